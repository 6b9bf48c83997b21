"""Markup repair, node tables, paths and round trips."""

import pytest

from tagweave.functions import markup as M
from tagweave.operators import trees

A = "<tei><text><figure"


@pytest.mark.parametrize(
    "broken, fixed",
    [("<tei><text>abc</text></tei>", None), ('<tei xmlns="http://www.tei-c.org/ns/1.0"><text>abc</text></tei>', None), (f"{A}>abc</p></text></tei>", f"{A}>abc</figure></text></tei>"),
     (f"{A}>abc</p><figure>abc</p></text></tei>", f"{A}>abc</figure><figure>abc</figure></text></tei>"), (f"{A}>abc</text></tei>", f"{A}>abc</figure></text></tei>"),
     (f'{A} a="1 &amp; 2">a &gt; b &apos;</p></text></tei>', f'{A} a="1 &amp; 2">a &gt; b \'</figure></text></tei>'), ("<a>x<br/>y", "<a>x<br></br>y</a>")],
)
def test_repair(broken, fixed):
    assert M.repair(broken) == (fixed or broken)
    assert M.parse(M.repair(broken))[0] is not None


def test_parse_error():
    assert M.parse("<a>\n</b>\n</a>")[:2] == (None, "</b>")
    assert M.parse("  \n<a/>")[0] is not None
    assert M.drop_dangling("a</content>") == "a" and M.drop_dangling("<content>a</content>") == "<content>a</content>"


def test_lines_round_trip():
    source = '<tei><text><front>A title<lb/>goes on</front> <note type="x">1</note><lb/>rest</text></tei>'
    root = M.parse(source)[0]
    lines = M.lines(root, "text")
    assert ["".join(t for t, _ in line) for line in lines] == ["A title", "goes on 1", "rest"]
    assert [g for _, g in lines[0]] == ["b-front", "i-front", "i-front"] and lines[2] == [("rest", "")]
    assert M.serialise(lines, {"note": 'note[@type="x"]'}) == source
    assert M.tokenize("aB c.1") == ["a", "B", " ", "c", ".", "1"]
    two = [[("a", "b-x"), ("b", "b-x"), ("C", "i-x")]]
    assert M.lines(M.parse(M.serialise(two, {}))[0], "text") == two


def test_trees(spark):
    docs = spark.createDataFrame([(1, '<r><a t="x">1<b>2</b></a><a>3<c><b>4</b></c></a></r>'), (2, "<r><a>5"), (3, None)], "id int, xml string")
    n = trees.shred(docs, "id", "xml").cache()
    got = lambda p: sorted((r["id"], r["content"]) for r in trees.select(n, "id", p).collect())
    assert got("/r/a") == [(1, "12"), (1, "34"), (2, "5")]
    assert got("//a//b") == [(1, "2"), (1, "4")] and got("//a/b") == [(1, "2")]
    assert got('//a[@t="x"]|//c') == [(1, "12"), (1, "4")] and got("//a[not(@t)]") == [(1, "34"), (2, "5")]
    assert [r["tag"] for r in trees.without_parents(trees.select(n, "id", "//c|//c/b"), "id").collect()] == ["b"]
    with pytest.raises(ValueError):
        trees.select(n, "id", "//a[position()=1]")
    assert [(r["id"], r["s"]["ok"]) for r in docs.select("id", trees.parse_status("xml").alias("s")).collect()] == [(1, True), (2, False), (3, None)]
    t = trees.token_lines(docs, "id", "xml")
    assert [r["xml"] for r in trees.to_markup(t.filter("id = 1"), "id", {}, "r").collect()] == ["<r><a>1<b>2</b></a><a>3<c><b>4</b></c></a></r>"]
