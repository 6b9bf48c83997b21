"""Reference tags and the repair of reference markup."""

import xml.etree.ElementTree as ET

import pytest

from tagweave.functions import references as R
from tagweave.operators import references as O

_ = None


def _tags(f, text, tags):
    return [g for _, g in f(list(zip(text, tags)))]


def test_folds():
    assert _tags(R.extend_prefix, ["x", " ", "doi", ":", "10"], [_, _, _, _, "b-idno"]) == [_, _, "b-idno", "i-idno", "i-idno"]
    assert _tags(R.extend_prefix, ["x", ",", "10"], [_, _, "b-idno"]) == [_, _, "b-idno"]
    assert _tags(R.extend_suffix, ["A", ".", "x"], ["b-author", _, _]) == ["b-author", "i-author", _]
    assert _tags(R.map_et_al, ["A", " ", "et", "al"], ["b-author", _, "b-etal", "i-etal"]) == ["b-author", _, "b-author", "i-author"]
    assert _tags(R.map_et_al, ["A", "et"], ["b-title", "b-etal"]) == ["b-title", "b-etal"]
    assert _tags(R.post_process, ["A", " ", "B", " ", "et", "t"], ["b-author", _, "b-author", _, "b-etal", "b-title"]) == ["b-author", "i-author", "i-author", "i-author", "i-author", "b-title"]
    both = frozenset({"t", "u"})
    run = lambda tags, m=both, e=both: _tags(lambda t: R.extend_to_lines(t, m, e), "abcdefgh", tags)
    assert run(["b-t", _, "b-t"]) == ["b-t", "i-t", "i-t"]
    assert run(["b-t", "i-t", _]) == ["b-t", "i-t", "i-t"] and run(["b-t", "i-t", _], e=frozenset()) == ["b-t", "i-t", _]
    assert run([_, "b-t", "i-t"]) == ["b-t", "i-t", "i-t"]
    # the gap between two values stays
    assert run(["b-t", _, _, "b-u", "i-u", "i-u"]) == ["b-t", _, _, "b-u", "i-u", "i-u"]
    assert run(["t", _, "t"]) == ["t", "t", "t"] and run([_, "t", "t"]) == ["t", "t", "t"] and run(["b-t", "b-t"]) == ["b-t", "i-t"]
    assert run([_, _, "b-t", "i-t"]) == [_, _, "b-t", "i-t"] and run([_, "b-t", "i-t"], e=frozenset()) == [_, "b-t", "i-t"]
    assert run(["b-t", _, "b-t"], m=frozenset()) == ["b-t", _, "b-t"]
    assert run([]) == []


@pytest.mark.parametrize(
    "ref, fixed",
    [('<ref>doi: <pub-id pub-id-type="DOI">10.1234/a</pub-id></ref>', '<ref>doi: <pub-id pub-id-type="doi">10.1234/a</pub-id></ref>'),
     ('<ref>doi: <pub-id pub-id-type="doi">not a doi</pub-id>.</ref>', "<ref>doi: not a doi.</ref>"), ('<ref>x <pub-id pub-id-type="doi">doi:10.1234/a</pub-id></ref>', '<ref>x doi:<pub-id pub-id-type="doi">10.1234/a</pub-id></ref>'),
     ("<ref>t. PMID: 123. PMC77 10.1234/b.</ref>", '<ref>t. PMID: <pub-id pub-id-type="pmid">123</pub-id>. <pub-id pub-id-type="pmcid">PMC77</pub-id> <pub-id pub-id-type="doi">10.1234/b</pub-id>.</ref>')],
)
def test_fix(ref, fixed):
    got, changed = R.fix_reference(ref)
    assert got == fixed and changed
    assert "".join(ET.fromstring(got).itertext()) == "".join(ET.fromstring(ref).itertext())
    assert R.fix_reference(got) == (got, False)


def test_doi_link():
    got, _c = R.fix_reference('<ref>some https : // doi . org / <pub-id pub-id-type="doi">10.1234/a</pub-id> tail</ref>')
    e = ET.fromstring(got)[0]
    assert e.tag == "ext-link" and e.text == "https : // doi . org / 10.1234/a" and e.get("{http://www.w3.org/1999/xlink}href") == "https://doi.org/10.1234/a" and e.tail == " tail"


def test_frames(spark):
    t = spark.createDataFrame([(1, 0, "A", "b-author"), (1, 1, ".", None), (2, 0, "A", None)], "ref int, token_no int, token string, tag string")
    assert [(r["ref"], r["tag"]) for r in O.post_process(t, ["ref"]).orderBy("ref", "token_no").collect()] == [(1, "b-author"), (1, "i-author"), (2, None)]
    refs = spark.createDataFrame([(1, "a", "<ref>PMID: 1</ref>"), (1, "b", "<ref>x</ref>"), (1, "c", None), (1, "d", "<ref>")], "doc int, id string, xml string")
    assert O.changed_summary(O.fix_references(refs, "xml"), "doc", "id").collect()[0][1:] == (1, "a")
