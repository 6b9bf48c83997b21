"""Identifiers, mappings and target values."""

import pytest
from pyspark.sql import functions as F

from tagweave.functions import ident as I
from tagweave.functions import mapping as P
from tagweave.functions.markup import parse

CASES = [
    (I.doi, "doi: 10.1234/a.b", "10.1234/a.b"), (I.doi, "x 10.1234.1.2.3/test.", "10.1234.1.2.3/test"), (I.doi, "[10.1234/a]", "10.1234/a"), (I.doi, "10.1234/a[test]", "10.1234/a[test]"),
    (I.doi, "10.1234/a [doi]", "10.1234/a"), (I.doi, "10.1234/a PMID: 12", "10.1234/a"), (I.doi, "10.1234/a (Epub 2001)", "10.1234/a"), (I.doi, "10.1234/a 10.1234/a", "10.1234/a"), (I.doi, "10.1234/a;", "10.1234/a"),
    (I.doi, "10.1234/a S0123 [pii]", "10.1234/a"), (I.doi, "none", ""), (I.doi_url_prefix, "x: https://dx.doi.org/10", "https://dx.doi.org/"), (I.pii_valid, "S0123-123X(11)01234-X", "S0123-123X(11)01234-X"), (I.pii_valid, "S0123", ""),
    (I.pmid, "PMID: 123", "123"), (I.pmid, "123", ""), (I.pmid_fix, "123", "123"), (I.pmcid, "Pmc1234", "Pmc1234"), (I.wos, "wos:000123456789012", "000123456789012"), (I.article_title, "A title; PMC123", "A title"),
    (I.article_title, "A; title", "A; title"), (I.article_title, "“A title”", "A title"), (I.article_title, "A title , ", "A title"), (I.ext_link, "https://doi.org/10.1234/a [10.1234/a]", "https://doi.org/10.1234/a"),
    (I.split_urls, "http://a.b/https://c.d", ["http://a.b/", "https://c.d"]), (lambda c: I.matched(c, r"(\d+)x"), "12x", "12"), (lambda c: I.matched(c, r"(\d+)x"), "a12x", "a12x"),
    (I.without_punctuation, "a.b—c d", "abc d"), (I.spaced_words, "a.b  c", "a . b c"), (lambda c: I.rename(c, r"/(.*)\.x/\1.y/"), "f.x", "f.y"),
]


def test_identifiers(spark):
    df = spark.range(1)
    row = df.select(*[f(F.lit(t)).alias(str(i)) for i, (f, t, _) in enumerate(CASES)]).collect()[0]
    assert [(t, row[str(i)]) for i, (_, t, _) in enumerate(CASES)] == [(t, w) for _, t, w in CASES]
    with pytest.raises(ValueError):
        I.rename(F.lit("a"), "/a/b")


def test_config():
    m = P.read("[article]\na = x/y\na.regex = (.*)\na.sub.b = z\na.sub.c = w\nd = q\n")
    assert P.keep_fields(m["article"], ["a"], ["b"]) == {"a": "x/y", "a.regex": "(.*)", "a.sub.b": "z"}
    assert P.override(m, {"d": "e"})["article"]["d"] == "e"
    assert P.list_algebra("+c,-a", ["a", "b"]) == ["b", "c"] and P.list_algebra("x, y", ["a"]) == ["x", "y"]
    with pytest.raises(ValueError):
        P.list_algebra("-z", ["a"])
    assert P.parse_pairs("a=b|c=d") == {"a": "b", "c": "d"} and P.parse_pairs(" ") == {}
    assert P.spellings("a=b, c\n\nd=e") == {"a": ["b", "c"], "d": ["e"]}


def test_targets():
    xml = """<article><front><t>A <i>big</i> title</t><c type="author"><n><s>Doe</s><g>Jane</g></n></c><c><n><s>Roe</s></n></c><c type="x"><n><s>No</s></n></c>
    <id t="doi">10.1/x</id><kw><k type="a">one</k><k>two</k></kw></front><ref><fp>3</fp><lp>5</lp></ref><fig><label>1</label><cap>A fig</cap></fig></article>"""
    m = P.read(
        "[article]\ntitle = front/t\nauthor = front/c[not(@type) or @type=\"author\"]/n\nauthor.children = .//*\nauthor.sub.surname = ./s\nid = front/id[@t='doi']\nid.regex = 10\\.(.*)\n"
        'page = ref\npage.children = fp|lp\npage.children.range = [{"min": {"xpath": "fp"}, "max": {"xpath": "lp"}, "standalone": true}]\n'
        'fig = fig\nfig.priority = 1\nfig.children = ./label | ./cap\nfig.children.concat = [[{"xpath": "./label"}, {"value": " "}, {"xpath": "./cap"}]]\nkw = front/kw\nkw.children = k[not(@type)]\nnone = q/r\n'
    )
    root = parse(xml)[0]
    got = [(t["field"], t["values"]) for t in P.targets(root, m)]
    assert got == [("fig", ["1 A fig"]), ("title", ["A big title"]), ("author", ["Jane", "Doe"]), ("author", ["Roe"]), ("id", ["1/x"]), ("kw", ["two"]), ("page", ["3"]), ("page", ["4"]), ("page", ["5"])]
    assert [s for t in P.targets(root, m) for s in t["sub"]] == [{"field": "surname", "values": ["Doe"]}, {"field": "surname", "values": ["Roe"]}]
    with pytest.raises(ValueError):
        P.targets(parse("<other/>")[0], m)
    assert P.extract("ab12cd", r"(\d+)") == ["ab", "12", "d", "ab12cd"]
    t = P.Tree(root)
    assert [e.tag for e in t.find("front/*[not(self::t)]")] == ["c", "c", "c", "id", "kw"] and len(t.find("//s")) == 3
