"""Sections of lines, line numbers and order-dependent tag operators."""

from pyspark.sql import functions as F

from tagweave.operators import segments as G
from tagweave.operators import sequences as S


def _lines(spark, rows):
    return spark.createDataFrame([(1, i, t, s, False) for i, (t, s) in enumerate(rows)], "id int, line_no int, text string, section string, has_page boolean")


def _sections(df):
    return [r["section"] for r in df.orderBy("line_no").collect()]


def test_segment(spark):
    rows = [("the title", "front"), ("more", None), ("by me", "front"), ("text", None), ("My Journal x", None), ("a", "reference"), ("My Journal x", None), ("b", None), ("c", "reference"), ("tail", None)]
    assert _sections(G.segment(_lines(spark, rows), "id")) == ["front", "front", "front", "body", "headnote", "reference", "headnote", "reference", "reference", "body"]
    assert _sections(G.segment(_lines(spark, [("x", None), ("y", "annex"), ("z", None)]), "id")) == ["body", "annex", "annex"]
    assert _sections(G.segment(_lines(spark, [("x", None), ("y", "front"), ("z", None)]), "id", preserve=True)) == ["front", "front", None]
    late = [(str("w" + chr(97 + i)), "front" if i in (0, 5) else None) for i in range(7)]
    assert _sections(G.segment(_lines(spark, late), "id", front_limit=3)) == ["front"] + ["body"] * 6
    pages = [("1", "page"), ("2", None), ("9", None), ("3", None), ("5", "page"), ("6", None)]
    assert _sections(G.page_numbers(_lines(spark, pages), "id")) == ["page", "page", None, "page", "page", None]
    assert G.segment(_lines(spark, []), "id").count() == 0


def test_line_numbers(spark):
    def found(firsts, **k):
        t = spark.createDataFrame([(1, i, 0, x) for i, x in enumerate(firsts)] + [(1, i, 1, "word") for i in range(len(firsts))], "id int, line_no int, token_no int, token string")
        return sorted(r["line_no"] for r in G.line_numbers(t, "id", **k).collect())

    assert found(["1", "2", "3", "4"]) == [0, 1, 2, 3]
    assert found(["1", "a", "b", "c"]) == [] and found(["1", "10", "20", "30"]) == [] and found(["4", "3", "2", "1"]) == []
    assert found(["₃", "1", "2", "3", "4"]) == [1, 2, 3, 4]
    assert found(["1", "2", "x", "3"]) == [0, 1, 3]


def test_tags(spark):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate([None, None, "b-a", "i-a", None, "b-x", None])], "id int, p int, tag string")
    got = lambda d: [r["new"] for r in d.orderBy("p").collect()]
    assert got(S.expand_back(df, "id", "p", "tag", ["a"], "new")) == ["b-a", "i-a", "i-a", "i-a", None, "b-x", None]
    assert got(S.expand_on(df, "id", "p", "tag", ["a"], "new")) == [None, None, "b-a", "i-a", "i-a", "b-x", None]
    assert got(S.merge_groups(df, "id", "p", "tag", {"a": "g", "x": "g"}, "new")) == [None, None, "b-g", "i-g", "i-g", "i-g", None]
    toks = spark.createDataFrame([(1, i, t, g) for i, (t, g) in enumerate([("A", "b-a"), (" ", None), ("B", "i-a"), (" ", None), ("C", None), (" ", None), ("D", "b-d")])], "id int, p int, t string, tag string")
    assert [r["t"] for r in S.drop_untagged(toks, "id", "p", "tag", F.trim("t") == "").orderBy("p").collect()] == ["A", " ", "B", " ", "D"]
    assert [r["s"] for r in S.trailing_space(toks, "id", "p", "t", "s").orderBy("p").collect()] == [" ", "", " ", "", " ", "", None]
    words = S.trailing_space(toks, "id", "p", "t", "s").filter("trim(t) <> ''")
    assert [(r["name"], r["text"]) for r in S.entities(words, "id", "p", "tag", "t", "s").orderBy("first").collect()] == [("a", "A B"), ("d", "D")]
    r = spark.createDataFrame([(1, 2, 4, 10), (1, 3, 6, 10), (1, 8, 9, 10)], "id int, s int, e int, n int")
    assert sorted((x["start"], x["end"]) for x in S.gaps(r, "id", "s", "e", "n").collect()) == [(0, 2), (6, 8), (9, 10)]
    assert [(x["start"], x["end"]) for x in S.offsets(toks, "id", "p", "t").orderBy("p").collect()] == [(i, i + 1) for i in range(7)]
    c = spark.createDataFrame([(1, 0, "b-x", "b-a"), (1, 1, None, "i-a"), (1, 2, None, "b-c")], "id int, p int, tag string, old string")
    assert [x["old"] for x in S.clear_replaced(c, ["id"], "tag", "old").orderBy("p").collect()] == [None, None, "b-c"]
