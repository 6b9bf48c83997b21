"""Options from configuration text, choices among matches, merged documents, links and titles of references."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tagweave.functions import mapping, settings
from tagweave.functions import references as R
from tagweave.functions import text as X
from tagweave.operators import documents, segments, sequences

_ = None


def test_tag_options():
    got = settings.tag_options(mapping.read('[a]\nx = p\nx.merge = false\nx.match-prefix-regex = "no[.]"\n[b]\nx.extend-to-line = no\nx.merge = true\ny = q\ny.alternative-spellings =\n  one=1,I\n  two=2\ny.max-chunks = 3\ny.block = z\n'))
    assert got["x"] == settings.TagOptions(match_prefix="no[.]", extend_to_line=False)
    assert got["y"] == settings.TagOptions(spellings={"one": ["1", "I"], "two": ["2"]}, max_chunks=3, block="z")
    with pytest.raises(ValueError):
        settings.tag_options({"a": {"x": "", "x.merge": "perhaps"}})
    o = settings.segmentation_options("[tags]\nfront = title, abstract\nbody = p\n[config]\nfront_max_start_line_index = 7\n")
    assert o.sections == {"front": ["title", "abstract"], "body": ["p"]} and (o.front_limit, o.header_before) == (7, 50)
    assert documents.sections_of(o.sections) == {"title": "front", "abstract": "front", "p": "body"}
    assert settings.resolve("tei:a/tei:b[@xml:id]", {"tei": "u", "xml": "v"}) == "{u}a/{u}b[@{v}id]"
    assert settings.match_prefix(r"{no}\.$", {"no": "1.2"}) == r"1\.2\.$" and settings.match_prefix("{no}", {}) == "NOT_FOUND"


def test_links_and_titles():
    a, b = "http://a.b/", "https://c.d/e"
    link = lambda t, h: f'<ext-link xmlns:xlink="http://www.w3.org/1999/xlink" ext-link-type="uri" xlink:href="{h}">{t}</ext-link>'
    got, changed = R.fix_reference(f"<ref>x {link(a + b, a + 'w' + b)} y</ref>")
    assert changed and got.count("<ext-link") == 2 and got.endswith("</ext-link> y</ref>") and f">{a}<" in got and f'href="{b}"' in got
    assert R.fix_reference(f"<ref>{link(a + b, 'http://z/')}</ref>")[0].count("<ext-link") == 1
    assert R.fix_reference("<ref>a <article-title>“A title”; PMC12</article-title></ref>", False)[0] == "<ref>a “<article-title>A title</article-title>”; PMC12</ref>"
    assert R.fix_reference('<ref><pub-id pub-id-type="ARXIV">1</pub-id></ref>')[0] == '<ref><pub-id pub-id-type="arxiv">1</pub-id></ref>'


def test_reference_names():
    doi = settings.REFERENCES.prefixes
    tags = [g for _t, g in R.post_process([("see", _), ("DOI", _), (":", _), ("12", "b-reference-doi"), ("A", "b-reference-author"), (".", _)], settings.REFERENCES.names, doi, settings.REFERENCES.marker)]
    assert tags == [_, "b-reference-doi", "i-reference-doi", "i-reference-doi", "b-reference-author", "i-reference-author"]


def test_pages(spark):
    run = lambda rows: [r["section"] for r in segments.page_numbers(spark.createDataFrame([(1, i, t, s) for i, (t, s) in enumerate(rows)], "d int, line_no int, text string, section string"), "d").orderBy("line_no").collect()]
    # pages before the first known one count from 1; each one taken raises the least by one
    assert run([("1", _), ("5", _), ("3", "page"), ("3", _), ("4", _), ("12345678901", _), ("9", "page"), ("10", _)]) == ["page", _, "page", "page", "page", _, "page", _]
    assert run([("x", "page"), ("1", _), ("4", "page")]) == ["page", "page", "page"]
    tokens = spark.createDataFrame([(d, p, i, 0, t) for d, p, firsts in ((1, 1, "1 2 3 4 1 5 6 7"), (1, 2, "1 3 x"), (2, 1, "10 11 1 2 3"), (3, 1, "₃ ₃ ₃")) for i, t in enumerate(firsts.split())], "d int, p int, line_no int, token_no int, token string")
    got = sorted(tuple(r) for r in segments.line_numbers(tokens, ["d", "p"], 2, 0).collect())
    assert got == [(1, 1, i) for i in (0, 1, 2, 3, 5, 6, 7)] + [(2, 1, i) for i in (2, 3, 4)]


def test_documents(spark):
    a = spark.createDataFrame([(1, 0, "x", "b-a"), (1, 1, "y", _)], "d int, at int, token string, tag string")
    b = spark.createDataFrame([(1, 0, "x", ""), (1, 1, "y", "b-b")], a.schema)
    assert [r["tag"] for r in documents.merge_documents(a, b, ["d", "at"], "token", "tag").orderBy("at").collect()] == ["b-a", "b-b"]
    assert [r["other"] for r in documents.merge_documents(a, b, ["d", "at"], "token", "tag", "other").orderBy("at").collect()] == [_, "b-b"]
    for worse in (b.filter("at = 0"), b.withColumn("token", F.lit("z"))):
        with pytest.raises(PySparkException):
            documents.merge_documents(a, worse, ["d", "at"], "token", "tag").collect()
    t = spark.createDataFrame([(1, i, g, p) for i, (g, p) in enumerate([("b-x", _), (_, _), (_, "b-k"), (_, _), ("b-y", _), (_, _)])], "d int, at int, tag string, old string")
    assert [r["tag"] for r in sequences.merge_groups(t, "d", "at", "tag", {"x": "g"}, "tag", preserved="old").orderBy("at").collect()] == ["b-x", "i-g", _, _, "b-y", _]
    assert [r["tag"] for r in sequences.expand_on(t, "d", "at", "tag", ["x", "k"], "tag", preserved="old").orderBy("at").collect()] == ["b-x", "i-x", _, "i-k", "b-y", _]


def test_columns(spark):
    row = spark.range(1).select(
        X.by_scope(F.create_map(*[F.lit(x) for x in ("tag", "a", "s-tag", "b", "other", "c")]), "tag").alias("m"), X.skip_blanks(F.lit("ab  c"), F.lit(2)).alias("skip"),
        X.flatten_all(F.array(F.array(F.array(F.lit(1)), F.array(F.lit(2)))), 2).alias("flat"), X.normalise_all(F.array(F.lit("A–B"))).alias("n"), X.item(F.array(F.lit(1), F.lit(2)), -2).alias("i"), X.item(F.array(F.lit(1)), 5).alias("none"),
        X.moved_range(F.struct(F.lit(1).alias("start"), F.lit(2).alias("end")), F.lit(10)).alias("r"), X.without_junk(F.lit("A. B., aab*")).alias("j"),
    ).collect()[0]
    assert row["m"] == {"": "a", "s": "b"} and row["skip"] == 4 and row["flat"] == [1, 2] and row["n"] == ["a-b"] and (row["i"], row["none"]) == (1, _) and tuple(row["r"]) == (11, 12)
    assert row["j"] == "AB ab"
    assert X.scoped("tag", "s", 2) == "s-level2_tag" and X.scoped("tag") == "tag"
