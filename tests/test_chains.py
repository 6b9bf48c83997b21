"""Chains from training markup and articles to new markup; the command line."""

from tagweave import cli
from tagweave.functions.settings import LineNumberOptions, MatchOptions, TagOptions
from tagweave.operators import chains

TEI = "<tei><text><front>A Study of Many Things<lb/>Jane Doe , John Roe<lb/>Abstract we studied them<lb/></front></text></tei>"
ARTICLE = "<article><t>A study of many things</t><a><s>Jane</s><n>Doe</n></a><a><s>John</s><n>Roe</n></a></article>"
SECTIONS = {"article": {"title": "t", "author": "a", "author.sub.given": "s", "author.children": "s|n", "author.children.concat": '[[{"xpath": "s"}, {"value": " "}, {"xpath": "n"}]]'}}


def test_run(spark):
    docs, articles = (spark.createDataFrame([(1, x), (2, None)], "id int, xml string") for x in (TEI, ARTICLE))
    got = {r["id"]: r for r in chains.run(docs, articles, "id", "xml", SECTIONS, container="front", required=("title",), matching=("title",)).collect()}
    assert set(got) == {1} and got[1]["passed"]
    assert '<note type="title">A Study of Many Things</note><lb/>' in got[1]["xml"] and '<note type="author">Jane Doe' in got[1]["xml"]


def test_sub_tags(spark):
    docs = chains.document_tokens(spark.createDataFrame([(1, TEI)], "id int, xml string"), "id", "xml", "front")
    targets = spark.createDataFrame([(1, 0, "author", ["Jane Doe"], [{"field": "given", "values": ["Jane"]}])], "id int, ordinal int, field string, values array<string>, sub array<struct<field:string,values:array<string>>>")
    from pyspark.sql import functions as F

    old = docs.withColumn("tag", F.lit("i-old"))
    got = chains.sub_tags(targets, "id", MatchOptions(tags={"author": TagOptions()}))(old).filter("sub_tag is not null").collect()
    assert [(r["token"], r["tag"], r["sub_tag"]) for r in got] == [("Jane", "i-old", "b-given")]
    numbered = spark.createDataFrame([(1, f"<t>{''.join(f'{i} some words<lb/>' for i in range(1, 15))}</t>")], "id int, xml string")
    tokens = chains.number_lines(chains.document_tokens(numbered, "id", "xml"), "id", MatchOptions(line_numbers=LineNumberOptions()))
    assert tokens.filter("tag = 'b-line_no'").count() == 14


def test_command_line(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "xml").mkdir()
    (tmp_path / "raw" / "d1.header.tei.xml").write_text(TEI)
    (tmp_path / "xml" / "d1.xml").write_text(ARTICLE)
    (tmp_path / "map.conf").write_text("[article]\ntitle = t\nauthor = a/n\n")
    args = ["annotate", "--docs", f"{tmp_path}/raw", "--articles", f"{tmp_path}/xml", "--mapping", f"{tmp_path}/map.conf", "--out", f"{tmp_path}/out", "--fields", "title", "--required-fields", "title"]
    cli.main(args, spark)
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(rows) == 1 and '<note type="title">A Study of Many Things</note>' in rows[0]["xml"] and "author" not in rows[0]["xml"]
    (tmp_path / "refs").mkdir()
    (tmp_path / "refs" / "r.xml").write_text("<ref>PMID: 12</ref>")
    cli.main(["fix-references", "--docs", f"{tmp_path}/refs", "--out", f"{tmp_path}/fixed"], spark)
    assert spark.read.parquet(f"{tmp_path}/fixed").collect()[0]["changed"]
