"""File sources, sinks and incremental runs."""

import gzip

import pytest
from pyspark.sql import functions as F

from tagweave.sources import files as S
from tagweave.streaming import incremental


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, t in (("a.xml", "<a/>"), ("b.xml", "<b>\n</b>"), ("c.txt", "c")):
        (tmp_path / "in" / n).write_text(t)
    (tmp_path / "in" / "d.xml.gz").write_bytes(gzip.compress(b"<d/>"))
    df = S.read_texts(spark, f"{tmp_path}/in", "*.xml*")
    assert sorted((r["path"].rsplit("/", 1)[1], r["text"]) for r in df.collect()) == [("a.xml", "<a/>"), ("b.xml", "<b>\n</b>"), ("d.xml.gz", "<d/>")]
    assert S.read_texts(spark, f"{tmp_path}/in", "*.xml", limit=1).count() == 1 and S.read_texts(spark, "", single=f"{tmp_path}/in/c.txt").count() == 1
    assert S.read_binaries(spark, f"{tmp_path}/in", "*.txt").count() == 1
    (tmp_path / "l.tsv").write_text("x\tsource_url\n1\tu/a.xml\n2\tu/b.xml\n")
    (tmp_path / "l.lst").write_text("u/a.xml\n\nu/c.xml\n")
    assert [r["path"] for r in S.file_list(spark, f"{tmp_path}/l.tsv").collect()] == ["u/a.xml", "u/b.xml"]
    assert S.file_list(spark, f"{tmp_path}/l.lst").count() == 2 and S.file_list(spark, f"{tmp_path}/l.lst", limit=1).count() == 1
    made = S.write_files(df.withColumn("path", S.output_path(F.col("path"), f"{tmp_path}/out/x")), "path", "text")
    assert sum(r["n_bytes"] for r in made.collect()) == 16 and (tmp_path / "out/x/b.xml").read_text() == "<b>\n</b>"


def test_names_and_joins(spark, tmp_path):
    p = spark.createDataFrame([("u/v/a.b.xml.gz", 3)], "path string, i int")
    assert p.select(S.output_name("{document.name}-{index}/{name}.tei{ext}|{dir}|{filename}", F.col("path"), F.col("i"), F.lit("D")).alias("o")).collect()[0]["o"] == "D-3/a.b.tei.xml|u/v|a.b.xml.gz"
    with pytest.raises(ValueError):
        S.output_name("{x}", F.col("path"))
    assert p.select(S.output_path(F.col("path"), "o/", "u").alias("o")).collect()[0]["o"] == "o/v/a.b.xml.gz"
    t = spark.createDataFrame([("s/1.tei.xml", "t1"), ("s/2.tei.xml", "t2")], "path string, text string")
    j = S.join_targets(t, spark.createDataFrame([("x/1.xml", "j1")], t.schema), r"\.tei\.xml$", ".xml")
    assert [(r["path"], r["target_text"]) for r in j.collect()] == [("s/1.tei.xml", "j1")]
    assert [r["path"] for r in S.unfinished(t, spark.createDataFrame([("o/1.tei.xml",)], "path string"), "o").collect()] == ["s/2.tei.xml"]
    a, b = (spark.createDataFrame([(0, f"{x}0"), (1, f"{x}1")], "index int, path string") for x in "ab")
    assert [r["index"] for r in S.pairs(a, b, spark.createDataFrame([("a0",), ("b0",), ("a1",)], "path string")).collect()] == [0]
    S.write_documents(spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, passed boolean"), f"{tmp_path}/ok", f"{tmp_path}/bad")
    assert (spark.read.parquet(f"{tmp_path}/ok").count(), spark.read.parquet(f"{tmp_path}/bad").count()) == (2, 1)
    spans = spark.createDataFrame([(1, "t", 0, 0, 4, 6)], "doc int, field string, ordinal int, part int, start long, end long")
    report = S.match_report(spans, spark.createDataFrame([(1, "abc de")], "doc int, text string"), "doc")
    assert [(r["id"], r["matched"]) for r in report.collect()] == [(1, "de")]
    S.write_report(report, f"{tmp_path}/r.tsv")
    assert spark.read.csv(f"{tmp_path}/r.tsv", header=True, sep="\t").count() == 1


def test_incremental(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: incremental.annotate_new(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp", lambda d: d.select("path", F.length("text").alias("n")), "*.txt").awaitTermination(60)
    (tmp_path / "in/a.txt").write_text("aaa")
    assert run()
    (tmp_path / "in/b.txt").write_text("bb")
    assert run() and run()
    assert sorted(r["n"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [2, 3]


def test_encodings_and_copies(spark, tmp_path):
    raw = spark.createDataFrame([(1, "<?xml version='1.0' encoding='iso-8859-1'?>\n<a>é</a>".encode("latin-1")), (2, "<b>é</b>".encode())], "id int, raw binary")
    got = raw.select("id", S.declared_encoding(F.col("raw")).alias("e"))
    assert [r["e"] for r in got.orderBy("id").collect()] == ["ISO-8859-1", "UTF-8"]
    out = got.select("id", S.with_declaration(F.lit("<a>é</a>"), F.col("e")).alias("x")).orderBy("id").collect()
    assert bytes(out[0]["x"]) == "<?xml version='1.0' encoding='ISO-8859-1'?>\n<a>é</a>".encode("latin-1") and bytes(out[1]["x"]).endswith("<a>é</a>".encode())
    (tmp_path / "one.gz").write_bytes(b"x" * 9_000_000)
    done = S.copy_files(spark.createDataFrame([(f"{tmp_path}/one.gz", f"{tmp_path}/to/two.gz")], "source string, target string")).collect()
    assert done[0]["n_bytes"] == 9_000_000 and (tmp_path / "to/two.gz").read_bytes() == b"x" * 9_000_000
