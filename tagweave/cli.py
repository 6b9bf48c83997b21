"""Command line: annotate training markup with articles' values, repair reference markup, or name output files.

    python -m tagweave.cli annotate --docs DIR --articles DIR --mapping FILE --out DIR [--model header] [--required-fields a,b] ...
    python -m tagweave.cli fix-references --docs DIR --out DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions import mapping
from tagweave.functions.settings import CONTAINERS, LineNumberOptions, MatchOptions
from tagweave.operators import chains
from tagweave.operators import references as O
from tagweave.session import ship
from tagweave.sources import files

STEPS = {"header": chains.annotator, "segmentation": chains.annotator, "fulltext": chains.annotator, "reference": chains.reference}


def _names(text: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in text.split(",") if x.strip())


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tagweave")
    commands = top.add_subparsers(dest="command", required=True)
    a = commands.add_parser("annotate")
    a.add_argument("--docs", required=True)
    a.add_argument("--articles", required=True)
    a.add_argument("--mapping", required=True)
    a.add_argument("--mapping-overrides", default="", help="a=b|c=d")
    a.add_argument("--out", required=True)
    a.add_argument("--failed", help="where documents that fail the checks go")
    a.add_argument("--model", choices=sorted(STEPS), default="header")
    a.add_argument("--name-rule", default=r"/(.*)\.[a-z]+\.tei\.xml/\1.xml/", help="/pattern/replacement/ from a document's name to its article's")
    a.add_argument("--fields", default="")
    a.add_argument("--required-fields", default="")
    a.add_argument("--matching-fields", default="")
    a.add_argument("--threshold", type=float, default=0.8)
    a.add_argument("--line-numbers", action="store_true")
    a.add_argument("--limit", type=int)
    a.add_argument("--resume", action="store_true", help="leave out documents that have an output")
    f = commands.add_parser("fix-references")
    f.add_argument("--docs", required=True)
    f.add_argument("--out", required=True)
    return top


def _texts(spark: SparkSession, path: str) -> DataFrame:
    return ship(spark).read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("xml"))


def annotate(spark: SparkSession, o: argparse.Namespace) -> None:
    docs, articles = _texts(spark, o.docs), _texts(spark, o.articles)
    if o.resume and list(Path(o.out).glob("*.parquet")):
        docs = docs.join(spark.read.parquet(o.out).select("path"), "path", "left_anti")
    docs = docs.orderBy("path").limit(o.limit) if o.limit else docs
    sections = mapping.override(mapping.read(Path(o.mapping).read_text()), mapping.parse_pairs(o.mapping_overrides))
    if o.fields:
        sections = {s: mapping.keep_fields(m, list(_names(o.fields))) for s, m in sections.items()}
    _, pattern, replacement, _ = o.name_rule.split(o.name_rule[0])
    joined = files.join_targets(docs, articles.withColumnRenamed("xml", "text"), pattern, replacement.replace("\\", "$"))
    options = MatchOptions(threshold=o.threshold, line_numbers=LineNumberOptions() if o.line_numbers else None)
    done = chains.run(
        joined.select("path", "xml"), joined.select("path", F.col("target_text").alias("xml")), "path", "xml", sections, options, CONTAINERS[o.model].split("/")[-1],
        STEPS[o.model], _names(o.required_fields), _names(o.matching_fields),
    )
    files.write_documents(done, o.out, o.failed)


def fix_references(spark: SparkSession, o: argparse.Namespace) -> None:
    O.fix_references(_texts(spark, o.docs), "xml").write.mode("overwrite").parquet(o.out)


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    o = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("tagweave").getOrCreate()
    {"annotate": annotate, "fix-references": fix_references}[o.command](spark, o)


if __name__ == "__main__":
    main()
