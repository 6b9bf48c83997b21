"""Which target passages documents hold: exact spans, the tokens they cover and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.session import ship

#: Items that may be broadcast; more are joined by a shuffle of ids and tokens, not of texts.
BROADCAST_ITEMS = 100_000


def exact_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end (code points): the first place of each item's text in each document.

    An item's tokens between its first and last blank stand in any document
    that holds the item, between blanks too.  The longest of them is the join key;
    items without such a token are compared with every document, in blocks.
    """
    parts = items.filter("length(text) > 0").select("item_id", F.col("text").alias("item"), F.split("text", " ").alias("w"))
    inner = F.expr("if(size(w) > 2, slice(w, 2, size(w) - 2), array())")
    longest = F.reduce(inner, F.lit("").cast("string"), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    keyed = parts.select("item_id", "item", longest.alias("key"))
    small = items.count() <= BROADCAST_ITEMS
    hint = F.broadcast if small else lambda df: df
    tokens = docs.select("doc_id", *(["text"] if small else []), F.explode(F.array_distinct(F.split("text", " "))).alias("key"))
    joined = tokens.join(hint(keyed.filter("key <> ''")), "key")
    if not small:
        joined = joined.join(docs.select("doc_id", "text"), "doc_id")
    both = joined.select("doc_id", "item_id", "text", "item")
    short = keyed.filter("key = ''")
    if n_short := short.count():
        # a stated set of short items against all rows: blocks of bounded size are broadcast one by one
        for b in range(-(-n_short // BROADCAST_ITEMS)):
            block = short.filter(F.pmod(F.xxhash64("item_id"), F.lit(-(-n_short // BROADCAST_ITEMS))) == b)
            rest = docs.select("doc_id", "text").join(F.broadcast(block), F.expr("contains(text, item)"))
            both = both.unionByName(rest.select("doc_id", "item_id", "text", "item"))
    start = F.instr(F.col("text"), F.col("item")) - 1
    return both.withColumn("start", start.cast("long")).filter("start >= 0").select("doc_id", "item_id", "start", (F.col("start") + F.length("item")).alias("end"))


def passage_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_spans(ship(spark).read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"passage_spans": passage_spans}
ORACLES = {
    "passage_spans": """SELECT doc_id, item_id, CAST(strpos(d.text, b.text) - 1 AS BIGINT) AS start, CAST(strpos(d.text, b.text) - 1 + length(b.text) AS BIGINT) AS "end"
FROM documents d JOIN benchmark b ON length(b.text) > 0 AND contains(d.text, b.text)"""
}
