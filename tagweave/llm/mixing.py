"""Mixing sources to target weights by hash-threshold histograms; DataFrame functions only.

A source's target is its weight's share of all words, at most `CEILING` times
the source's words; what is over goes to the other sources by weight until no
target is above (a threshold on ceiling / weight, found with one running sum over
the sources).  The target is whole passes over the source and a rest.  The rest
is filled by the documents whose 52-bit hash of doc_id lies below a threshold:
words are summed by source and hash bucket (LEVEL_BITS leading bits), the bucket
where the running sum passes the rest is refined by the next bits, and so on to
single hashes.  Nothing is sorted by document, and a hot source is only more
rows for the partial sums of each task.

Cases: null and empty texts have size 0 and take nothing; a null source is a
source of its own, last in order; documents that share a doc_id (and so its
hash) are taken or left together; a null doc_id hashes as an empty text; sources
without words have target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.llm.common import fresh, table

CEILING = 3.0
LEVEL_BITS = 13
LEVELS = 4
#: Sources whose plan (some 60 bytes each) may be broadcast; more are joined by shuffles that split hot keys.
BROADCAST_SOURCES = 50_000


def words(text: F.col) -> F.col:
    """The count of runs without white space."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("long")


def hashed(doc_id: F.col) -> F.col:
    """52 bits of the hash of doc_id."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", words(F.col("text")).alias("size"), hashed(F.col("doc_id")).alias("u"))


def targets(rows: DataFrame, weights: tuple[float, ...] = (1, 2, 3), ceiling: float = CEILING) -> DataFrame:
    """source, sid, source_size, target, whole and rest by source; rows has source and size."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # sources are few beside documents: these windows over all of them hold one row a source
    order = W.orderBy(F.col("source").asc_nulls_last())
    sums = sums.withColumn("sid", F.row_number().over(order))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    sums = sums.withColumn("weight", weight).withColumn("most", ceiling * F.col("source_size"))
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.orderBy(F.col("most") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("total", F.sum("source_size").over(everything)).withColumn("total_weight", F.sum("weight").over(everything))
    level = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.col("total_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    full = F.col("most") <= level * F.col("weight")
    sums = sums.withColumn("full", full)
    held = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("most")).otherwise((F.col("total") - held) / open_weight * F.col("weight"))
    sums = sums.withColumn("target", target)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sums = sums.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    return sums.select("source", "sid", "source_size", "target", "whole", "rest")


def _beside(rows: DataFrame, small: DataFrame, on: str, n: int) -> DataFrame:
    """Inner join with the table of sources, broadcast while it is small."""
    small = small.withColumnRenamed(on, f"{on}_")
    small = F.broadcast(small) if n <= BROADCAST_SOURCES else small
    return rows.join(small, rows[on].eqNullSafe(small[f"{on}_"])).drop(f"{on}_")


def plan(rows: DataFrame, weights: tuple[float, ...] = (1, 2, 3), ceiling: float = CEILING) -> tuple[DataFrame, int]:
    """source, source_size, target, whole, theta by source, and the number of sources.

    rows (source, size, u) are read once a level.  A document is taken `whole`
    times, and once more if its u is less than theta.
    """
    goal, _ = table(targets(rows, weights, ceiling), "targets")
    n = goal.count()
    state = goal.select("sid", F.col("rest"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("sum"))
    within = _beside(rows.filter("size > 0"), goal.select("source", "sid"), "source", n).select("sid", "size", "u")
    for k in range(1, LEVELS + 1):
        left = LEVEL_BITS * (LEVELS - k)
        held = state.select(F.col("sid").alias("sid_"), "low")
        held = F.broadcast(held) if n <= BROADCAST_SOURCES else held
        high = left + LEVEL_BITS
        part = within.join(held, (within["sid"] == held["sid_"]) & (F.shiftright("u", high) == F.shiftright("low", high)))
        boxes = part.groupBy("sid", F.shiftright("u", left).alias("box")).agg(F.sum("size").alias("box_size"))
        boxes = boxes.join(state, "sid")
        upto = F.col("sum") + F.sum("box_size").over(W.partitionBy("sid").orderBy("box"))
        first = boxes.withColumn("upto", upto).filter("upto > rest").groupBy("sid").agg(F.min_by(F.struct("box", "box_size", "upto"), "box").alias("b"))
        low = F.when(F.col("b").isNull(), F.lit((1 << LEVEL_BITS * LEVELS) - 1)).otherwise(F.shiftleft(F.col("b.box"), left))
        moved = state.join(first, "sid", "left")
        if k < LEVELS:
            state, _ = table(moved.select("sid", "rest", low.alias("low"), F.coalesce(F.col("b.upto") - F.col("b.box_size"), F.col("sum")).alias("sum")), "level")
        else:
            nearer = 2 * F.col("b.upto") - F.col("b.box_size") < 2 * F.col("rest")
            theta = F.when(F.col("b").isNull(), F.lit(1 << LEVEL_BITS * LEVELS)).otherwise(F.col("b.box") + nearer.cast("long"))
            state, _ = table(moved.select("sid", theta.alias("theta")), "level")
    out, _ = table(goal.join(state, "sid").select("source", "source_size", "target", "whole", "theta"), "plan")
    return out, n


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), ceiling: float = CEILING) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row."""
    rows, _ = table(sized(docs), "sized")
    found, n = plan(rows, weights, ceiling)
    copies = F.col("whole") + (F.col("u") < F.col("theta")).cast("long")
    return _beside(rows, found, "source", n).select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def take(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), ceiling: float = CEILING) -> DataFrame:
    """The documents that the mix takes, whole, with all columns, and `copies`: how often each is taken."""
    rows, _ = table(sized(docs), "sized")
    found, n = plan(rows, weights, ceiling)
    name, s, w, t = (fresh(c, docs.columns) for c in ("copies", "mix_source", "mix_whole", "mix_theta"))
    found = found.select(F.col("source").alias(s), F.col("whole").alias(w), F.col("theta").alias(t))
    found = F.broadcast(found) if n <= BROADCAST_SOURCES else found
    copies = (F.col(w) + (hashed(F.col("doc_id")) < F.col(t)).cast("long")).alias(name)
    return docs.join(found, docs["source"].eqNullSafe(found[s])).select(*[docs[f"`{c}`"] for c in docs.columns], copies).filter(F.col(name) > 0)


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source),
w AS (SELECT *, CAST((sid - 1) % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS most FROM s),
t AS (SELECT *, most <= (sum(source_size) OVER () - coalesce(sum(most) OVER b, 0::DOUBLE)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0::DOUBLE)) * weight AS is_full FROM w
  WINDOW b AS (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, CASE WHEN is_full THEN most ELSE (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(CASE WHEN is_full THEN most END) OVER (), 0::DOUBLE)) / sum(CASE WHEN NOT is_full THEN weight END) OVER () * weight END AS target FROM t),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM g),
c AS (SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
  sum(size) OVER (PARTITION BY d.source ORDER BY u RANGE UNBOUNDED PRECEDING) AS upto, sum(size) OVER (PARTITION BY d.source, u) AS unit FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN upto <= rest OR 2 * upto - unit < 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""
