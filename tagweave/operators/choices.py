"""Which candidate matches are taken: acceptance by scores, nearness to earlier matches, dependence on the next match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def accepted(
    match: Column, b_score: float, least: int, total: float, long: int = 100, ratio: float | None = None, following: Column | None = None, joined: Column | None = None
) -> Column:
    """Whether a match (struct of count, ratio, b_gap_ratio, a_ratio) is good enough.

    One of at least `long` characters counts by its ratio alone.  Otherwise the
    needle must be found to `b_score`, and the match must go on from one before
    it (`joined`), or have `least` characters and no worse one behind it
    (`following`, a struct as `match`, null for none), or cover the text to `total`.
    """
    ratio = b_score if ratio is None else ratio
    behind = F.lit(True) if following is None else following.isNull() | (following["ratio"] >= ratio)
    before = F.lit(False) if joined is None else F.coalesce(joined, F.lit(False))
    whole = (match["count"] >= long) & (match["ratio"] >= ratio)
    return whole | ((match["b_gap_ratio"] >= b_score) & (before | ((match["count"] >= least) & behind) | (match["a_ratio"] >= total)))


def bonded(matches: DataFrame, keys: list[str], order: str, position: str, gap: int | None) -> DataFrame:
    """Matches that lie within `gap` + 1 positions of any match taken before them (in `order`); the first of a key, and all without a gap, are taken.

    A match is taken exactly if a step of at most gap + 1 connects it with what
    was taken before, so matches are folded by key; a key holds one field's candidates.
    """
    if not gap:
        return matches
    near = lambda m, x: F.exists(m, lambda p: F.abs(p - x) <= gap + 1)
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(position).cast("long").alias("p"))))
    taken = F.aggregate(
        "__rows", F.array().cast("array<struct<o:%s,p:bigint>>" % matches.schema[order].dataType.simpleString()),
        lambda m, x: F.when((F.size(m) == 0) | near(F.transform(m, lambda y: y["p"]), x["p"]), F.concat(m, F.array(x))).otherwise(m),
    )
    kept = matches.groupBy(*keys).agg(rows.alias("__rows")).select(*keys, F.explode(taken).alias("__t")).select(*keys, F.col("__t.o").alias(order))
    return matches.join(kept.distinct(), [*keys, order], "left_semi")


def confirmed(matches: DataFrame, key: str, order: str, start: str, end: str, conditional: str, within: int = 1) -> DataFrame:
    """Matches that stand: the unconditional, and a conditional one whose next match lies at most `within` positions from it."""
    w = W.partitionBy(key).orderBy(order)
    apart = F.least(F.abs(F.lead(start).over(w) - F.col(end)), F.abs(F.col(start) - F.lead(end).over(w)))
    return matches.withColumn("__apart", apart).filter(~F.col(conditional) | (F.col("__apart") <= within)).drop("__apart")
