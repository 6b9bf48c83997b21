"""Order-dependent operators on rows with explicit positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.functions.text import tag_prefix, tag_value


def runs(df: DataFrame, key: str, position: str, value: str, to: str = "run") -> DataFrame:
    """A number for each maximal run of equal values within a key, from 1."""
    order = W.partitionBy(key).orderBy(position)
    start = F.when(F.lag(value).over(order).eqNullSafe(F.col(value)) & (F.row_number().over(order) > 1), 0).otherwise(1)
    return df.withColumn("__start", start).withColumn(to, F.sum("__start").over(order.rowsBetween(W.unboundedPreceding, 0))).drop("__start")


def fill_forward(df: DataFrame, key: str, position: str, value: Column, to: str) -> DataFrame:
    """The last non-null value so far."""
    return df.withColumn(to, F.last(value, ignorenulls=True).over(W.partitionBy(key).orderBy(position).rowsBetween(W.unboundedPreceding, 0)))


def fill_backward(df: DataFrame, key: str, position: str, value: Column, to: str) -> DataFrame:
    """The next non-null value from here on."""
    return df.withColumn(to, F.first(value, ignorenulls=True).over(W.partitionBy(key).orderBy(position).rowsBetween(0, W.unboundedFollowing)))


def majority(df: DataFrame, keys: list[str], position: str, value: str, to: str) -> DataFrame:
    """The most frequent value by keys; ties go to the value that comes first."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), F.min(position).alias("__first"))
    best = F.max_by(F.struct(F.col(value).alias("v")), F.struct("__n", -F.col("__first")))
    return counts.groupBy(*keys).agg(best.alias("__b"), F.max("__n").alias("n")).select(*keys, F.col("__b.v").alias(to), "n")


def begin_inside(df: DataFrame, span: list[str], position: str, name: str, to: str = "tag") -> DataFrame:
    """b- on the first row of each span, i- on the others."""
    first = F.row_number().over(W.partitionBy(*span).orderBy(position)) == 1
    return df.withColumn(to, F.concat(F.when(first, "b-").otherwise("i-"), F.col(name)))


def replace_tags(tag: Column, names: dict[str, str | None]) -> Column:
    """Tag values renamed with their prefix kept; a name mapped to None clears the tag."""
    known = [k for k, v in names.items() if v is not None]
    gone = [k for k, v in names.items() if v is None]
    new = F.coalesce(*[F.when(tag_value(tag) == k, F.lit(names[k])) for k in known], tag_value(tag)) if known else tag_value(tag)
    return F.when(tag_value(tag).isin(gone), F.lit(None)).otherwise(F.concat(tag_prefix(tag), new))


def _known(tag: str, preserved: str | None) -> Column:
    """The tag, or the one that the document came with."""
    return F.col(tag) if preserved is None else F.coalesce(tag, preserved)


def expand_back(df: DataFrame, key: str, position: str, tag: str, enabled: list[str], to: str, preserved: str | None = None) -> DataFrame:
    """Untagged rows before a row of an enabled value join it: b- on their first, i- on the others and on that row; rows with a preserved tag aren't untagged."""
    order = W.partitionBy(key).orderBy(position)
    known = _known(tag, preserved)
    out = fill_backward(df, key, position, known, "__next")
    untagged = known.isNull()
    starts = untagged & ~F.coalesce(F.lag(untagged).over(order), F.lit(False))
    filled = F.when(tag_value(F.col("__next")).isin(enabled), F.concat(F.when(starts, "b-").otherwise("i-"), tag_value(F.col("__next"))))
    after = ~untagged & F.coalesce(F.lag(untagged).over(order), F.lit(False)) & tag_value(known).isin(enabled)
    return out.withColumn(to, F.when(untagged, filled).when(after, F.concat(F.lit("i-"), tag_value(known))).otherwise(F.col(tag))).drop("__next")


def expand_on(df: DataFrame, key: str, position: str, tag: str, enabled: list[str], to: str, preserved: str | None = None) -> DataFrame:
    """Untagged rows after a row of an enabled value join it with i-; rows with a preserved tag aren't untagged."""
    known = _known(tag, preserved)
    out = fill_forward(df, key, position, known, "__last")
    joined = F.when(known.isNull() & tag_value(F.col("__last")).isin(enabled), F.concat(F.lit("i-"), tag_value(F.col("__last"))))
    return out.withColumn(to, F.coalesce(tag, joined)).drop("__last")


def merge_groups(df: DataFrame, key: str, position: str, tag: str, groups: dict[str, str], to: str, preserved: str | None = None, parent: str | None = None) -> DataFrame:
    """Untagged rows after a tag with a group get i-<group>, until the next tag; tagged rows stay as they are.

    Preserved tags count as tags.  With `parent`, a column of tags one level up,
    rows without one are passed over: they neither get a group nor end one.
    """
    known = _known(tag, preserved)
    seen = known if parent is None else F.when(F.col(parent).isNotNull(), known)
    out = fill_forward(df, key, position, tag_value(seen), "__last")
    group = F.coalesce(*[F.when(F.col("__last") == k, F.lit(v)) for k, v in groups.items()])
    open_ = known.isNull() if parent is None else known.isNull() & F.col(parent).isNotNull()
    return out.withColumn(to, F.when(open_, F.concat(F.lit("i-"), group)).otherwise(F.col(tag))).drop("__last")


def offsets(df: DataFrame, key: str, position: str, text: str, between: int = 0) -> DataFrame:
    """start and end of each row's text in the joined text, `between` characters apart."""
    before = F.sum(F.length(text) + between).over(W.partitionBy(key).orderBy(position).rowsBetween(W.unboundedPreceding, -1))
    out = df.withColumn("start", F.coalesce(before, F.lit(0)).cast("long"))
    return out.withColumn("end", F.col("start") + F.length(text))


def gaps(df: DataFrame, key: str, start: str, end: str, to: str) -> DataFrame:
    """key, start, end of what lies between a key's ranges within [0, to); ranges may overlap or repeat."""
    order = W.partitionBy(key).orderBy(start, end)
    reach = F.coalesce(F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inner = df.select(key, reach.cast("long").alias("start"), F.least(start, to).cast("long").alias("end"))
    tail = df.groupBy(key).agg(F.max(end).cast("long").alias("start"), F.max(to).cast("long").alias("end"))
    return inner.unionByName(tail).filter("start < end")


def trailing_space(df: DataFrame, key: str, position: str, token: str, to: str) -> DataFrame:
    """The blank that follows each token of a key: the next token if that is blank, else nothing; null for the last."""
    following = F.lead(token).over(W.partitionBy(key).orderBy(position))
    return df.withColumn(to, F.when(following.isNull(), None).when(F.trim(F.translate(following, "\t\n\r", "   ")) == "", following).otherwise(""))


def drop_untagged(df: DataFrame, key: str, position: str, tag: str, blank: Column) -> DataFrame:
    """Tagged tokens, and blanks that follow one; position orders tokens within the key."""
    last = F.last(F.when(~blank, F.col(tag).isNotNull()), ignorenulls=True).over(W.partitionBy(key).orderBy(position).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("__keep", F.coalesce(last, F.lit(False)) | (F.col(tag).isNotNull())).filter("__keep").drop("__keep")


def clear_replaced(df: DataFrame, line: list[str], tag: str, preserved: str) -> DataFrame:
    """Preserved values of a line are cleared where any of their tokens has got a tag of another value."""
    changed = F.max(F.when(F.col(tag).isNotNull() & (tag_value(F.col(tag)) != tag_value(F.col(preserved))), 1).otherwise(0)).over(W.partitionBy(*line, tag_value(F.col(preserved))))
    return df.withColumn(preserved, F.when(changed == 1, None).otherwise(F.col(preserved)))


def entities(df: DataFrame, key: str, position: str, tag: str, token: str, after: str) -> DataFrame:
    """key, name, first position and text of each tagged run; a run ends where the value changes or b- stands."""
    order = W.partitionBy(key).orderBy(position)
    value = F.when(F.col(tag).isNotNull(), tag_value(F.col(tag)))
    start = F.when(~F.lag(value).over(order).eqNullSafe(value) | (tag_prefix(F.col(tag)) == "b-") | (F.row_number().over(order) == 1), 1).otherwise(0)
    numbered = df.withColumn("__start", start).withColumn("__run", F.sum("__start").over(order.rowsBetween(W.unboundedPreceding, 0))).filter(F.col(tag).isNotNull())
    last = F.lead("__run").over(W.partitionBy(key, "__run").orderBy(position)).isNull()
    piece = F.struct(F.col(position).alias("p"), F.concat(F.col(token), F.when(last, "").otherwise(F.coalesce(after, F.lit(" ")))).alias("t"))
    rows = numbered.withColumn("__piece", piece).groupBy(key, "__run").agg(F.first(tag_value(F.col(tag))).alias("name"), F.min(position).alias("first"), F.array_sort(F.collect_list("__piece")).alias("l"))
    return rows.select(key, "name", "first", F.array_join("l.t", "").alias("text"))


def untagged_runs(df: DataFrame, line: list[str], position: str, tag: str, blank: Column) -> DataFrame:
    """The untagged, non-blank tokens with `run`: which maximal untagged stretch of their line they belong to, from 1; blanks don't part stretches."""
    solid = df.filter(~blank)
    order = W.partitionBy(*line).orderBy(position)
    free = F.col(tag).isNull()
    start = (free & ~F.coalesce(F.lag(free).over(order), F.lit(False))).cast("int")
    numbered = solid.withColumn("__start", start).withColumn("run", F.sum("__start").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.filter(free).drop("__start")


def next_pairs(df: DataFrame, key: str, position: str, columns: list[str]) -> DataFrame:
    """Each row with `next_<column>` of the row after it; null for the last of a key."""
    order = W.partitionBy(key).orderBy(position)
    return df.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
