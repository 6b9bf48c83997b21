"""Tags that a document came with: set aside, kept or cleared by field, and put back.

A tag column (`tag`, `sub_tag`) has a partner `preserved_<column>`.  All steps
are expressions on a row: nothing is shuffled and filters pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.text import tag_prefix, tag_value


def _given(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


def current(column: str) -> Column:
    """The tag, or the preserved one where there is none."""
    return F.coalesce(_given(column), _given(f"preserved_{column}"))


def set_aside(df: DataFrame, paths: dict[str, str], columns: tuple[str, ...] = ("tag",), keep: bool = True) -> DataFrame:
    """Tags that are paths move to the preserved column under their field's name (`paths`: path by field; of fields with one path the last); without `keep` they are dropped."""
    fields = {path: field for field, path in paths.items()}
    new = {}
    for c in columns:
        value = F.coalesce(*[F.when(tag_value(F.col(c)) == path, F.lit(field)) for path, field in fields.items()], tag_value(F.col(c)))
        new[f"preserved_{c}"] = F.concat(tag_prefix(_given(c)), value) if keep else F.lit(None).cast("string")
        new[c] = F.lit(None).cast("string")
    return df.withColumns(new)


def clear(df: DataFrame, gone: Column, column: str) -> DataFrame:
    """Neither a tag nor a preserved one where `gone` holds."""
    gone = F.coalesce(gone, F.lit(False))
    return df.withColumns({c: F.when(~gone, F.col(c)) for c in (column, f"preserved_{column}")})


def prepare(df: DataFrame, fields: set[str], *, keep: bool = False, keep_fields: set[str] | None = None, keep_sub: bool = False, drop_sub_fields: set[str] | None = None) -> DataFrame:
    """What stays before a document is annotated in place.

    Tags: without `keep` and `keep_fields` none; else those that aren't of
    `fields` (those about to be annotated) unless in `keep_fields`, and, where
    `keep_fields` is given, no others than those.  Sub tags: none without
    `keep_sub`, else all but those of `drop_sub_fields`.
    """
    field = tag_value(current("tag"))
    gone = F.lit(not (keep or keep_fields))
    if away := sorted(set(fields) - (keep_fields or set())):
        gone = gone | field.isin(away)
    if keep_fields:
        gone = gone | ~field.isin(sorted(keep_fields))
    df = clear(df, gone, "tag")
    if "sub_tag" not in df.columns:
        return df
    if not keep_sub:
        return clear(df, F.lit(True), "sub_tag")
    return clear(df, tag_value(current("sub_tag")).isin(sorted(drop_sub_fields)), "sub_tag") if drop_sub_fields else df


def put_back(df: DataFrame, fields: set[str]) -> DataFrame:
    """Preserved tags of these fields become tags where there is none."""
    tag = current("tag")
    return df.withColumn("tag", F.when(tag_value(tag).isin(sorted(fields)), tag).otherwise(F.col("tag")))
