"""Reference strings: tag repair by reference, and the repair of their markup."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions import references as R
from tagweave.session import ship


def by_sequence(tokens: DataFrame, keys: list[str], fold: Callable[[list[R.Token]], list[R.Token]]) -> DataFrame:
    """tokens (keys, token_no, token, tag) with the tags that a fold over each key's tokens gives; a task holds one sequence at a time."""
    ship(tokens.sparkSession)

    @F.pandas_udf("array<struct<token_no:int,token:string,tag:string>>")
    def run(some: pd.Series) -> pd.Series:
        def one(rows) -> list[dict]:
            new = fold([(r["token"], r["tag"]) for r in rows])
            return [{"token_no": r["token_no"], "token": t, "tag": g} for r, (t, g) in zip(rows, new)]

        return some.map(one)

    rows = tokens.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("token_no").cast("int").alias("token_no"), "token", "tag"))).alias("l"))
    return rows.select(*keys, F.explode(run("l")).alias("r")).select(*keys, "r.*")


def post_process(tokens: DataFrame, keys: list[str], names: tuple[str, ...] = ("author", "editor"), patterns: dict[str, str] | None = None, marker: str = "etal") -> DataFrame:
    """References' tags repaired; see `functions.references.post_process` for the tags' names."""
    return by_sequence(tokens, keys, lambda t: R.post_process(t, names, patterns, marker))


def extend_to_lines(tokens: DataFrame, keys: list[str], merge: list[str], extend: list[str]) -> DataFrame:
    m, e = frozenset(merge), frozenset(extend)
    return by_sequence(tokens, keys, lambda t: R.extend_to_lines(t, m, e))


def fix_references(refs: DataFrame, xml: str, find_missing: bool = True) -> DataFrame:
    """refs with `fixed` and `changed`; null and broken markup stays as it is."""
    ship(refs.sparkSession)

    @F.pandas_udf("fixed string, changed boolean")
    def run(some: pd.Series) -> pd.DataFrame:
        from xml.etree.ElementTree import ParseError

        def one(x: str | None) -> tuple[str | None, bool]:
            try:
                return (x, False) if x is None else R.fix_reference(x, find_missing)
            except ParseError:
                return x, False

        return pd.DataFrame([one(x) for x in some], columns=["fixed", "changed"])

    return refs.withColumn("__f", run(xml)).select(*refs.columns, "__f.fixed", "__f.changed")


def changed_summary(fixed: DataFrame, key: str, ref: str) -> DataFrame:
    """key, n_changed and the changed references' ids, comma-joined."""
    # ids of one document's references, of which it has hundreds at most
    ids = F.array_join(F.array_sort(F.collect_list(F.when(F.col("changed"), F.col(ref).cast("string")))), ",")
    return fixed.groupBy(key).agg(F.count_if("changed").alias("n_changed"), ids.alias("changed_ids"))


def metadata_record(fixed: DataFrame, key: str, ref: str, repaired: str, timestamp: Column) -> DataFrame:
    """key and an array of name and value that says what a run changed: note, time, whether markup was repaired, count and ids of changed references."""
    names = ("fix-jats-note", "fix-jats-run-timestamp", "fix-jats-malformatted-xml", "fix-jats-changed-reference-count", "fix-jats-changed-reference-ids")
    found = changed_summary(fixed, key, ref).join(fixed.groupBy(key).agg(F.bool_or(repaired).alias("__r")), key)
    values = (F.lit("This XML file had been modified to fix some of the potential errors."), timestamp.cast("string"), F.lower(F.col("__r").cast("string")), F.col("n_changed").cast("string"), F.col("changed_ids"))
    return found.select(key, F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in zip(names, values)]).alias("meta"))
