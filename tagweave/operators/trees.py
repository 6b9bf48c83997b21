"""Node tables of XML documents, and location paths over them as joins."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions import markup
from tagweave.session import ship

NODES = "pre int, size int, parent_pre int, level int, tag string, attrs map<string,string>, text string, tail string, content string"


def repair(source: Column) -> Column:
    """Markup with every element closed."""

    @F.pandas_udf("string")
    def mend(some: pd.Series) -> pd.Series:
        return some.map(markup.repair)

    return mend(source)


def parse_status(source: Column) -> Column:
    """ok, error_line and error: whether markup parses; the line that fails and why."""

    @F.pandas_udf("ok boolean, error_line string, error string")
    def status(some: pd.Series) -> pd.DataFrame:
        found = [(None, None, None) if s is None else (lambda r: (r[0] is not None, r[1], r[2]))(markup.parse(s)) for s in some]
        return pd.DataFrame(found, columns=["ok", "error_line", "error"])

    return status(source)


def shred(docs: DataFrame, key: str, xml: str, repaired: bool = True) -> DataFrame:
    """A row for each element of each document, with its range in document order; documents that don't parse have none."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, source in zip(batch.column(0), batch.column(1).to_pylist()):
                root = None if source is None else markup.parse(markup.repair(source) if repaired else source)[0]
                if root is not None:
                    rows = [{key: k.as_py(), **n, "attrs": list(n["attrs"].items())} for n in markup.nodes(root)]
                    yield pa.RecordBatch.from_pylist(rows, schema=to)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = f"{key} {kind}, {NODES}"
    to = to_arrow_schema(StructType.fromDDL(schema))
    return docs.select(key, xml).mapInArrow(run, schema)


_STEP = re.compile(r"(//|/)?(\*|[\w:.-]+)((?:\[[^\]]*\])*)")


def _predicate(text: str) -> Column:
    """@a, @a="v", not(@a) and these joined by or / and."""
    ors = []
    for alternative in re.split(r"\s+or\s+", text):
        ands = []
        for term in re.split(r"\s+and\s+", alternative):
            m = re.fullmatch(r"\s*(not\()?\s*@([\w:.-]+)\s*(?:=\s*[\"']([^\"']*)[\"'])?\s*(\))?\s*", term)
            if not m or bool(m[1]) != bool(m[4]):
                raise ValueError(f"predicate not supported: {text}")
            value = F.element_at("attrs", F.lit(m[2].rsplit(":", 1)[-1]))
            c = value.isNotNull() if m[3] is None else F.coalesce(value == m[3], F.lit(False))
            ands.append(~c if m[1] else c)
        ors.append(reduce(lambda x, y: x & y, ands))
    return reduce(lambda x, y: x | y, ors)


def select(nodes: DataFrame, key: str, path: str) -> DataFrame:
    """Nodes that a location path reaches: / and // steps, names or *, attribute predicates, and | between paths (rows of each, not deduplicated between them)."""
    paths = [p.strip().strip("()") for p in path.split("|")]
    return reduce(DataFrame.unionByName, [_one(nodes, key, p) for p in paths])


def _one(nodes: DataFrame, key: str, path: str) -> DataFrame:
    at, found = 0, None
    while at < len(path):
        m = _STEP.match(path, at)
        if not m:
            raise ValueError(f"path not supported: {path}")
        at = m.end()
        rows = nodes if m[2] == "*" else nodes.filter(F.col("tag") == m[2].rsplit(":", 1)[-1])
        for p in re.findall(r"\[([^\]]*)\]", m[3]):
            rows = rows.filter(_predicate(p))
        if found is None:
            found = rows.filter("level = 0") if m[1] == "/" else rows
            continue
        up = found.select(key, F.col("pre").alias("__pre"), F.col("size").alias("__size")).distinct()
        inside = (F.col("pre") > F.col("__pre")) & (F.col("pre") <= F.col("__pre") + F.col("__size")) if m[1] == "//" else F.col("parent_pre") == F.col("__pre")
        joined = rows.alias("n").join(up.alias("u"), (F.col(f"n.{key}") == F.col(f"u.{key}")) & inside, "left_semi")
        found = joined.select("n.*")
    if found is None:
        raise ValueError("empty path")
    return found


def without_parents(selected: DataFrame, key: str) -> DataFrame:
    """Selected nodes that aren't the parent of another one."""
    up = selected.select(key, F.col("parent_pre").alias("pre")).distinct()
    return selected.join(up, [key, "pre"], "left_anti").select(*selected.columns)


def token_lines(docs: DataFrame, key: str, xml: str, container: str | None = None) -> DataFrame:
    """key, line_no, token_no (from 0 in the line), token and tag of repaired documents."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, source in zip(batch.column(0), batch.column(1).to_pylist()):
                root = None if source is None else markup.parse(markup.repair(source))[0]
                rows = [(i, j, t, g) for i, line in enumerate(markup.lines(root, container)) for j, (t, g) in enumerate(line)] if root is not None else []
                if rows:
                    i, j, t, g = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array([k.as_py()] * len(rows), batch.column(0).type), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(t), pa.array(g)], names=[key, "line_no", "token_no", "token", "tag"])

    return docs.select(key, xml).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, line_no int, token_no int, token string, tag string")


def to_markup(tokens: DataFrame, key: str, paths: dict[str, str], root: str = "tei/text") -> DataFrame:
    """key and xml: each document written from its tagged tokens; one document is one task's row, as its markup is one text."""
    ship(tokens.sparkSession)

    @F.pandas_udf("string")
    def write(all_lines: pd.Series) -> pd.Series:
        return all_lines.map(lambda d: markup.serialise([[(t["token"], t["tag"] or "") for t in line["tokens"]] for line in d], paths, root))

    line = tokens.groupBy(key, "line_no").agg(F.array_sort(F.collect_list(F.struct("token_no", "token", "tag"))).alias("tokens"))
    doc = line.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("line_no", "tokens"))).alias("l"))
    return doc.select(key, write("l").alias("xml"))
