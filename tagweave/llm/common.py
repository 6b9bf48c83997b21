"""Helpers that the operators share: the shared folder, text batches and connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.session import ship

#: Edges that one task may hold when the last contraction is finished by union-find.
UNION_FIND_EDGES = 20_000

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor can read and write.

    It is spark.checkpoint.dir; only where that is unset (tests, local mode) a
    temporary folder is made and set.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="tagweave-")
        spark.sparkContext.setCheckpointDir(_own_dir[app])
    return _own_dir[app]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove(spark, path)
    except Exception:  # the session has ended: the folder goes with the cluster's scratch space
        return


def table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder and read it again.

    This cuts the lineage: lost executors re-read files, they don't re-run
    what made them.  Returns the new frame and its path.
    """
    spark = ship(df.sparkSession)
    path = f"{shared_dir(spark)}/tagweave/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove_at_exit, spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def fresh(name: str, taken: list[str]) -> str:
    """This name, with underscores added until no column has it (case ignored, as Spark does)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


#: Rows of ids (some 32 bytes each) that may be broadcast so that texts aren't shuffled.
BROADCAST_IDS = 1_000_000


def beside(texts: DataFrame, ids: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join of texts with a written table of ids, broadcast if it has at most BROADCAST_IDS rows; with more, texts are shuffled once."""
    return texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, on, how)


def hot_join(left: DataFrame, right: DataFrame, key: str, rows: str, share: int = 1000) -> DataFrame:
    """Inner join on `key`, unique in `right`, whose column `rows` counts each key's rows in `left`.

    Keys with over 1/share of all rows, of which there are fewer than `share`, are broadcast, so that
    none of them lands in one task; the others are shuffled.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    hot = F.broadcast(right.filter(F.col(rows) > total / share))
    cold = left.join(hot.select(key), key, "left_anti").join(right.filter(F.col(rows) <= total / share), key)
    return left.join(hot, key).unionByName(cold)


def slices(batches: Iterator[pa.RecordBatch], column: str | list[str], limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with about `limit` bytes of text each, in this column or these together; a longer row stands alone."""
    columns = [column] if isinstance(column, str) else column
    for batch in batches:
        size = sum(np.asarray(pa.compute.binary_length(batch.column(c)).fill_null(0), dtype=np.int64) for c in columns)
        ends = np.cumsum(size + 16)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, each followed by one LF, and the start of each text (one more for the end)."""
    texts = [b"" if x is None else x.encode() for x in column.to_pylist()]
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=starts[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), starts


def union_find(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            return nodes, nodes[label]


def components(edges: DataFrame, bound: int = UNION_FIND_EDGES) -> DataFrame:
    """(node, root): each node of `edges` (u, v) with the smallest node of its component.

    Rounds of contraction: every node takes the smallest of itself and its
    neighbours, and edges move to those; a component's nodes at least halve in
    a round.  Once no more than `bound` edges are left, one task ends the work.
    Only counts reach the driver.  Nodes whose edges are all loops are left out.
    """
    spark = edges.sparkSession
    kind = edges.schema["u"].dataType.simpleString()

    def tidy(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    edges, path = table(tidy(edges), "edges")
    steps: list[DataFrame] = []
    while (n := edges.count()) > bound:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent, _ = table(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("parent")), "parents")
        steps.append(parent)
        at = lambda c, p=parent: p.select(F.col("node").alias(c), F.col("parent").alias(f"p{c}"))
        moved = edges.join(at("u"), "u").join(at("v"), "v").select(F.col("pu").alias("u"), F.col("pv").alias("v"))
        before, (edges, new) = path, table(tidy(moved), "edges")
        remove(spark, before)
        path = new

    def finish(_: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, root = union_find(pdf["u"].to_numpy(), pdf["v"].to_numpy())
        return pd.DataFrame({"node": nodes, "root": root})

    last = edges.groupBy(F.lit(0).alias("all")).applyInPandas(finish, f"node {kind}, root {kind}") if n else edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out, _ = table(last, "roots")
    for parent in reversed(steps):
        nxt = out.select(F.col("node").alias("parent"), "root")
        out, _ = table(parent.join(nxt, "parent", "left").select("node", F.coalesce("root", "parent").alias("root")), "roots")
    return out
