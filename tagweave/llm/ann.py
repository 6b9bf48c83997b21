"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fit on at most SAMPLE_ROWS vectors (unit length; a hash of the row
picks them) by k-means into FANOUT children a node until a leaf holds about
LEAF_SAMPLE of them.  Every vector is then sent down to its leaf, and the index
(leaf, block, vector) is a written table; a leaf with more than BLOCK_ROWS
vectors, such as thousands of copies, is cut into blocks by a hash of the id, so
that no task gets a leaf whole.

A query walks the tree with a priority queue of nodes ordered by distance to
their centres and takes leaves in that order.  How many leaves it takes is
calibrated: bounded sample queries are searched exhaustively, in blocks against
all rows, and visits widen (doubling) until their recall at k reaches the goal.
Scores are exact cosines of the original vectors in double precision.

Cases: vectors that are null, empty, zero, of another length than most of the
sample, or that hold null or non-finite numbers take no part; a query's own row
(its vec_id) is no candidate; fewer than k candidates are all returned; ties go
to the smaller vec_id; copies are each a candidate; empty tables give an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.llm.common import table
from tagweave.session import ship

SAMPLE_ROWS = 20_000
FANOUT = 8
LEAF_SAMPLE = 40
BLOCK_ROWS = 4_096
#: Queries that calibrate, and the recall they must reach.
CALIBRATION_QUERIES = 100
GOAL = 0.98


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centres by Lloyd's rounds from a k-means++ start; fewer than k where points coincide."""
    centres = x[rng.integers(len(x))][None]
    gap = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k and gap.max() > 1e-12:
        centres = np.vstack([centres, x[rng.choice(len(x), p=gap / gap.sum())]])
        gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(1))
    for _ in range(rounds):
        to = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, to, x)
        n = np.bincount(to, minlength=len(centres))
        new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        if np.allclose(new, centres, atol=1e-6):
            break
        centres = new
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)


class Tree:
    """centre of every node, its children (first, count; leaves have none) and leaf number."""

    def __init__(self, x: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        centre, first, count, leaf = [x.mean(0)], [0], [0], [-1]
        todo, n_leaves = [(0, np.arange(len(x)))], 0
        while todo:
            node, rows = todo.pop()
            children = _kmeans(x[rows], FANOUT, rng) if len(rows) > LEAF_SAMPLE else x[:0]
            to = _nearest(x[rows], children) if len(children) > 1 else None
            if to is None or np.bincount(to).max() == len(rows):
                leaf[node] = n_leaves
                n_leaves += 1
                continue
            first[node], count[node] = len(centre), len(children)
            for c in range(len(children)):
                centre.append(children[c])
                first.append(0)
                count.append(0)
                leaf.append(-1)
                todo.append((first[node] + c, rows[to == c]))
        self.centre, self.first, self.count, self.leaf = np.array(centre), np.array(first), np.array(count), np.array(leaf)
        self.n_leaves = n_leaves

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest child at each node."""
        node = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            if not self.count[at]:
                node[rows] = self.leaf[at]
                continue
            to = _nearest(x[rows], self.centre[self.first[at] : self.first[at] + self.count[at]])
            todo += [(self.first[at] + c, rows[to == c]) for c in range(self.count[at]) if (to == c).any()]
        return node

    def visit(self, q: np.ndarray, leaves: int) -> list[int]:
        """The first `leaves` leaves, best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < leaves:
            _, at = heapq.heappop(queue)
            if not self.count[at]:
                out.append(int(self.leaf[at]))
                continue
            some = slice(self.first[at], self.first[at] + self.count[at])
            far = ((self.centre[some] - q) ** 2).sum(1)
            for c, d in enumerate(far.tolist()):
                heapq.heappush(queue, (d, int(self.first[at]) + c))
        return out


def _usable(vectors: DataFrame) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull()
    return vectors.select("vec_id", v.alias("v")).filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(good)


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix."""
    if isinstance(column, pd.Series):
        return np.stack(column.to_numpy()).astype(np.float64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _score(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of paired rows (or of one row with each), summed in one order whatever the number of rows."""
    return np.clip((_unit(q) * _unit(x)).sum(1), -1.0, 1.0)


def _hits(ids: np.ndarray, x: np.ndarray, unit: np.ndarray, qid: int, q: np.ndarray, fast: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the k best of these rows, by fast scores first (good to 1e-9)."""
    fast = np.where(ids == qid, -np.inf, fast)
    if len(ids) > k + 1:
        least = np.partition(fast, len(fast) - k)[len(fast) - k]
        near = np.flatnonzero(fast >= least - 1e-9)
    else:
        near = np.flatnonzero(fast > -np.inf)
    near = near[ids[near] != qid]
    score = _score(q[None], x[near])
    best = np.lexsort((ids[near], -score))[:k]
    return ids[near][best], score[best]


OUT = "query_id long, vec_id long, score double, leaf int"
#: Leaves (neighbours in the tree) whose rows one group of a search holds; scores and exact pairs held at once.
GROUP_LEAVES = 32
SCORES = 2_000_000
#: Queries that one task of a group holds, about.
QUERY_ROWS = 50_000
PAIRS = 50_000


def _search_groups(pairs: DataFrame, k: int) -> DataFrame:
    """pairs: grp, block, part, vec_id, v, leaf (of rows of the index) or leaves (that a query visits); the k best of each query in each group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        is_query = pdf["leaf"].isna().to_numpy()
        q, x = pdf[is_query], pdf[~is_query]
        got = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))]
        if not q.empty and not x.empty:
            qid, qv, ids, mat = q["vec_id"].to_numpy(), _matrix(q["v"]), x["vec_id"].to_numpy(), _matrix(x["v"])
            leaf = x["leaf"].to_numpy().astype(np.int32)
            order = np.argsort(leaf, kind="stable")
            ids, mat, leaf = ids[order], mat[order], leaf[order]
            qu, unit = _unit(qv), _unit(mat)
            starts = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
            pieces = list(zip(leaf[starts] % GROUP_LEAVES, starts, np.append(starts[1:], len(leaf))))
            visited = np.zeros((len(q), GROUP_LEAVES), bool)
            visited[np.repeat(np.arange(len(q)), q["leaves"].map(len)), np.concatenate(q["leaves"].to_list()) % GROUP_LEAVES] = True
            step = max(1, SCORES // len(x))
            for a in range(0, len(q), step):
                some = slice(a, a + step)
                # only leaves that a query visits are scored for it
                fast = np.full((len(qu[some]), len(x)), -np.inf)
                for f, lo, hi in pieces:
                    here = np.flatnonzero(visited[some, f])
                    fast[here, lo:hi] = qu[some][here] @ unit[lo:hi].T
                fast[qid[some, None] == ids] = -np.inf
                # fast scores are good to 1e-9: all within that of the k-th are scored exactly
                least = np.partition(fast, len(x) - k, axis=1)[:, len(x) - k] if len(x) > k else np.full(len(fast), -np.inf)
                at, row = np.nonzero((fast >= least[:, None] - 1e-9) & (fast > -np.inf))
                score = np.concatenate([np.zeros(0), *[_score(qv[a + at[s : s + PAIRS]], mat[row[s : s + PAIRS]]) for s in range(0, len(at), PAIRS)]])
                order = np.lexsort((ids[row], -score, at))
                at, row, score = at[order], row[order], score[order]
                best = np.arange(len(at)) - np.searchsorted(at, at) < k
                got.append((qid[a + at[best]], ids[row[best]], score[best], leaf[row[best]]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score", "leaf"), map(np.concatenate, zip(*got)))))

    return pairs.groupBy("grp", "block", "part").applyInPandas(run, OUT)


def exhaustive(index: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """k best of each of these few queries among all rows: each task takes its rows block by block."""
    qid = np.array([i for i, _ in queries], np.int64)
    q = np.array([v for _, v in queries], np.float64)
    qu = _unit(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))] * len(qid)
        for batch in batches:
            vec, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
            for a in range(0, len(vec), 4096):
                mat = _matrix(batch.column("v").slice(a, 4096))
                unit = _unit(mat)
                some, at = vec[a : a + 4096], leaf[a : a + 4096]
                for j, fast in enumerate(qu @ unit.T):
                    found, score = _hits(some, mat, unit, qid[j], q[j], fast, k)
                    where = at[np.array([np.flatnonzero(some == i)[0] for i in found], np.int64)] if len(found) else at[:0]
                    i, t, f = (np.concatenate(z) for z in zip(held[j], (found, score, where)))
                    best = np.lexsort((i, -t))[:k]
                    held[j] = i[best], t[best], f[best]
        sizes = [len(i) for i, *_ in held]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qid, sizes)), *[pa.array(np.concatenate([h[c] for h in held])) for c in range(3)]], names=["query_id", "vec_id", "score", "leaf"])

    return _top(index.select("vec_id", "v", "leaf").mapInArrow(run, OUT), k)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


class Index:
    """A tree and the written table of vectors by leaf and block."""

    def __init__(self, vectors: DataFrame) -> None:
        ship(vectors.sparkSession)
        good, _ = table(_usable(vectors), "vectors")
        self.n = good.count()
        self.tree = None
        if not self.n:
            return
        u = F.pmod(F.xxhash64("vec_id", F.lit("ann")), F.lit(1 << 30))
        sample = good.filter(u < max(1, int((1 << 30) * min(1.0, SAMPLE_ROWS / self.n)))).limit(SAMPLE_ROWS + SAMPLE_ROWS // 5)
        rows = sample.select("vec_id", "v").toPandas().sort_values("vec_id")
        if rows.empty:
            rows = good.limit(1).toPandas()
        dims = int(rows["v"].map(len).mode()[0])
        self.dims = dims
        mat = _unit(_matrix(rows["v"][rows["v"].map(len) == dims]))
        tree = self.tree = Tree(mat)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = tree.assign(_unit(_matrix(batch.column("v")))) if batch.num_rows else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(leaf.astype(np.int32))], names=["vec_id", "v", "leaf"])

        good = good.filter(F.size("v") == dims)
        placed, _ = table(good.mapInArrow(place, "vec_id long, v array<double>, leaf int"), "placed")
        # leaves are as many as the bounded sample allows, so their counts are bounded too
        sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
        self.blocks = {leaf: -(-c // BLOCK_ROWS) for leaf, c in sizes.items()}
        cut = F.create_map(*[F.lit(x) for leaf, b in self.blocks.items() if b > 1 for x in (leaf, b)]) if any(b > 1 for b in self.blocks.values()) else None
        block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.coalesce(F.element_at(cut, F.col("leaf")), F.lit(1))).cast("int") if cut is not None else F.lit(0)
        self.rows = placed.withColumn("block", block)

    def search(self, queries: DataFrame, k: int, leaves: int) -> DataFrame:
        """query_id, rank, vec_id, score: the k best of each query (vec_id, v) among the first leaves it visits."""
        tree, blocks = self.tree, self.blocks

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = _unit(_matrix(batch.column("v"))) if batch.num_rows else np.zeros((0, 1))
                at, grp, block, some = [], [], [], []
                for i, x in enumerate(q):
                    by: dict[tuple[int, int], list[int]] = {}
                    for f in tree.visit(x, leaves):
                        for b in range(blocks.get(f, 0)):
                            by.setdefault((f // GROUP_LEAVES, b), []).append(f)
                    for (g, b), fs in by.items():
                        at.append(i)
                        grp.append(g)
                        block.append(b)
                        some.append(fs)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(take), batch.column("v").take(take), pa.array(grp, pa.int32()), pa.array(block, pa.int32()), pa.array(some, pa.list_(pa.int32()))],
                    names=["vec_id", "v", "grp", "block", "leaves"],
                )

        visits = queries.filter(F.size("v") == self.dims).select("vec_id", "v").mapInArrow(walk, "vec_id long, v array<double>, grp int, block int, leaves array<int>")
        visits, _ = table(visits, "visits")
        # queries of a group are cut too, so that a task holds about QUERY_ROWS of them; its rows then go to each part
        parts, _ = table(visits.groupBy("grp", "block").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("parts")), "parts")
        rows = self.rows.select("vec_id", "v", F.floor(F.col("leaf") / GROUP_LEAVES).cast("int").alias("grp"), "block", F.lit(None).cast("array<int>").alias("leaves"), "leaf")
        rows = rows.join(parts, ["grp", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        asked = visits.join(parts, ["grp", "block"]).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("parts")).cast("int")).drop("parts")
        both = rows.unionByName(asked.withColumn("leaf", F.lit(None).cast("int")))
        return _top(_search_groups(both, k), k).select("query_id", "rank", "vec_id", "score")

    def calibrate(self, queries: DataFrame, k: int, goal: float = GOAL) -> int:
        """The least power of two of leaves (or all) with which bounded sample queries reach this recall.

        Within a leaf the search is exact, so a true neighbour is found exactly
        if its leaf is among those visited.
        """
        u = F.pmod(F.xxhash64("vec_id", F.lit("calibrate")), F.lit(1 << 30))
        n = queries.count()
        some = queries.filter(u < max(1, int((1 << 30) * min(1.0, CALIBRATION_QUERIES / max(n, 1))))).limit(2 * CALIBRATION_QUERIES).select("vec_id", "v").collect()
        if not some:
            return self.tree.n_leaves
        vectors = {r["vec_id"]: r["v"] for r in some}
        at = []
        order = {i: {f: r for r, f in enumerate(self.tree.visit(_unit(np.array([v]))[0], self.tree.n_leaves))} for i, v in vectors.items()}
        for r in exhaustive(self.rows, sorted(vectors.items()), k).select("query_id", "leaf").collect():
            at.append(order[r["query_id"]][r["leaf"]])
        at = np.array(at)
        leaves = 4
        while leaves < self.tree.n_leaves and len(at) and (at < leaves).mean() < goal:
            leaves *= 2
        return min(leaves, self.tree.n_leaves)


def op1(vectors: DataFrame, k: int = 5) -> DataFrame:
    """The contract's columns: queries are the rows whose vec_id is divisible by 50."""
    index = Index(vectors)
    if index.tree is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = index.rows.filter(F.col("vec_id") % 50 == 0).select("vec_id", "v")
    return index.search(queries, k, index.calibrate(queries, k))
