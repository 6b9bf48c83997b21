"""Near copies by similarity: ball hashing over several SimHash codes, and a whole check of what collides.

One 64-bit fingerprint can't tell a pair of similarity 0.8, of which 15 % of the
bits differ, from chance.  So a text has `tables` short codes; in each, pairs
within RADIUS bits are found by meeting in the middle (variants within half
the radius, see `simhash`), and each pair is then checked by its whole sets of
shingles.  Bits (CODE_BITS) and tables (`tables_of`, so that a pair of exactly the
least similarity is drawn with probability RECALL) are the same for every input:
a pair that is drawn in one table of texts is drawn in any other.  Only the chance
pairs a row, and so the work, grow with the rows.

What keeps skewed tables in bounds:

* Exact copies (equal words) are one text before any code is made.
* Beside its code a row carries 52 more bits and its count of shingles, so
  chance pairs are dropped where they meet.
* Pairs never become rows: a task gives each row under a prefix the least row
  that pairs connect it with, at most one edge a row.  Edges of all prefixes
  and tables make clusters, and every pair drawn lies within one.
* Within a cluster all texts are compared by whole sets of shingles through an
  inverted index (`linked`), which gives at most one link a text.
* A prefix with more than twice KEY_ROWS rows is dealt out in blocks, and a
  cluster of more than CELL_BYTES of shingles too; both are compared in cells of
  two blocks, so that every two rows meet.  Work there grows with the square of a cluster's texts that are
  not near copies of its middle; memory doesn't.

Cases: rows with a null doc_id take no part; null, empty and blank texts are
alike; texts of fewer words than a shingle are alike only if their words are
equal; rows that repeat a doc_id with other words are texts of their own, and
of one doc_id with equal texts are one; an empty table gives an empty result.
Extra columns are kept by `keep_one` and ignored by `similar_groups`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import beside, components, fresh, hot_join, slices, table, union_find
from tagweave.llm.simhash import masks, prefix_bits, shared, shingles, word_bytes

RADIUS = 4
#: Bits of a code.
CODE_BITS = 40
#: Probability that a pair of exactly the least similarity is drawn.
RECALL = 0.95
#: Low bits of a code's long that hold the number of its table.
TABLE_BITS = 7
#: Bits that go with a code to drop chance pairs, and deviations beyond the expected share at which they drop one.
CHECK_BITS, DEVIATIONS = 52, 4.0
#: Base of the logarithm that a count of shingles is rounded to (12 bits).
SIZE_BASE = 1.01
#: Texts that share a variant and are compared two by two; more are taken as connected where their counts of shingles allow.
GROUP = 16
#: Rows aimed at under one prefix of a table; a task holds at most about twice as many.
KEY_ROWS = 2_400_000
#: Bytes of shingles that a check holds a side, about.
CELL_BYTES = 8 << 20
#: Pairs that a task holds before it reduces them to connected rows.
HELD_PAIRS = 1_000_000


def tables_of(similarity: float) -> int:
    """Count of tables that draw a pair of exactly this similarity with probability RECALL."""
    share = differing(similarity)
    hit = sum(math.comb(CODE_BITS, k) * share**k * (1 - share) ** (CODE_BITS - k) for k in range(RADIUS + 1))
    return min(math.ceil(math.log(1 - RECALL) / math.log(1 - hit)), (1 << TABLE_BITS) - 1)


def differing(similarity: float) -> float:
    """The share of SimHash bits that differ between two sets of equal size and this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def majorities(h: np.ndarray, bits: int) -> np.ndarray:
    """SimHash bits (0 or 1; a multiple of 64) of distinct shingle hashes, each mixed into as many words as it takes."""
    salt = (np.arange(1, bits // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    lanes = np.uint64(0x0101010101010101)
    counts = np.zeros((len(salt), 8, 8), np.int64)
    for a in range(0, len(h), 8160):
        g = h[a : a + 8160] + salt
        g = (g ^ (g >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        g = (g ^ (g >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        g ^= g >> np.uint64(31)
        # eight bits of a word are counted at once, a byte for each, over 255 hashes at most
        cuts = np.arange(0, g.shape[1], 255)
        for k in range(8):
            part = np.add.reduceat((g >> np.uint64(k)) & lanes, cuts, axis=1)
            counts[:, :, k] += part.view(np.uint8).reshape(len(salt), -1, 8).sum(1, dtype=np.int64)
    return (2 * counts.reshape(-1) > len(h)).astype(np.uint8)


def _pack(bits: np.ndarray) -> np.ndarray:
    """The last axis, at most 64 bits, as the top bits of a long."""
    weight = np.uint64(1) << (np.uint64(63) - np.arange(bits.shape[-1], dtype=np.uint64))
    return (bits.astype(np.uint64) * weight).sum(-1, dtype=np.uint64)


class Limits:
    """Which pairs can reach the similarity, by the bits and counts that go with a code."""

    def __init__(self, similarity: float) -> None:
        share = differing(similarity)
        self.bits = CHECK_BITS * share + DEVIATIONS * math.sqrt(CHECK_BITS * share * (1 - share))
        self.sizes = math.floor(math.log(1 / similarity) / math.log(SIZE_BASE)) + 1
        self.low = np.uint64((1 << (64 - CHECK_BITS)) - 1)

    def sized(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.abs((a & self.low).astype(np.int64) - (b & self.low).astype(np.int64)) <= self.sizes

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (np.bitwise_count((a ^ b) & ~self.low) <= self.bits) & self.sized(a, b)


def _connected(code: np.ndarray, extra: np.ndarray, rid: np.ndarray, prefix: int, key: int, floor: int, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Rows under a prefix that pairs connect with others, and the least rid that each is connected with."""
    rank = np.argsort(np.argsort(rid))
    u, v, count = [], [], 0

    def reduce() -> tuple[np.ndarray, np.ndarray]:
        return union_find(np.concatenate(u), np.concatenate(v)) if count else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    for group, row in shared(code, prefix, key, RADIUS // 2, floor):
        order = np.lexsort((extra[row] & limits.low, group))
        group, row = group[order], row[order]
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(start, len(row)))
        at_group = np.repeat(np.arange(len(start)), size)
        last = start[at_group] + size[at_group] - 1
        few = size[at_group] <= GROUP
        for step in range(1, min(GROUP, int(size.max()))):
            left = np.flatnonzero((few | (step == 1)) & (np.arange(len(row)) + step <= last))
            if not len(left):
                continue
            a, b = row[left], row[left + step]
            good = np.where(few[left], limits.near(extra[a], extra[b]), limits.sized(extra[a], extra[b]))
            u.append(rank[a[good]])
            v.append(rank[b[good]])
            count += len(u[-1])
        if count > HELD_PAIRS:
            nodes, roots = reduce()
            u, v, count = [nodes], [roots], len(nodes)
    nodes, roots = reduce()
    by_rank = np.sort(rid)
    moved = nodes != roots
    return by_rank[nodes[moved]], by_rank[roots[moved]]


def _edges(texts: DataFrame, bits: int, tables: int, n: int, limits: Limits) -> DataFrame:
    """Edges (u, v) of rids whose components hold every pair drawn."""
    spark = texts.sparkSession
    half = RADIUS // 2
    p = prefix_bits(n, half, KEY_ROWS)
    flips = masks(list(range(p)), half)
    each = texts.select("rid", "extra", F.explode("codes").alias("code")).select("*", F.explode(F.array(*[F.lit(int(m)).cast("long") for m in flips])).alias("flip"))
    tab = F.col("code").bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    key = F.shiftleft(tab, p).bitwiseOR(F.shiftrightunsigned("code", 64 - p).bitwiseXOR(F.col("flip")))
    each = each.withColumn("key", key).drop("flip")
    hot, _ = table(each.groupBy("key").count().filter(F.col("count") > 2 * KEY_ROWS).select("key", F.ceil(F.col("count") / KEY_ROWS).cast("int").alias("blocks")), "hot")
    each = each.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("rid", "key"), "blocks").cast("int"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.withColumn("block", F.least("own", "other") * F.col("blocks").cast("long") + F.greatest("own", "other"))
    floor = 64 - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            key, code, extra, rid = (t.column(c).to_numpy() for c in ("key", "code", "extra", "rid"))
            u, v = _connected(code.view(np.uint64), extra.view(np.uint64), rid, p, int(key[0]) & ((1 << p) - 1), floor, limits)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        now, held = None, []
        for batch in batches:
            key, block = batch.column("key").to_numpy(), batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if now != (key[a], block[a]) and held:
                        yield from flush(held)
                        held = []
                    now = (key[a], block[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield from flush(held)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * len(flips) * tables // KEY_ROWS))
    dealt = each.select("key", "block", "code", "extra", "rid").repartition(parts, "key", "block").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(run, "u long, v long").distinct()


def linked(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set (sorted, distinct) the number of a set that links of at least this Jaccard similarity connect it with, the same for all that are connected.

    Sets are taken from the one of the most frequent shingles on.  Each meets
    all others through the postings of its shingles, unless too few of those
    are held by another set, or it is connected with the first one already:
    whatever isn't connected with that takes its turn itself.
    """
    size = np.array([len(s) for s in sets])
    number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    ends = np.cumsum(size)
    owner = np.repeat(np.arange(len(sets)), size)[np.argsort(number, kind="stable")]
    last = np.cumsum(count)
    label = np.arange(len(sets))
    common = np.add.reduceat(np.append(count[number] > 1, 0), np.minimum(ends - size, len(number))) * (size > 0)
    often = np.add.reduceat(np.append(count[number], 0), np.minimum(ends - size, len(number))) * (size > 0)
    turns = np.flatnonzero((size > 0) & (common >= similarity * size - 1e-9))
    turns = turns[np.argsort(-often[turns], kind="stable")]
    for x in turns:
        if label[x] == label[turns[0]] and x != turns[0]:
            continue
        own = number[ends[x] - size[x] : ends[x]]
        n = count[own]
        upto = np.cumsum(n)
        at = np.arange(upto[-1]) - np.repeat(upto - n, n) + np.repeat(last[own] - n, n)
        both = np.bincount(owner[at], minlength=len(sets))
        near = both >= similarity * (size[x] + size - both) - 1e-9
        near[x] = True
        label[np.isin(label, label[near])] = label[x]
    return label


def _links(docs: DataFrame, texts: DataFrame, clusters: DataFrame, words: int, similarity: float) -> DataFrame:
    """Edges (u, v) of rids whose components are those of all pairs of one cluster that are this similar."""
    sized = texts.select(F.col("rid").alias("node"), (F.col("n") * 8 + 64).alias("bytes"), "first").join(clusters, "node")
    sized, _ = table(sized, "sized")
    whole = sized.groupBy("root").agg(F.sum("bytes").alias("bytes"))
    whole, _ = table(whole.select("root", "bytes", F.ceil(F.col("bytes") / CELL_BYTES).alias("blocks")), "clusters")
    groups = -(-(whole.filter("blocks = 1").agg(F.sum("bytes")).first()[0] or 0) // CELL_BYTES) + 1
    asked = sized.join(whole.drop("bytes"), "root").select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.h").alias("h"), F.col("node").alias("rid"), "root", "blocks",
        F.when(F.col("blocks") > 1, F.col("root")).otherwise(-1 - F.pmod(F.xxhash64("root"), F.lit(groups))).alias("part"),
        F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"),
    )
    asked, _ = table(asked, "asked")
    names = ["rid", "root", "blocks", "part", "block"]

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 21):
            sets = [np.unique(shingles(word_bytes(t), words)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sets, pa.binary())], names=[*names, "shingles"])

    sets = beside(docs, asked, ["doc_id", "h"], "inner").select(*names, "text").mapInArrow(whole_sets, ", ".join(f"{c} long" for c in names) + ", shingles binary")
    dealt = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))).select("part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "root", "rid", "shingles")

    def compare(cell: pa.Table) -> pa.Table:
        held: dict[int, dict[int, np.ndarray]] = {}
        for root, rid, x in zip(*(cell.column(c).to_pylist() for c in ("root", "rid", "shingles"))):
            held.setdefault(root, {})[rid] = np.frombuffer(x, np.uint64)  # a row that is repeated gives its set again
        u, v = [], []
        for some in held.values():
            rid = np.array(list(some))
            label = linked(list(some.values()), similarity)
            u.append(rid[label != np.arange(len(rid))])
            v.append(rid[label[label != np.arange(len(rid))]])
        return pa.table({"u": pa.array(np.concatenate(u)), "v": pa.array(np.concatenate(v))})

    return dealt.groupBy("part", "i", "j").applyInArrow(compare, "u long, v long")


def _grouped(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """doc_id, h (XXHash of the text) and the least (doc_id, h) of the row's component, as `first`, for rows with a doc_id."""
    docs = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h"), "text")
    n = docs.count()
    bits, tables = CODE_BITS, tables_of(similarity)
    kind = docs.schema["doc_id"].dataType.simpleString()
    total = -(-(bits * tables + CHECK_BITS) // 64) * 64
    limits = Limits(similarity)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        number = np.arange(tables, dtype=np.uint64)
        for batch in slices(batches, "text", 1 << 21):
            texts = [word_bytes(t) for t in batch.column("text").to_pylist()]
            sets = [np.unique(shingles(t, words)) for t in texts]
            size = np.array([len(s) for s in sets])
            bit = np.stack([majorities(s, total) for s in sets])
            code = _pack(bit[:, : bits * tables].reshape(len(texts), tables, bits)) | number
            rounded = np.floor(np.log(np.maximum(size, 1)) / math.log(SIZE_BASE)).astype(np.uint64)
            extra = _pack(bit[:, bits * tables : bits * tables + CHECK_BITS]) | rounded
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(texts) * tables + 1, tables), pa.int32()), pa.array(code.view(np.int64).ravel()))
            key = pa.array([xxh3_128_digest(b" ".join(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), key, pa.array(size.astype(np.int64)), pa.array(extra.view(np.int64)), lists],
                names=["doc_id", "h", "key", "n", "extra", "codes"],
            )

    every, _ = table(docs.mapInArrow(codes, f"doc_id {kind}, h long, key binary, n long, extra long, codes array<long>"), "codes")
    first = every.groupBy("key").agg(F.min(F.struct("doc_id", "h")).alias("first"), F.any_value("n").alias("n"), F.any_value("extra").alias("extra"), F.any_value("codes").alias("codes"), F.count(F.lit(1)).alias("rows"))
    texts, _ = table(first.withColumn("rid", F.monotonically_increasing_id()), "texts")
    clusters = components(_edges(texts, bits, tables, n, limits))
    roots = components(_links(docs, texts, clusters, words, similarity))
    roots = roots.select(F.col("node").alias("rid"), "root")
    named = texts.join(roots, "rid", "left").select("key", "first", F.coalesce("root", "rid").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    moved, _ = table(named.join(least, "root").filter("first <> least").select("key", "least"), "moved")
    firsts, _ = table(texts.select("key", "first", "rows").join(moved, "key", "left").select("key", "rows", F.coalesce("least", "first").alias("first")), "firsts")
    return hot_join(every.select("doc_id", "h", "key"), firsts, "key", "rows").select("doc_id", "h", "first")


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id and component_id (the smallest doc_id reachable) over pairs of texts whose shingles' Jaccard similarity is at least this; one row for each row with a doc_id."""
    return _grouped(docs, words, similarity).select("doc_id", F.col("first.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group of near copies stays, whole and with all columns: the one of the smallest doc_id, then of the least hash of its text.

    Rows with a null doc_id stay.  Of rows that repeat a doc_id and text one stays.
    """
    i, h, number = (fresh(x, docs.columns) for x in ("near_id", "near_hash", "near_number"))
    found, _ = table(_grouped(docs, words, similarity).withColumnsRenamed({"doc_id": i, "h": h}), "grouped")
    rows = found.groupBy(i, h).agg(F.count(F.lit(1)).alias("rows"), F.any_value("first").alias("first"))
    rows, _ = table(rows.select(i, h, (F.struct(i, h) != F.struct("first.doc_id", "first.h")).alias("away"), (F.col("rows") > 1).alias("again")).filter("away or again"), "rows")
    gone, _ = table(rows.select(i, h), "gone")
    again, _ = table(rows.filter("again and not away").select(i, h), "again")
    marked = docs.withColumns({i: F.col("doc_id"), h: F.xxhash64("text")})
    once = beside(marked, gone, [i, h], "left_anti")
    # only rows that are repeated are dealt out by doc_id to number them
    order = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    many = beside(marked, again, [i, h], "left_semi").withColumn(number, F.row_number().over(Window.partitionBy(i, h).orderBy(*order))).filter(F.col(number) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return once.select(*columns).unionByName(many.select(*columns))
