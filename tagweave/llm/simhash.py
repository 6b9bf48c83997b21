"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints differ in at most r bits exactly when some 64-bit value lies
within r/2 bits of both.  So every distinct fingerprint emits the values within
r/2 bits (its variants), and fingerprints that share a variant are linked: both
lie within r/2 of it, hence within r of each other, so a shared variant is its
own verification (colliding pairs are not compared once more) and a star from its smallest fingerprint keeps every link's
connectivity without emitting pairs.

What is shuffled is not the 2,081 variants themselves but the distinct leading
`prefix` bits among them (37 for 8 bits); the task that gets a prefix makes the
variants under it, in blocks of bounded size that deepen the prefix where a
hot neighbourhood of fingerprints needs it.  `prefix` grows with the count of
distinct fingerprints so that a prefix keeps a bounded share.

Cases: null, empty and blank texts have fingerprint zero and link to each other
(and to any fingerprint within r bits of zero); repeated texts share one
fingerprint and are reduced before variants are made; rows with a null doc_id
get their component's smallest doc_id (null if none of its rows has one); an
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import components, hot_join, slices, table

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Variants that a task holds at once (8 bytes each, and a sorted copy).
BLOCK_VARIANTS = 4_000_000
#: Fingerprint rows aimed at under one prefix.
ROWS_A_PREFIX = 50_000


def fingerprint(text: str | None, words: int = 4) -> int:
    """The SimHash of one text: the majority, bit by bit, of XXH64 (seed 42) over its shingles."""
    return int(_fingerprints([text], words)[0])


def word_bytes(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingles(parts: list[bytes], words: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle, repeats included; of fewer words, of the whole sequence."""
    from xxhash import xxh64_intdigest

    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(size + 1) - 1
    n = max(1, len(parts) - words + 1)
    starts, stops = (ends - size)[:n].tolist(), ends[min(words, len(parts)) - 1 :].tolist()
    return np.fromiter((xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, stops)), np.uint64, n)


def _fingerprints(texts: list[str | None], words: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    for row, text in enumerate(texts):
        h = shingles(word_bytes(text), words)
        counts = np.zeros(64, np.int64)
        for a in range(0, len(h), 8192):
            counts += np.unpackbits(h[a : a + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[row] = np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 21):
            fp = _fingerprints(batch.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def masks(bits: list[int], radius: int) -> np.ndarray:
    """XOR masks that flip up to `radius` of these bits."""
    return np.array([sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(bits, k)], np.uint64)


def prefix_bits(n: int, half: int, rows: int, least: int = 4) -> int:
    """The least prefix (a multiple of 4, from `least`) that leaves at most about `rows` rows under each."""
    for p in range(least, 61, 4):
        if n * len(masks(list(range(p)), half)) / 2**p <= rows:
            return p
    return 60


def shared(fps: np.ndarray, prefix: int, key: int, half: int, floor: int = 0, rows: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Group and row (of fps; bits from `floor` up) of each variant under the prefix `key` that several rows hold, in blocks of bounded size."""
    rows = np.arange(len(fps)) if rows is None else rows
    if len(rows) < 2:
        return
    shift, some = np.uint64(64 - prefix), fps[rows]
    off = np.bitwise_count((some >> shift) ^ np.uint64(key))
    low = list(range(floor, 64 - prefix))
    per = [len(masks(low, half - d)) if d <= half else 0 for d in range(half + 1)]
    total = sum(int((off == d).sum()) * per[d] for d in range(half + 1))
    if total > BLOCK_VARIANTS and prefix <= 60 - floor:
        for sub in range(16):
            near = np.bitwise_count((some >> np.uint64(60 - prefix)) ^ np.uint64((key << 4) | sub)) <= half
            yield from shared(fps, prefix + 4, (key << 4) | sub, half, floor, rows[near])
        return
    under = (np.uint64(key) << shift) | (some & ((np.uint64(1) << shift) - np.uint64(1)))
    values, owners = [], []
    for d in range(half + 1):
        at = np.flatnonzero(off == d)
        if len(at):
            values.append((under[at, None] ^ masks(low, half - d)).ravel())
            owners.append(np.repeat(rows[at], per[d]))
    if not values:
        return
    value = np.concatenate(values)
    owner = np.concatenate(owners)
    ordered = np.sort(value)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    at = np.searchsorted(twice, value)
    at[at == len(twice)] = 0
    hit = np.flatnonzero(twice[at] == value)
    yield at[hit], owner[hit]


def _links(fps: np.ndarray, prefix: int, key: int, half: int) -> np.ndarray:
    """Star links (smallest fingerprint, member) between fingerprints that share a variant under the prefix `key`."""
    found = []
    for group, row in shared(fps, prefix, key, half):
        member = fps[row].view(np.int64)
        first = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, group, member)
        pairs = np.unique(np.stack([first[group], member], 1), axis=0)
        found.append(pairs[pairs[:, 0] != pairs[:, 1]])
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def links(distinct: DataFrame, radius: int, n: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints `fp` whose components are those of all pairs within `radius` bits."""
    half = radius // 2
    p = prefix_bits(n, half, ROWS_A_PREFIX, 8)
    flips = [int(m) for m in masks(list(range(p)), half)]
    keyed = distinct.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in flips])).alias("flip"))
    keyed = keyed.select("fp", F.shiftrightunsigned("fp", 64 - p).bitwiseXOR(F.col("flip")).alias("key"))
    parts = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * len(flips) // (4 * ROWS_A_PREFIX)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(key: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            pairs = _links(np.concatenate(held), p, key, half)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        key, held = None, []
        for batch in batches:
            fps, keys = batch.column("fp").to_numpy().view(np.uint64), batch.column("key").to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if key != keys[a] and held:
                        yield from flush(key, held)
                        held = []
                    key = int(keys[a])
                    held.append(fps[a:b])
        if held:
            yield from flush(key, held)

    return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 4, words: int = 4) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links of at most `radius` bits; even radius)."""
    fp, _ = table(fingerprints(docs, words), "fingerprints")
    small, _ = table(fp.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows")), "distinct")
    roots = components(links(small.select("fp"), radius, small.count()))
    grouped = roots.join(small, roots["node"] == small["fp"]).select("root", "node", "first_id")
    least = grouped.groupBy("root").agg(F.min("first_id").alias("root_id"))
    moved, _ = table(grouped.join(least, "root").filter("first_id <> root_id").select(F.col("node").alias("fp"), "root_id"), "moved")
    ids, _ = table(small.join(moved, "fp", "left").select("fp", "rows", F.coalesce("root_id", "first_id").alias("component_id")), "ids")
    return hot_join(fp, ids, "fp", "rows").select("doc_id", "fp", "component_id")


def op7(docs: DataFrame) -> DataFrame:
    """The contract's columns: fingerprint as 16 hex digits."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
