"""Benchmark decontamination with a positional inverted index over the training documents.

`build_index` tokenises whole documents once and writes the index as Parquet in
the shared folder: a row is a segment (a run of documents, about `SEGMENT`
bytes of text), and holds its documents and, for each term in it, the sorted
positions of that term.  Segments are independent, so the index is spread over
the cluster by document, nothing is shuffled, and a lost task only reads its
segments again.

`search` takes the test terms a block of windows at a time (each block has at
most `BLOCK_WINDOWS` windows, so what is broadcast is bounded; more windows mean
more passes over the index).  In a segment, windows with a term that does not
occur drop out at once; for the rest, offset-adjusted position lists are
intersected from the rarest term upwards, which leaves the exact places.
`proximity` does the same with lists that must meet within a span.

Terms are held as 64-bit hashes (a random-table polynomial, mixed); a wrong
match needs a collision with a test term inside an otherwise equal window.

Cases: null and empty texts have no words, no hits and are kept in the result;
items without words match nothing; items of fewer than `window` words are one
window of all their words; repeated rows and repeated or null doc_ids are each
their own row (rows are keyed by segment and place, never by doc_id); an empty
benchmark leaves all documents clean; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.bytehash import Words
from tagweave.llm.common import beside, fresh, joined_bytes, slices, table

#: Bytes of text in a segment of the index.
SEGMENT = 1 << 21
#: Windows of the benchmark that a pass over the index takes along.
BLOCK_WINDOWS = 200_000

def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word in these bytes and its 64-bit hash."""
    words = Words(data)
    return words.start, words.hashes()


def build_index(docs: DataFrame) -> DataFrame:
    """The index as a written table: a row per segment.

    seg; doc_ids, first (position of each document's first word; one free
    position lies between documents) and n_words by document; terms (sorted
    uint64), counts, and positions (uint32, by term, as byte planes of the steps).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for k, batch in enumerate(slices(batches, "text", SEGMENT)):
            data, starts = joined_bytes(batch.column("text"))
            at, h = words_of(data)
            doc = np.searchsorted(starts, at, side="right") - 1
            n_words = np.bincount(doc, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(n_words + 1)[:-1]])
            pos = (np.arange(len(at)) + doc).astype(np.uint32)
            order = np.argsort(h, kind="stable")
            h, pos = h[order], pos[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            step = np.diff(pos, prepend=np.uint32(0))
            step[new] = pos[new]
            counts = np.diff(np.append(new, len(h))).astype(np.int32)
            one = lambda x, t: pa.array([x], pa.list_(t))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{part}-{k}"]),
                    pa.array([batch.column("doc_id").to_pylist()], pa.list_(batch.schema.field("doc_id").type)),
                    one(first.astype(np.int32), pa.int32()),
                    one(n_words.astype(np.int32), pa.int32()),
                    pa.array([h[new].tobytes()], pa.binary()),
                    one(counts, pa.int32()),
                    pa.array([np.ascontiguousarray(step.view(np.uint8).reshape(-1, 4).T).tobytes()], pa.binary()),
                ],
                names=["seg", "doc_ids", "first", "n_words", "terms", "counts", "positions"],
            )

    schema = f"seg string, doc_ids array<{kind}>, first array<int>, n_words array<int>, terms binary, counts array<int>, positions binary"
    index, _ = table(docs.select("doc_id", "text").mapInArrow(run, schema), "index")
    return index


class Segment:
    """Row i of a batch of the index, opened."""

    def __init__(self, batch: pa.RecordBatch, i: int) -> None:
        ints = lambda name: batch.column(name)[i].values.to_numpy().astype(np.int64)
        self.first, self.n_words = ints("first"), ints("n_words")
        self.terms = np.frombuffer(batch.column("terms")[i].as_py(), np.uint64)
        self.ends = np.cumsum(ints("counts"))
        planes = np.frombuffer(batch.column("positions")[i].as_py(), np.uint8).reshape(4, -1)
        self.steps = np.ascontiguousarray(planes.T).view(np.uint32).ravel()

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The number of each of these terms here, -1 for those that don't occur."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == terms, at, -1)

    def count(self, number: int) -> int:
        return int(self.ends[number] - (self.ends[number - 1] if number else 0))

    def positions(self, number: int) -> np.ndarray:
        a = self.ends[number - 1] if number else 0
        return np.cumsum(self.steps[a : self.ends[number]].astype(np.int64))

    def phrase(self, numbers: np.ndarray) -> np.ndarray:
        """Positions where these terms stand one after the other."""
        lists: dict[int, np.ndarray] = {}
        order = sorted(range(len(numbers)), key=lambda i: self.count(numbers[i]))
        found = self.positions(numbers[order[0]]) - order[0]
        for i in order[1:]:
            number = int(numbers[i])
            if number not in lists:
                lists[number] = self.positions(number)
            at = np.searchsorted(lists[number], found + i)
            at[at == len(lists[number])] = 0
            found = found[lists[number][at] == found + i]
            if not len(found):
                break
        return found

    def near(self, numbers: np.ndarray, span: int) -> np.ndarray:
        """Positions of the rarest term that has each other term less than `span` words away in its document."""
        order = sorted(set(map(int, numbers)), key=self.count)
        found = self.positions(order[0])
        doc = np.searchsorted(self.first, found, side="right") - 1
        low, high = self.first[doc], self.first[doc] + self.n_words[doc] - 1
        keep = np.ones(len(found), bool)
        for number in order[1:]:
            where = self.positions(number)
            a = np.searchsorted(where, np.maximum(found - span + 1, low))
            b = np.searchsorted(where, np.minimum(found + span - 1, high), side="right")
            keep &= b > a
        return found[keep]


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id and the terms (binary) of each window."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                _, h = words_of(np.frombuffer((text or "").encode() + b"\n", np.uint8))
                for a in range(max(1, len(h) - window + 1) if len(h) else 0):
                    ids.append(item)
                    terms.append(h[a : a + window].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("item_id").type), pa.array(terms, pa.binary())], names=["item_id", "terms"])

    return benchmark.select("item_id", "text").filter("text is not null").mapInArrow(run, f"item_id {kind}, terms binary")


def _blocks(cut: DataFrame, limit: int) -> Iterator[list[bytes]]:
    """The distinct windows' terms in blocks of about `limit`; a block is held by the driver at a time."""
    terms = cut.select("terms").distinct()
    n = -(-terms.count() // limit)
    for b in range(n):
        # distinct terms hash evenly, so a block holds about `limit` of them however many items share one
        yield [r[0] for r in terms.filter(F.pmod(F.xxhash64("terms"), F.lit(n)) == b).collect()]


def _pass(index: DataFrame, keys: list[bytes], span: int | None) -> DataFrame:
    """seg, place (of the document in it), starts and sizes of what each found window covers, and found, their terms: a row for each document with hits."""
    flat = np.frombuffer(b"".join(keys), np.uint64)
    sizes = np.array([len(k) // 8 for k in keys], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = np.cumsum(sizes) - sizes
        for batch in batches:
            for i in range(batch.num_rows):
                seg = Segment(batch, i)
                number = seg.find(flat)
                starts: dict[int, list] = {}
                names: dict[int, set] = {}
                for w in np.flatnonzero(np.minimum.reduceat(number, begin) >= 0).tolist():
                    numbers = number[begin[w] : begin[w] + sizes[w]]
                    found = seg.phrase(numbers) if span is None else seg.near(numbers, span)
                    for doc, at in zip((np.searchsorted(seg.first, found, side="right") - 1).tolist(), found.tolist()):
                        starts.setdefault(doc, []).append((at - int(seg.first[doc]), int(sizes[w]) if span is None else 1))
                        names.setdefault(doc, set()).add(keys[w])
                docs = sorted(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("seg")[i].as_py()] * len(docs), pa.string()),
                        pa.array(docs, pa.int32()),
                        pa.array([[s for s, _ in starts[d]] for d in docs], pa.list_(pa.int32())),
                        pa.array([[n for _, n in starts[d]] for d in docs], pa.list_(pa.int32())),
                        pa.array([sorted(names[d]) for d in docs], pa.list_(pa.binary())),
                    ],
                    names=["seg", "place", "starts", "sizes", "found"],
                )

    needed = index.select("seg", "first", "n_words", "terms", "counts", "positions")
    return needed.mapInArrow(run, "seg string, place int, starts array<int>, sizes array<int>, found array<binary>")


def search(index: DataFrame, benchmark: DataFrame, window: int = 10, span: int | None = None, block: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted strings), a row for each indexed document.

    span None: exact phrases, n_hit counts the words inside any of them.
    Otherwise proximity: a window's terms all lie less than `span` words from
    its rarest one, in any order; n_hit counts those rarest words.
    """
    hits = None
    cut, _ = table(_windows(benchmark, window).distinct(), "windows")
    for rows in _blocks(cut, block):
        if rows:
            one, _ = table(_pass(index, rows, span), "hits")
            hits = one if hits is None else hits.unionByName(one)
    every = index.select("seg", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "d")).select("seg", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").cast("long").alias("n_words"))
    if hits is None:
        return every.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.arrays_zip("starts", "sizes"), lambda x: F.sequence(x["starts"], x["starts"] + x["sizes"] - 1)))))
    merged = hits.groupBy("seg", "place").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("sizes")).alias("sizes"))
    merged = merged.select("seg", "place", covered.cast("long").alias("n_hit"))
    named = hits.select("seg", "place", F.explode("found").alias("terms")).join(cut, "terms").select("seg", "place", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"))
    named = named.groupBy("seg", "place").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return every.join(merged.join(named, ["seg", "place"]), ["seg", "place"], "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op2(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns."""
    found = search(build_index(docs), benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without any benchmark window, whole and with all columns.

    A row goes by its text alone (named by a hash of it), so rows that repeat a
    doc_id, or have none, stay or go each on their own.
    """
    name = fresh("text_hash", docs.columns)
    found = search(build_index(docs.select(F.xxhash64("text").alias("doc_id"), "text")), benchmark)
    bad, _ = table(found.filter("n_hit > 0").select(F.col("doc_id").alias(name)).distinct(), "bad")
    return beside(docs.withColumn(name, F.xxhash64("text")), bad, [name], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
g AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT g.r, g.i, g.n, win.item_id FROM g JOIN win ON g.n = win.n AND g.g = win.g),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
