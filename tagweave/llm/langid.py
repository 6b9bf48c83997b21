"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, everything else becomes one boundary symbol, and 1- to
3-grams of code points are hashed into `DIMS` columns.  Document frequencies
come from every training row (partial sums in each task, then one sum by
column).  Weights come from a bounded sample of training rows (SAMPLE_ROWS, at
most, dealt by language) plus two short cuts of each of them, by
follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties; a
fifth of the sample sets the temperature that calibrates the scores.

Cases: null texts and texts without a letter are `und` with score 0; empty and
very long texts are taken whole; repeated rows are scored alike; rows with a
null lang are scored but not learnt from; with nothing to learn from every row
is `und`; an empty table gives an empty result.  lang, source and doc_id are
not inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import fresh, slices
from tagweave.session import ship

DIMS = 1 << 15
#: Rows that weights are learnt from, at most (about; a hash picks them).
SAMPLE_ROWS = 2_000
_SLICE = 1 << 18


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point of the basic plane to lower-case letter (0 for what is no letter)."""
    out = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return out


def _symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each text between boundary symbols, and which text each is of."""
    parts = ["" if t is None else t for t in texts]
    codes = np.frombuffer("\n".join(["", *parts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    owner = np.repeat(np.arange(len(parts)), size)
    table = _letters()
    symbols = table[np.minimum(codes, (1 << 16) - 1)]
    above = np.flatnonzero(codes >= 1 << 16)
    if len(above):
        found, at = np.unique(codes[above], return_inverse=True)
        lower = [ord(x.lower()) if x.isalpha() and len(x.lower()) == 1 else ord(x) * x.isalpha() for x in map(chr, found.tolist())]
        symbols[above] = np.array(lower, np.uint32)[at]
    return symbols.astype(np.uint32), np.append(owner, len(parts) - 1)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (row, column) pairs of these texts as two arrays, and their counts."""
    s, owner = _symbols(texts)
    a, b, c = (s[k:] for k in (0, 1, 2))
    keys = []
    for n in (1, 2, 3):
        m = len(s) - n + 1
        if m <= 0:
            continue
        h = a[:m] * np.uint32(0x9E3779B1) + np.uint32(n)
        some = s[:m] > 0
        if n > 1:
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) + b[:m] * np.uint32(0xC2B2AE3D)
            some = some | (b[:m] > 0)
        if n > 2:
            h = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F) + c[:m] * np.uint32(0x165667B1)
            some = (b[:m] > 0) & (some | (c[:m] > 0))
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x7FEB352D)
        at = owner[:m] if n == 1 else np.where(s[:m] > 0, owner[:m], owner[1 : 1 + m]) if n == 2 else owner[1 : 1 + m]
        keys.append((at.astype(np.int64) * DIMS + (h >> np.uint32(17)).astype(np.int64))[some])
    key = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    if not len(key):
        return key, key, key
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(new, len(key)))
    key = key[new]
    return key // DIMS, key % DIMS, count


def _weigh(row: np.ndarray, col: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """TF-IDF values with rows of length 1."""
    v = (1 + np.log(count)) * idf[col]
    norm = np.sqrt(np.bincount(row, weights=v * v, minlength=n))
    return v / np.maximum(norm, 1e-12)[row]


def document_frequency(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training rows each column occurs, over all of them, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in slices(batches, "text", _SLICE):
            _, col, _ = grams(batch.column("text").to_pylist())
            df += np.bincount(col, minlength=DIMS)
            n += batch.num_rows
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], n))], names=["col", "n"])

    parts = train.select("text").mapInArrow(run, "col long, n long").groupBy("col").agg(F.sum("n").alias("n")).toPandas()
    df, n = np.zeros(DIMS, np.int64), 0
    for c, x in zip(parts["col"], parts["n"]):
        if c < 0:
            n = int(x)
        else:
            df[c] = x
    return df, n


def _sample(train: DataFrame, langs: dict[str, int]) -> list[tuple[str, list[list[np.ndarray]]]]:
    """For each picked row: lang, and columns and counts of the text and of two cuts of it."""
    share = max(20, SAMPLE_ROWS // max(1, len(langs)))
    rate = F.create_map(*[F.lit(x) for k, n in langs.items() for x in (k, min(1.0, share / n))])
    u = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # examples are learnt from in this order, whichever way rows arrive
    order = [F.xxhash64("doc_id", F.lit("order")), F.xxhash64("text"), F.col("lang")]
    picked = train.filter(u < F.element_at(rate, F.col("lang"))).orderBy(*order).select("lang", "text").limit(2 * SAMPLE_ROWS + 40 * len(langs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                n = len(text)
                middle = text[n // 2 : n // 2 + 120], text[n // 3 : n // 3 + 30]
                row, col, count = grams([text, *middle])
                cut = np.searchsorted(row, [0, 1, 2, 3])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([col.astype(np.int32)], pa.list_(pa.int32())), pa.array([count.astype(np.int32)], pa.list_(pa.int32())), pa.array([cut.astype(np.int32)], pa.list_(pa.int32()))],
                    names=["lang", "col", "count", "cut"],
                )

    out = []
    for r in picked.mapInArrow(run, "lang string, col array<int>, count array<int>, cut array<int>").toLocalIterator():
        col, count = np.array(r["col"], np.int64), np.array(r["count"], np.int64)
        out.append((r["lang"], [[col[a:b], count[a:b]] for a, b in zip(r["cut"], r["cut"][1:]) if b > a]))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], k: int, *, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 4) -> np.ndarray:
    """Weights (DIMS + 1, k); the last row is the bias, which isn't penalised."""
    z, n, w = (np.zeros((DIMS + 1, k)) for _ in range(3))
    order = np.random.default_rng(3)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            col, v, y = examples[i]
            col, v = np.append(col, DIMS), np.append(v, 0.2)
            zz, nn = z[col], n[col]
            first = np.where(col == DIMS, 0.0, l1)[:, None]
            second = np.where(col == DIMS, 0.0, l2)[:, None]
            ww = np.where(np.abs(zz) <= first, 0.0, -(zz - np.sign(zz) * first) / ((beta + np.sqrt(nn)) / alpha + second))
            p = _softmax(v @ ww)
            p[y] -= 1
            g = v[:, None] * p
            z[col] = zz + g - (np.sqrt(nn + g * g) - np.sqrt(nn)) / alpha * ww
            n[col] = nn + g * g
    first = np.full((DIMS + 1, 1), l1)
    second = np.full((DIMS + 1, 1), l2)
    first[-1] = second[-1] = 0
    return np.where(np.abs(z) <= first, 0.0, -(z - np.sign(z) * first) / ((beta + np.sqrt(n)) / alpha + second))


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of scores with the least negative log-likelihood, by golden section between 0.05 and 10."""
    loss = lambda t: -np.log(np.maximum(_softmax(scores / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()
    a, b, r = np.log(0.05), np.log(10.0), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


class Model:
    """idf, weights of the columns that have any, classes and temperature."""

    def __init__(self, idf: np.ndarray, w: np.ndarray, langs: list[str], t: float) -> None:
        self.idf, self.w, self.langs, self.t = idf.astype(np.float32), w.astype(np.float32), langs, t
        self.active = np.abs(w[:DIMS]).sum(1) > 0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """A lang and its probability for each text."""
        row, col, count = grams(texts)
        has = np.zeros(len(texts), bool)
        has[row] = True
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        v = _weigh(row, col, count, self.idf, len(texts))
        use = self.active[col]
        row, col, v = row[use], col[use], v[use]
        scores = np.stack([np.bincount(row, weights=v * self.w[col, k], minlength=len(texts)) for k in range(len(self.langs))], 1) + self.w[DIMS] * 0.2
        p = _softmax(scores / self.t)
        best = p.argmax(1)
        return [self.langs[b] if h else "und" for b, h in zip(best, has)], np.where(has, p.max(1), 0.0)


def fit(train: DataFrame) -> Model:
    """train: doc_id, text, lang, of which rows with a null text or lang teach nothing.

    Every lang value is learnt (the model holds a column of weights for each);
    of languages with equal probability the first by code point is predicted.
    """
    ship(train.sparkSession)
    train = train.filter("lang is not null and text is not null")
    langs = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(langs)
    if not names:
        return Model(np.ones(DIMS), np.zeros((DIMS + 1, 0)), [], 1.0)
    df, n = document_frequency(train)
    idf = np.log((1 + n) / (1 + df)) + 1
    examples, held = [], []
    for i, (lang, cuts) in enumerate(sorted(_sample(train, langs), key=lambda x: x[0])):
        for col, count in cuts:
            v = _weigh(np.zeros(len(col), np.int64), col, count, idf, 1)
            (held if i % 5 == 4 else examples).append((col, v, names.index(lang)))
    w = ftrl(examples, len(names))
    t = 1.0
    if held:
        scores = np.stack([v @ w[col] + 0.2 * w[DIMS] for col, v, _ in held])
        t = temperature(scores, np.array([y for *_, y in held]))
    return Model(idf, w, names, t)


def predict(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs and two more columns, in place of any of those names; only the text is read."""
    where = [c for c in docs.columns if c.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            lang, score = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in where], pa.array(lang, pa.string()), pa.array(score)], names=[*where, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*where).schema)
    return docs.select(*where).mapInArrow(run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def held_out(mod: int, rest: int) -> F.col:
    """Whether crc32 of doc_id as text leaves this rest; a null doc_id doesn't."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, F.lit(False))


def op9(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    model = fit(docs.select("doc_id", "text", "lang").filter(~held_out(4, 2)))
    out = predict(docs.select("doc_id", held_out(4, 2).alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows whose language is recognised, whole and with all columns.

    A row goes when it is `und` (null, or no letter) or when no language
    reaches the probability `least`, which a text in a learnt language does.
    """
    model = fit(docs.select("doc_id", "text", "lang").filter(~held_out(4, 2)))
    lang, score = (fresh(c, docs.columns) for c in ("lang_pred", "score"))
    return predict(docs, model, (lang, score)).filter((F.col(lang) != "und") & (F.col(score) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
