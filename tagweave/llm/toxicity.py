"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a fixed lexicon and of a learnt one
(words and leading parts of words that labelled rows tie to the label), how
near second-person words stand to lexicon words, capitals, punctuation,
obfuscation (symbols or digits inside words, lexicon words behind such) and
repetition.  Everything is counted on byte arrays of whole batches.

The model is fit on at most SAMPLE_ROWS labelled rows of each class (a hash of
doc_id picks them).  Trees and the calibration see lexicon features from folds
that leave a row's own fold out, so a word is never evidence for the row it was
learnt from; calibration weighs the classes as they are in all labelled rows.

Cases: null and empty texts have all-zero features and get the score that such
features get; repeated rows score alike; labels that are null, or of documents
that don't exist, teach nothing, and a document with several labels counts once
with the largest; with fewer than two classes every score is the share of class
1 (0 with no labels); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.bytehash import WORD, LOWER_VALUES, Words, among, hash_words
from tagweave.llm.common import joined_bytes, slices, table
from tagweave.llm.langid import held_out
from tagweave.session import ship

#: Labelled rows of each class that the model is fit on, at most (about).
SAMPLE_ROWS = 2_500
_SLICE = 1 << 18
FOLDS = 5
#: Insults, and second-person words, in the languages at hand.
INSULTS = (
    "idiot idiots moron morons stupid dumb fool loser losers scum trash garbage worthless pathetic disgusting clown jerk creep freak liar coward lunatic imbecile cretin dimwit "
    "bastard bitch crap damn shit fuck fucking asshole hate ugly vermin filth parasite pig rat "
    "dumm idiotisch trottel arschloch schwein dreck abschaum imbécile connard salaud merde crétin abruti ordure idiota estúpido imbécil tonto basura cabrón mierda asqueroso"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros os".split()

_LEET = {ord(a): ord(b) for a, b in zip("013457@$!", "oieastasi")}
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "*@$#!0123456789"]] = True
_LEET_WORD = WORD.copy()
_LEET_VALUES = LOWER_VALUES.copy()
for _k, _v in _LEET.items():
    _LEET_WORD[_k] = True
    _LEET_VALUES[_k] = LOWER_VALUES[_v]
PREFIXES = (4, 5, 6, 7)
NAMES = ("fixed", "fixed_n", "strong", "strong_n", "weak", "best", "nearness", "second", "capitals", "shouting", "punctuation", "marks", "obfuscated", "hidden", "runs", "repeats", "length", "mean_word")


class Batch:
    """Words of some texts and the hashes of the words and of their leading parts."""

    def __init__(self, texts: pa.Array) -> None:
        self.data, self.starts = joined_bytes(texts)
        self.n = len(texts)
        words = Words(self.data)
        self.words = words
        self.doc = np.searchsorted(self.starts, words.start, side="right") - 1
        self.full = words.hashes()
        size = words.end - words.start
        self.parts = []
        for p in PREFIXES:
            long = np.flatnonzero(size > p)
            self.parts.append((long, words.part(words.start[long], words.start[long] + p) ^ np.uint64(p)))

    def tokens(self) -> list[np.ndarray]:
        """The distinct hashes of each text."""
        doc = np.concatenate([self.doc, *[self.doc[i] for i, _ in self.parts]])
        h = np.concatenate([self.full, *[x for _, x in self.parts]])
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        cut = np.searchsorted(doc[keep], np.arange(self.n + 1))
        return [h[keep][a:b] for a, b in zip(cut, cut[1:])]

    def shape(self) -> np.ndarray:
        """The features that need no lexicon but the fixed one."""
        n, doc, at = self.n, self.doc, self.starts
        by_byte = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[at])
        words = np.bincount(doc, minlength=n)
        per = 1 / np.maximum(words, 1)
        d = self.data
        letter = _LETTER[d]
        letters = np.maximum(by_byte(letter), 1)
        upper = (d >= 65) & (d <= 90)
        size = np.maximum(np.diff(at) - 1, 1)
        inner = np.zeros(len(d), bool)
        inner[1:-1] = _SYMBOL[d[1:-1]] & letter[:-2] & letter[2:]
        runs = np.zeros(len(d), bool)
        runs[2:] = (d[2:] == d[1:-1]) & (d[1:-1] == d[:-2]) & letter[2:]
        caps = np.concatenate([[0], np.cumsum(upper)])
        w = self.words
        shout = (caps[w.end] - caps[w.start] == w.end - w.start) & (w.end - w.start > 2)
        same = np.zeros(len(doc), bool)
        same[1:] = (self.full[1:] == self.full[:-1]) & (doc[1:] == doc[:-1])
        fixed = among(self.full, _INSULTS)
        leet = Words(d, _LEET_WORD, _LEET_VALUES)
        behind = among(leet.hashes(), _INSULTS)
        symbols = np.concatenate([[0], np.cumsum(~WORD[d] | ((d >= 48) & (d <= 57)))])
        behind &= symbols[leet.end] > symbols[leet.start]
        hidden = np.bincount(np.searchsorted(at, leet.start[behind], side="right") - 1, minlength=n)
        self.second = among(self.full, _SECOND)
        self.fixed = fixed
        count = lambda mask: np.bincount(doc[mask], minlength=n)
        self.per, self.count = per, count
        return np.stack(
            [count(fixed) * per, np.minimum(count(fixed), 5), count(self.second) * per, by_byte(upper) / letters, count(shout) * per, by_byte(_PUNCT[d]) / size, by_byte((d == 33) | (d == 63)) / size,
             by_byte(inner) * per, np.minimum(hidden, 5), by_byte(runs) / size, count(same) * per, np.log1p(words), (size - words) * per],
            1,
        )

    def learnt(self, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """strong, strong_n, weak, best, nearness under this lexicon (sorted hashes and their evidence)."""
        keys, weight = lexicon
        evidence = np.zeros(len(self.full))
        for i, h in [(slice(None), self.full), *self.parts]:
            hit = among(h, keys)
            if hit.any():
                got = np.zeros(len(h))
                got[hit] = weight[np.searchsorted(keys, h[hit])]
                evidence[i] = np.maximum(evidence[i], got)
        strong, weak = evidence > 0.9, (evidence > 0) & (evidence <= 0.9)
        best = np.zeros(self.n)
        np.maximum.at(best, self.doc, evidence)
        # how near the next second-person word on either side of a lexicon word stands
        bad, you = np.flatnonzero(strong | self.fixed), np.flatnonzero(self.second)
        near = np.zeros(self.n)
        if len(bad) and len(you):
            k = np.searchsorted(you, bad)
            for side in (np.clip(k - 1, 0, len(you) - 1), np.clip(k, 0, len(you) - 1)):
                gap = np.where(self.doc[you[side]] == self.doc[bad], np.abs(you[side] - bad), 1 << 30)
                np.maximum.at(near, self.doc[bad], 1 / (1.0 + gap))
        return np.stack([self.count(strong) * self.per, np.minimum(self.count(strong), 5), self.count(weak) * self.per, best, near], 1)


_INSULTS = hash_words(INSULTS)
_SECOND = hash_words(SECOND_PERSON)


def _order(shape: np.ndarray, learnt: np.ndarray) -> np.ndarray:
    return np.concatenate([shape[:, :2], learnt, shape[:, 2:]], 1)


def learn_lexicon(tokens: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that at least three rows of class 1 hold and that say class 1 with evidence of 0.7 or more (the smoothed share)."""
    if not len(y) or not y.any():
        return np.zeros(0, np.uint64), np.zeros(0)
    keys, n1 = np.unique(np.concatenate([t for t, v in zip(tokens, y) if v == 1]), return_counts=True)
    keys, n1 = keys[n1 >= 3], n1[n1 >= 3]
    n0 = np.zeros(len(keys))
    for t, v in zip(tokens, y):
        if v == 0 and len(keys):
            n0[np.searchsorted(keys, t[among(t, keys)])] += 1
    w1, w0 = n1 * weight[y == 1].mean(), n0 * (weight[y == 0].mean() if (y == 0).any() else 0.0)
    prior = float((y * weight).sum() / weight.sum())
    share = (w1 + prior * 0.25) / (w1 + w0 + 0.25)
    return keys[share >= 0.7], share[share >= 0.7]


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, lam: float = 1.0) -> dict:
    """Gradient-boosted trees with logistic loss on quantile bins.

    A tree is a full binary tree: `feature` and `cut` of its inner nodes in
    breadth-first order (feature 0 and an infinite cut where nothing is gained), and its leaves.
    """
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    # rare features have all their quantiles at zero
    cuts = [np.unique(np.append(c, [0.0, *np.quantile(x[x[:, j] > 0, j], [0.1, 0.3, 0.5, 0.7, 0.9])] if (x[:, j] > 0).any() else c)) for j, c in enumerate(cuts)]
    box = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    share = float((y * weight).sum() / weight.sum())
    start = float(np.log(share / (1 - share)))
    score = np.full(len(y), start)
    out = {"start": start, "depth": depth, "feature": [], "cut": [], "leaf": []}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = (p - y) * weight, np.maximum(p * (1 - p), 1e-6) * weight
        node = np.zeros(len(y), np.int64)
        feature, cut = [], []
        for level in range(depth):
            k = 1 << level
            best = np.full(k, 1e-6)
            pick = [(0, np.inf, len(cuts[0]))] * k
            gg, hh = (np.bincount(node, weights=v, minlength=k) for v in (g, h))
            whole = gg**2 / (hh + lam)
            for j, c in enumerate(cuts):
                m = len(c) + 1
                gl, hl = (np.cumsum(np.bincount(node * m + box[:, j], weights=v, minlength=k * m).reshape(k, m), 1)[:, :-1] for v in (g, h))
                gain = gl**2 / (hl + lam) + (gg[:, None] - gl) ** 2 / (hh[:, None] - hl + lam) - whole[:, None]
                if gain.shape[1]:
                    a = gain.argmax(1)
                    for i in np.flatnonzero(gain[np.arange(k), a] > best):
                        best[i] = gain[i, a[i]]
                        pick[i] = (j, float(c[a[i]]), int(a[i]))
            feature += [f for f, *_ in pick]
            cut += [c for _, c, _ in pick]
            f, b = np.array([f for f, *_ in pick]), np.array([b for *_, b in pick])
            node = 2 * node + (box[np.arange(len(y)), f[node]] > b[node])
        leaf = -np.bincount(node, weights=g, minlength=1 << depth) / (np.bincount(node, weights=h, minlength=1 << depth) + lam) * rate
        score += leaf[node]
        out["feature"].append(feature)
        out["cut"].append(cut)
        out["leaf"].append(leaf)
    out |= {k: np.array(out[k]) for k in ("feature", "cut", "leaf")}
    return out


def raw_scores(model: dict, x: np.ndarray) -> np.ndarray:
    score = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for feature, cut, leaf in zip(model["feature"], model["cut"], model["leaf"]):
        node = np.zeros(len(x), np.int64)
        first = 0
        for level in range(model["depth"]):
            node = 2 * node + (x[rows, feature[first + node]] > cut[first + node])
            first += 1 << level
        score += leaf[node]
    return score


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and their non-decreasing values."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # value, weight, first and last score
    for s, t, w in zip(score[order], y[order], weight[order]):
        blocks.append([float(t), float(w), float(s), float(s)])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            v, u, _, last = blocks.pop()
            b = blocks[-1]
            b[0], b[1], b[3] = (b[0] * b[1] + v * u) / (b[1] + u), b[1] + u, last
    knots = np.array([x for b in blocks for x in (b[2], b[3])])
    return knots, np.array([b[0] for b in blocks for _ in (0, 1)])


class Model:
    def __init__(self, lexicon: tuple, trees: dict | None, knots: tuple | None, share: float) -> None:
        self.lexicon, self.trees, self.knots, self.share = lexicon, trees, knots, share

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        batch = Batch(texts)
        shape = batch.shape()
        return np.clip(np.interp(raw_scores(self.trees, _order(shape, batch.learnt(self.lexicon))), *self.knots), 0, 1)


def fit(docs: DataFrame, known: DataFrame) -> Model:
    """docs: doc_id, text; known: doc_id, toxic, a row a document.

    Labels other than 0 and 1, and of documents that docs lacks, teach nothing.
    The sample is drawn from the labels, so texts are not shuffled: its ids are broadcast.
    """
    ship(docs.sparkSession)
    known = known.filter("toxic in (0, 1)").join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    none = np.zeros(0, np.uint64), np.zeros(0)
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Model(none, None, None, float(1 in n))
    u = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rate = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_ROWS / n[1])).otherwise(min(1.0, SAMPLE_ROWS / n[0]))
    # copies mostly share their start, so they share their fold
    fold = F.pmod(F.xxhash64(F.substring("text", 1, 40)), F.lit(FOLDS)).cast("int").alias("fold")
    some = known.filter(u < rate).select("doc_id", F.col("toxic").cast("int").alias("toxic")).limit(3 * SAMPLE_ROWS)
    picked, _ = table(docs.join(F.broadcast(some), "doc_id").select("doc_id", "toxic", fold, "text"), "labelled")

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", _SLICE):
            tokens = pa.array([t.tobytes() for t in Batch(part.column("text")).tokens()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("toxic"), part.column("fold"), tokens], names=["toxic", "fold", "tokens"])

    rows = picked.select("text", "toxic", "fold").mapInArrow(tokens_of, "toxic int, fold int, tokens binary").toPandas()
    y = rows["toxic"].to_numpy(np.float64)
    if not 0 < y.sum() < len(y):
        return Model(none, None, None, n[1] / (n[0] + n[1]))
    tokens = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
    part_of = rows["fold"].to_numpy()
    heavy = {1: n[1] / y.sum(), 0: n[0] / (len(y) - y.sum())}
    weight = np.where(y == 1, heavy[1], heavy[0])
    del rows
    lexicons = []
    for f in [*range(FOLDS), -1]:
        rest = np.flatnonzero(part_of != f)
        lexicons.append(learn_lexicon([tokens[i] for i in rest], y[rest], weight[rest]))

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", _SLICE):
            batch = Batch(part.column("text"))
            shape, fold = batch.shape(), part.column("fold").to_numpy()
            learnt = np.stack([batch.learnt(x) for x in lexicons[:-1]])[fold, np.arange(batch.n)]
            x = pa.array([r.tobytes() for r in _order(shape, learnt)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.string()), part.column("toxic"), part.column("fold"), x], names=["doc_id", "toxic", "fold", "x"])

    rows = picked.mapInArrow(features_of, "doc_id string, toxic int, fold int, x binary").toPandas().sort_values(["doc_id", "x"])
    x = np.stack([np.frombuffer(v, np.float64) for v in rows["x"]])
    y, part_of = rows["toxic"].to_numpy(np.float64), rows["fold"].to_numpy()
    weight = np.where(y == 1, heavy[1], heavy[0])
    weight /= weight.mean()
    held = np.zeros(len(y))
    for f in range(FOLDS):
        rest = part_of != f
        if 0 < y[rest].sum() < rest.sum():
            held[~rest] = raw_scores(boost(x[rest], y[rest], weight[rest]), x[~rest])
    return Model(lexicons[-1], boost(x, y, weight), isotonic(held, y, weight), 0.0)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs and its score, in place of any column of that name; only the text is read."""
    where = [c for c in docs.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", _SLICE):
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in where], pa.array(model.score(part.column("text")))], names=[*where, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*where).schema)
    return ship(docs.sparkSession) and docs.select(*where).mapInArrow(run, f"{schema}, `{name}` double")


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = fit(docs.select("doc_id", "text"), known.filter(~held_out(5, 0)))
    out = score(docs.select("doc_id", held_out(5, 0).alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
