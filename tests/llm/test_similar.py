"""Near copies by similarity, against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from tagweave.llm import neardup, simhash


def test_similar_groups(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(3000)]
    rows = [(i, rng.choices(words, k=rng.randint(60, 300))) for i in range(150)]
    for i in range(100, 250):
        base = list(rows[i - 100][1])
        for at in rng.sample(range(len(base)), max(1, len(base) // rng.choice((40, 60, 90)))):
            base[at] = rng.choice(words)
        rows.append((i + 50, base))
    docs = [(i, " ".join(w)) for i, w in rows] + [(900, rows[3][1][0]), (901, None), (902, ""), (903, " ".join(rows[5][1])), (None, "x y z")]
    sets = {i: set(simhash.shingles(simhash.word_bytes(t), 5).tolist()) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = [(a, b) for a in sets for b in sets if a < b and (len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.similar_groups(df).collect()}
    assert got.keys() == sets.keys() and len(pairs) > 60
    assert np.mean([got[a] == got[b] for a, b in pairs]) >= 0.97
    for a, b in pairs:
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert all(top(i) == top(c) for i, c in got.items())
    kept = [r["doc_id"] for r in neardup.keep_one(df).collect()]
    assert None in kept and len(kept) == len(set(got.values())) + 1


def test_keep_one_rows(spark):
    """Repeated ids with other texts, repeated rows, clashing column names, no rows."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(7, a, 1), (7, b, 2), (8, a, 3), (9, "c d", 4), (9, "c d", 4), (9, "c d", 5), (None, a, 6), (10, None, 7), (11, "", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, near_hash int").withColumn("key", F.lit(0)).withColumn("near_id", F.array(F.lit(1)))
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(7, a), (7, b), (9, "c d"), (None, a), (10, None)], key=str)
    assert neardup.keep_one(df.limit(0)).count() == 0


def test_linked_against_all_pairs():
    rng = random.Random(11)
    for _ in range(200):
        base = [rng.sample(range(1000), 30) for _ in range(4)]
        sets = []
        for _ in range(rng.randint(1, 40)):
            s = set(rng.choice(base))
            for x in rng.sample(sorted(s), rng.choice((0, 1, 3, 6))):
                s.remove(x)
                s.add(rng.randrange(1000, 1100))
            sets.append(np.array(sorted(s), np.uint64) if rng.random() > 0.05 else np.zeros(0, np.uint64))
        root = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                x, y = set(sets[i].tolist()), set(sets[j].tolist())
                if x and len(x & y) >= 0.8 * len(x | y):
                    root = [root[j] if r == root[i] else r for r in root]
        label = neardup.linked(sets, 0.8)
        assert all((label[i] == label[j]) == (root[i] == root[j]) for i in range(len(sets)) for j in range(i))


def test_templated_source(spark):
    """One template fills every text's first part, so all crowd the same short fingerprints; only some are near copies."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(4, 8))) for _ in range(4000)]
    head = rng.choices(words, k=180)
    rows = [head + rng.choices(words, k=28) for _ in range(400)]
    rows += [w[:188] + rng.choices(words, k=20) for w in rows[:80]]
    rng.shuffle(rows)
    docs = [(i, " ".join(w)) for i, w in enumerate(rows)]
    sets = [set(simhash.shingles(simhash.word_bytes(t), 5).tolist()) for _, t in docs]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert 80 <= len(pairs) < 200
    got = {r["doc_id"]: r["component_id"] for r in neardup.similar_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    recall = np.mean([got[a] == got[b] for a, b in pairs])
    assert recall >= 0.97
    assert len(set(got.values())) >= len(docs) - len(pairs)


def test_groups_do_not_depend_on_size(spark):
    """Pairs are drawn alike however many rows there are and however a crowded prefix is dealt out."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(4, 8))) for _ in range(4000)]
    head = rng.choices(words, k=180)
    rows = [head + rng.choices(words, k=28) for _ in range(200)]
    rows += [w[:190] + rng.choices(words, k=18) for w in rows[:100]]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    groups = lambda: {r["doc_id"]: r["component_id"] for r in neardup.similar_groups(df).collect()}
    kept = neardup.KEY_ROWS, neardup.RECALL
    try:
        neardup.RECALL = 0.4  # two tables
        whole = groups()
        assert len(set(whole.values())) < 250
        neardup.KEY_ROWS = 100
        assert groups() == whole
    finally:
        neardup.KEY_ROWS, neardup.RECALL = kept
