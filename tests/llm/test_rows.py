"""Rows that once went wrong: letters beyond the basic plane, odd labels, repeated and missing ids, clashing columns; brute force for allocations."""

import random

import numpy as np
from pyspark.sql import functions as F

from tagweave.llm import decontam, langid, mixing, pii, tokencount, toxicity


def test_supplementary_letters(spark):
    train = [(i, "abc abd abe " * 5, "en") for i in range(30)] + [(100 + i, "𐐨𐐩𐐪 𐐫𐐬 " * 5, "xx") for i in range(30)]
    model = langid.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "😀 😀"), (2, "𐐨𐐩𐐪"), (3, "abc"), (4, "1 2"), (5, None)], "doc_id long, text string")
    assert [r["lang_pred"] for r in langid.predict(docs, model).orderBy("doc_id").collect()] == ["und", "xx", "en", "und", "und"]


def test_many_languages(spark):
    """No language is too rare to be learnt."""
    rows = [(i, chr(0x4E00 + i) * 20, f"l{i:04}") for i in range(1100)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.langs) == 1100


def test_odd_labels(spark):
    docs = spark.createDataFrame([(i, "you fool" if i % 2 else "good day") for i in range(40)], "doc_id long, text string")
    for labels in ([(i, 2 * (i % 2)) for i in range(40)], [(i, 3) for i in range(40)], [(1000 + i, i % 2) for i in range(40)], []):
        got = toxicity.op4(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert len(got) == 40 and all(0 <= r["score"] <= 1 for r in got)


def test_clean_goes_by_rows(spark):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(None, f"a {item} b", 1), (None, "clean one", 2), (7, f"c {item}", 3), (7, "clean too", 4), (8, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash int")
    items = spark.createDataFrame([(1, item), (2, item), (None, item)], "item_id long, text string")
    assert sorted(r["text_hash"] for r in decontam.clean(docs, items).collect()) == [2, 4, 5]
    got = {(r["doc_id"], r["n_hit"]): r["items"] for r in decontam.search(decontam.build_index(docs.select("doc_id", "text")), items, block=1).collect()}
    assert got[(7, 12)] == ["", "1", "2"] and got[(7, 0)] == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(i, f"mail x{i}@y.com now", "s" + str(i % 2)) for i in range(20)], "doc_id long, text string, source string")
    for name in ("_w", "mix_whole", "Copies", "pii", "PII_base", "pii_matches0", "pii_rest"):
        docs = docs.withColumn(name, F.lit("kept"))
    for out in (mixing.take(docs), pii.redact(docs)):
        assert out.columns[: len(docs.columns)] == docs.columns
        assert {r[c] for r in out.collect() for c in docs.columns[3:]} == {"kept"}
    assert all("<EMAIL>" in r["text"] for r in pii.redact(docs).collect())


def test_allocation_by_bytes():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 60)
        ends = np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n}))
        bounds = np.array([0, *sorted(rng.choices(range(n + 1), k=rng.randint(0, 5))), n])
        section = [max(s for s in range(len(bounds) - 1) if bounds[s] <= b) for b in range(n)]
        for rule in tokencount.RULES:
            want = np.zeros(len(bounds) - 1)
            for a, b in zip([0, *ends[:-1]], ends):
                own = [section[x] for x in range(a, b)]
                if rule == "start":
                    want[own[0]] += 1
                elif rule == "majority":
                    want[max(sorted(set(own)), key=own.count)] += 1
                else:
                    for x in own:
                        want[x] += 1 / len(own)
            assert np.allclose(tokencount.allocate(ends, bounds, rule), want)
