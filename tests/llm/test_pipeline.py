"""The pipeline's stages on a small corpus with planted cases."""

import random

import corpus_pipeline


def test_run(spark, tmp_path):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = [(i, text(60), "aa", "s" + str(i % 2), 1) for i in range(200)]
    item = text(20)
    rows += [(300, "12 34 !!", None, "s0", 8), (301, None, "aa", "s1", None), (302, rows[7][1], "aa", "s1", 1), (303, text(9) + " " + item + " " + text(9), "aa", "s0", 1), (304, text(20) + " x.y@z.com " + text(20), "aa", "s0", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    gone = [{300, 301}, {302}, {303}, set()]
    for (_, stage), away in zip(corpus_pipeline.STAGES[:4], gone):
        new = stage(spark, docs, str(tmp_path)).cache()
        assert new.columns == docs.columns
        assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in new.collect()} == away
        docs = new
    assert [r["text"] for r in docs.filter("doc_id = 304").collect()][0].split()[20] == "<EMAIL>"
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and {r["doc_id"] for r in out} <= {r["doc_id"] for r in docs.collect()} and all(r["copies"] > 0 for r in out)
