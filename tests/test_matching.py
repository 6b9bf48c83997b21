"""Targets found in documents, and tags from spans."""

from pyspark.sql import functions as F

from tagweave.operators import matching as M
from tagweave.plans import annotation


def test_matcher():
    run = lambda text, *t, **k: M.Matcher(text, **k).run([(f, i, [v] if isinstance(v, str) else v) for i, (f, v) in enumerate(t)])
    text = "A Study of Things\nJane Doe, John Roe\nAbstract we studied things"
    got = run(text, ("title", "a study of thlngs"), ("author", ["Jane Doe", "John Roe"]), ("none", "not in the text"))
    assert [(f, text[s:e]) for f, _, _, s, e in got] == [("title", "A Study of Things"), ("author", "Jane Doe, John Roe")]
    # a value taken once is found at its next place
    assert [(s, e) for *_, s, e in run("abcdef xx abcdef", ("a", "abcdef"), ("b", "abcdef"))] == [(0, 6), (10, 16)]
    # beyond the window only another field is looked for
    far = "x" * 60 + " needle here"
    assert run(far, ("a", "needle here"), window=20)[0][3:] == (61, 72)
    by_line = "one line\nsecond line\nneedle here\nneedle here"
    assert run(by_line, ("a", "one line"), ("b", "needle here"), lines=2)[1][3:] == (21, 32) and M.Matcher(by_line, lines=2).reach(0) == 21 and M.Matcher(by_line, lines=9).reach(0) == len(by_line)
    assert run("Dr. Muller", ("a", "Mueller"), threshold=0.99) == []
    assert run("Dr. Muller", ("a", "Mueller"), threshold=0.99, spellings={"Mueller": ["Muller"]})[0][3:] == (4, 10)
    assert run("", ("a", "b")) == [] and run("abc", ("a", "b")) == []
    assert M.chunks("abc 123456789 def", "abc def", 2) == [(0, 3), (14, 17)]


def test_spans_and_tags(spark):
    docs = spark.createDataFrame([(1, "The Title of it, by Ann Lee"), (2, None), (3, "nothing"), (5, "x"), (5, "of A Name")], "id int, text string")
    targets = spark.createDataFrame([(1, "title", 0, ["the title of it"]), (1, "author", 1, ["Ann Lee"]), (2, "title", 0, ["x y z"]), (4, "title", 0, ["x"]), (5, "name", 0, ["a name"])], "id int, field string, ordinal int, values array<string>")
    spans = M.fuzzy_spans(docs, targets, "id").cache()
    assert sorted((r["id"], r["field"], r["start"], r["end"]) for r in spans.collect()) == [(1, "author", 20, 27), (1, "title", 0, 15), (5, "name", 3, 9)]
    words = docs.filter("id = 1").select("id", F.posexplode(F.split("text", " ")).alias("token_no", "token"))
    ends = {0: 3, 1: 9, 2: 12, 3: 16, 4: 19, 5: 23, 6: 27}
    rows = [(1, r["token_no"], r["token"], ends[r["token_no"]] - len(r["token"]), ends[r["token_no"]]) for r in words.collect()]
    tokens = spark.createDataFrame(rows, "id int, token_no int, token string, start int, end int")
    assert [r["tag"] for r in M.tag_tokens(tokens, spans, "id").orderBy("token_no").collect()] == ["b-title", "i-title", "i-title", "i-title", None, "b-author", "i-author"]
    assert {(r["value"], r["start"]) for r in M.all_spans(docs, ["title", "ann"], "id").collect()} >= {("title", 4), ("ann", 20)}


def test_required(spark):
    t = spark.createDataFrame([(1, "title", "abcde"), (2, "title", "abcde"), (3, "title", "abcde"), (4, "title", "")], "id int, field string, text string")
    f = spark.createDataFrame([(1, "title", "abcdf"), (2, "title", "xyz")], t.schema)
    assert {r["id"]: r["passed"] for r in M.required_fields(t, f, "id", ["title"], ["title"]).collect()} == {1: True, 2: False, 3: False, 4: True}


def test_fuzzy_passages(spark, tmp_path):
    item = "the quick brown fox jumps over the lazy dog while eleven grey wolves are watching from the hill"
    docs = [(1, f"before it {item} and after"), (2, f"x {item.replace('wolves', 'wolwes')} y"), (3, "the quick brown fox only"), (4, None), (5, item.split()[0])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item), (8, "another text that no document holds at all here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, annotation.fuzzy_passages(spark, str(tmp_path)).collect()))
    # brute force: every pair
    want = [(d, f"item{i}", *s) for d, t in docs for i, x in ((7, item),) if t and (s := M.find(t, x))]
    assert got == want == [(1, "item7", 10, 10 + len(item)), (2, "item7", 2, 2 + len(item))]
