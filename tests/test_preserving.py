"""Preserved tags."""

from tagweave.operators import preserving as P

ROWS = [(1, "b-front/title", "i-x/y"), (2, "i-front/title", None), (3, "b-note", "b-z"), (4, None, ""), (5, "", "b-z"), (6, "b-p", None)]


def _start(spark):
    df = spark.createDataFrame(ROWS, "id int, tag string, sub_tag string")
    return P.set_aside(df, {"old": "front/title", "title": "front/title", "sub": "x/y"}, ("tag", "sub_tag"))


def _get(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_set_aside(spark):
    got = _get(_start(spark), "tag", "sub_tag", "preserved_tag", "preserved_sub_tag")
    assert got == {1: (None, None, "b-title", "i-sub"), 2: (None, None, "i-title", None), 3: (None, None, "b-note", "b-z"), 4: (None,) * 4, 5: (None, None, None, "b-z"), 6: (None, None, "b-p", None)}


def test_prepare(spark):
    df = _start(spark)
    one = lambda **k: [v[0] for _, v in sorted(_get(P.prepare(df, {"title"}, **k), "preserved_tag").items())]
    assert one() == [None] * 6
    assert one(keep=True) == [None, None, "b-note", None, None, "b-p"]
    assert one(keep_fields={"title"}) == ["b-title", "i-title", None, None, None, None]
    sub = lambda **k: [v[0] for _, v in sorted(_get(P.prepare(df, set(), **k), "preserved_sub_tag").items())]
    assert sub() == [None] * 6
    assert sub(keep_sub=True) == ["i-sub", None, "b-z", None, "b-z", None]
    assert sub(keep_sub=True, drop_sub_fields={"z"}) == ["i-sub", None, None, None, None, None]


def test_put_back(spark):
    assert _get(P.put_back(_start(spark), {"title"}), "tag") == {1: ("b-title",), 2: ("i-title",), 3: (None,), 4: (None,), 5: (None,), 6: (None,)}
    assert P.put_back(_start(spark).limit(0), {"title"}).count() == 0
