"""The operators on documents against plain Python, with nulls, empty and long texts, copies and odd columns."""

import hashlib
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from tagweave.llm import ann, chaining, decontam, langid, mixing, pii, simhash, tokencount, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, key string, score double"
LETTERS = {"aa": "abcdeé", "bb": "mnopqr"}


def rows_of(seed=1, n=60):
    rng = random.Random(seed)
    words = {k: ["".join(rng.choices(v, k=rng.randint(2, 7))) for _ in range(300)] for k, v in LETTERS.items()}
    out = []
    for i in range(n):
        lang = rng.choice(list(LETTERS))
        text = " ".join(rng.choices(words[lang], k=rng.randint(1, 150)))
        out.append([i, text.capitalize() if i % 3 else text.upper(), lang, rng.choice(["s1", "s2", None]), len(text), 1, "k", 0.5])
    out[3][1] = out[2][1]
    out[4][1] = out[2][1] + " more"
    out += [[100, None, None, None, None, None, None, None], [101, "", "aa", "s1", 0, None, None, None], [102, " \t\n", "aa", "s3", 3, None, None, None]]
    out += [[103, " ".join(rng.choices(words["aa"], k=30_000)), "aa", "s2", 1, None, None, None], [104, "!!! 123 ???", None, "s1", 11, None, None, None]]
    out += [[None, out[5][1], "aa", "s1", 1, None, None, None], list(out[6])]
    return [tuple(r) for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def plain_fp(t, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if linked(i, j) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_simhash(docs, empty):
    rows = [r for r in docs.collect() if r["doc_id"] is not None]
    fps = [plain_fp(r["text"]) for r in rows]
    label = plain_components(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    least = {c: min(r["doc_id"] for r, x in zip(rows, label) if x == c) for c in label}
    want = sorted((r["doc_id"], f"{f:016x}", least[c]) for r, f, c in zip(rows, fps, label))
    got = sorted(tuple(r) for r in simhash.op7(docs.filter("doc_id is not null")).collect())
    assert got == want
    assert simhash.op7(empty).count() == 0
    from tagweave.llm import neardup

    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 2 in ids and 3 not in ids and ids.count(6) == 1 and None in ids


def test_simhash_links_against_all_pairs(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), k)) for f in fps[:40] for k in (1, 2, 3, 4, 5)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    label = plain_components(len(fps), lambda i, j: ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 4)
    want = {f: fps[c] for f, c in zip(fps, label)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    from tagweave.llm.common import components

    before = simhash.BLOCK_VARIANTS
    for bound, block in ((20_000, before), (0, 2_000)):
        simhash.BLOCK_VARIANTS = block
        got = {r["node"]: r["root"] for r in components(simhash.links(df, 4, len(fps)), bound).collect()}
        assert all(got.get(f, f) == r for f, r in want.items())
    simhash.BLOCK_VARIANTS = before


def plain_windows(t, k=10):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    return w, [tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def test_decontamination(spark, docs, empty):
    rows = docs.collect()
    by = {r["doc_id"]: r["text"] for r in rows}
    take = lambda i, a, n: " ".join(by[i].split()[a : a + n])
    bench = [(1, take(103, 50, 14)), (10, take(103, 500, 9).upper()), (2, "nothing like it at all in any of these texts here"), (3, None), (4, "..."), (5, take(5, 0, 12)), (5, take(5, 0, 12))]
    items = spark.createDataFrame(bench, "item_id long, text string")

    def plain(t):
        w, _ = plain_windows(t)
        hit, found = set(), set()
        for item, x in bench:
            for win in plain_windows(x)[1]:
                for i in range(len(w) - len(win) + 1):
                    if tuple(w[i : i + len(win)]) == win:
                        hit |= set(range(i, i + len(win)))
                        found.add(str(item))
        return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)

    key = lambda r: (r[0] is None, *r[:1], *r[1:]) if r[0] is not None else (True, -1, *r[1:])
    want = sorted(((r["doc_id"], *plain(r["text"])) for r in rows), key=key)
    assert sorted((tuple(r) for r in decontam.op2(docs, items).collect()), key=key) == want
    index = decontam.build_index(docs)
    blocks = decontam.search(index, items, block=2).select("n_words", "n_hit", F.concat_ws(",", "items"))
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, decontam.search(index, items).select("n_words", "n_hit", F.concat_ws(",", "items")).collect()))
    shuffled = spark.createDataFrame([(7, " ".join(reversed(take(103, 900, 6).split())))], "item_id long, text string")
    assert [r["doc_id"] for r in decontam.search(index, shuffled, span=8).filter("n_hit > 0").collect()] == [103]
    assert decontam.search(index, shuffled).filter("n_hit > 0").count() == 0
    assert decontam.op2(empty, items).count() == 0
    assert decontam.op2(docs, items.limit(0)).filter("contaminated").count() == 0
    clean = decontam.clean(docs, items)
    assert clean.columns == docs.columns and {103, 5} & {r["doc_id"] for r in clean.collect()} == set()


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = docs.collect()
    assert sorted(r["size"] for r in got) == sorted(size(r["text"]) for r in rows)
    total = sum(r["size"] for r in got)
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s))
    sums = {s: sum(size(r["text"]) for r in rows if r["source"] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, fixed = {}, {}
    while True:
        rest = total - sum(fixed.values())
        open_ = [s for s in sources if s not in fixed]
        target = fixed | {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if target[s] > 3 * sums[s]]
        if not over:
            break
        fixed |= {s: 3.0 * sums[s] for s in over}
    by_id = {r["doc_id"]: r for r in got}
    for r in rows:
        assert by_id[r["doc_id"]]["target"] == pytest.approx(target[r["source"]])
        assert 0 <= by_id[r["doc_id"]]["taken"] <= 3 * by_id[r["doc_id"]]["size"]
    assert sorted(map(str, mixing.mix(docs.repartition(5)).collect())) == sorted(map(str, got))
    assert mixing.mix(empty).count() == 0 and mixing.take(empty).count() == 0
    assert mixing.take(docs).columns == [*docs.columns, "copies"]


def luhn(s):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - (9 if int(c) > 4 else 0) for i, c in enumerate(reversed(s))) % 10 == 0


def plain_pii(t):
    e, i = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    c, p = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", m) for m in re.finditer(e, t)]
    out += [("ip", m) for m in re.finditer(i, t) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split("."))]
    out += [("card", m) for m in re.finditer(c, t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in re.finditer(p, t) if 9 <= len(digits(m)) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


PII_TEXTS = [
    "é𝄞 mail a.b@c.de, x@y, a@b.c_d@e.f.g and 1.2.3.4.5.6.7.8 or 256.1.1.1 010.0.0.255", "@@ a@@b.c a@b..c %+@x-.y", "4111 1111 1111 1111-4111-1111-1111-1111 4111111111111112",
    "+1 (227) 555-0199 +12 +123456789012345678 +1.2.3.4.5.6.7.8.9", "call me (555) 123-4567 or write bob at example dot com", None, "", "1 " * 30_000 + "+" * 2_000, "9" * 40_000 + "." + "1.1.1", "a@b" + ".c" * 20_000,
    "x" * 50_000 + "@", "1.2.3.4" * 300 + " card 5500-0000-0000-0004.",
]


def test_pii(spark, empty):
    df = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.op6(df).collect()}
    for i, t in enumerate(PII_TEXTS):
        base = plain_pii(t or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (i, got[i]["spans"][:200], joined[:200])
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in base) for k in pii.KINDS]
        assert set(joined.split(",")) <= set(got[i]["spans"].split(","))
    assert pii.op6(empty).count() == 0
    clean = pii.redact(df.withColumn("n_chars", F.length("text"))).collect()
    text = {r["doc_id"]: r["text"] for r in clean}
    assert "a.b@c.de" not in text[0] and "<EMAIL>" in text[0] and text[6] == "" and text[5] is None
    assert "5500" not in text[11] and all(r["n_chars"] is None or r["n_chars"] == len(r["text"]) for r in clean)


def test_em_finds_the_reliable_labelers():
    counts = [("card", (1, 1, 1, 0, 0), 90), ("card", (1, -1, -1, 0, -1), 60), ("card", (0, -1, -1, -1, 0), 20), ("card", (0, 1, 1, 1, 0), 9)]
    p = pii.em(counts)
    assert p["card", (1, 1, 1, 0, 0)] > 0.9 and p["card", (0, 1, 1, 1, 0)] > 0.5 and p["card", (0, -1, -1, -1, 0)] < 0.1
    assert pii.em([]) == {} and pii.logistic([]) == []


def test_language(docs, empty):
    got = langid.op9(docs).collect()
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        text = rows[r["doc_id"]]["text"]
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] == "und"
        elif rows[r["doc_id"]]["lang"] and r["doc_id"] not in (3, 4):  # their texts are copies of another row's
            assert r["lang_pred"] == rows[r["doc_id"]]["lang"]
    assert langid.op9(empty).count() == 0
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    assert not {100, 101, 102, 104} & {r["doc_id"] for r in kept.collect()} and kept.count() == docs.count() - 4
    assert {r["lang_pred"] for r in langid.op9(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_ngrams_do_not_cross_texts():
    texts = ["Ab", "", None, "é!b", "xyz xyz"]
    row, col, count = langid.grams(texts)
    alone = [langid.grams([t]) for t in texts]
    for i, (_, c, n) in enumerate(alone):
        assert col[row == i].tolist() == c.tolist() and count[row == i].tolist() == n.tolist()


def test_toxicity(spark, empty):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    texts, labels = [], []
    for i in range(400):
        t = rng.choices(words, k=rng.randint(20, 80))
        bad = i % 4 == 0
        for _ in range(3 * bad):
            t[rng.randrange(len(t))] = rng.choice(["idiot", "zzquat", "zzquab", "you"])
        texts.append((i, " ".join(t)))
        labels.append((i, 1, int(bad)))
    texts += [(900, None), (901, ""), (902, "idiot " * 20_000), (3, texts[3][1])]
    labels += [(900, None, None), (5555, 1, 1), (7, 1, 0)]
    df, lab = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.op4(df, lab).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) > 0.9 * len(held)
    assert toxicity.op4(empty.select("doc_id", "text"), lab).count() == 0
    assert {r["score"] for r in toxicity.op4(df, lab.limit(0)).collect()} == {0.0}


def test_isotonic_and_boost():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((500, 3))
    y = (x[:, 1] > 0.6).astype(float)
    s = toxicity.raw_scores(toxicity.boost(x, y, np.ones(500), trees=20), x)
    assert ((s > 0) == (y == 1)).mean() > 0.97
    knots, values = toxicity.isotonic(s, y, np.ones(500))
    assert (np.diff(values) >= 0).all() and (np.diff(knots) >= 0).all()


@pytest.mark.parametrize("rule", tokencount.RULES)
def test_token_counts(docs, empty, rule):
    data = open(tokencount.DEFAULT, "rb").read()
    encode, size = tokencount.encoder(data)
    got = tokencount.count(docs, rule=rule).collect()
    assert len(got) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        text = texts[r["doc_id"]] or ""
        tokens = encode.encode_ordinary(text)
        assert encode.decode(tokens) == text and r["n_tokens"] == len(tokens)
        assert sum(r["section_tokens"]) == pytest.approx(len(tokens)) and r["n_sections"] == len(r["section_tokens"])
    assert tokencount.count(empty, rule=rule).count() == 0
    fields = tokencount.count(docs, ["lang", "source", "text"], rule).collect()
    assert all(r["n_sections"] == 3 and sum(r["section_tokens"]) == pytest.approx(r["n_tokens"]) for r in fields)


def test_allocation_rules():
    import numpy as np

    ends, bounds = np.array([2, 7, 9]), np.array([0, 4, 4, 9])
    assert tokencount.allocate(ends, bounds, "start").tolist() == [2, 0, 1]
    assert tokencount.allocate(ends, bounds, "majority").tolist() == [1, 0, 2]
    assert tokencount.allocate(ends, bounds, "split").tolist() == pytest.approx([1.4, 0, 1.6])


def test_passages(spark, empty):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    body = lambda n: [word() for _ in range(n)]
    passage, fuzzy = body(60), body(120)
    edited = list(fuzzy)
    for i in range(20, 120, 25):
        edited[i] = word()
    del edited[70]
    docs = {i: body(80) for i in range(20)}
    for i in (3, 8, 11):
        docs[i] = docs[i][:30] + passage + docs[i][30:]
    docs[5] = docs[5][:10] + fuzzy + docs[5][10:]
    docs[6] = docs[6][:60] + edited + docs[6][60:]
    docs[7] = docs[7][:5] + passage[:20] + docs[7][5:]
    texts = [(i, " ".join(w)) for i, w in docs.items()]
    texts += [(30, texts[8][1]), (31, None), (32, ""), (33, "a"), (34, "la " * 20_000), (None, texts[3][1]), (15, texts[15][1])]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in chaining.op10(df).collect()}
    assert set(got) == {i for i, _ in texts if i is not None}
    assert [got[i]["class_id"] for i in (3, 8, 11, 30)] == [3] * 4 and got[6]["class_id"] == 5
    assert got[3]["passages"] == got[8]["passages"] == "30:90" and got[5]["passages"] == "10:130" and got[6]["passages"] == "60:179"
    assert got[30]["n_copies"] == 2 and got[7]["n_passages"] == 0
    assert all(got[i]["n_passages"] == 0 and got[i]["class_id"] == i for i in (0, 1, 2, 4, 7, 31, 32, 33, 34))
    assert chaining.op10(empty).count() == 0


def test_chain_against_quadratic():
    import numpy as np

    rng = np.random.default_rng(5)
    k, gap = chaining.K, chaining.GAP_COST
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = np.unique(rng.integers(0, 90, (2, n)), axis=1)
        n = len(a)
        score = np.zeros(n)
        for j in np.lexsort((b, a)):
            before = [score[i] - gap * (a[j] - a[i] + b[j] - b[i]) for i in range(n) if a[i] < a[j] and b[i] < b[j]]
            score[j] = k + max([0.0, *before])
        lines = chaining.chain(a, b)
        assert sorted(i for line in lines for i in line.tolist()) == list(range(n))
        for line in lines:
            assert (np.diff(a[line]) > 0).all() and (np.diff(b[line]) > 0).all()
        best = k * len(lines[0]) - gap * (np.diff(a[lines[0]]).sum() + np.diff(b[lines[0]]).sum())
        assert abs(best - score.max()) < 1e-9


def test_passages_hard(spark):
    """A passage that repeats a phrase, ids that repeat, two passages far apart, lines of frequent passages, small edits all along."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    body = lambda n: [word() for _ in range(n)]
    phrase, one, two = body(7) * 40, body(60), body(60)
    lines = [body(20) for _ in range(3)]
    rows = [(0, phrase + body(30)), (1, body(30) + phrase)]
    rows += [(2, one + body(10)), (3, one + body(10)), (3, two + body(20)), (4, body(9) + two)]
    a, b = body(70), body(70)
    rows += [(5, a + body(120) + b), (6, a + body(120) + b)]
    for i in range(12):  # each line has other first and last holders
        rows.append((10 + i, body(40) + lines[i % 3] + body(40)))
    rows += [(30, body(40) + sum(lines, []) + body(40)), (31, sum(lines, []))]
    edited = {}
    for i in range(20):
        w = body(60)
        e = [x if j % 10 != 5 else word() for j, x in enumerate(w)]
        edited[40 + 2 * i] = 41 + 2 * i
        rows += [(40 + 2 * i, body(30) + w), (41 + 2 * i, e + body(30))]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").withColumn("rep", F.lit(1)).withColumn("seed", F.lit("x"))
    got = {}
    for r in chaining.op10(df).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert got[0][0]["passages"] == "0:280" and got[1][0]["passages"] == "30:310" and got[1][0]["class_id"] == 0
    assert sorted(r["class_id"] for r in got[3]) == [2, 3] and got[4][0]["class_id"] == 3 and got[4][0]["passages"] == "9:69"
    assert got[5][0]["passages"] == "0:70,190:260" == got[6][0]["passages"]
    assert got[30][0]["passages"] == "40:100" and got[31][0]["class_id"] == 30
    assert all(got[10 + i][0]["n_passages"] == 0 for i in range(12))
    assert sum(got[j][0]["class_id"] == i for i, j in edited.items()) >= 18


def test_passages_of_frequent_seeds(spark):
    """A passage each part of which many more texts hold; a notice that all texts of a kind hold; lines that nearly all hold: as if all holders of every seed were paired."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    body = lambda n: [word() for _ in range(n)]
    passage, notice, line, other = body(60), body(55), body(13), body(14)
    rows = {i: body(30) + passage + body(30) for i in (0, 1)}
    for i in range(120):  # parts that overlap by 20 words hold every seed of the passage
        at = 10 * (i % 4)
        rows[10 + i] = body(20) + passage[at : at + 30] + body(20)
    tail = body(6)
    for i in range(200, 230):
        rows[i] = body(15) + notice + (tail if i % 7 == 3 else []) + body(20)
    for i in range(220, 245):
        rows[i] = rows.get(i, body(10)) + line + body(40) + (other if i % 2 else []) + body(5)
    for i in range(240, 245):  # a line and what surrounds it, with single words changed
        w = rows[i][:8] + line + body(60)
        rows[i + 20] = w
        rows[i + 40] = [x if j % 9 != 4 else word() for j, x in enumerate(w)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], "doc_id long, text string")
    columns = ["doc_id", "class_id", "n_passages", "n_words", "passages"]
    got = {r["doc_id"]: tuple(r) for r in chaining.op10(df).select(*columns).collect()}
    assert got[0][1:] == got[1][1:] == (0, 1, 60, "30:90")
    assert all(got[10 + i][1:3] == (10 + i, 0) for i in range(120))
    assert all(got[i][1] == 200 for i in range(200, 230))
    kept = chaining.ALL_HOLDERS
    try:
        chaining.ALL_HOLDERS = 1_000_000
        assert got == {r["doc_id"]: tuple(r) for r in chaining.op10(df).select(*columns).collect()}
    finally:
        chaining.ALL_HOLDERS = kept


def test_passages_of_runs(spark):
    """Runs of one word and near copies that many texts hold: as if all holders of every seed were paired, from far fewer pairs."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    body = lambda n: [word() for _ in range(n)]
    common, notice = ["and", "the", "of", "a", "in", "to"], body(120)
    rows = []
    for i in range(90):  # a few runs each, some of one word twice
        rows.append(body(rng.randrange(12)) + sum(([rng.choice(common)] * rng.randrange(16, 60) + body(rng.choice([0, 0, 3, 15])) for _ in range(rng.randrange(1, 3))), []) + body(9))
    for i in range(60):  # one notice, words left out, added and changed
        w = list(notice)
        for _ in range(3):
            j = rng.randrange(len(w))
            w[j : j + 1] = rng.choice([[], [word()], [w[j], word()]])
        rows.append(body(10) + w + body(10))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    columns = ["doc_id", "class_id", "n_passages", "n_words", "passages"]
    drawn, frequent = [], chaining._frequent
    kept = chaining.ALL_HOLDERS
    try:
        chaining._frequent = lambda *a: drawn.append(frequent(*a)) or drawn[-1]
        got = {r["doc_id"]: tuple(r) for r in chaining.op10(df).select(*columns).collect()}
        assert drawn[0].distinct().count() < 10 * len(rows)
        chaining.ALL_HOLDERS = 1_000_000
        assert got == {r["doc_id"]: tuple(r) for r in chaining.op10(df).select(*columns).collect()}
    finally:
        chaining.ALL_HOLDERS, chaining._frequent = kept, frequent


def test_ann(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(3_000, 8))
    x[100:160] = x[99]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(5_000, None, 1), (5_050, [], 1), (5_100, [0.0] * 8, 1), (5_150, [float("nan")] * 8, 1), (5_200, [1.0, None] * 4, 1), (5_250, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {}
    for r in sorted(ann.op1(df).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x = x.astype(np.float32).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = 0
    assert sorted(got) == list(range(0, 3_000, 50))
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(3_000), -s.round(12)))[:5]
        hit += len({v for v, _ in found} & set(best.tolist()))
        assert all(abs(s[v] - t) < 1e-12 for v, t in found)
    assert hit >= 0.9 * 5 * len(got)
    assert [v for v, _ in got[100]] == [99, 101, 102, 103, 104]
    assert ann.op1(df.limit(0)).count() == 0
    assert ann.op1(df.filter("vec_id < 3")).count() == 2
