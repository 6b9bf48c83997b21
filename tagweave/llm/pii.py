"""PII spans by weak supervision; DataFrame and SQL functions only.

Candidates are the strict matches (email, ip, card, phone) and looser ones of
the same kinds (spelt-out e-mail addresses, national phone numbers, card-like
numbers that fail the checksum).  Offsets come from the gaps that the same
pattern leaves when it splits the text.  Patterns hold no unbounded
backtracking: runs are possessive, a match starts where a run starts, and
repeated groups are nested in atomic groups so that depth stays bounded.

Labelers vote +1, 0 or -1 on each candidate: strict regex, checksum or shape,
gazetteer (domains, card issuers, dialling codes), words of the context, and
what touches the span.  Votes are counted by kind and pattern over all
documents (at most 4 * 3**5 rows), and expectation-maximisation on these counts
estimates each labeler's reliability without labels.  Its posteriors train the
span classifier, a logistic regression on features that need no labeler
(also counted by combination over all documents).  A loose candidate that the
classifier accepts and that overlaps no strict span is added; strict spans stay.

Cases: null and empty texts have no spans; documents without candidates,
repeated rows and null doc_ids each give their row; an empty table gives an
empty result, and with no candidates every weight is zero and none is added.
Extra columns are kept by `find` and `redact`, which use names that docs lacks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import fresh, table

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_deep = lambda body: f"(?>(?>(?:{body}){{1,200}}){{1,200}})"
#: kind, strict?, pattern, cheap test of the text
PATTERNS: tuple[tuple[str, bool, str, str], ...] = (
    ("email", True, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++{_deep(r'\.' + _LABEL + '++')}++", "contains({t}, '@')"),
    ("ip", True, r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"{t} rlike '[0-9]\\.[0-9]'"),
    ("card", True, rf"[0-9]{_deep('[ -]?[0-9]')}++", "{t} rlike '[0-9](?:[ -]?[0-9]){{12}}'"),
    ("phone", True, r"\+[0-9][ ().0-9-]+[0-9]", "contains({t}, '+')"),
    ("email", False, rf"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}+ ?(?:\(at\)|\[at\]|\bat\b) ?[A-Za-z0-9-]{{1,63}}(?: ?(?:\(dot\)|\[dot\]|\bdot\b) ?[A-Za-z0-9-]{{1,63}}+){{1,8}}", "({t} rlike '[(\\\\[ ]dot[)\\\\] ]')"),
    ("phone", False, r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", "{t} rlike '[0-9]{{3}}[ .-][0-9]{{4}}'"),
)
CONTEXT = 32
SPAN = "array<struct<kind:string,start:int,end:int,hit:string,left:string,right:string>>"
EMPTY = f"cast(array() as {SPAN})"
#: Words that speak for a kind, or against personal data, and gazetteers.
FOR = {"email": "e-?mail|mail|contact|write|reach", "ip": "ip|address|host|server|login|client", "card": "card|visa|credit|debit|payment|mastercard|amex|iban", "phone": "phone|call|tel|mobile|cell|fax|contact|sms"}
AGAINST = "version|order|invoice|isbn|issn|serial|sku|build|release|ticket|revision|part no|section|chapter"
TOP_LEVEL = "com|org|net|edu|gov|int|info|biz|io|co|de|fr|es|it|nl|eu|uk|us|ca|au|ch|at|be|pt|br|mx|jp|cn|in|ru|pl|se|no|dk|fi"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|64[4-9]|35|62|30[0-5]|36|38"
DIAL = "1|7|20|27|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69][0-9]|3[578][0-9]|42[0-3]|5[09][0-9]|6[7-9][0-9]|8[58][0-9]|9[679][0-9]"


def _lit(s: str) -> str:
    return "r'" + s + "'" if "'" not in s else "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(d: str) -> str:
    """Whether a string of digits passes the checksum."""
    one = f"cast(substring({d}, length({d}) - i, 1) as int)"
    return f"aggregate(sequence(0, length({d}) - 1), 0, (s, i) -> s + if(i % 2 = 0, {one}, if({one} > 4, 2 * {one} - 9, 2 * {one}))) % 10 = 0"


def _valid(kind: str, x: str) -> str:
    d = _digits(x)
    return {
        "email": "true",
        "ip": f"forall(split({x}, '[.]'), p -> length(regexp_replace(p, '^0+(?=.)', '')) <= 3 and cast(regexp_replace(p, '^0+(?=.)', '') as int) <= 255)",
        "card": f"length({d}) between 13 and 19 and {_luhn(d)}",
        "phone": f"length({d}) between 9 and 15",
    }[kind]


def _matches(kind: str, pattern: str, guard: str, text: str) -> Column:
    """array<struct<kind, start, end, hit, left, right>> of all matches of one pattern, in code points."""
    p = _lit(pattern)
    gaps, hits = f"split({text}, {p}, -1)", f"regexp_extract_all({text}, {p}, 0)"
    inner = f"""element_at(transform(array(named_struct('g', {gaps}, 'h', {hits})), q -> aggregate(
      zip_with(zip_with(q.h, slice(q.g, 1, size(q.h)), (h, a) -> named_struct('hit', h, 'gap', a)), slice(q.g, 2, size(q.h)), (x, b) -> named_struct('hit', x.hit, 'gap', x.gap, 'nxt', b)),
      named_struct('at', 0, 'out', {EMPTY}),
      (s, x) -> named_struct('at', s.at + length(x.gap) + length(x.hit), 'out', concat(s.out, array(named_struct('kind', '{kind}', 'start', s.at + length(x.gap),
        'end', s.at + length(x.gap) + length(x.hit), 'hit', x.hit, 'left', right(x.gap, {CONTEXT}), 'right', left(x.nxt, {CONTEXT}))))),
      s -> s.out)), 1)"""
    return F.expr(f"if({guard.format(t=text)}, {inner}, null)")


def candidates(docs: DataFrame, text: str = "text", to: tuple[str, str] = ("base", "loose")) -> DataFrame:
    """docs and two arrays of spans: the valid strict ones by kind and start, and the loose ones that touch none of them."""
    raw = docs
    names = []
    rest = fresh("pii_rest", [*docs.columns, *to])
    for k, (kind, _, pattern, guard) in enumerate(PATTERNS):
        names.append(fresh(f"pii_matches{k}", [*docs.columns, *to]))
        raw = raw.withColumn(names[-1], _matches(kind, pattern, guard, f"coalesce(`{text}`, '')"))
    strict = [f"filter(coalesce({n}, {EMPTY}), x -> {_valid(kind, 'x.hit')})" for n, (kind, is_strict, *_) in zip(names, PATTERNS) if is_strict]
    loose = [f"coalesce({n}, {EMPTY})" for n, (_, is_strict, *_) in zip(names, PATTERNS) if not is_strict]
    card = names[next(k for k, p in enumerate(PATTERNS) if p[0] == "card")]
    failed = f"filter(coalesce({card}, {EMPTY}), x -> length({_digits('x.hit')}) between 13 and 19 and not ({_luhn(_digits('x.hit'))}))"
    kept = [c for c in docs.columns]
    base = raw.select(*[F.col(f"`{c}`") for c in kept], F.expr(f"concat({', '.join(strict)})").alias(to[0]), F.expr(f"concat({', '.join(loose)}, {failed})").alias(rest))
    clear = f"if(size({rest}) = 0, {rest}, filter({rest}, x -> not exists({to[0]}, b -> b.start < x.end and x.start < b.end)))"
    return base.select(*[F.col(f"`{c}`") for c in kept], to[0], F.expr(clear).alias(to[1]))


def _votes(strict: str) -> dict[str, str]:
    """SQL of each labeler's vote on the span c."""
    d, around = _digits("c.hit"), "lower(concat(c.left, ' ', c.right))"
    by = lambda of: "case c.kind " + " ".join(f"when '{k}' then {v}" for k, v in of.items()) + " end"
    return {
        "regex": f"if({strict}, 1, 0)",
        "shape": by(
            {
                "email": "if(c.hit rlike '^[A-Za-z0-9].{0,63}@[^@]{3,}$', 1, if(c.hit rlike '@', -1, 0))",
                "ip": "if(c.hit rlike '^(0|10[.]0|127)[.]', -1, 1)",
                "card": f"if({_luhn(d)}, 1, -1)",
                "phone": f"if(length({d}) between 10 and 13, 1, -1)",
            }
        ),
        "gazetteer": by(
            {
                "email": f"if(lower(c.hit) rlike '(?:[.]|dot[)\\\\]]? ?)(?:{TOP_LEVEL})$', 1, -1)",
                "ip": "if(c.hit rlike '^(?:[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])[.]', 1, -1)",
                "card": f"if({d} rlike '^(?:{ISSUERS})', 1, -1)",
                "phone": f"if(startswith(c.hit, '+'), if({d} rlike '^(?:{DIAL})', 1, -1), if({d} rlike '^[2-9]', 0, -1))",
            }
        ),
        "context": f"if({around} rlike '(?:^|[^a-z])(?:{AGAINST})(?:[^a-z]|$)', -1, if({around} rlike concat('(?:^|[^a-z])(?:', " + by({k: f"'{v}'" for k, v in FOR.items()}) + "), ')(?:[^a-z]|$)'), 1, 0))".replace("), ')(", ", ')("),
        "touch": "if(c.left rlike '[A-Za-z0-9_=/.-]$' or c.right rlike '^[A-Za-z0-9_=/]', -1, 0)",
    }


def _features(strict: str) -> dict[str, str]:
    """SQL of the classifier's 0/1 features of the span c."""
    d = _digits("c.hit")
    out = {f"is_{k}": f"c.kind = '{k}'" for k in KINDS}
    out |= {
        "strict": strict,
        "luhn": f"c.kind = 'card' and {_luhn(d)}",
        "issuer": f"c.kind = 'card' and {d} rlike '^(?:{ISSUERS})'",
        "sixteen": f"c.kind = 'card' and length({d}) in (15, 16)",
        "parted": "c.hit rlike '[ ().-]'",
        "plus": "startswith(c.hit, '+')",
        "after_word": "c.left rlike '[A-Za-z0-9_=/.-]$'",
        "before_word": "c.right rlike '^[A-Za-z0-9_=/]'",
        "for": "lower(concat(c.left, ' ', c.right)) rlike concat('(?:^|[^a-z])(?:', case c.kind " + " ".join(f"when '{k}' then '{v}'" for k, v in FOR.items()) + " end, ')(?:[^a-z]|$)')",
        "against": f"lower(concat(c.left, ' ', c.right)) rlike '(?:^|[^a-z])(?:{AGAINST})(?:[^a-z]|$)'",
        "brackets": "c.hit rlike '[(\\\\[](?:at|dot)[)\\\\]]'",
    }
    return out


def em(counts: list[tuple[str, tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[str, tuple[int, ...]], float]:
    """Posterior that a candidate is personal data, by (kind, votes).

    Each labeler has, within each class, probabilities of its three votes;
    kinds have their own prior and share the labelers.  Counts are smoothed, so
    a vote never seen stays possible.
    """
    if not counts:
        return {}
    n = len(counts[0][1])
    chance = [{1: {1: 0.7, 0: 0.25, -1: 0.05}, 0: {1: 0.15, 0: 0.45, -1: 0.4}} for _ in range(n)]
    prior = {k: 0.5 for k, *_ in counts}
    out: dict[tuple[str, tuple[int, ...]], float] = {}
    for _ in range(rounds):
        for kind, votes, _ in counts:
            yes = math.log(prior[kind]) + sum(math.log(chance[j][1][v]) for j, v in enumerate(votes))
            no = math.log(1 - prior[kind]) + sum(math.log(chance[j][0][v]) for j, v in enumerate(votes))
            out[kind, votes] = 1 / (1 + math.exp(max(-700.0, min(700.0, no - yes))))
        for k in prior:
            mass = sum(c for kind, _, c in counts if kind == k)
            prior[k] = (sum(c * out[kind, v] for kind, v, c in counts if kind == k) + 1) / (mass + 2)
        for j in range(n):
            for y in (0, 1):
                # pseudo-counts hold the labelers to being better than chance
                mass = {v: 5 * (0.7, 0.25, 0.05)[1 - v] if y else 5 * (0.15, 0.45, 0.4)[1 - v] for v in (1, 0, -1)}
                for kind, votes, c in counts:
                    mass[votes[j]] += c * (out[kind, votes] if y else 1 - out[kind, votes])
                total = sum(mass.values())
                chance[j][y] = {v: x / total for v, x in mass.items()}
    return out


def logistic(rows: list[tuple[tuple[int, ...], float, float]], rounds: int = 400, l2: float = 1e-3) -> list[float]:
    """Weights and, last, the bias; rows: features, weight of class 1, weight of class 0."""
    if not rows:
        return []
    n, total = len(rows[0][0]), sum(a + b for _, a, b in rows)
    w, speed = [0.0] * (n + 1), [0.0] * (n + 1)
    for _ in range(rounds):
        g = [l2 * x for x in w]
        for x, a, b in rows:
            z = w[n] + sum(w[j] for j in range(n) if x[j])
            err = ((a + b) / (1 + math.exp(-max(-30.0, min(30.0, z)))) - a) / total
            for j in range(n):
                if x[j]:
                    g[j] += err
            g[n] += err
        speed = [0.9 * s + x for s, x in zip(speed, g)]
        w = [x - 0.5 * s for x, s in zip(w, speed)]
    return w


def train(found: DataFrame, base: str = "base", loose: str = "loose") -> dict[str, float]:
    """Weights of the span classifier, from the candidates of all documents."""
    spans = found.select(F.explode(F.expr(f"concat(transform({base}, x -> named_struct('c', x, 's', true)), transform({loose}, x -> named_struct('c', x, 's', false)))")).alias("q")).select("q.c", "q.s")
    votes, features = _votes("s"), _features("s")
    pattern = spans.select(F.col("c.kind").alias("kind"), F.array(*[F.expr(v).cast("int") for v in votes.values()]).alias("votes"), F.array(*[F.expr(f"cast(coalesce({v}, false) as int)") for v in features.values()]).alias("x"))
    # at most 4 * 3**5 vote patterns by 2**16 features, of which few can occur together
    rows = pattern.groupBy("kind", "votes", "x").agg(F.count(F.lit(1)).alias("n")).collect()
    merged: dict[tuple[str, tuple[int, ...]], int] = {}
    for r in rows:
        key = r["kind"], tuple(v or 0 for v in r["votes"])
        merged[key] = merged.get(key, 0) + r["n"]
    posterior = em([(k, v, n) for (k, v), n in sorted(merged.items())])
    by_x: dict[tuple[int, ...], list[float]] = {}
    for r in rows:
        p = posterior[r["kind"], tuple(v or 0 for v in r["votes"])]
        at = by_x.setdefault(tuple(r["x"]), [0.0, 0.0])
        at[0] += r["n"] * p
        at[1] += r["n"] * (1 - p)
    w = logistic([(x, a, b) for x, (a, b) in sorted(by_x.items())])
    return dict(zip([*features, "bias"], w)) if w else {}


def _accepted(loose: str, w: dict[str, float]) -> str:
    if not w:
        return f"filter({loose}, c -> false)"
    terms = " + ".join([repr(w["bias"]) + "D", *[f"if(coalesce({sql}, false), {w[name]!r}D, 0D)" for name, sql in _features("false").items()]])
    return f"filter({loose}, c -> {terms} >= 0D)"




def _by_kind(spans: str) -> str:
    """Spans sorted by kind as listed, then start."""
    at = lambda x: f"array_position(array('email', 'ip', 'card', 'phone'), {x}.kind)"
    return f"array_sort({spans}, (p, q) -> case when {at('p')} < {at('q')} then -1 when {at('p')} > {at('q')} then 1 when p.start < q.start then -1 when p.start > q.start then 1 else 0 end)"


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"


def op6(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    found, _ = table(candidates(docs.select("doc_id", "text")).drop("text"), "candidates")
    w = train(found)
    counted = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    every = found.withColumn("every", F.expr(f"if(size(loose) = 0, base, {_by_kind(f'concat(base, {_accepted("loose", w)})')})"))
    return every.select("doc_id", *counted, F.sha2(F.expr(_joined("base")), 256).alias("base_sha256"), F.expr(_joined("every")).alias("spans"))


def find(docs: DataFrame, to: str = "pii") -> DataFrame:
    """docs and an array of all spans (kind, start, end, hit), by kind and start."""
    found, _ = table(candidates(docs.select("text")).select("base", "loose").filter("size(base) + size(loose) > 0"), "candidates")
    w = train(found)
    base, loose = (fresh(c, docs.columns) for c in ("pii_base", "pii_loose"))
    both = candidates(docs, to=(base, loose))
    spans = F.expr(f"transform({_by_kind(f'concat({base}, {_accepted(loose, w)})')}, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'hit', x.hit))")
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], spans.alias(to))


def redact(docs: DataFrame) -> DataFrame:
    """docs with each span in `text` replaced by its kind in angle brackets (overlapping spans are one), and n_chars, if there, counted anew."""
    name = fresh("pii", docs.columns)
    found = find(docs, name)
    # spans by start; one that starts before the furthest end so far is part of what stands before it
    ordered = f"array_sort(transform({name}, x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind)))"
    merged = f"""aggregate({ordered}, cast(array() as array<struct<start:int,end:int,kind:string>>), (m, x) ->
      if(size(m) > 0 and x.start < element_at(m, -1).end,
         concat(slice(m, 1, size(m) - 1), array(named_struct('start', element_at(m, -1).start, 'end', greatest(element_at(m, -1).end, x.end), 'kind', element_at(m, -1).kind))),
         concat(m, array(x))))"""
    held = found.withColumn(name, F.expr(f"if(size({name}) = 0, null, {merged})"))
    before = f"if(i = 0, 0, {name}[i - 1].end)"
    parts = f"transform({name}, (x, i) -> concat(substring(text, {before} + 1, x.start - {before}), '<', upper(x.kind), '>'))"
    new = f"if({name} is null, text, concat(array_join({parts}, ''), substring(text, element_at({name}, -1).end + 1)))"
    out = held.withColumn("text", F.expr(new)).drop(name)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
