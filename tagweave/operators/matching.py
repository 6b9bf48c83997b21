"""Locating target values in documents, fuzzily, and tagging the tokens that they cover."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.functions.align import THRESHOLD, find, find_all, search, select_ranges
from tagweave.session import ship

SPANS = "field string, ordinal int, part int, start long, end long"
_SAME = str.maketrans("–— '", '-- "')


def normalise(s: str) -> str:
    """As functions.text.normalise, of one length with the text but for &apos;."""
    return s.replace("&apos;", '"').lower().translate(_SAME)


def _same_length(s: str) -> str:
    """Normal form in which every character keeps its place."""
    return "".join(c if len(c.lower()) != 1 else c.lower() for c in s).translate(_SAME)


def value_span(text: str, value: str, others: list[str], threshold: float, start: int = 0, short: int = 2) -> tuple[int, int] | None:
    """Where a value stands from `start`: in normal form, then with its words spaced apart, then by other spellings."""
    value = normalise(value)
    if len(value) < short:
        return None
    for needle in (value, " ".join(spaced(value)), *map(normalise, others)):
        if needle and (span := find(text, needle, threshold, start)):
            return span
    return None


def spaced(value: str) -> list[str]:
    """Words and other characters, without blanks."""
    import re

    return [x for x in re.split(r"(\W)", value) if x.strip()]


class Matcher:
    """Spans of one document's targets, in their order.

    A target is looked for in the text that no other has taken, within `window`
    characters or `lines` lines (0: all) from where the last match of another field ended; if
    it isn't there and its field is another than the last one's, in the whole
    text, and the window moves to it.  What isn't found is tried again until a
    pass finds nothing new.
    """

    def __init__(self, text: str, threshold: float = THRESHOLD, window: int = 0, spellings: dict[str, list[str]] | None = None, lines: int = 0) -> None:
        self.text, self.threshold, self.window, self.spellings = _same_length(text), threshold, window, spellings or {}
        self.taken: list[tuple[int, int]] = []
        self.lines, self.ends = lines, [i + 1 for i, c in enumerate(text) if c == "\n"] if lines else []

    def reach(self, at: int) -> int:
        """Where the part of the text ends in which a target is looked for first."""
        end = min(len(self.text), at + self.window) if self.window else len(self.text)
        k = bisect_right(self.ends, at) + self.lines - 1
        return min(end, self.ends[k]) if self.lines and k < len(self.ends) else end

    def free(self, start: int, end: int) -> list[tuple[int, int]]:
        out = []
        for s, e in sorted(self.taken):
            if s > start:
                out.append((start, min(s, end)))
            start = max(start, e)
            if start >= end:
                break
        return out + ([(start, end)] if start < end else [])

    def one(self, values: list[str], start: int, end: int) -> list[tuple[int, int]]:
        """The chosen range of the values (one, or a list found each by itself) between start and end."""
        for s, e in self.free(start, end):
            part = self.text[s:e]
            found = [x for v in values if (x := value_span(part, v, self.spellings.get(v, []), self.threshold))]
            if found:
                chosen = select_ranges(found) if len(values) > 1 else found
                return [(min(a for a, _ in chosen) + s, max(b for _, b in chosen) + s)]
        return []

    def run(self, targets: list[tuple[str, int, list[str]]]) -> list[tuple[str, int, int, int, int]]:
        out, todo, at, last = [], list(targets), 0, None
        while todo:
            missed = []
            for field, ordinal, values in todo:
                end = self.reach(at)
                got = self.one(values, at, end)
                if not got and field != last and (at or end < len(self.text)):
                    got = self.one(values, 0, len(self.text))
                    if got:
                        at = got[0][0]
                if not got:
                    missed.append((field, ordinal, values))
                    continue
                last = field
                for part, (s, e) in enumerate(got):
                    out.append((field, ordinal, part, s, e))
                    self.taken.append((s, e))
            if len(missed) == len(todo):
                break
            todo = missed
        return out


def fuzzy_spans(docs: DataFrame, targets: DataFrame, key: str, text: str = "text", threshold: float = THRESHOLD, window: int = 0, spellings: dict[str, list[str]] | None = None, lines: int = 0) -> DataFrame:
    """key and SPANS: where each document's targets (key, field, ordinal, values) stand; code points, end exclusive.

    Documents and their targets meet by key: what a task holds is one document
    and its own targets; of a key that several rows have each is searched.  Null texts and empty values have no spans.
    """
    ship(docs.sparkSession)

    def run(d: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(d) and len(t):
            asked = [(f, int(o), [x for x in v if x]) for f, o, v in sorted(zip(t["field"], t["ordinal"], t["values"]), key=lambda x: x[1])]
            for one in d[text]:
                rows += Matcher(one, threshold, window, spellings, lines).run([x for x in asked if x[2]]) if one else []
        out = pd.DataFrame(rows, columns=["field", "ordinal", "part", "start", "end"])
        out.insert(0, key, d[key].iloc[0] if len(d) else None)
        return out.astype({"ordinal": "int32", "part": "int32", "start": "int64", "end": "int64"})

    kind = docs.schema[key].dataType.simpleString()
    # renamed anew, as both sides may come from one frame
    left, right = docs.select(key, text).toDF(key, text), targets.select(key, "field", "ordinal", "values").toDF(key, "field", "ordinal", "values")
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInPandas(run, f"{key} {kind}, {SPANS}")


def _beside_text(spans: DataFrame, docs: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """spans with the text before and in each, and its target's sub values."""
    subs = targets.select(key, "ordinal", "sub").dropDuplicates([key, "ordinal"])
    text = docs.select(key, F.col("text").alias("__text"))
    start, end = F.col("start").cast("int"), F.col("end").cast("int")
    joined = spans.join(text, key).join(subs, [key, "ordinal"], "left")
    return joined.withColumns({"__before": F.col("__text").substr(F.lit(1), start), "__in": F.col("__text").substr(start + 1, end - start)}).drop("__text")


def with_prefixes(spans: DataFrame, docs: DataFrame, targets: DataFrame, key: str, patterns: dict[str, str]) -> DataFrame:
    """spans that take in what their field's pattern finds in the text before them, from there on; {sub-field} in a pattern stands for the target's sub value."""
    ship(spans.sparkSession)

    @F.pandas_udf("bigint")
    def begin(field: pd.Series, before: pd.Series, start: pd.Series, sub: pd.Series) -> pd.Series:
        import re

        from tagweave.functions.settings import match_prefix

        def one(name: str, text: str, at: int, subs) -> int:
            if not text or name not in patterns:
                return at
            values = {x["field"]: x["values"][0] for x in ([] if subs is None else subs) if len(x["values"]) == 1}
            m = re.search(match_prefix(patterns[name], values), text)
            return m.start() if m else at

        return pd.Series([one(*x) for x in zip(field, before, start, sub)])

    return _beside_text(spans, docs, targets, key).withColumn("start", begin("field", "__before", "start", "sub")).select(*spans.columns)


def sub_spans(spans: DataFrame, docs: DataFrame, targets: DataFrame, key: str, threshold: float = THRESHOLD) -> DataFrame:
    """key and SPANS of sub values within their targets' spans: in their order, each at its first place that no sub value before it has taken."""
    ship(spans.sparkSession)

    @F.pandas_udf("array<struct<field:string,start:bigint,end:bigint>>")
    def within(text: pd.Series, sub: pd.Series) -> pd.Series:
        def one(t: str, subs) -> list[dict]:
            taken: list[tuple[int, int]] = []
            out = []
            for x in [] if subs is None else subs:
                if len(x["values"]) != 1:
                    raise ValueError("a sub annotation has one value")
                for a, b in find_all(_same_length(t), x["values"][0].lower(), threshold):
                    if all(b <= s or e <= a for s, e in taken):
                        taken.append((a, b))
                        out.append({"field": x["field"], "start": a, "end": b})
                        break
            return out

        return pd.Series([one(*x) for x in zip(text, sub)])

    found = _beside_text(spans, docs, targets, key).select(key, "ordinal", "part", "start", F.explode(within("__in", "sub")).alias("s"))
    return found.select(key, "s.field", "ordinal", "part", (F.col("start") + F.col("s.start")).alias("start"), (F.col("start") + F.col("s.end")).alias("end"))


def all_spans(docs: DataFrame, values: list[str], key: str, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every place of each of a few values in every document."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<struct<value:string,start:bigint,end:bigint>>")
    def places(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: [{"value": v, "start": a, "end": b} for v in values for a, b in (find_all(_same_length(s), normalise(v), threshold) if s else ())])

    return docs.select(key, F.explode(places(text)).alias("p")).select(key, "p.*")


def chunks(text: str, value: str, n: int, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Ranges of a value that may stand in up to n parts."""
    found = search(_same_length(text), normalise(value), threshold, chunks=n)
    return [(c[0][0], c[-1][0] + c[-1][2]) for c in found]


def tag_tokens(tokens: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """tokens (key, token_no, start, end, ...) with `tag`: b- and i- of the first span by (start, ordinal) that each overlaps; tokens of blanks only carry a tag inside spans too."""
    hit = (F.col(f"t.{key}") == F.col(f"s.{key}")) & (F.col("t.end") > F.col("s.start")) & (F.col("t.start") < F.col("s.end"))
    joined = tokens.alias("t").join(spans.alias("s"), hit).select(F.col(f"t.{key}"), "t.token_no", F.struct(F.col("s.start").alias("s"), "s.ordinal", "s.field").alias("span"))
    best = joined.groupBy(key, "token_no").agg(F.min("span").alias("span"))
    first = F.row_number().over(W.partitionBy(key, "span").orderBy("token_no")) == 1
    tags = best.select(key, "token_no", F.concat(F.when(first, "b-").otherwise("i-"), F.col("span.field")).alias("tag"))
    return tokens.join(tags, [key, "token_no"], "left")


def required_fields(targets: DataFrame, found: DataFrame, key: str, required: list[str], matching: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """key and passed: every required field has text, and a matching field's text is as its target (Levenshtein ratio); targets and found: key, field, text."""
    from tagweave.functions.text import levenshtein_ratio

    wanted = F.array(*[F.lit(x) for x in sorted({*required, *matching})])
    fields = targets.select(key).distinct().select(key, F.explode(wanted).alias("field"))
    both = fields.join(targets.select(key, "field", F.col("text").alias("target")), [key, "field"], "left").join(found.select(key, "field", "text"), [key, "field"], "left")
    ok = F.when(F.coalesce(F.col("target"), F.lit("")) == "", True).when(F.col("text").isNull(), False)
    ok = ok.otherwise(~F.col("field").isin(matching) | (levenshtein_ratio(F.col("target"), F.col("text")) >= threshold))
    return both.groupBy(key).agg(F.bool_and(ok).alias("passed"))
