"""Sections of lines: majority sections, page numbers and headers, filled gaps; line numbers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.operators.sequences import fill_backward, fill_forward, runs
from tagweave.session import ship

MERGED = ("front", "annex", "reference")
TRANSPARENT = ("headnote", "page")


def clear_late_front(lines: DataFrame, key: str, limit: int) -> DataFrame:
    """Blocks of front lines that begin after `limit` lose their section; 0 for no limit."""
    if not limit:
        return lines
    numbered = runs(lines, key, "line_no", "section", "__run")
    first = F.min("line_no").over(W.partitionBy(key, "__run"))
    return numbered.withColumn("section", F.when((F.col("section") == "front") & (first > limit), None).otherwise(F.col("section"))).drop("__run")


def headers(lines: DataFrame, key: str, least: int = 2, first_before: int = 50) -> DataFrame:
    """Lines whose text repeats become headnote: the most frequent such text and those but one less frequent, of two words or more and not only digits and dots, seen before line 50."""
    counted = F.col("section").isNull()
    texts = lines.groupBy(key, "text").agg(F.count_if(counted).alias("n"), F.min("line_no").alias("first"))
    ok = texts.filter((F.col("n") >= least) & ~F.col("text").rlike(r"^(\d|\s|\.)+$") & (F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")) >= 2) & (F.col("first") < first_before))
    top = F.max("n").over(W.partitionBy(key))
    names = ok.withColumn("top", top).filter(F.col("n") >= F.greatest(F.lit(2), F.col("top") - 1)).select(key, "text", F.lit(True).alias("__head"))
    return lines.join(names, [key, "text"], "left").withColumn("section", F.when(F.col("__head"), "headnote").otherwise(F.col("section"))).drop("__head")


def page_numbers(lines: DataFrame, key: str) -> DataFrame:
    """Untagged lines that are a number become page where it fits between the known pages around, the first page being 1.

    Lines are taken in order: a number counts if it is at least the least page
    still to come and less than the next known page; each one taken raises the
    least page by one, a known page sets it to its number (-1 if that is none).
    Only lines with a number or a known page are gathered by key.
    """
    ship(lines.sparkSession)
    text = F.trim("text")
    number = F.col("section").isNull() & text.rlike("^[0-9]+$")
    some = lines.select(key, "line_no", "section", text.alias("n")).filter(number | (F.col("section") == "page"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("line_no")
        numbers = [int(n) if n.isascii() and n.isdigit() else -1 for n in pdf["n"]]
        known = (pdf["section"] == "page").tolist()
        least, upto, limits = 1, None, []
        for n, page in zip(numbers[::-1], known[::-1]):
            upto = n if page else upto
            limits.append(upto)
        taken = []
        for i, (n, page, limit) in enumerate(zip(numbers, known, limits[::-1])):
            if page:
                least = n
            elif limit is not None and least <= n < limit:
                taken.append(i)
                least += 1
        return pdf.iloc[taken][[key, "line_no"]]

    found = some.groupBy(key).applyInPandas(run, f"{key} {lines.schema[key].dataType.simpleString()}, line_no {lines.schema['line_no'].dataType.simpleString()}")
    return lines.join(found.withColumn("__page", F.lit(True)), [key, "line_no"], "left").withColumn("section", F.when(F.col("__page"), "page").otherwise(F.col("section"))).drop("__page")


def merge_sections(lines: DataFrame, key: str, enabled: tuple[str, ...] = MERGED) -> DataFrame:
    """Untagged lines between two lines of one enabled section join it (headers and pages don't part them, the text begins as front); trailing ones join annex only."""
    solid = F.when(~F.col("section").isin(*TRANSPARENT), F.col("section"))
    both = fill_backward(fill_forward(lines, key, "line_no", solid, "__before"), key, "line_no", solid, "__after")
    before = F.coalesce("__before", F.lit("front"))
    joins = (before == F.col("__after")) | (F.col("__after").isNull() & (before == "annex"))
    new = F.when(F.col("section").isNull() & before.isin(*enabled) & joins, before).otherwise(F.col("section"))
    return both.withColumn("section", new).drop("__before", "__after")


def segment(lines: DataFrame, key: str, front_limit: int = 0, enabled: tuple[str, ...] = MERGED, preserve: bool = False) -> DataFrame:
    """lines (key, line_no, text, section: majority section or null; has_page: whether a token was a page number before) with their final section."""
    ship(lines.sparkSession)
    out = clear_late_front(lines, key, front_limit)
    if preserve:
        out = out.withColumn("section", F.when(F.col("section").isNull() & F.col("has_page"), "page").otherwise(F.col("section")))
    out = merge_sections(headers(page_numbers(out, key), key), key, enabled)
    return out if preserve else out.withColumn("section", F.coalesce("section", F.lit("body")))


def line_number_runs(numbers: list[int], gap: int = 1) -> list[list[int]]:
    """Places of numbers (in text order) gathered in rising runs, each step at most 1 + gap; out-of-order numbers are passed over."""
    order = sorted(range(len(numbers)), key=lambda i: (numbers[i], i))
    out: list[list[int]] = []
    for i in order:
        if out and i > out[-1][-1] and 1 <= numbers[i] - numbers[out[-1][-1]] <= 1 + gap:
            out[-1].append(i)
        elif out and (numbers[i] == numbers[out[-1][-1]] or i < out[-1][-1]):
            continue
        else:
            out.append([i])
    return out


def line_numbers(tokens: DataFrame, key: str | list[str], least: int = 10, gap: int = 10, ratio: float = 0.1) -> DataFrame:
    """keys, line_no of lines whose first token is a line number: in a run of at least `least`, if at least `ratio` of the lines begin with one.

    `key` names a page (document and page number): runs and shares are those of a page.
    """
    ship(tokens.sparkSession)
    keys = [key] if isinstance(key, str) else key
    first = tokens.filter(F.trim("token") != "").groupBy(*keys, "line_no").agg(F.min_by("token", "token_no").alias("n"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("line_no")
        numbers = [int(n) if n.isdecimal() else 0 for n in pdf["n"]]
        some = [i for i, n in enumerate(numbers) if n > 0]
        at = sorted(some[i] for r in line_number_runs([numbers[i] for i in some], gap) if len(r) >= least for i in r)
        return pdf.iloc[at if at and len(at) >= ratio * len(pdf) else []][[*keys, "line_no"]]

    kinds = {c: tokens.schema[c].dataType.simpleString() for c in (*keys, "line_no")}
    return first.groupBy(*keys).applyInPandas(run, ", ".join(f"{c} {k}" for c, k in kinds.items()))
