"""Operators on whole documents: merging two taggings, counts of tags, layout markup to text, sections' checks, composition."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.align import find
from tagweave.functions.markup import local
from tagweave.functions.text import tag_value
from tagweave.session import ship


def compose(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """The steps, one after the other."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


def take_tag(tag: str, other: str) -> Column:
    """The other document's tag, where it has one."""
    return F.coalesce(F.when(F.col(other) != "", F.col(other)), F.col(tag))


def merge_documents(a: DataFrame, b: DataFrame, position: list[str], token: str, tag: str, to: str | None = None, merge: Callable[[str, str], Column] = take_tag) -> DataFrame:
    """Tokens of a with tags of b merged in (as `to`, or in place), joined by position; a token that lacks its equal in the other document is an error."""
    to = to or tag
    other = b.select(*position, F.col(token).alias("__token"), F.col(tag).alias("__tag"))
    both = a.join(other.withColumn("__there", F.lit(True)), position, "full")
    same = F.coalesce(F.col("__there") & F.col(token).eqNullSafe(F.col("__token")), F.lit(False))
    checked = both.withColumn("__ok", F.assert_true(same, F.lit("the documents' tokens differ")))
    base = checked if to in a.columns else checked.withColumn(to, F.lit(None).cast("string"))
    return base.filter(F.col("__ok").isNull()).withColumn(to, merge(to, "__tag")).drop("__token", "__tag", "__there", "__ok")


def tag_counts(tokens: DataFrame, key: str, columns: tuple[str, ...] = ("tag", "sub_tag")) -> DataFrame:
    """How many tokens of a document have each value in each of these columns."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("level"), tag_value(F.col(c)).alias("value")) for c in columns]))
    return tokens.select(key, values.alias("v")).filter("v.value is not null and v.value <> ''").groupBy(key, "v.level", "v.value").agg(F.count(F.lit(1)).alias("n"))


def layout_text(docs: DataFrame, xml: str, to: str = "text") -> DataFrame:
    """The text of layout markup (pages of blocks of lines of strings): words one blank apart, a line feed after each line, a blank line between blocks, two more between pages."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def run(some: pd.Series) -> pd.Series:
        import xml.etree.ElementTree as ET

        def within(e: ET.Element, name: str) -> list[ET.Element]:
            return [x for x in e.iter() if local(x.tag) == name and x is not e]

        def line(e: ET.Element) -> str:
            return " ".join(s.get("CONTENT", "") for s in within(e, "String")) + "\n"

        def block(e: ET.Element) -> str:
            return "".join(line(x) for x in within(e, "TextLine") if within(x, "String"))

        def page(e: ET.Element) -> str:
            return "\n".join(block(x) for x in within(e, "TextBlock") if within(x, "String"))

        def one(x: str | None) -> str | None:
            if x is None:
                return None
            root = ET.fromstring(x)
            pages = [e for e in root.iter() if local(e.tag) == "Page"]
            return "\n\n".join(page(e) for e in pages) + "\n"

        return some.map(one)

    return docs.withColumn(to, run(F.col(xml)))


def sections_of(mapping: dict[str, list[str]]) -> dict[str, str]:
    """Section by field, from fields by section."""
    return {field: section for section, fields in mapping.items() for field in fields}


def section_check(found: DataFrame, expected: DataFrame, key: str, mapping: dict[str, list[str]], matching: list[str], required: list[str], threshold: float = 0.8) -> DataFrame:
    """key and passed: whether each expected value (key, field, text) is found, to the threshold, within the text of its field's section (found: key, name, position, text).

    A required field must have an expected value; fields without one don't count
    otherwise.  A section's texts are joined by blanks, in order.
    """
    ship(found.sparkSession)
    of = sections_of(mapping)
    if unknown := sorted((set(matching) | set(required)) - set(of)):
        raise ValueError(f"fields without a section: {', '.join(unknown)}")
    section = F.create_map(*[F.lit(x) for pair in of.items() for x in pair])
    wanted = expected.filter(F.col("field").isin(sorted(set(matching) | set(required))) & (F.trim("text") != ""))
    wanted = wanted.select(key, "field", F.col("text").alias("needle"), F.element_at(section, F.col("field")).alias("name"))
    joined = found.groupBy(key, "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda x: x["text"]), " ").alias("joined"))

    @F.pandas_udf("boolean")
    def holds(text: pd.Series, needle: pd.Series) -> pd.Series:
        return pd.Series([bool(t) and find(t, n, threshold) is not None for t, n in zip(text, needle)])

    checked = wanted.join(joined, [key, "name"], "left").select(key, "field", holds(F.coalesce("joined", F.lit("")), "needle").alias("ok"))
    every = found.select(key).unionByName(expected.select(key)).distinct()
    good = checked.groupBy(key).agg(F.bool_and("ok").alias("ok"), F.collect_set("field").alias("fields"))
    has = F.size(F.array_except(F.array(*[F.lit(f) for f in required]) if required else F.array().cast("array<string>"), F.coalesce("fields", F.array().cast("array<string>")))) == 0
    return every.join(good, key, "left").select(key, (F.coalesce("ok", F.lit(True)) & has).alias("passed"))
