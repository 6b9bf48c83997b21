"""Text and tag functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise(c: Column) -> Column:
    """Lower case; long dashes, thin spaces and apostrophes in one form."""
    return F.translate(F.lower(F.replace(c, F.lit("&apos;"), F.lit('"'))), "–— '", '-- "')


def strip_whitespace(c: Column) -> Column:
    """Tabs to blanks, runs of blanks to one, CR to LF, no blanks around LF, runs of LF to one."""
    c = F.regexp_replace(F.translate(c, "\t", " "), " +", " ")
    return F.regexp_replace(F.regexp_replace(F.translate(c, "\r", "\n"), " *\n *", "\n"), "\n+", "\n")


def tokens(c: Column) -> Column:
    """Words, single other characters, and a cut between a lower- and an upper-case letter."""
    return F.filter(F.split(c, r"(?U)(?<=\W)|(?=\W)|(?<=\p{javaLowerCase})(?=\p{javaUpperCase})", -1), lambda x: x != "")


def tag_prefix(c: Column) -> Column:
    """b-, i- or an empty string."""
    return F.regexp_extract(c, "^(b-|i-)?(.*)$", 1)


def tag_value(c: Column) -> Column:
    return F.regexp_extract(c, "^(b-|i-)?(.*)$", 2)


def is_blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def comma_list(c: Column) -> Column:
    """Items of a comma-separated list, stripped; none for a blank list."""
    return F.when(is_blank(c), F.array().cast("array<string>")).otherwise(F.transform(F.split(F.trim(c), ","), F.trim))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


def full_url(c: Column) -> Column:
    """No white space, and https:// where no scheme is given."""
    bare = F.regexp_replace(c, r"\s+", "")
    return F.when(F.contains(bare, F.lit("://")), bare).otherwise(F.concat(F.lit("https://"), bare))


def normalise_all(c: Column) -> Column:
    """Every text of an array, normalised."""
    return F.transform(c, normalise)


def flatten_all(c: Column, depth: int) -> Column:
    """An array nested `depth` times as one array."""
    for _ in range(depth):
        c = F.flatten(c)
    return c


def ends_with_word(c: Column) -> Column:
    """Whether the last character is a letter, digit or underscore."""
    return F.coalesce(c, F.lit("")).rlike(r"(?U)^.*\w$")


def starts_with_word(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?U)^\w")


def skip_blanks(c: Column, start: Column) -> Column:
    """The first place from `start` on (from 0) that isn't white space; the length if there is none."""
    return start + F.length(F.regexp_extract(c.substr((start + 1).cast("int"), F.length(c)), r"(?U)^\s*", 0))


def moved_range(c: Column, by: Column) -> Column:
    """A range (start, end), moved."""
    return F.struct((c["start"] + by).alias("start"), (c["end"] + by).alias("end"))


def item(c: Column, i: int) -> Column:
    """The i-th item of an array, from 0, or from the end if negative; null where there is none."""
    return F.try_element_at(c, F.lit(i + 1 if i >= 0 else i))


def scoped(name: str, scope: str | None = None, level: int | str | None = None) -> str:
    """An attribute's name within a scope and a level of tags."""
    name = f"level{level}_{name}" if level else name
    return f"{scope}-{name}" if scope else name


def by_scope(attributes: Column, name: str) -> Column:
    """The values of an attribute in a map, by scope; the scope of the bare name is an empty string."""
    own = F.map_filter(attributes, lambda k, v: (k == name) | k.endswith(f"-{name}"))
    return F.transform_keys(own, lambda k, v: F.when(k == name, F.lit("")).otherwise(F.substring(k, F.lit(1), F.length(k) - len(name) - 1)))


def without_junk(c: Column) -> Column:
    """A text less what the line matcher passes over, each character judged by the whole text: a blank or comma after a dot, a dot after a letter, a character that repeats the one before, asterisks."""
    return F.regexp_replace(c, r"(?s)(?<=\.)[ ,]|(?<=\p{L})\.|\*|(?<=(.))\1", "")
