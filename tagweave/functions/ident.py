"""Identifiers in reference strings, as Column expressions; empty where there is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and words that results depend on.
DOI = r"\b(10\.\d{4,}(?:\.\d{1,})*/.+)"
DOI_URL_PREFIX = r"((?:https?\s*\:\s*/\s*/\s*)?(?:[a-z]+\s*\.\s*)?doi\s*.\s*org\s*/\s*)"
DOI_ENDS_AT = ("PubMed", "PMID", "PMCID", "Error", "Epub", "Accessed")
PII_VALID = r"\b([S,B]\W*(?:[0-9xX]\W*){15,}[0-9xX])"
PII_OTHER = r"\b(?:doi\:)?(\S{5,})\s*\[pii\]"
PMID = r"(?:PMID\s*\:\s*)(\d{1,10})\b"
PMID_FIX = r"(?:PMID\s*\:\s*)?\b(\d{1,10})\b"
PMCID = r"(?i)(PMC\d{1,})"
WOS = r"(?i)(?:WOS\s*\:\s*)(\d{15,15})\b"
ARTICLE_TITLE = r"^(.*?)(\;\s*PMC\d+|\s*,\s*)?$"
QUOTES = (('"', '"'), ("'", "'"), ("“", "”"), ("‘", "’"))


def _first(pattern: str):
    return lambda c: F.regexp_extract(c, pattern, 1)


doi_url_prefix, pii_valid, pii_other, pmid, pmid_fix, pmcid, wos = map(_first, (DOI_URL_PREFIX, PII_VALID, PII_OTHER, PMID, PMID_FIX, PMCID, WOS))


def doi(c: Column) -> Column:
    """A DOI less what follows it: dots, labels, other identifiers, a second DOI, an unbalanced bracket."""
    end = lambda x: F.regexp_replace(x, r"[\s.]+$", "")
    x = end(F.regexp_extract(c, DOI, 1))
    x = end(F.regexp_replace(x, rf"(?i)[\s(]+(?:{'|'.join(DOI_ENDS_AT)})\b.*$", ""))
    x = end(F.regexp_replace(x, r"\s*\[doi\].*$", ""))
    x = end(F.regexp_replace(x, r"\s+\S+\s*\[pii\]$|\s*\[pii\]$", ""))
    x = F.regexp_replace(x, r"^(10\.\d{4,}\S*?/\S+?)[\s;,.]*(?:https?://\S*?)?(?:doi:\s*)?\1$", "$1")
    x = F.regexp_replace(x, r";+$", "")
    open_, shut = (F.length(x) - F.length(F.replace(x, F.lit(b), F.lit(""))) for b in "[]")
    return F.when((shut > open_) & x.endswith("]"), F.regexp_replace(x, r"\]$", "")).otherwise(x)


def ext_link(c: Column) -> Column:
    """A doi.org address less a repeated [doi] behind it."""
    return F.when(F.contains(c, F.lit("doi.org")), F.regexp_replace(c, rf"\s*\[{DOI[2:]}\]\s*$", "")).otherwise(c)


def article_title(c: Column) -> Column:
    """A title less a PMC id or comma behind it and quotes around it."""
    x = F.regexp_extract(c, f"(?s){ARTICLE_TITLE}", 1)
    for a, b in QUOTES:
        x = F.when(x.startswith(a) & x.endswith(b) & (F.length(x) > 1), x.substr(F.lit(2), F.length(x) - 2)).otherwise(x)
    return x


def split_urls(c: Column) -> Column:
    """Addresses that stand joined in one text."""
    return F.filter(F.split(c, r"(?=https?://)", -1), lambda x: F.trim(x) != "")


def matched(c: Column, pattern: str) -> Column:
    """Group 1 of a pattern that begins with the text, else the text."""
    return F.when(c.rlike(f"^(?:{pattern})"), F.regexp_extract(c, f"^(?:{pattern})", 1)).otherwise(c)


def without_punctuation(c: Column, blanks: bool = False) -> Column:
    return F.regexp_replace(c, r"[\p{P}\s]" if blanks else r"\p{P}", "")


def spaced_words(c: Column) -> Column:
    """Words and other characters, one blank apart."""
    return F.array_join(F.filter(F.split(c, r"(?U)(?<=\W)|(?=\W)", -1), lambda x: ~x.rlike(r"(?U)^\s*$")), " ")


def rename(c: Column, rule: str) -> Column:
    """/pattern/replacement/, in any delimiter, applied to a name; \\1 or $1 for groups."""
    parts = rule.split(rule[0]) if rule else []
    if len(parts) != 4 or parts[0] or parts[3]:
        raise ValueError(f"not a rule of the form /pattern/replacement/: {rule}")
    import re

    return F.regexp_replace(c, parts[1], re.sub(r"\\(\d)", r"$\1", parts[2]))
