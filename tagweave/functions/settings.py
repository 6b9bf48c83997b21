"""Options of matchers, segmentation, line numbers and references, and how configuration text gives them. No Spark here."""

from __future__ import annotations

import configparser
import re
from dataclasses import dataclass, field, replace

from tagweave.functions.mapping import Mapping, spellings

SIMPLE, COMPLEX = "simple", "complex"


@dataclass(frozen=True)
class TagOptions:
    """How one field is matched: what must stand before it, other spellings, whether gaps between its parts and up to a line's edge are filled, in how many parts it may stand, and the block around it."""

    match_prefix: str | None = None
    spellings: dict[str, list[str]] = field(default_factory=dict)
    merge: bool = True
    extend_to_line: bool = True
    max_chunks: int = 1
    block: str | None = None


@dataclass(frozen=True)
class LineNumberOptions:
    tag: str = "line_no"
    least: int = 10
    gap: int = 10
    ratio: float = 0.1


@dataclass(frozen=True)
class MatchOptions:
    matcher: str = SIMPLE
    threshold: float = 0.8
    lookahead_lines: int = 500
    min_length: int = 2
    begin_prefix: bool = True
    extend_to_line: bool = True
    sub_annotations: bool = False
    line_numbers: LineNumberOptions | None = None
    tags: dict[str, TagOptions] = field(default_factory=dict)

    def of(self, name: str) -> TagOptions:
        return self.tags.get(name, TagOptions())


@dataclass(frozen=True)
class SegmentationOptions:
    """Fields by section, the line from which front blocks no longer count (0: any), and the line before which a page header must be seen."""

    sections: dict[str, list[str]]
    front_limit: int = 0
    header_before: int = 50


@dataclass(frozen=True)
class ReferenceOptions:
    """Tags of references: what each becomes, which are merged, take the dot behind them, or what stands before them."""

    renamed: dict[str, str]
    merged: tuple[str, ...]
    names: tuple[str, ...]
    prefixes: dict[str, str]
    marker: str


# The tags of references and the words before identifiers.
_WORD = r"\b[a-zA-Z]{2,}(\s?:)?$"
REFERENCES = ReferenceOptions(
    renamed={"reference-fpage": "reference-page", "reference-lpage": "reference-page"},
    merged=("reference-author", "reference-editor", "reference-issue", "reference-page"),
    names=("reference-author", "reference-editor"),
    prefixes={
        "reference-issn": _WORD,
        "reference-isbn": _WORD,
        "reference-doi": r"(?i)\bDOI(\s?:)?$",
        "reference-pii": r"(?i)\bPII(\s?:)?$",
        "reference-pmid": _WORD,
        "reference-pmcid": _WORD,
        "reference-arxiv": _WORD,
    },
    marker="reference-etal",
)
# Where each model's training markup keeps its content.
CONTAINERS = {"header": "text/front", "segmentation": "text", "fulltext": "text", "reference": "text/back/listBibl"}
NAMESPACES = {"tei": "http://www.tei-c.org/ns/1.0", "xml": "http://www.w3.org/XML/1998/namespace"}


def yes(text: str | None, default: bool) -> bool:
    """A truth value as configuration files write it."""
    if text is None:
        return default
    low = text.strip().lower()
    if low in ("y", "yes", "t", "true", "on", "1"):
        return True
    if low in ("n", "no", "f", "false", "off", "0"):
        return False
    raise ValueError(f"not a truth value: {text}")


def pattern(text: str | None) -> str | None:
    """A pattern, less quotes around it; one that doesn't compile is an error."""
    if not text:
        return text
    text = text[1:-1] if len(text) > 1 and text[0] == text[-1] == '"' else text
    re.compile(text)
    return text


def tag_options(sections: dict[str, Mapping]) -> dict[str, TagOptions]:
    """Options by field; sections count as one, the later before the earlier."""
    flat = {k: v for m in sections.values() for k, v in m.items()}
    return {
        f: TagOptions(
            match_prefix=pattern(flat.get(f"{f}.match-prefix-regex")),
            spellings=spellings(flat.get(f"{f}.alternative-spellings") or ""),
            merge=yes(flat.get(f"{f}.merge"), True),
            extend_to_line=yes(flat.get(f"{f}.extend-to-line"), True),
            max_chunks=int(flat.get(f"{f}.max-chunks") or flat.get(f"{f}.max_chunks") or 1),
            block=flat.get(f"{f}.block"),
        )
        for f in flat
        if "." not in f
    }


def match_options(base: MatchOptions, sections: dict[str, Mapping]) -> MatchOptions:
    return replace(base, tags=tag_options(sections))


def segmentation_options(text: str) -> SegmentationOptions:
    """[tags] with fields by section, comma-separated, and [config] with the two limits."""
    p = configparser.ConfigParser()
    p.read_string(text)
    fields = {k: [x.strip() for x in v.split(",") if x.strip()] for k, v in p.items("tags")}
    number = lambda k, d: p.getint("config", k, fallback=d)
    return SegmentationOptions(fields, number("front_max_start_line_index", 0), number("page_header_max_first_line_index", 50))


def resolve(path: str, namespaces: dict[str, str] | None = None) -> str:
    """A path with each step's prefix as its namespace in braces; a prefix without one is an error."""
    known = NAMESPACES if namespaces is None else namespaces

    def step(m: re.Match) -> str:
        if m[1] not in known:
            raise ValueError(f"unknown prefix: {m[1]}")
        return f"{{{known[m[1]]}}}"

    return re.sub(r"(?<![\w\"'])([A-Za-z_][\w.-]*):(?=[A-Za-z_])", step, path)


def match_prefix(text: str, sub_values: dict[str, str]) -> str:
    """A prefix pattern with {sub-field} replaced by that value, taken literally; NOT_FOUND where it is missing."""
    return re.sub(r"\{([A-Za-z_][\w-]*)\}", lambda m: re.escape(sub_values.get(m[1]) or "NOT_FOUND"), text)
