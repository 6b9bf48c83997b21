"""Tags of reference strings repaired token by token, and mixed-content references with misplaced identifiers. No Spark here."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from itertools import groupby

from tagweave.functions import ident

# Fixed value: what stands before an identifier.
IDNO_PREFIX = r"\b[a-zA-Z]{2,}(\s?:)?$"

Token = tuple[str, str | None]


def value(tag: str | None) -> str | None:
    return re.sub("^[bi]-", "", tag) if tag else None


def groups(tokens: list[Token]) -> list[list[int]]:
    """Places of each run of one value; b- begins a run."""
    out: list[list[int]] = []
    for i, (_, tag) in enumerate(tokens):
        if not out or value(tag) != value(tokens[i - 1][1]) or (tag or "").startswith("b-"):
            out.append([])
        out[-1].append(i)
    return out


def _texts(tokens: list[Token], places: list[int]) -> tuple[str, list[int]]:
    """The text of these tokens and where each begins; one blank apart, unless blanks are tokens themselves."""
    between = "" if any(not t.strip() for t, _ in tokens) else " "
    text, starts = "", []
    for i in places:
        starts.append(len(text))
        text += tokens[i][0] + between
    return text, starts


def extend_prefix(tokens: list[Token], patterns: dict[str, str] | None = None) -> list[Token]:
    """A value with a pattern (by default `idno`) takes in what the pattern finds at the end of the untagged text right before it."""
    patterns = {"idno": IDNO_PREFIX} if patterns is None else patterns
    out, runs = list(tokens), groups(tokens)
    for before, run in zip(runs, runs[1:]):
        name = value(tokens[run[0]][1])
        if name not in patterns or tokens[before[0]][1]:
            continue
        text, starts = _texts(tokens, before)
        m = re.search(patterns[name], text.rstrip())
        if m:
            taken = [i for i, s in zip(before, starts) if s >= m.start()]
            for k, i in enumerate([*taken, run[0]]):
                out[i] = (tokens[i][0], ("b-" if k == 0 else "i-") + name)
    return out


def extend_suffix(tokens: list[Token], names: tuple[str, ...] = ("author", "editor")) -> list[Token]:
    """A name takes in the dot right behind it."""
    out, runs = list(tokens), groups(tokens)
    for run, after in zip(runs, runs[1:]):
        if value(tokens[run[0]][1]) in names and not tokens[after[0]][1] and tokens[after[0]][0].startswith("."):
            out[after[0]] = (tokens[after[0]][0], "i-" + value(tokens[run[0]][1]))
    return out


def map_et_al(tokens: list[Token], names: tuple[str, ...] = ("author", "editor"), marker: str = "etal") -> list[Token]:
    """`et al` gets the name before it (blanks between don't matter), with a b- of its own; without one it keeps its tag."""
    out, last = list(tokens), None
    for run in groups(tokens):
        v = value(tokens[run[0]][1])
        if v == marker:
            if last:
                for k, i in enumerate(run):
                    out[i] = (tokens[i][0], ("b-" if k == 0 else "i-") + last)
        elif v is not None:
            last = v if v in names else None
    return out


def merge_names(tokens: list[Token], names: tuple[str, ...] = ("author", "editor")) -> list[Token]:
    """Runs of one name, with nothing of another tag between them, are one run."""
    at = [i for i, (_, t) in enumerate(tokens) if t]
    out = list(tokens)
    for name, some in groupby(at, key=lambda i: value(tokens[i][1])):
        some = list(some)
        if name in names:
            for i in range(some[0], some[-1] + 1):
                out[i] = (tokens[i][0], ("b-" if i == some[0] else "i-") + name)
    return out


def post_process(tokens: list[Token], names: tuple[str, ...] = ("author", "editor"), patterns: dict[str, str] | None = None, marker: str = "etal") -> list[Token]:
    """et al, suffixes, prefixes, then merged names; `names`, `patterns` and `marker` name the tags meant (such as reference-author)."""
    return merge_names(extend_prefix(extend_suffix(map_et_al(tokens, names, marker), names), patterns), names)


def _inside(tag: str | None) -> str | None:
    """The tag with i- for b-; one without a prefix stays."""
    return re.sub("^b-", "i-", tag) if tag else tag


def extend_to_lines(tokens: list[Token], merge: frozenset[str], extend: frozenset[str]) -> list[Token]:
    """Gaps of one line filled: between two runs of one value that may merge, and at the line's edges by a neighbour that may extend and is longer than the gap.

    A run of a value that may merge has one b- at most.  A gap between two values stays.
    """
    tags = [t for _, t in tokens]
    runs = [list(g) for _, g in groupby(range(len(tokens)), key=lambda i: value(tags[i]))]
    for run in runs:
        if value(tags[run[0]]) in merge and re.match("[bi]-", tags[run[0]]):
            for i in run[1:]:
                tags[i] = "i-" + value(tags[i])
    for k, run in enumerate(runs):
        if tags[run[0]]:
            continue
        before = runs[k - 1] if k else None
        after = runs[k + 1] if k + 1 < len(runs) else None
        a, b = (value(tags[x[0]]) if x else None for x in (before, after))
        if before and (a == b and a in merge if after else a in extend and len(before) > len(run)):
            for i in run:
                tags[i] = _inside(tags[before[-1]])
            if after:
                tags[after[0]] = _inside(tags[after[0]])
        elif after and not before and b in extend and len(after) > len(run):
            first = tags[after[0]]
            for j, i in enumerate(run):
                tags[i] = re.sub("^[bi]-", "i-" if j else "b-", first)
            tags[after[0]] = _inside(first)
    return [(t, g) for (t, _), g in zip(tokens, tags)]


#: How each identifier is recognised in text; of a DOI only what stands before white space.
ID_PATTERNS = {"pmid": ident.PMID, "pmcid": ident.PMCID, "pii": ident.PII_VALID, "doi": ident.DOI.replace(".+)", r"\S+?)(?=[\s.;]*(?:$|\s))")}
# The identifier types of the article format.
KNOWN_TYPES = frozenset(
    """accession archive ark art-access-id arxiv coden doaj doi handle index isbn manuscript medline mr other pii pmcid pmid
    publisher-id sici std-designation zbl""".split()
)


def fix_reference(xml: str, find_missing: bool = True) -> tuple[str, bool]:
    """A reference with identifiers in <pub-id pub-id-type> where they stand in the text, and whether it changed.

    Known types are lower-cased; an identifier's element keeps only the
    identifier, what else it held goes to the text around it; one that holds
    none is unwrapped; a doi.org address before a DOI makes both an ext-link;
    types that are missing are looked for in the text.  The text stays as it is.
    """
    root = ET.fromstring(xml)
    before = ET.tostring(root, encoding="unicode")
    for parent in list(root.iter()):
        _fix_children(parent)
        _fix_links(parent)
    for title in root.iter("article-title"):
        _fix_title(title)
    for parent in root.iter():
        for i, e in enumerate(parent):
            if before_title := e.attrib.pop("__before", None):
                _set_before(parent, i, _text_before(parent, i) + before_title)
    if find_missing:
        have = {e.get("pub-id-type") for e in root.iter("pub-id")}
        if any("doi.org/" in re.sub(r"\s", "", "".join(e.itertext())) for e in root.iter("ext-link")):
            have.add("doi")
        for kind, pattern in ID_PATTERNS.items():
            if kind not in have:
                _annotate(root, kind, pattern)
    after = ET.tostring(root, encoding="unicode")
    return after, after != before


def _text_before(parent: ET.Element, i: int) -> str:
    return (parent.text if i == 0 else parent[i - 1].tail) or ""


def _set_before(parent: ET.Element, i: int, text: str) -> None:
    if i == 0:
        parent.text = text
    else:
        parent[i - 1].tail = text


def _fix_children(parent: ET.Element) -> None:
    for e in list(parent):
        kind = e.get("pub-id-type")
        if e.tag != "pub-id" or kind is None:
            continue
        if kind.lower() in KNOWN_TYPES:
            kind = kind.lower()
            e.set("pub-id-type", kind)
        if kind == "pii" and not re.search(ID_PATTERNS["pii"], e.text or "") and (m := re.search(ident.PII_OTHER, e.text or "")):
            e.set("pub-id-type", kind := "other")
        if kind not in ID_PATTERNS or len(e):
            continue
        i, text = list(parent).index(e), e.text or ""
        pattern = r"\b(\d{1,10})\b" if kind == "pmid" else ID_PATTERNS[kind]
        m = re.search(pattern, text)
        if not m:
            _set_before(parent, i, _text_before(parent, i) + text + (e.tail or ""))
            parent.remove(e)
            continue
        _set_before(parent, i, _text_before(parent, i) + text[: m.start(1)])
        e.text, e.tail = m[1], text[m.end(1) :] + (e.tail or "")
        url = re.search(ident.DOI_URL_PREFIX + "$", _text_before(parent, i))
        if kind == "doi" and url:
            _set_before(parent, i, _text_before(parent, i)[: url.start()])
            e.tag, e.text = "ext-link", url[0] + e.text
            e.attrib.clear()
            e.set("ext-link-type", "uri")
            e.set("{http://www.w3.org/1999/xlink}href", re.sub(r"\s", "", e.text))


HREF = "{http://www.w3.org/1999/xlink}href"


def _fix_links(parent: ET.Element) -> None:
    """Addresses joined in one ext-link, whose href is its text or joins them by `w`, become a link each."""
    for e in list(parent):
        if e.tag != "ext-link" or not e.text or len(e):
            continue
        starts = [m.start() for m in re.finditer("https?://", e.text)]
        cuts = sorted({0, *starts, len(e.text)})
        parts = [e.text[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(parts) < 2 or e.get(HREF) not in (e.text, "w".join(parts)):
            continue
        at, tail = list(parent).index(e), e.tail
        e.text, e.tail = parts[0], None
        e.set(HREF, parts[0])
        for k, part in enumerate(parts[1:]):
            new = ET.Element("ext-link", {"ext-link-type": "uri", HREF: part})
            new.text = part
            parent.insert(at + 1 + k, new)
        parent[at + len(parts) - 1].tail = tail


def _fix_title(title: ET.Element) -> None:
    """What follows a title (a PMC id, a comma) and quotes around it leave its element, where the title is plain text."""
    text = title.text or ""
    if len(title) or not text:
        return
    start, end = 0, re.match(f"(?s){ident.ARTICLE_TITLE}", text).end(1)
    for a, b in ident.QUOTES:
        if end - start > 1 and text[start] == a and text[end - 1] == b:
            start, end = start + 1, end - 1
    if (start, end) == (0, len(text)) or start >= end:
        return
    title.text, title.tail = text[start:end], text[end:] + (title.tail or "")
    if start:
        title.set("__before", text[:start])


def _annotate(root: ET.Element, kind: str, pattern: str) -> None:
    """The first place of an identifier in plain text outside identifiers and links gets an element."""
    for parent in root.iter():
        if parent.tag in ("pub-id", "ext-link"):
            continue
        for i in range(len(parent) + 1):
            text = _text_before(parent, i)
            if m := re.search(pattern, text):
                e = ET.Element("pub-id", {"pub-id-type": kind})
                e.text, e.tail = m[1], text[m.end(1) :]
                _set_before(parent, i, text[: m.start(1)])
                parent.insert(i, e)
                return
