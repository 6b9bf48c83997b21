"""Fuzzy text search: local alignment in windows, a word matcher for short texts, scores less junk. No Spark here."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from itertools import accumulate

import numpy as np

Block = tuple[int, int, int]

MATCH, MISMATCH, GAP = 2, -1, -2
THRESHOLD, SHORT, WINDOW = 0.8, 5, 1000
#: Cells of an alignment matrix (4 bytes each); larger pairs are matched by words, in linear memory.
CELLS = 40_000_000
SPACES = " \t\n"


def is_junk(s: str, i: int) -> bool:
    """Stars and spaces, a comma after a dot, and a dot after a letter (spaces between don't count)."""
    c = s[i]
    if c in " *":
        return True
    if c not in ",.":
        return False
    before = s[:i].rstrip(" ")[-1:]
    return before == "." if c == "," else before.isalpha()


def junk_outside(s: str, ranges: list[tuple[int, int]], start: int, end: int) -> int:
    """Junk characters of s[start:end] outside the sorted ranges."""
    stops = [start, *(e for _, e in ranges)]
    return sum(is_junk(s, i) for at, to in zip(stops, [*(b for b, _ in ranges), end]) for i in range(at, to))


def needle_ratio(blocks: list[Block], haystack: str, needle: str) -> float:
    """Matched characters against the needle's, gaps in the haystack added and unmatched junk left out; spaces of neither count."""
    if not blocks:
        return 0.0
    solid = lambda s: sum(c not in SPACES for c in s)
    a, b = [(x, x + n) for x, _, n in blocks], [(y, y + n) for _, y, n in blocks]
    matched = sum(solid(haystack[s:e]) for s, e in a)
    start, end = a[0][0], a[-1][1]
    strip = lambda s, r, lo, hi: junk_outside(s, r, lo, hi) - sum(s[i] == " " for p, q in zip([lo, *(e for _, e in r)], [*(s_ for s_, _ in r), hi]) for i in range(p, q))
    whole = solid(needle) + max(0, solid(haystack[start:end]) - matched) - strip(haystack, a, start, end) - strip(needle, b, 0, len(needle))
    return matched / whole if whole > 0 else 0.0


def local_alignment(a: str, b: str) -> list[Block]:
    """Runs of equal characters on the best local alignment that ends first in a."""
    if not a or not b:
        return []
    x, y = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (a, b))
    ramp = -GAP * np.arange(len(x) + 1, dtype=np.int32)
    h = np.zeros((len(y) + 1, len(x) + 1), np.int32)
    for i in range(1, len(y) + 1):
        row = h[i]
        row[1:] = np.maximum(h[i - 1, :-1] + np.where(x == y[i - 1], MATCH, MISMATCH), h[i - 1, 1:] + GAP)
        np.maximum(row, 0, out=row)
        np.maximum(row, np.maximum.accumulate(row + ramp) - ramp, out=row)
    j = int(h.max(0).argmax())
    i = int(h[:, j].argmax())
    equal: list[tuple[int, int]] = []
    while h[i, j] > 0:
        same = x[j - 1] == y[i - 1]
        if h[i, j] == h[i - 1, j - 1] + (MATCH if same else MISMATCH):
            i, j = i - 1, j - 1
            if same:
                equal.append((j, i))
        elif h[i, j] == h[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return _joined((j, i, 1) for j, i in reversed(equal))


def _joined(blocks) -> list[Block]:
    out: list[Block] = []
    for x, y, n in blocks:
        if out and out[-1][0] + out[-1][2] == x and out[-1][1] + out[-1][2] == y:
            out[-1] = (*out[-1][:2], out[-1][2] + n)
        elif n:
            out.append((x, y, n))
    return out


def split_with_offset(s: str, separators: str = " \t\n.,:;()[]-") -> list[tuple[str, int]]:
    """Pieces between separators, and the separators, each with its place."""
    out: list[tuple[str, int]] = []
    start = 0
    for i, c in enumerate([*s, separators[0]]):
        if c in separators:
            if i > start:
                out.append((s[start:i], start))
            if i < len(s):
                out.append((c, i))
            start = i + 1
    return out


def word_blocks(a: str, b: str) -> list[Block]:
    """Equal runs of pieces by the longest-run rule, in characters."""
    pa, pb = split_with_offset(a), split_with_offset(b)
    found = SequenceMatcher(None, [w for w, _ in pa], [w for w, _ in pb], autojunk=False).get_matching_blocks()
    return [(pa[m.a][1], pb[m.b][1], sum(len(w) for w, _ in pa[m.a : m.a + m.size])) for m in found if m.size]


def window_size(n_haystack: int, n_needle: int, threshold: float = THRESHOLD, least: int = WINDOW) -> tuple[int, int]:
    """Length and stride of the windows; one window for a short haystack."""
    if n_haystack <= least:
        return n_haystack, n_haystack
    reach = n_needle + round(min(n_haystack, n_needle) * (1 - threshold))
    length = max(least, 4 * reach)
    return length, length - reach


def strided(haystack: str, needle: str, length: int, stride: int, threshold: float, chunks: int = 1, ratio: Callable = needle_ratio) -> list[list[Block]]:
    """Blocks of the needle, in up to `chunks` parts, in the first window that reaches the threshold."""
    for at in range(0, max(len(haystack), 1), max(stride, 1)):
        window = haystack[at : at + length]
        if len(window) * len(needle) <= CELLS:
            exact = window.find(needle) if needle else -1
            blocks = [(exact, 0, len(needle))] if exact >= 0 else local_alignment(window, needle)
        else:
            blocks = word_blocks(window, needle)
        if not blocks or blocks[0][0] >= stride:
            continue
        moved = [(x + at, y, n) for x, y, n in blocks]
        if ratio(moved, haystack, needle) >= threshold:
            return [moved]
        if chunks < 2:
            continue
        for keep in range(len(moved), 0, -1):
            part, stop = moved[:keep], moved[keep - 1][1] + moved[keep - 1][2]
            if stop < len(needle) and ratio(part, haystack, needle[:stop]) >= threshold:
                base = part[-1][0] + part[-1][2]
                rest = strided(haystack[base:], needle[stop:], length, stride, threshold, chunks - 1, ratio)
                if rest:
                    return [part, *([(x + base, y + stop, n) for x, y, n in c] for c in rest)]
        for drop in range(len(moved)):
            part, start = moved[drop:], moved[drop][1]
            tail = [(x, y - start, n) for x, y, n in part]
            if start and ratio(tail, haystack, needle[start:]) >= threshold:
                rest = strided(haystack[: part[0][0]], needle[:start], length, stride, threshold, chunks - 1, ratio)
                if rest:
                    return [*rest, part]
    return []


def search(haystack: str, needle: str, threshold: float = THRESHOLD, short: int = SHORT, chunks: int = 1, start: int = 0) -> list[list[Block]]:
    """Blocks of the needle in the haystack from `start`; texts under `short` characters by words, others without regard to spaces."""
    hay = haystack[start:]
    if min(len(hay), len(needle)) < short:
        blocks = word_blocks(hay, needle)
        found = [blocks] if blocks and needle_ratio(blocks, hay, needle) >= threshold else []
    else:
        ia, ib = ([i for i, c in enumerate(s) if c not in SPACES] for s in (hay, needle))
        if not ia or not ib:
            return []
        a, b = "".join(hay[i] for i in ia), "".join(needle[i] for i in ib)
        length, stride = window_size(len(a), len(b), threshold)

        def whole(blocks: list[Block], _: str, part: str) -> float:
            lo = b.find(part) if part != b else 0
            lo = 0 if lo < 0 else lo
            return needle_ratio([(ia[x], ib[y + lo] - ib[lo], ia[x + n - 1] - ia[x] + 1) for x, y, n in blocks], hay, needle[ib[lo] : ib[lo + len(part) - 1] + 1])

        found = [[(ia[x], ib[y], ia[x + n - 1] - ia[x] + 1) for x, y, n in c] for c in strided(a, b, length, stride, threshold, chunks, whole)]
    return [[(x + start, y, n) for x, y, n in c] for c in found]


def find(haystack: str, needle: str, threshold: float = THRESHOLD, start: int = 0) -> tuple[int, int] | None:
    """Start and end of the needle in the haystack, or None."""
    found = search(haystack, needle, threshold, start=start)
    return (found[0][0][0], found[-1][-1][0] + found[-1][-1][2]) if found else None


def find_all(haystack: str, needle: str, threshold: float = THRESHOLD) -> Iterator[tuple[int, int]]:
    """Every place of the needle, each from the end of the one before."""
    at = 0
    while at < len(haystack) and (span := find(haystack, needle, threshold, at)) and span[1] > at:
        yield span
        at = span[1]


def select_ranges(ranges: list[tuple[int, int]], slack: int = 10) -> list[tuple[int, int]]:
    """The ranges of the longest cluster; neighbours belong together while their gap is at most the longer one's length and `slack`. Ties go to the first."""
    groups = [(s, e, [(s, e)]) for s, e in sorted(ranges)]
    while True:
        out: list[tuple[int, int, list[tuple[int, int]]]] = []
        for s, e, members in groups:
            if out and s - out[-1][1] <= max(out[-1][1] - out[-1][0], e - s) + slack:
                out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + members)
            else:
                out.append((s, e, members))
        if len(out) == len(groups):
            break
        groups = out
    return max(groups, key=lambda g: g[1] - g[0])[2] if groups else []


def join_with_ranges(items: list[str], between: list[str] | str = " ") -> tuple[str, list[tuple[int, int]]]:
    """The joined text and each item's range in it."""
    gaps = [between] * len(items) if isinstance(between, str) else list(between)
    ends = list(accumulate(len(x) + len(g) for x, g in zip(items, gaps)))
    starts = [0, *ends[:-1]]
    text = "".join(x + g for x, g in zip(items, gaps))
    return text[: len(text) - len(gaps[-1])] if items else "", [(s, s + len(x)) for s, x in zip(starts, items)]
