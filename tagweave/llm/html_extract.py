"""HTML extraction by a recurrent block labeller.

A page becomes its sequence of leaf blocks (runs of text between block-level
tags, with the path of open elements).  A bidirectional LSTM in numpy reads, for
each block, a hashed vector of the tag path (tags, classes, ids and their
parts), a hashed vector of its words and a few counts, and labels every block
with the whole page as context; the main text is the blocks labelled so.

The labeller is trained, once in a driver's life, on generated pages (TRAIN_PAGES of them, from a
fixed seed) whose blocks are labelled by construction: articles under many
containers, with menus, headers, footers, sidebars, notices, adverts, forms and
reader comments around and within them.  No page of the input is learnt from.

Scripts, styles and other elements that hold no text for readers never become
blocks.  Cases: null and empty html, and pages without a main block, give an empty
text; unclosed and stray tags, text without tags and cut character references are
read as browsers do; repeated rows each give their row; an empty table gives an
empty result.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Generator, Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagweave.llm.common import slices
from tagweave.session import ship

TRAIN_PAGES = 1_200
PATH_DIMS, WORD_DIMS, HIDDEN = 320, 24, 20

#: Fixed values of HTML: elements without content, elements whose content isn't text for readers, and elements that don't end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg math iframe object canvas select textarea button head audio video".split())
RAW = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table td th div section article body html blockquote".split())

HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_TAG = re.compile(_NAME.pattern[:-1] + r"+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_HIDES = re.compile(r"display\s*:\s*none", re.I)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[a-z]+|[0-9]+")


def _marks(html: str) -> Generator[tuple[int, int, str, str, str], int | None, None]:
    """start, end, "/" of an end tag, name and attributes of each tag, in order; comments and declarations have no name.

    The next one is looked for from the end that was last sent, if one was.
    Every part of a page is read a fixed number of times: a tag that quotes keep
    open to the end of the page ends at the next ">", and so do all after it.
    """
    at, last, quotes = 0, html.rfind(">"), True
    while (start := html.find("<", at)) >= 0:
        if html.startswith(("!", "?"), start + 1):
            comment = html.startswith("<!--", start)
            end = html.find("-->", start + 4) if comment else html.find(">", start)
            at = len(html) if end < 0 else end + (3 if comment else 1)
            at = (yield start, at, "", "", "") or at
            continue
        if start > last:
            return
        if quotes and (m := _TAG.match(html, start)):
            at = m.end()
            at = (yield start, at, m[1], m[2].lower(), m[3]) or at
        elif name := _NAME.match(html, start):
            quotes = False
            at = html.find(">", name.end()) + 1
            at = (yield start, at, name[1], name[2].lower(), html[name.end() : at - 1]) or at
        else:
            at = start + 1


class Block:
    __slots__ = ("path", "text", "linked", "names")

    def __init__(self, path: tuple[str, ...], names: tuple[str, ...], text: str, linked: int) -> None:
        self.path, self.names, self.text, self.linked = path, names, text, linked


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    tags: list[str] = []
    names: list[str] = []
    parts: list[str] = []
    linked = 0
    hides: list[bool] = []  # whether each open element hides its content
    skip = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split()) if parts else ""
        if text:
            out.append(Block(tuple(t for t in tags if t not in INLINE), tuple(n for n in names if n), text, linked))
        parts.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal skip
        skip -= sum(hides[depth:])
        del tags[depth:], names[depth:], hides[depth:]

    at, n = 0, len(html)
    marks = _marks(html)
    resume = None
    while at < n:
        try:
            start, end, slash, tag, attributes = marks.send(resume)
        except StopIteration:
            start, end, slash, tag, attributes = n, n, "", "", ""
        resume = None
        piece = html[at:start]
        if piece and tags and tags[-1] == "head" and not piece.isspace():
            close(len(tags) - 1)  # text stands in the body
        if piece and not skip:
            parts.append(piece)
            if "a" in tags:
                linked += len(piece)
        at = end
        if not tag:
            continue
        if slash:
            if tag in tags:
                depth = len(tags) - 1 - tags[::-1].index(tag)
                if tag in INLINE:
                    if not any(t in SCOPE or t == "p" for t in tags[depth:]):
                        close(depth)
                else:
                    flush()
                    close(depth)
            elif tag not in INLINE:
                flush()
            continue
        if tags and tags[-1] == "head" and tag not in HEAD:
            close(len(tags) - 1)
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P and "p" in tags:
                close(len(tags) - 1 - tags[::-1].index("p"))
            if tag in CLOSES_SAME:
                for depth in range(len(tags) - 1, -1, -1):
                    if tags[depth] in CLOSES_SAME[tag]:
                        close(depth)
                        break
                    if tags[depth] in SCOPE:
                        break
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in SKIPPED and tag in INLINE:
            continue
        found = [(k.lower(), (a or b or c or "").lower()) for k, a, b, c in _ATTR.findall(attributes)] if attributes and not attributes.isspace() else []
        tags.append(tag)
        names.append(" ".join(f"{k}={v}" for k, v in found))
        hides.append(tag in SKIPPED or any(k == "hidden" or k == "style" and _HIDES.search(v) for k, v in found))
        skip += hides[-1]
        if tag in RAW:
            raw = re.compile(rf"</{re.escape(tag)}\b", re.I).search(html, at)
            close_at = html.find(">", raw.end()) + 1 if raw else 0
            if not skip and raw:
                parts.append(html[at : raw.start()])
            at = close_at or n
            if raw:
                flush()
                close(len(tags) - 1)
            resume = at
    flush()
    return out


@lru_cache(1 << 16)
def _slot(word: str, dims: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return h % dims, 1.0 if h & 0x10000 else -1.0


@lru_cache(1 << 14)
def _path_vector(path: tuple[str, ...], names: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATH_DIMS, np.float32)
    found = {f"t:{t}" for t in path if t not in ("html", "body")}
    found |= {f"l:{path[-1]}"} if path else set()
    for name in names:
        found |= {f"n:{p}" for p in _PARTS.findall(name) if p not in ("class", "id", "role", "style")}
    for f in found:
        at, sign = _slot(f, PATH_DIMS)
        v[at] += sign
    return v


COUNTS = 8
_DIGIT = re.compile("[0-9]")


def features(page: list[Block]) -> np.ndarray:
    x = np.zeros((len(page), PATH_DIMS + WORD_DIMS + COUNTS), np.float32)
    counts = []
    for i, b in enumerate(page):
        x[i, :PATH_DIMS] = _path_vector(b.path, b.names)
        text = b.text
        words = text.lower().split()
        if words:
            at, sign = zip(*(_slot(w, WORD_DIMS) for w in words))
            x[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = 0.5 * np.bincount(at, weights=sign, minlength=WORD_DIMS) / np.sqrt(len(words))
        size = len(text)
        counts.append((np.log1p(size) / 5, min(1.0, b.linked / size), len(b.path) / 10, text[-1] in ".!?…", sum(map(text.count, ".,;:!?")) / size, len(_DIGIT.findall(text)) / size, i / len(page), 1.0))
    if page:
        x[:, PATH_DIMS + WORD_DIMS :] = counts
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one from each end, and a logistic layer over both states and the input."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        d, h = PATH_DIMS + WORD_DIMS + COUNTS, HIDDEN
        self.p = {f"{k}{s}": (rng.normal(size=shape) * scale).astype(np.float32) for s in "fb" for k, shape, scale in (("w", (d, 4 * h), d**-0.5), ("u", (h, 4 * h), h**-0.5), ("c", (4 * h,), 0.0))}
        for s in "fb":
            self.p[f"c{s}"][h : 2 * h] = 1.0
        self.p["o"] = (rng.normal(size=2 * h) * 0.1).astype(np.float32)
        self.p["r"] = np.zeros(d, np.float32)
        self.p["e"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """x: steps, pages, dims, in this side's order; padding keeps the state."""
        steps, n, _ = x.shape
        h = np.zeros((n, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out, kept = np.zeros((steps, n, HIDDEN), np.float32), []
        given = x @ self.p[f"w{side}"] + self.p[f"c{side}"]
        for t in range(steps):
            z = given[t] + h @ self.p[f"u{side}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            kept.append((h, c, i, f, o, g, tc))
            h, c = np.where(m, o * tc, h), np.where(m, c2, c)
            out[t] = h
        return out, kept

    def logits(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        a, ka = self._run(x, mask, "f")
        b, kb = self._run(x[::-1], mask[::-1], "b")
        both = np.concatenate([a, b[::-1]], 2)
        return both @ self.p["o"] + x @ self.p["r"] + self.p["e"], (both, ka, kb)

    def _back(self, dout: np.ndarray, x: np.ndarray, mask: np.ndarray, kept: list, side: str, g: dict) -> None:
        steps, n, _ = x.shape
        dh = np.zeros((n, HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        dz_all = np.zeros((steps, n, 4 * HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, gg, tc = kept[t]
            m = mask[t][:, None]
            dh = dh + dout[t]
            dht, dct = dh * m, dc * m
            d2 = dct + dht * o * (1 - tc * tc)
            dz = np.concatenate([d2 * gg * i * (1 - i), d2 * c * f * (1 - f), dht * tc * o * (1 - o), d2 * i * (1 - gg * gg)], 1)
            dz_all[t] = dz
            g[f"u{side}"] += h.T @ dz
            dh = dh * ~m + dz @ self.p[f"u{side}"].T
            dc = dc * ~m + d2 * f
        g[f"w{side}"] += np.tensordot(x, dz_all, ([0, 1], [0, 1]))
        g[f"c{side}"] += dz_all.sum((0, 1))

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 6, batch: int = 24, rate: float = 6e-3) -> Labeller:
        rng = np.random.default_rng(1)
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in (0, 1))
        step = 0
        for epoch in range(epochs):
            # pages of like length together: less padding
            order = np.argsort([len(y) + rng.random() * 4 for _, y in pages])
            for some in rng.permutation(len(pages) // batch):
                rows = [pages[i] for i in order[some * batch : (some + 1) * batch]]
                x, mask = padded([r[0] for r in rows])
                y = np.zeros(mask.shape, np.float32)
                for j, (_, t) in enumerate(rows):
                    y[: len(t), j] = t
                z, (both, ka, kb) = self.logits(x, mask)
                d = (_sigmoid(z) - y) * mask / mask.sum()
                g = {k: np.zeros_like(v) for k, v in self.p.items()}
                g["o"], g["r"], g["e"] = np.tensordot(d, both, ([0, 1], [0, 1])), np.tensordot(d, x, ([0, 1], [0, 1])), d.sum(keepdims=True)[0]
                dboth = d[:, :, None] * self.p["o"]
                self._back(dboth[:, :, :HIDDEN], x, mask, ka, "f", g)
                self._back(dboth[::-1, :, HIDDEN:], x[::-1], mask[::-1], kb, "b", g)
                step += 1
                norm = max(1.0, float(np.sqrt(sum((v * v).sum() for v in g.values()))))
                now = rate * (1 - epoch / (epochs + 1))
                for k, v in self.p.items():
                    gk = g[k] / norm
                    m1[k] = 0.9 * m1[k] + 0.1 * gk
                    m2[k] = 0.99 * m2[k] + 0.01 * gk * gk
                    v -= (now * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            # at most 64 pages and, unless one page is longer, 4,096 blocks with padding
            n = 1
            while at + n < len(order) and n < 64 and (n + 1) * len(pages[order[at + n]]) <= 4096:
                n += 1
            some = order[at : at + n]
            x, mask = padded([pages[i] for i in some])
            z, _ = self.logits(x, mask)
            for j, i in enumerate(some):
                out[i] = z[: len(pages[i]), j] > 0
            at += n
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for j, p in enumerate(pages):
        x[: len(p), j] = p
        mask[: len(p), j] = True
    return x, mask


#: Names that sites give to parts of a page, for generated training pages.
NAMES = {
    "main": "content main-content article article-body post post-content entry entry-content story story-body page-content text body-text single hentry".split(),
    "menu": "nav navbar menu main-menu navigation breadcrumb breadcrumbs topnav links pagination tabs toc".split(),
    "header": "header site-header masthead top topbar banner branding logo".split(),
    "footer": "footer site-footer bottom copyright legal colophon foot".split(),
    "aside": "sidebar side aside widget related recommended rail popular more-news secondary".split(),
    "notice": "notice cookie cookie-banner cookies gdpr consent alert message newsletter popup modal overlay announcement warning disclaimer".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad ad-slot adsense".split(),
    "form": "form search searchform login signup subscribe contact-form".split(),
    "comments": "comments comment comment-list discussion responses replies disqus comment-body respond reviews".split(),
    "share": "share social sharing share-buttons tools meta byline author-box tags".split(),
}
PHRASES = "home about contact login sign up subscribe read more share follow us privacy policy terms cookies we use accept all rights reserved advertisement sponsored related posts leave a reply search menu skip to content newsletter".split()


def generated(rng: random.Random) -> tuple[str, list[bool]]:
    """A page and, for each of its blocks, whether it is main text."""
    labels: list[bool] = []
    letters = "etaoinshrdlucmfwypvbgkéèäöüñßç"
    words = ["".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(60)]
    pick = lambda kind: rng.choice(NAMES[kind])
    chance = lambda p: rng.random() < p

    def text(main: bool, least: int, most: int, stock: float = 0.0) -> str:
        labels.append(main)
        n = rng.randint(least, most)
        out = [rng.choice(PHRASES) if chance(stock) else rng.choice(words) for _ in range(n)]
        for i in range(0, n, rng.randrange(6, 14)):
            out[i] = out[i].capitalize()
            if i and chance(0.8):
                out[i - 1] += "."
        if chance(0.15):
            out = [w + "%%%" for w in out]
        return " ".join(out) + ("." if chance(0.7) and n > 4 else "")

    def attr(kind: str) -> str:
        return f' {rng.choice(["class", "class", "id"])}="{pick(kind)}{" " + rng.choice(words) if chance(0.2) else ""}"'

    def para(main: bool, least: int = 6, most: int = 60, stock: float = 0.0) -> str:
        body = text(main, least, most, stock)
        if chance(0.25):
            cut = body.split(" ")
            k = rng.randrange(0, len(cut))
            tag = rng.choice(["b", "i", "em", "strong", "span"])
            cut[k] = f"<{tag}>{cut[k]}</{tag}>" if chance(0.8) else f'<a href="/x">{cut[k]}</a>'
            body = " ".join(cut)
        shape = rng.random()
        return f"<p><b>{body}<br>" if shape < 0.12 else f"<p>{body}" if shape < 0.2 else f"<p>{body}</p>"

    def linked(kind: str, tag: str) -> str:
        rows = "".join(f'<li><a href="/{k}">{text(False, 1, 3, 0.4)}</a></li>' for k in range(rng.randrange(2, 8)))
        return f"<{tag}{attr(kind) if tag == 'div' or chance(0.4) else ''}><ul>{rows}</ul></{tag}>"

    def boiler(kind: str) -> str:
        if kind == "menu":
            return linked("menu", "nav" if chance(0.6) else "div")
        if kind == "share":
            return f"<div{attr('share')}>" + "".join(f'<a href="#">{w}</a> ' for w in [text(False, 1, 3, 0.6)]) + "</div>"
        tag = {"header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        named = tag is None or chance(0.45)
        tag = (tag if tag and chance(0.6 if named else 1) else "div") if kind != "comments" else rng.choice(["div", "section", "ul"])
        named = named or tag in ("div", "section", "ul")
        inner = ""
        for _ in range(rng.randrange(1, 4 if kind not in ("comments", "aside") else 7)):
            shape = rng.random()
            if kind == "form":
                inner += f"<label>{text(False, 1, 4, 0.6)}</label><input name=q>" + ("<button>Go</button>" if chance(0.5) else "") + ("<br>" if chance(0.2) else "<p></p>")
            elif tag == "ul":
                inner += f"<li>{text(False, 3, 40)}</li>"
            elif shape < 0.5:
                inner += para(False, 2, 40, 0.25)
            elif shape < 0.6:
                inner += f"<h3>{text(False, 1, 6, 0.3)}</h3>"
            elif shape < 0.8:
                inner += f"<div>{text(False, 2, 30, 0.25)}</div>"
            else:
                return f"<{tag}{attr(kind) if named else ''}>{inner}{'' if inner == '' else '<p></p>'}{text(False, 2, 25, 0.3)}</{tag}>"
        return f"<{tag}{attr(kind) if named else ''}>{inner}</{tag}>"

    def article() -> str:
        inner = f"<h1>{text(True, 2, 12)}</h1>" if chance(0.85) else ""
        if chance(0.15):
            inner += boiler("share")
        for _ in range(rng.randrange(1, 14)):
            shape = rng.random()
            if shape < 0.78:
                inner += para(True, 1 if chance(0.2) else 6, 80)
            elif shape < 0.84:
                inner += f"<h2>{text(True, 1, 8)}</h2>"
            elif shape < 0.89:
                inner += "<ul>" + "".join(f"<li>{text(True, 2, 20)}</li>" for _ in range(rng.randrange(1, 6))) + "</ul>"
            elif shape < 0.92:
                inner += f"<blockquote>{text(True, 5, 40)}</blockquote>"
            elif shape < 0.94:
                inner += f"<pre>{text(True, 3, 30)}</pre>"
            elif shape < 0.96:
                inner += "<table><tr>" + "".join(f"<td>{text(True, 1, 5)}</td>" for _ in range(rng.randrange(1, 5))) + "</tr></table>"
            else:
                inner += boiler(rng.choice(["ad", "ad", "notice", "share", "form", "aside"]))
        if chance(0.08):
            inner += boiler("comments")
        shape = rng.random()
        if shape < 0.4:
            return f"<article{attr('main') if chance(0.3) else ''}>{inner}</article>"
        if shape < 0.55:
            return f"<main{attr('main') if chance(0.3) else ''}>{inner}</main>"
        if shape < 0.7:
            return f"<main><article>{inner}</article></main>"
        if shape < 0.93:
            return f"<div{attr('main')}>{inner}</div>"
        return inner

    before = [boiler(str(k)) for k in rng.choices(["menu", "header", "notice", "ad", "form", "menu", "aside"], k=rng.randrange(0, 5))]
    # text() has labelled in the order of the calls, which is the order on the page
    middle = article()
    after = [boiler(str(k)) for k in rng.choices(["aside", "comments", "footer", "ad", "notice", "form", "share", "menu"], k=rng.randrange(0, 5))]
    if chance(0.7):
        after.append(boiler("footer"))
    body = "".join([*before, middle, *after])
    if chance(0.2):
        body = f'<div id="{rng.choice(["page", "wrapper", "container", "app", "root"])}">{body}</div>'
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}</body></html>", labels


@lru_cache(1)
def labeller() -> Labeller:
    """The trained labeller."""
    rng = random.Random(2024)
    pages = []
    while len(pages) < TRAIN_PAGES:
        html, labels = generated(rng)
        page = blocks(html)
        if page and len(page) == len(labels):
            pages.append((features(page), np.array(labels, np.float32)))
    return Labeller().train(pages)


def main_texts(htmls: list[str | None], model: Labeller) -> list[str]:
    pages = [blocks(h or "") for h in htmls]
    keep = model.label([features(p) for p in pages])
    return ["\n".join(b.text for b, k in zip(p, ks) if k) for p, ks in zip(pages, keep)]


def extract(pages: DataFrame, html: str = "html", to: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """pages without the column html and with the main text and its length, in place of any columns of those names (in any case)."""
    model = labeller()
    where = [c for c in pages.columns if c.lower() not in (html.lower(), *to)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html, 1 << 20):
            texts = main_texts(batch.column(html).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in where], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*where, *to])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*where).schema)
    ship(pages.sparkSession)
    return pages.select(*where, html).mapInArrow(run, f"{schema}, `{to[0]}` string, `{to[1]}` long")


def op8(pages: DataFrame) -> DataFrame:
    """The contract's columns."""
    return extract(pages.select("page_id", "url", "html"))
