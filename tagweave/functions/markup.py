"""XML: repair of broken markup, nodes with ranges, lines of tagged tokens, and serialisation. No Spark here."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from html.parser import HTMLParser
from xml.sax.saxutils import escape, quoteattr


def parse(source: str) -> tuple[ET.Element | None, str | None, str | None]:
    """The root, or None with the line that fails and why; white space before the declaration doesn't matter."""
    try:
        return ET.fromstring(source.lstrip().encode()), None, None
    except ET.ParseError as e:
        lines = source.lstrip().split("\n")
        row = e.position[0] - 1
        return None, lines[row] if row < len(lines) else "", str(e)


class _Repair(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.open: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.out.append(f"<{tag}{''.join(f' {k}={quoteattr(v or "")}' for k, v in attrs)}>")
        self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.close_last()

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.close_last() != tag:
                pass
        elif self.open:
            self.close_last()

    def handle_data(self, data):
        self.out.append(escape(data))

    def close_last(self) -> str:
        tag = self.open.pop()
        self.out.append(f"</{tag}>")
        return tag


def repair(source: str | None) -> str | None:
    """Valid markup as it is; else every element closed: an end tag that nothing opened closes the innermost element, one that was opened closes all inside it."""
    if source is None or parse(source)[0] is not None:
        return source
    p = _Repair()
    p.feed(source)
    p.close()
    while p.open:
        p.close_last()
    return "".join(p.out)


def fix_entities(source: str) -> str:
    return source.lstrip().replace("&dagger;", "&#x2020;")


def drop_dangling(source: str, tag: str = "content") -> str:
    """Without end tags of an element that never begins."""
    return source if re.search(rf"<{tag}[\s>]", source) else source.replace(f"</{tag}>", "")


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def nodes(root: ET.Element) -> list[dict]:
    """Elements in document order: pre, size (elements below), parent_pre, level, tag, attrs, text, tail and all text inside."""
    out: list[dict] = []
    stack = [(root, -1, 0)]
    while stack:
        e, parent, level = stack.pop()
        pre = len(out)
        out.append({"pre": pre, "size": sum(1 for _ in e.iter()) - 1, "parent_pre": parent, "level": level, "tag": local(e.tag), "attrs": {local(k): v for k, v in e.attrib.items()}, "text": e.text or "", "tail": e.tail or "", "content": "".join(e.itertext())})
        stack += [(c, pre, level + 1) for c in reversed(list(e))]
    return out


def tokenize(text: str) -> list[str]:
    """Words, and single characters between them; a lower-case letter before an upper-case one ends a word."""
    out: list[str] = []
    for piece in re.split(r"(\W)", text):
        start = 0
        for i in range(1, len(piece)):
            if piece[i - 1].islower() and piece[i].isupper():
                out.append(piece[start:i])
                start = i
        if piece[start:]:
            out.append(piece[start:])
    return out


def lines(root: ET.Element, container: str | None = None) -> list[list[tuple[str, str]]]:
    """Lines, ended by <lb/>, of (token, tag): the tag is the path below the container of the element that holds the token, with b- at its first token and i- after."""
    top = root if container is None else next((e for e in root.iter() if local(e.tag) == container), root)
    out: list[list[tuple[str, str]]] = [[]]
    begun: set[int] = set()

    def put(text: str | None, path: str, key: int) -> None:
        for t in tokenize(text or ""):
            if not path:
                out[-1].append((t, ""))
            elif t.isspace() and key not in begun:
                out[-1].append((t, ""))
            else:
                out[-1].append((t, ("i-" if key in begun else "b-") + path))
                begun.add(key)

    todo: list[tuple] = [("in", top, "")]
    while todo:
        kind, e, path = todo.pop()
        if kind == "tail":
            put(e.tail, path[0], path[1])
            continue
        if local(e.tag) == "lb":
            out.append([])
            continue
        put(e.text, path, id(e))
        for c in reversed(list(e)):
            todo.append(("tail", c, (path, id(e))))
            todo.append(("in", c, f"{path}/{local(c.tag)}".lstrip("/")))
    return out if len(out) > 1 or out[0] else []


def _element(step: str) -> tuple[str, str]:
    """Start and end tag of a step such as note[@type="page"]."""
    m = re.fullmatch(r"([\w:.-]+)(?:\[@([\w:.-]+)=[\"']([^\"']*)[\"']\])?", step)
    if not m:
        raise ValueError(f"not a step: {step}")
    name, key, value = m.groups()
    return f"<{name}{f' {key}={quoteattr(value)}' if key else ''}>", f"</{name}>"


def split_path(path: str) -> list[str]:
    """Steps of a path; slashes within braces or brackets don't part them."""
    return [x for x in re.findall(r"(?:\{[^}]*\}|\[[^\]]*\]|[^/])+", path) if x]


def serialise(token_lines: list[list[tuple[str, str]]], paths: dict[str, str], root: str = "tei/text") -> str:
    """Markup whose lines() are these tokens: each tag's path is opened at b- or where it changes, spaces go to the common path, and <lb/> ends a line."""
    base, out, at = split_path(root), [], []

    def go(to: list[str], fresh: bool = False) -> None:
        same = next((i for i, (x, y) in enumerate(zip(at, to)) if x != y), min(len(at), len(to)))
        if fresh and same == len(to) > len(base):
            same -= 1
        while len(at) > same:
            out.append(_element(at.pop())[1])
        for step in to[same:]:
            out.append(_element(step)[0])
            at.append(step)

    flat = [(t, tag) for i, line in enumerate(token_lines) for t, tag in [*line, *([("\n", None)] if i < len(token_lines) - 1 else [])]]
    go(base)
    for n, (token, tag) in enumerate(flat):
        name = re.sub("^[bi]-", "", tag or "")
        if tag is None or (token.isspace() and not name):
            nxt = next((g for _, g in flat[n + 1 :] if g), "")
            to = base + split_path(paths.get(nxt[2:], nxt[2:])) if nxt.startswith("i-") else base
            if at != to:
                go([x for x, y in zip(at, to) if x == y] if at[: len(base)] == base else base)
            out.append("<lb/>" if tag is None else escape(token))
            continue
        go(base + split_path(paths.get(name, name)) if name else base, fresh=(tag or "").startswith("b-"))
        out.append(escape(token))
    while at:
        out.append(_element(at.pop())[1])
    return "".join(out)
