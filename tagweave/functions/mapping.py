"""Field mappings: sections of `field = path` and `field.option = value`, and the target values they select. No Spark here."""

from __future__ import annotations

import configparser
import json
import re
import xml.etree.ElementTree as ET

from tagweave.functions.markup import local

Mapping = dict[str, str]


def read(text: str) -> dict[str, Mapping]:
    p = configparser.ConfigParser(interpolation=None)
    p.optionxform = str
    p.read_string(text)
    return {s: dict(p[s]) for s in p.sections()}


def override(sections: dict[str, Mapping], more: Mapping) -> dict[str, Mapping]:
    """These keys added or replaced in every section."""
    return {s: {**m, **more} for s, m in sections.items()}


def keep_fields(m: Mapping, fields: list[str] | None, sub_fields: list[str] | None = None) -> Mapping:
    """Keys of these fields (all, if None), and of their sub fields only these."""
    named = set(fields if fields is not None else (k for k in m if "." not in k))
    out = {k: v for k, v in m.items() if k.split(".")[0] in named}
    return out if sub_fields is None else {k: v for k, v in out.items() if ".sub." not in k or k.split(".sub.", 1)[1] in sub_fields}


def parse_pairs(text: str) -> dict[str, str]:
    """a=b|c=d."""
    return dict((x.strip() for x in p.split("=", 1)) for p in text.split("|")) if text.strip() else {}


def list_algebra(spec: str, defaults: list[str]) -> list[str]:
    """a,b stands for itself; +a,b adds to the defaults and -c takes away, each sign until the next; what isn't there can't be taken away."""
    items = [x.strip() for x in spec.split(",") if x.strip()]
    if not items or items[0][0] not in "+-":
        return items
    out, sign = list(defaults), "+"
    for x in items:
        if x[0] in "+-":
            sign, x = x[0], x[1:].strip()
        if sign == "-":
            out.remove(x)
        elif x not in out:
            out.append(x)
    return out


def spellings(text: str) -> dict[str, list[str]]:
    """Lines key=a,b."""
    return {k.strip(): [x.strip() for x in v.split(",") if x.strip()] for k, _, v in (line.partition("=") for line in text.splitlines()) if k.strip()}


_STEP = re.compile(r"(\.//|\./|//|/)?(self::)?(\.|\*|@?[\w:.-]+)((?:\[(?:[^\[\]]|\[[^\]]*\])*\])*)")


class Tree:
    """A document with parents and order, for location paths relative to a node."""

    def __init__(self, root: ET.Element) -> None:
        self.root = root
        self.order = {id(e): i for i, e in enumerate(root.iter())}
        self.parent = {id(c): e for e in root.iter() for c in e}

    def find(self, path: str, at: ET.Element | None = None) -> list[ET.Element]:
        """Nodes in document order, each once; paths are joined by |."""
        found = {id(e): e for p in _outside(path, "|") for e in self._one(p.strip().strip("()").strip(), self.root if at is None else at)}
        return sorted(found.values(), key=lambda e: self.order[id(e)])

    def _one(self, path: str, at: ET.Element) -> list[ET.Element]:
        here, pos, first = [at], 0, True
        while pos < len(path):
            m = _STEP.match(path, pos)
            if not m or m.end() == pos:
                raise ValueError(f"path not supported: {path}")
            pos = m.end()
            axis, _, name, predicates = m.groups()
            if name != ".":
                if axis in ("//", ".//"):
                    some = [e for h in here for e in h.iter() if e is not h or (first and axis == "//")]
                elif axis == "/" and first:
                    some = [self.root]
                else:
                    some = [e for h in here for e in h]
                here = list({id(e): e for e in some if name == "*" or local(e.tag) == name.rsplit(":", 1)[-1]}.values())
            for p in re.findall(r"\[((?:[^\[\]]|\[[^\]]*\])*)\]", predicates):
                here = [e for e in here if self._holds(p, e)]
            first = False
        return here

    def _holds(self, text: str, e: ET.Element) -> bool:
        text = text.strip()
        for word, both in ((" or ", any), (" and ", all)):
            if len(parts := _outside(text, word)) > 1:
                return both(self._holds(p, e) for p in parts)
        if m := re.fullmatch(r"not\((.*)\)", text, re.S):
            return not self._holds(m[1], e)
        if m := re.fullmatch(r"self::([\w:.*-]+)", text):
            return m[1] == "*" or local(e.tag) == m[1]
        m = re.fullmatch(r"(?:(.*?)/?)@([\w:.-]+)\s*(?:=\s*(['\"])(.*)\3)?", text, re.S)
        if m:
            of = self._one(m[1], e) if m[1] else [e]
            values = [v for o in of for k, v in o.attrib.items() if local(k) == m[2].rsplit(":", 1)[-1]]
            return bool(values) if m[3] is None else m[4] in values
        return bool(self._one(text, e))


def _outside(text: str, sep: str) -> list[str]:
    """Parts between separators that stand outside brackets."""
    out, depth, last, i = [], 0, 0, 0
    while i < len(text):
        depth += (text[i] in "([") - (text[i] in ")]")
        if depth == 0 and text.startswith(sep, i):
            out.append(text[last:i])
            i = last = i + len(sep)
            continue
        i += 1
    return [*out, text[last:]]


def tidy(text: str) -> str:
    text = re.sub(" +", " ", text.replace("\t", " ")).replace("\r", "\n")
    return re.sub("\n+", "\n", re.sub(" *\n *", "\n", text))


def content(e: ET.Element, without: frozenset[int] = frozenset()) -> str:
    """Text inside, less these nodes; a blank between two words that only a node's border parts."""
    out: list[str] = []

    def add(t: str | None) -> None:
        if t:
            if out and out[-1][-1:].isalnum() and t[0].isalnum():
                out.append(" ")
            out.append(t)

    def walk(x: ET.Element) -> None:
        add(x.text)
        for c in x:
            if id(c) not in without:
                walk(c)
            add(c.tail)

    walk(e)
    return tidy("".join(out)).strip()


def _children(tree: Tree, e: ET.Element, m: Mapping, field: str) -> tuple[list[str], list[list[str]]]:
    """Values of a node's children, and values that stand for themselves."""
    used: set[int] = set()
    values: list[str] = []
    alone: list[list[str]] = []
    for item in json.loads(m.get(f"{field}.children.concat", "[]")):
        parts, nodes = [], []
        for p in item:
            if "value" in p:
                parts.append(p["value"])
                continue
            found = tree.find(p["xpath"], e)
            if not found:
                break
            nodes += found
            parts.append(" ".join(content(x) for x in found))
        else:
            values.append("".join(parts))
            used |= {id(x) for x in nodes}
    for item in json.loads(m.get(f"{field}.children.range", "[]")):
        a, b = (tree.find(item[k]["xpath"], e) for k in ("min", "max"))
        if a and b and content(a[0]).isdigit() and content(b[0]).isdigit():
            numbers = [str(n) for n in range(int(content(a[0])), int(content(b[0])) + 1)]
            used |= {id(a[0]), id(b[0])}
            if item.get("standalone"):
                alone += [[n] for n in numbers]
            else:
                values += numbers
    rest = [x for x in tree.find(m[f"{field}.children"], e) if id(x) not in used]
    parents = {id(tree.parent[id(x)]) for x in rest if id(x) in tree.parent}
    values += [content(x) for x in rest if id(x) not in parents]
    if m.get(f"{field}.unmatched-parent-text") == "true" and (own := tidy(" ".join(filter(None, map(str.strip, [e.text or "", *(c.tail or "" for c in e)]))))) and own not in values:
        values.append(own)
    return [v for v in values if v.strip()], alone


def extract(value: str, pattern: str) -> list[str]:
    """Group 1 of every match, what stands between and after the matches, and the whole value."""
    out, at = [], 0
    for x in re.finditer(pattern, value):
        out += [value[at : x.start()].strip(), x.group(1)]
        at = x.end() + 1
    if at:
        out.append(value[at:].strip())
    return [v for v in dict.fromkeys([*out, value]) if v]


def targets(root: ET.Element, sections: dict[str, Mapping]) -> list[dict]:
    """field, ordinal, values (longest first) and sub (field, values) of a document, by priority and place; an unknown root is an error."""
    name = local(root.tag)
    if name not in sections:
        raise ValueError(f"no mapping for {name}")
    m, tree, out = sections[name], Tree(root), []
    for at, field in enumerate(k for k in m if "." not in k):
        option = lambda k, f=field: m.get(f"{f}.{k}")
        for e in [x for p in m[field].split("\n") if p.strip() for x in tree.find(p, root)]:
            hidden = frozenset(id(x) for x in tree.find(option("ignore"), e)) if option("ignore") else frozenset()
            raw = option("use-raw-text") == "true" if option("use-raw-text") else any((c.tail or "").strip() for c in e.iter() if c is not e)
            alone: list[list[str]] = []
            if option("children") and not (raw and option("children") == ".//*"):
                values, alone = _children(tree, e, m, field)
            else:
                values = [content(e, hidden)]
            if option("regex"):
                values = [x.group(1) if (x := re.match(option("regex"), v)) else v for v in values]
            if option("extract-regex"):
                values = [y for v in values for y in extract(v, option("extract-regex"))]
            sub = []
            for k in m:
                if k.startswith(f"{field}.sub.") and "." not in (short := k[len(field) + 5 :]):
                    found = [content(x) for x in tree.find(m[k], e)]
                    if m.get(f"{k}.extract-regex"):
                        found = [y for v in found for y in extract(v, m[f"{k}.extract-regex"])]
                    sub += [{"field": short, "values": [v]} for v in found if v]
            for vs in [sorted(filter(None, values), key=lambda v: -len(v)), *alone]:
                if vs:
                    out.append((-int(option("priority") or 0), tree.order[id(e)], at, {"field": field, "values": vs, "sub": sub, "match_multiple": option("match-multiple") == "true", "bonding": option("bonding") == "true", "require_next": option("require-next") == "true"}))
    out.sort(key=lambda x: x[:3])
    return [{"ordinal": i, **t} for i, (*_, t) in enumerate(out)]
