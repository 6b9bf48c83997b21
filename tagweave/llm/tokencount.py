"""Token counts by field or section, from one encoding of each whole document.

A document (one text, or its fields joined by LF) is encoded once.  The tokens
of a byte-level vocabulary join up to the text's bytes, so their lengths give
every token's span; these spans are interval-joined to the spans of the
sections (two sorted lists, one binary search).  A token that crosses a
boundary is allocated by a rule: "start" (the section of its first byte),
"majority" (the section with most of its bytes, ties to the earlier) or
"split" (shares by bytes).  Under each, a document's sections add up to its tokens.

The vocabulary is a file of ranks whose path is a parameter; the driver reads
it and ships its bytes (under MAX_VOCABULARY) to the tasks.

Cases: null and empty texts have no tokens and no sections; texts are taken
whole whatever their length; repeated rows and null doc_ids each give their row;
an empty table gives an empty result; columns that aren't asked for are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import fresh, slices
from tagweave.session import ship

RULES = ("start", "majority", "split")
MAX_VOCABULARY = 32 << 20
#: A public byte-level vocabulary; see /opt/tokenizers/README.md.
DEFAULT = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how that vocabulary's public pattern cuts texts into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[int, tuple] = {}


def encoder(vocabulary: bytes, pattern: str = PATTERN) -> tuple:
    """An encoder and the byte length of each token; kept for the life of a worker."""
    key = hash((vocabulary, pattern))
    if key not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        _encoders[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size
    return _encoders[key]


def allocate(ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section; ends: of the tokens, in bytes; bounds: starts of the sections and, last, the end of the text."""
    n = len(bounds) - 1
    if not len(ends) or n < 1:
        return np.zeros(max(n, 0))
    starts = np.concatenate([[0], ends[:-1]])
    # empty sections hold no byte: the last section that starts at or before a byte has it
    first = np.searchsorted(bounds[:-1], starts, side="right") - 1
    last = np.searchsorted(bounds[:-1], ends - 1, side="right") - 1
    if rule == "start":
        return np.bincount(first, minlength=n).astype(np.float64)
    out = np.bincount(first[first == last], minlength=n).astype(np.float64)
    for s, e, a, b in zip(*(x[first != last].tolist() for x in (starts, ends, first, last))):
        share = np.diff(np.clip(bounds[a : b + 2], s, e))
        if rule == "majority":
            out[a + int(share.argmax())] += 1
        else:
            out[a : b + 1] += share / (e - s)
    return out


def lines(data: bytes) -> np.ndarray:
    """Bounds of the lines, each with its LF."""
    at = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    bounds = np.concatenate([[0], at])
    return np.append(bounds, len(data)) if bounds[-1] < len(data) else bounds


def count(docs: DataFrame, fields: list[str] | None = None, rule: str = "majority", vocabulary: str = DEFAULT, keys: list[str] | None = None) -> DataFrame:
    """keys (doc_id), n_tokens, n_sections, n_crossing and section_tokens.

    fields None: the sections are the lines of `text`.  Otherwise they are these
    columns, in order, encoded together with an LF after each but the last (an
    LF belongs to the field before it; a null field is empty).
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    ship(docs.sparkSession)
    keys = keys or ["doc_id"]
    with open(vocabulary, "rb") as f:
        data = f.read()
    if len(data) > MAX_VOCABULARY:
        raise ValueError("the vocabulary is too large to ship")
    texts = ["text"] if fields is None else fields
    names = [fresh(f"field{i}", keys) for i in range(len(texts))]
    whole = docs.select(*keys, *[F.col(f"`{t}`").alias(n) for t, n in zip(texts, names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = encoder(data)
        for batch in slices(batches, names, 1 << 21):
            out: list[tuple] = []
            for row in zip(*[batch.column(n).to_pylist() for n in names]):
                if fields is None:
                    text = row[0] or ""
                    bounds = lines(text.encode())
                else:
                    text = "\n".join(x or "" for x in row)
                    bounds = np.concatenate([[0], np.cumsum([len((x or "").encode()) + (i < len(row) - 1) for i, x in enumerate(row)])])
                ends = np.cumsum(size[np.array(encode.encode_ordinary(text), np.int64)])
                inside = np.searchsorted(ends, bounds[1:-1])
                crossing = int(np.unique(inside[ends[inside] != bounds[1:-1]]).size) if len(ends) and len(bounds) > 2 else 0
                out.append((len(ends), len(bounds) - 1, crossing, allocate(ends, bounds, rule).tolist()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.list_(pa.float64()))],
                names=[*keys, "n_tokens", "n_sections", "n_crossing", "section_tokens"],
            )

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return whole.mapInArrow(run, f"{kinds}, n_tokens long, n_sections long, n_crossing long, section_tokens array<double>")


def op5(docs: DataFrame) -> DataFrame:
    """doc_id, its tokens, its lines, the tokens that cross lines, and the tokens of each line (majority rule)."""
    return count(docs).withColumn("section_tokens", F.col("section_tokens").cast("array<long>"))
