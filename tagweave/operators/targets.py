"""Target values of article markup as rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tagweave.functions import mapping, markup
from tagweave.session import ship

FIELDS = "ordinal int, field string, values array<string>, sub array<struct<field:string,values:array<string>>>, match_multiple boolean, bonding boolean, require_next boolean"
_TYPES = pa.schema(
    [
        ("ordinal", pa.int32()), ("field", pa.string()), ("values", pa.list_(pa.string())), ("sub", pa.list_(pa.struct([("field", pa.string()), ("values", pa.list_(pa.string()))]))),
        ("match_multiple", pa.bool_()), ("bonding", pa.bool_()), ("require_next", pa.bool_()),
    ]
)


def target_values(docs: DataFrame, key: str, xml: str, sections: dict[str, mapping.Mapping]) -> DataFrame:
    """key and FIELDS: each document's target values in their order, by a mapping of fields to paths.

    A pass over documents, one at a time, without a shuffle.  Null and
    unrepairable markup has none; a root element without a mapping is an error.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, source in enumerate(batch.column(1).to_pylist()):
                root = None if source is None else markup.parse(markup.repair(source))[0]
                rows = mapping.targets(root, sections) if root is not None else []
                if rows:
                    keys = pa.DictionaryArray.from_arrays(pa.array([0] * len(rows), pa.int32()), batch.column(0).slice(at, 1)).dictionary_decode()
                    columns = [pa.array([r[f.name] for r in rows], f.type) for f in _TYPES]
                    yield pa.RecordBatch.from_arrays([keys, *columns], names=[key, *_TYPES.names])

    return docs.select(key, xml).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, {FIELDS}")
