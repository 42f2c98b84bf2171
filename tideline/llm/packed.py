"""Texts carried through shuffles in compressed form."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T


def packed(texts: pa.Array) -> pa.Array:
    """Texts compressed one by one; a null stays null."""
    press = zstandard.ZstdCompressor(level=1).compress
    return pa.array([None if t is None else press(t) for t in texts.cast(pa.large_binary()).to_pylist()], pa.binary())


def pack_texts(rows: DataFrame) -> DataFrame:
    """``rows`` (key, text, any others) as (key, packed, others): texts compressed one by one; a null stays null."""
    others = [f for f in rows.schema.fields if f.name not in ("key", "text")]
    rows = rows.select("key", "text", *[F.col(f"`{f.name}`") for f in others])
    schema = T.StructType([rows.schema["key"], T.StructField("packed", T.BinaryType()), *others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(batch.column(1)), *batch.columns[2:]], schema.names)

    return rows.mapInArrow(run, schema)


def unpack(values: list[bytes | None]) -> list[bytes]:
    """The texts again; null is empty."""
    expand = zstandard.ZstdDecompressor().decompress
    return [b"" if v is None else expand(v) for v in values]
