"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type

from ..session import BATCH_BYTES, small_batches  # noqa: F401

#: ASCII white space: the characters that separate words.
SPACE = b" \t\n\v\f\r"


def raw(column: pa.Array, at_once: int = 128) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, a few rows at a time."""
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for start in range(0, len(column), at_once):
        yield from column.slice(start, at_once).to_pylist()


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo ``by``; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(by))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def own(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever their names."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def by_arrow(kind: pa.DataType):
    """Decorator: a function from Arrow arrays to one Arrow array of ``kind``, for use on columns."""
    return arrow_udf(from_arrow_type(kind))


def structs(kind: pa.StructType, rows: list[tuple]) -> pa.StructArray:
    """Rows as a column of structs."""
    columns = zip(*rows, strict=True) if rows else [()] * kind.num_fields
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))
