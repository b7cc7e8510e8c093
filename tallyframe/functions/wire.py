"""Column expressions for bytes on the wire: little-endian numbers, floats, bits, checksums."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed
from .naming import _col, let

WORD = "decimal(20,0)"


def slice_bytes(data, offset, size) -> Column:
    return F.substring(_col(data), _col(offset).cast("int") + 1, _col(size).cast("int"))


def _reversed_pairs(hexed: Column) -> Column:
    return F.regexp_replace(F.reverse(hexed), "(.)(.)", "$2$1")


def _swap_bytes(hexed: Column) -> Column:
    """Up to eight bytes in hex, last byte first."""
    return F.concat(*[F.substring(hexed, at, 2) for at in range(15, 0, -2)])


def reversed_hex(data) -> Column:
    """Hex of some bytes, last byte first."""
    data = _col(data)
    return F.when(F.length(data) > 8, _reversed_pairs(F.hex(data))).otherwise(let(F.hex(data), _swap_bytes))


def unsigned(data) -> Column:
    """Little-endian unsigned number of 1 to 8 bytes."""
    return F.conv(reversed_hex(data), 16, 10).cast(WORD)


def _by_size(size: Column, exponent: int) -> Column:
    """2 ** (8 * size - exponent) for sizes 1, 2, 4 and 8."""
    out = F.lit(None).cast("decimal(21,0)")
    for s in (1, 2, 4, 8):
        out = F.when(size == s, F.lit(str(2 ** (8 * s - exponent))).cast("decimal(21,0)")).otherwise(out)
    return out


def signed(data) -> Column:
    size = F.length(_col(data))

    def body(v):
        return F.when(v >= _by_size(size, 1), (v - _by_size(size, 0)).cast(WORD)).otherwise(v)

    return let(unsigned(data), body)


def float_value(data) -> Column:
    """IEEE 754 value of 4 or 8 little-endian bytes, from its bits; exact."""
    double = F.length(_col(data)) == 8

    def parts(h):
        top = F.conv(F.substring(h, 1, 3), 16, 10).cast("bigint")
        single = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
        fraction = F.when(double, F.conv(F.substring(h, 4, 13), 16, 10).cast("bigint")).otherwise(single % (1 << 23))
        return F.struct(
            F.substring(h, 1, 1).isin(list("89ABCDEF")).alias("negative"),
            F.when(double, top % 2048).otherwise(F.shiftright(single, 23) % 256).cast("int").alias("exponent"),
            (fraction.cast("double") / F.when(double, F.lit(float(1 << 52))).otherwise(F.lit(float(1 << 23)))).alias("fraction"),
        )

    def value(p):
        bias, full = F.when(double, 1023).otherwise(127), F.when(double, 2047).otherwise(255)
        power = F.pow(F.lit(2.0), (F.greatest(p["exponent"], F.lit(1)) - bias).cast("double"))
        magnitude = (
            F.when((p["exponent"] == full) & (p["fraction"] == 0), F.lit(float("inf")))
            .when(p["exponent"] == full, F.lit(float("nan")))
            .otherwise((F.when(p["exponent"] == 0, F.lit(0.0)).otherwise(F.lit(1.0)) + p["fraction"]) * power)
        )
        return F.when(p["negative"], -magnitude).otherwise(magnitude)

    return let(let(reversed_hex(data), parts), value)


def text_value(data) -> Column:
    """ASCII text without trailing NULs; other bytes become U+FFFD."""
    text = F.decode(_col(data), "ISO-8859-1")
    return F.regexp_replace(F.regexp_replace(text, "\\x00+$", ""), "[\\x80-\\xff]", "�")


def integer_value(data, base) -> Column:
    """Number of a wire type: I is signed, RU1_3 and RU2_5 are a base shifted by an exponent."""
    base = _col(base)

    def ranged(raw):
        one = F.when(base == "RU1_3", F.lit(5)).otherwise(F.lit(11))
        low = raw.bitwiseAND(F.when(base == "RU1_3", F.lit(0x1F)).otherwise(F.lit(0x7FF)).cast("bigint"))
        return (low * F.pow(F.lit(2), F.call_function("shiftright", raw, one)).cast("bigint")).cast(WORD)

    return (
        F.when(base.startswith("I"), signed(data))
        .when(base.isin(list(fixed.RANGE_FLOAT_SIZES)), let(unsigned(data).cast("bigint"), ranged))
        .otherwise(unsigned(data))
    )


def little_endian_hex(value, size) -> Column:
    """Hex of a number in ``size`` little-endian bytes (two's complement)."""
    whole = F.lpad(F.conv(_col(value).cast("string"), 10, 16), 16, "0")
    return F.substring(_reversed_pairs(whole), F.lit(1), _col(size).cast("int") * 2)


def text_hex(value, size) -> Column:
    """Hex of ASCII text cut or NUL-padded to ``size``; other characters become '?'."""
    ascii_text = F.regexp_replace(_col(value), r"[^\x00-\x7f]", "?")
    return F.rpad(F.substring(F.hex(F.encode(ascii_text, "US-ASCII")), F.lit(1), _col(size).cast("int") * 2), _col(size).cast("int") * 2, "0")


@F.pandas_udf(T.StringType())
def float_hex(value: pd.Series, dtype: pd.Series) -> pd.Series:
    """Little-endian hex of a number as R4 or R8."""
    wide = dtype.to_numpy() != "R4"
    numbers = value.to_numpy(dtype="float64", na_value=0.0)
    doubles = numbers.astype("<f8").tobytes().hex().upper()
    with np.errstate(over="ignore"):
        singles = numbers.astype("<f4").tobytes().hex().upper()
    return pd.Series([doubles[16 * i : 16 * i + 16] if w else singles[8 * i : 8 * i + 8] for i, w in enumerate(wide)], index=value.index)


def bit_field(value, start, width) -> Column:
    """Bits start .. start+width-1 of a number."""
    v = _col(value).cast("bigint")
    mask = (F.pow(F.lit(2), _col(width)).cast("bigint") - 1).cast("bigint")
    moved = F.call_function("shiftrightunsigned", v, _col(start).cast("int"))
    return moved.bitwiseAND(mask)


def _fletcher(buffers) -> np.ndarray:
    """Fletcher sums of each buffer as a + 256 b: a is the sum, b weights byte i with the bytes left."""
    lengths = np.fromiter((len(b) for b in buffers), dtype=np.int64, count=len(buffers))
    out = np.zeros(len(buffers), dtype=np.int64)
    filled = np.flatnonzero(lengths)
    if len(filled):
        data = np.frombuffer(b"".join(buffers), dtype=np.uint8).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        left = np.repeat(starts + lengths, lengths) - np.arange(len(data))
        a = np.add.reduceat(data, starts[filled]) % 256
        b = np.add.reduceat(data * left, starts[filled]) % 256
        out[filled] = a + 256 * b
    return out


@F.pandas_udf(T.IntegerType())
def checksum(data: pd.Series) -> pd.Series:
    """Frame checksum of class..payload: first byte + 256 * second byte; null for null."""
    present = data.notna().to_numpy()
    out = pd.Series([None] * len(data), index=data.index, dtype="Int32")
    if present.any():
        out[present] = _fletcher([bytes(b) for b in data[present]]).astype("int32")
    return out


def checksum_sql(data) -> Column:
    """The same sums by built-in functions, for short inputs and cross-checks."""
    d = _col(data)
    count = F.length(d)
    index = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    values = F.transform(index, lambda i: F.conv(F.hex(F.substring(d, i, F.lit(1))), 16, 10).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    a = F.aggregate(values, zero, lambda acc, v: acc + v)
    b = F.aggregate(F.zip_with(values, index, lambda v, i: v * (count - i + 1)), zero, lambda acc, v: acc + v)
    return ((a % 256) + (b % 256) * 256).cast("int")


def frame(class_id, message_id, payload) -> Column:
    """A whole frame: sync bytes, ids, length, payload, checksum."""
    body = F.concat(
        F.unhex(F.concat(F.lpad(F.hex(_col(class_id).cast("int")), 2, "0"), F.lpad(F.hex(_col(message_id).cast("int")), 2, "0"),
                         little_endian_hex(F.length(_col(payload)), F.lit(2)))),
        _col(payload),
    )
    return F.concat(F.lit(fixed.SYNC), body, F.unhex(little_endian_hex(checksum(body), F.lit(2))))
