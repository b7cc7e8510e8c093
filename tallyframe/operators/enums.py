"""Enumerations read out of description texts, and the canonical one per field name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n


def enum_pairs(text) -> Column:
    """Array of struct(value, description) from 'N = label' texts: hex pairs, then decimal pairs.

    The first pair of a number wins; texts with fewer than two labelled numbers give an empty array.
    """
    c = n._col(text)

    def found(pattern, to_number):
        numbers = F.regexp_extract_all(c, F.lit(pattern), F.lit(1))
        labels = F.regexp_extract_all(c, F.lit(pattern), F.lit(2))
        return F.zip_with(numbers, labels, lambda v, d: F.struct(to_number(v).alias("value"), d.alias("description")))

    pairs = F.concat(
        found(fixed.ENUM_HEX_PAIR, n.hex_to_long), found(fixed.ENUM_DEC_PAIR, lambda v: v.try_cast("bigint"))
    )

    def first(pairs, numbers):
        return F.filter(pairs, lambda p, i: F.array_position(numbers, p["value"]) == i + 1)

    def cleaned(p):
        trimmed = F.regexp_replace(F.regexp_replace(p["description"], r"^\s+|\s+$", ""), "^[ ,.]+|[ ,.]+$", "")
        return F.struct(p["value"].alias("value"), trimmed.alias("description"))

    firsts = _with(F.filter(pairs, lambda p: p["value"].isNotNull()), lambda pairs: _with(F.transform(pairs, lambda p: p["value"]), lambda numbers: first(pairs, numbers)))
    labelled = F.array_sort(F.filter(F.transform(firsts, cleaned), lambda p: p["description"] != ""))
    return _with(labelled, lambda found: F.when(F.size(found) >= 2, found).otherwise(F.slice(found, 1, 0)))


def _with(value: Column, body) -> Column:
    """``body`` of a value that is worked out once; else the functions inside ``body`` would do so for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def extract_enums(fields: DataFrame, keys, description: str) -> DataFrame:
    """(keys.., value, name, description) of every enumeration found in a description; row by row."""
    found = fields.select(*keys, F.explode(enum_pairs(F.coalesce(F.col(description), F.lit("")))).alias("_p"))
    return found.select(*keys, F.col("_p.value").alias("value"), n.enum_name(F.col("_p.description")).alias("name"), F.col("_p.description").alias("description"))


def canonical_enums(fields: DataFrame, field_name: str, message: str, dtype: str, description: str, order) -> DataFrame:
    """Per field name the longest value list (the first on a tie), with its type and occurrences."""
    lists = fields.withColumn("_pairs", enum_pairs(F.coalesce(F.col(description), F.lit("")))).where(F.size("_pairs") > 0)
    best = lists.groupBy(field_name).agg(
        F.min_by(F.struct(F.col(dtype).alias("type"), F.col("_pairs").alias("values")), F.struct(-F.size("_pairs"), *order)).alias("_b"),
        F.count(F.lit(1)).alias("occurrences"),
    )
    return best.select(field_name, "_b.type", "_b.values", "occurrences")


def enum_messages(fields: DataFrame, field_name: str, message: str, description: str) -> DataFrame:
    """(field name, message) for every enumeration found."""
    pairs = enum_pairs(F.coalesce(F.col(description), F.lit("")))
    return fields.where(F.size(pairs) > 0).select(field_name, message)
