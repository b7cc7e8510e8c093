"""Finding the field that carries a layout's version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import naming as n


def _verdict(found: Column, offset: Column, confidence: Column, reason: Column) -> Column:
    return F.struct(
        F.lit(True).alias("detected"),
        found["name"].alias("field_name"),
        offset.cast("bigint").alias("byte_offset"),
        n.version_value(found["description"]).alias("value"),
        confidence.alias("confidence"),
        reason.alias("reason"),
    )


def resolve(at_zero: Column, at_one: Column, named: Column, any_field: Column) -> Column:
    """The verdict from the last field at offset 0, the last at 1, and the first with a version name."""

    def placed(f, offset):
        reason = F.concat(F.lit("Field '"), f["name"], F.lit(f"' at offset {offset} with type U1"))
        hit = f.isNotNull() & n.is_version_name(f["name"]) & (f["data_type"] == "U1")
        return hit, _verdict(f, F.lit(offset), F.lit("high"), reason)

    def implicit(reason):
        return F.struct(
            F.lit(False).alias("detected"),
            F.lit(None).cast("string").alias("field_name"),
            F.lit(None).cast("bigint").alias("byte_offset"),
            F.lit(0).cast("bigint").alias("value"),
            F.lit("none").alias("confidence"),
            F.lit(reason).alias("reason"),
        )

    text = F.lower(F.coalesce(at_zero["description"], F.lit("")))
    level = F.when(named["data_type"] == "U1", F.lit("medium")).otherwise(F.lit("low"))
    named_reason = F.concat(
        F.lit("Field '"), named["name"], F.lit("' at offset "), named["byte_offset"].cast("string")
    )
    zero_hit, zero = placed(at_zero, 0)
    one_hit, one = placed(at_one, 1)
    described = _verdict(at_zero, F.lit(0), F.lit("medium"), F.lit("Field at offset 0 description mentions version"))
    return (
        F.when(~any_field, implicit("No fields in message"))
        .when(F.coalesce(zero_hit, F.lit(False)), zero)
        .when(F.coalesce(one_hit, F.lit(False)), one)
        .when(named.isNotNull(), _verdict(named, named["byte_offset"], level, named_reason))
        .when(at_zero.isNotNull() & text.contains("version") & text.contains("message"), described)
        .otherwise(implicit("No version field detected, using implicit version 0"))
    )


def protocol_version(verdict) -> Column:
    """0 when undetected, the value when known, else 1."""
    v = n._col(verdict)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    return F.when(~v["detected"], zero).otherwise(F.coalesce(v["value"], one))


def _version_named(f) -> Column:
    return n.is_version_name(f["name"]) & ~n.is_version_lookalike(f["name"])


def add_version(documents: DataFrame, fields: str = "fields", own_count: str | None = None) -> DataFrame:
    """Add ``version_info`` and ``protocol_version`` from a ``fields`` array, row by row.

    ``own_count`` holds how many leading fields are the definition's own (not of repeated groups).
    """
    own = F.col(fields) if own_count is None else F.slice(F.col(fields), F.lit(1), F.col(own_count))
    slim = F.transform(
        own,
        lambda f: F.struct(
            f["original_name"].alias("name"), f["byte_offset"].alias("byte_offset"),
            f["data_type"].alias("data_type"), f["description"].alias("description"),
        ),
    )
    rows = documents.withColumn("_slim", slim)
    verdict = resolve(
        F.try_element_at(F.filter("_slim", lambda f: f["byte_offset"] == 0), F.lit(-1)),
        F.try_element_at(F.filter("_slim", lambda f: f["byte_offset"] == 1), F.lit(-1)),
        F.try_element_at(F.filter("_slim", _version_named), F.lit(1)),
        F.size("_slim") > 0,
    )
    out = rows.withColumn("version_info", verdict).drop("_slim")
    return out.withColumn("protocol_version", protocol_version("version_info"))


def detect_version(fields: DataFrame, entity, name: str, offset: str, dtype: str, description: str, order) -> DataFrame:
    """The same verdict per entity of a field table, by aggregation only."""
    row = F.struct(
        F.col(name).alias("name"), F.col(offset).cast("bigint").alias("byte_offset"),
        F.col(dtype).alias("data_type"), F.col(description).alias("description"),
    )
    rank = F.struct(*order)
    named = n.is_version_name(name) & ~n.is_version_lookalike(name)
    grouped = fields.groupBy(*entity).agg(
        F.max_by(row, F.when(F.col(offset) == 0, rank)).alias("_zero"),
        F.max_by(row, F.when(F.col(offset) == 1, rank)).alias("_one"),
        F.min_by(row, F.when(named, rank)).alias("_named"),
    )
    verdict = resolve(F.col("_zero"), F.col("_one"), F.col("_named"), F.lit(True))
    out = grouped.select(*entity, verdict.alias("version_info"))
    return out.withColumn("protocol_version", protocol_version("version_info"))
