"""Configuration keys: repair of misread text, de-duplication and the compliant form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n

TEXTS = ("name", "data_type", "description", "scale", "unit")


def repair(keys: DataFrame) -> DataFrame:
    """Full repair of (name, data_type, description, scale, unit); ``fixed`` marks changed rows."""
    name = n.unicode_to_ascii("name")
    name = F.when(name.contains(" ") & name.startswith("CFG-"), F.replace(name, F.lit(" "), F.lit("_"))).otherwise(name)
    unit, scale = F.col("unit"), F.col("scale")
    unit_in_scale = F.coalesce(scale.isin(fixed.UNITS_IN_SCALE), F.lit(False))
    vague = unit.isNull() | (F.length(unit) > fixed.MAX_UNIT_LENGTH)
    new_unit = F.when(unit_in_scale & vague, scale).when(unit.isin(fixed.UNIT_BLANKS), F.lit(None)).otherwise(unit)
    new_unit = F.when(F.length(new_unit) <= fixed.MAX_UNIT_LENGTH, new_unit)
    new_unit = F.when(new_unit == "S", F.lit("s")).otherwise(F.replace(new_unit, F.lit("\n"), F.lit(" ")))
    new = {
        "name": n.repair_name(name, fixed.NAME_REPAIRS),
        "data_type": n.repair_type("data_type"),
        "description": n.unicode_to_ascii("description"),
        "scale": F.when(~unit_in_scale & ~scale.isin(fixed.SCALE_BLANKS), scale),
        "unit": new_unit,
    }
    changed = F.lit(False)
    for c, expression in new.items():
        changed = changed | ~expression.eqNullSafe(F.col(c))
    return keys.withColumns({**new, "fixed": changed})


def repair_light(keys: DataFrame) -> DataFrame:
    """The lighter repair: names, types, and blank scales and units."""
    blanks = fixed.LIGHT_BLANKS
    return keys.withColumns({
        "name": F.replace(n.repair_name("name", fixed.NAME_REPAIRS_LIGHT), F.lit(" "), F.lit("_")),
        "data_type": n.repair_type("data_type"),
        "scale": F.when(~F.col("scale").isin(blanks), F.col("scale")),
        "unit": F.when(~F.col("unit").isin(blanks), F.col("unit")),
    })


def deduplicate(keys: DataFrame, by: str, order) -> DataFrame:
    """First row per name or key id; rows without one drop out."""
    columns = [c for c in keys.columns if c != by]
    named = keys.where(F.col(by).isNotNull() & (F.col(by) != ""))
    firsts = named.groupBy(by).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_r"))
    return firsts.select(by, "_r.*").select(*keys.columns)


def with_group(keys: DataFrame) -> DataFrame:
    """Add ``group``, the prefix in front of the item; keys without one have none."""
    return keys.withColumn("group", n.extract("name", fixed.KEY_GROUP))


def compliant(keys: DataFrame) -> DataFrame:
    """Keys with padded id, group, item id, scale struct and cleaned unit."""
    padded = n.padded_key_id("key_id")
    parts = n.key_id_parts(padded)
    return keys.withColumns({
        "key_id": padded,
        "group": n.key_group("name"),
        "group_id": parts["group_id"],
        "item_id": parts["item_id"],
        "scale": n.scale("scale"),
        "unit": F.when(~F.col("unit").isin(fixed.UNIT_BLANKS_COMPLIANT), F.col("unit")),
    })


def groups(keys: DataFrame, order) -> DataFrame:
    """Groups with the id taken from their first key."""
    return keys.groupBy(F.col("group").alias("name")).agg(F.min_by("group_id", F.struct(*order)).alias("group_id"))


def valid_enum_items(items: DataFrame, value: str) -> DataFrame:
    return items.where(F.col(value).isNotNull())


def complete_bits(bits: DataFrame) -> DataFrame:
    """Bits with defaults: type U, start 0, end = start."""
    start = F.coalesce("bit_start", F.lit(0))
    return bits.withColumns({
        "data_type": F.coalesce("data_type", F.lit("U")),
        "bit_start": start,
        "bit_end": F.coalesce(F.col("bit_end"), start),
    })
