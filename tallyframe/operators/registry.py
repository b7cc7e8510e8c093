"""Lookups in the message registry: by name or alias, by variant alias, and by ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import naming as n
from . import skew


def name_index(messages: DataFrame, order, name="name", aliases="variant_aliases") -> DataFrame:
    """(lookup, name): each message under its name and its aliases; the first message wins."""
    empty = F.array().cast("array<string>")
    keys = F.array_distinct(F.concat(F.array(F.col(name)), F.coalesce(F.col(aliases), empty)))
    long = messages.select(F.explode(keys).alias("lookup"), F.col(name), *order)
    return long.groupBy("lookup").agg(F.min_by(name, F.struct(*order)).alias(name))


def find_by_name(requests: DataFrame, messages: DataFrame, request: str, order, name="name", aliases="variant_aliases") -> DataFrame:
    index = name_index(messages, order, name, aliases).withColumnRenamed("lookup", request)
    return skew.null_safe_join(requests, index, [request], "left")


def variant_index(variants: DataFrame, aliases: DataFrame) -> DataFrame:
    """(alias, name, variant): an alias is the message name, a dash and the variant name.

    ``variants``: name, variant. ``aliases``: name, alias (the aliases a message lists).
    """
    formed = variants.select("name", "variant", F.concat_ws("-", "name", "variant").alias("alias"))
    return formed.join(aliases.select("name", "alias").distinct(), ["name", "alias"], "left_semi")


def id_index(messages: DataFrame, order, class_id="class_id", message_id="message_id", columns=("name",)) -> DataFrame:
    """One row per (class, message) id pair as numbers; the first message wins.

    Ids are single bytes on the wire, so there are at most 65,536 rows.
    """
    ids = messages.withColumns({"_class": n.parse_id(F.col(class_id).cast("string")), "_message": n.parse_id(F.col(message_id).cast("string"))})
    first = ids.where("_class between 0 and 255 and _message between 0 and 255").groupBy("_class", "_message").agg(
        F.min_by(F.struct(*columns), F.struct(*order)).alias("_m")
    )
    return first.select(F.col("_class").cast("int").alias("class_id"), F.col("_message").cast("int").alias("message_id"), "_m.*")
