"""Merging agreeing sources: supersets, provenance, upserts, versions, variants and patches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import naming as n
from . import skew

#: Distinct (name, value) pairs of one enumeration.
MOST_PAIRS = 1 << 20


def superset(items: DataFrame, entity, key, text: str, order, columns, drop_reserved: str | None = None, reserved: str | None = None) -> DataFrame:
    """Union of child items by ``key``; the longest ``text`` wins, the first on a tie.

    ``drop_reserved`` names the column in which 'reserved' marks an item to leave out, ``reserved`` a boolean
    column that does.
    """
    if reserved:
        items = items.where(~F.coalesce(F.col(reserved), F.lit(False)))
    if drop_reserved:
        items = items.where(~F.lower(F.col(drop_reserved)).contains("reserved") & (F.col(drop_reserved) != ""))
    for k in key:
        items = items.where(F.col(k).isNotNull())
    rank = F.struct(-F.length(F.coalesce(F.col(text), F.lit(""))), *order)
    best = items.groupBy(*entity, *key).agg(F.min_by(F.struct(*columns), rank).alias("_b"))
    return best.select(*entity, *key, "_b.*")


def merge_children(winners: DataFrame, items: DataFrame, entity, field_key, key, text: str, order, columns, **options) -> DataFrame:
    """Superset of child items over agreeing sources, for the winner's fields that have such items.

    ``winners`` holds (entity.., field_key..) of the winning layouts' fields with items.
    """
    owned = [*entity, *field_key]
    kept = skew.null_safe_join(items, winners.select(*owned).distinct(), owned, "left_semi")
    return superset(kept, owned, key, text, order, columns, **options)


# -- keys with provenance --------------------------------------------------------------------


def provenance(df: DataFrame, key, source: str, order, first=(), longest=(), present=()) -> DataFrame:
    """One row per key: first-seen columns, longest texts, first non-null columns, sources counted."""
    rank = F.struct(*order)
    aggs = [F.min_by(F.struct(*first), rank).alias("_first")] if first else []
    for c in longest:
        aggs.append(F.min_by(c, F.struct(-F.length(F.coalesce(F.col(c), F.lit(""))), *order)).alias(c))
    for c in present:
        aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c))
    # (key, source) first: a hot key reaches the second level as one row per source.
    header = df.groupBy(*key).agg(*aggs, F.count(F.lit(1)).alias("instance_count"))
    counts = members(df, key, source).groupBy(*key).agg(F.count(F.lit(1)).alias("source_count"))
    out = skew.null_safe_join(header, counts, key, "left")
    shown = [f"_first.{c}" for c in first] + list(longest) + list(present)
    return out.select(*key, *shown, "instance_count", "source_count")


def members(df: DataFrame, key, source: str) -> DataFrame:
    """Distinct (key, source) pairs: the sources of each key."""
    return df.select(*key, source).distinct()


def enum_union(items: DataFrame, key, name: str, value: str, order, columns=()) -> DataFrame:
    """Union of enumeration values by name, in source order.

    A name is added by the first source that has it with a number no earlier source's accepted value uses; a
    name already there stays. Which pairs are accepted depends on the order, so the distinct pairs of a key are
    settled by one pass over them, sorted by source, name and value. ``order`` ranks sources. A key with more
    than ``MOST_PAIRS`` distinct pairs is no enumeration and fails the job.
    """
    rank = F.struct(*order)
    pairs = items.groupBy(*key, name, value).agg(
        F.min(rank).alias("_at"), *([F.min_by(F.struct(*columns), rank).alias("_cols")] if columns else [])
    )
    place = W.partitionBy(*key).orderBy("_at", name, value)
    ranked = pairs.withColumns({"_n": F.row_number().over(place), "_source": F.dense_rank().over(W.partitionBy(*key).orderBy("_at"))})
    # A pair with all it takes to judge it; the rest of its row stays in Spark.
    judged = ranked.select(*key, "_n", "_source", F.col(name).cast("string").alias("_name"), F.col(value).cast("string").alias("_value"))

    def accepted(key_values, group):
        if len(group) > MOST_PAIRS:
            raise ValueError(f"{len(group)} distinct pairs of one enumeration; the most is {MOST_PAIRS}")
        names, taken, now, source, out = set(), set(), [], None, []
        for n, at, one, number in group.sort_values("_n")[["_n", "_source", "_name", "_value"]].itertuples(index=False):
            if at != source:
                taken.update(now)
                now, source = [], at
            if one not in names and number not in taken:
                names.add(one)
                now.append(number)
                out.append(n)
        return pd.DataFrame({**{k: [v] * len(out) for k, v in zip(key, key_values)}, "_n": out})

    kinds = dict(ranked.dtypes)
    chosen = judged.groupBy(*key).applyInPandas(accepted, ", ".join([*[f"`{k}` {kinds[k]}" for k in key], "_n int"]))
    kept = skew.null_safe_join(ranked, chosen, [*key, "_n"], "left_semi")
    shown = ["_cols.*"] if columns else []
    return kept.select(*key, name, value, F.col("_at").alias("added_at"), *shown)


def enum_sources(items: DataFrame, union: DataFrame, key, name: str, source: str, order) -> DataFrame:
    """Sources of each accepted enumeration name: those that have it from its addition on."""
    at = union.select(*key, name, "added_at")
    rows = items.select(*key, name, source, F.struct(*order).alias("_at")).distinct()
    joined = skew.null_safe_join(rows, at, [*key, name], "inner")
    return joined.where(F.col("_at") >= F.col("added_at")).select(*key, name, source).distinct()


def merge_stats(keys: DataFrame, columns) -> DataFrame:
    counted = [F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(f"with_{c}") for c in columns]
    return keys.agg(F.count(F.lit(1)).alias("keys"), *counted)


# -- upserts ---------------------------------------------------------------------------------


def last_per_key(df: DataFrame, key, order) -> DataFrame:
    columns = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_r")).select(*key, "_r.*")


def upsert(old: DataFrame, new: DataFrame, key, order) -> DataFrame:
    """``new`` over ``old`` by key, with ``status`` added, updated or kept; duplicates: last wins."""
    columns = [c for c in old.columns if c not in key]
    left = last_per_key(old, key, order).select(*key, F.struct(*columns).alias("_old"))
    right = last_per_key(new.select(*old.columns), key, order).select(*key, F.struct(*columns).alias("_new"))
    both = left.join(right, list(key), "full_outer")
    status = (
        F.when(F.col("_old").isNull(), F.lit("added"))
        .when(F.col("_new").isNull(), F.lit("kept"))
        .otherwise(F.lit("updated"))
    )
    return both.select(*key, F.coalesce("_new", "_old").alias("_r"), status.alias("status")).select(*key, "_r.*", "status")


def upsert_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "added").alias("added"),
        F.count_if(F.col("status") == "updated").alias("updated"),
    )


def sorted_registry(messages: DataFrame, class_id="class_id", message_id="message_id", name="name") -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return messages.orderBy(
        F.coalesce(n.parse_id(class_id), zero), F.coalesce(n.parse_id(message_id), zero), name
    )


# -- versions --------------------------------------------------------------------------------


def entity_versions(entity_source: DataFrame, source_meta: DataFrame, entity, source: str, version: str) -> DataFrame:
    """Distinct (entity, version) pairs through the sources' metadata; unknown and zero versions drop out.

    A source has one version."""
    pairs = entity_source.select(*entity, source).distinct()
    meta = source_meta.where(F.col(version) != 0).groupBy(source).agg(F.max(version).alias(version))
    return skew.null_safe_join(pairs, meta, [source], "inner").select(*entity, version).distinct()


def supported_versions(entity_source: DataFrame, source_meta: DataFrame, entity, source: str, version: str, keep_empty=True) -> DataFrame:
    """Per entity: lowest version, how many versions and how many sources.

    ``keep_empty=False`` leaves out entities without a known version. The sets themselves are the
    tables of :func:`entity_versions` and :func:`members`.
    """
    versions = entity_versions(entity_source, source_meta, entity, source, version).groupBy(*entity).agg(
        F.min(version).alias("min_version"), F.max(version).alias("max_version"), F.count(F.lit(1)).alias("version_count")
    )
    sources = members(entity_source, entity, source).groupBy(*entity).agg(F.count(F.lit(1)).alias("source_count"))
    joined = skew.null_safe_join(sources, versions, entity, "left" if keep_empty else "inner")
    return joined.withColumn("version_count", F.coalesce("version_count", F.lit(0).cast("bigint")))


# -- variants --------------------------------------------------------------------------------


def find_variants(messages: DataFrame, families: DataFrame, name="name") -> DataFrame:
    """Messages named base + suffix of a family, with the family's columns.

    ``families``: base_name, variant, suffix, value, position. The discriminator is the family's
    value, else the one read from ``discriminator_text`` if the messages have it.
    """
    named = families.withColumn("_name", F.concat("base_name", "suffix"))
    found = messages.join(named, messages[name] == named["_name"]).drop("_name")
    read = n.discriminator_value("discriminator_text") if "discriminator_text" in messages.columns else F.lit(None)
    return found.withColumn("discriminator", F.coalesce(F.col("value").cast("bigint"), read.cast("bigint"))).drop("value")


def variant_order(variants: DataFrame) -> DataFrame:
    """Variants of each base numbered by discriminator; unknown ones last, then family order."""
    rank = [F.coalesce("discriminator", F.lit(999).cast("bigint")).alias("_d"), F.col("position")]
    numbered = variants.withColumn("_d", rank[0])
    before = skew.ordered(numbered, ["base_name"], ["_d", "position"], {"_n": ("sum_before", F.lit(1).cast("bigint"))})
    return before.withColumn("variant_index", F.coalesce("_n", F.lit(0).cast("bigint"))).drop("_n", "_d")


def consolidate(messages: DataFrame, families: DataFrame, name="name", message_type="message_type"):
    """Parents instead of suffix-named messages: (messages with parents, variants, aliases)."""
    variants = variant_order(find_variants(messages, families, name))
    parents = variants.groupBy("base_name").agg(
        F.min_by(F.coalesce(message_type, F.lit("input")), "position").alias(message_type),
        F.count(F.lit(1)).alias("variant_count"),
    )
    kept = messages.join(variants.select(F.col(name)).distinct(), name, "left_anti").select(
        name, message_type, F.lit(0).cast("bigint").alias("variant_count")
    )
    merged = kept.unionByName(parents.withColumnRenamed("base_name", name))
    aliases = families.join(parents, "base_name", "left_semi").select(
        "base_name", F.concat("base_name", "suffix").alias("alias")
    )
    return merged, variants, aliases


def expand_variants(names: DataFrame, variants: DataFrame, name: str, parent: str, variant: str) -> DataFrame:
    """Replace a parent by its variants; other names stay."""
    dim = variants.select(F.col(parent).alias("_parent"), F.col(variant).alias("_variant")).distinct()
    joined = names.join(dim, F.col(name).eqNullSafe(F.col("_parent")), "left")
    return joined.withColumn(name, F.coalesce("_variant", name)).drop("_parent", "_variant")


# -- patches ---------------------------------------------------------------------------------


def patch(df: DataFrame, patches: DataFrame, key, columns) -> DataFrame:
    """Replace ``columns`` where a patch has a value; ``patched`` tells which rows changed."""
    new = patches.select(*key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = skew.null_safe_join(df, new, key, "left")
    changed = F.lit(False)
    for c in columns:
        changed = changed | (F.col(f"_new_{c}").isNotNull() & ~F.col(f"_new_{c}").eqNullSafe(F.col(c)))
    joined = joined.withColumn("patched", changed)
    for c in columns:
        joined = joined.withColumn(c, F.coalesce(f"_new_{c}", c))
    return joined.select(*df.columns, "patched")


def replace_lists(current: DataFrame, extracted: DataFrame, key, item: str) -> DataFrame:
    """Child lists in which a key's list is replaced when the extracted one adds an item."""
    added = skew.null_safe_join(extracted, current.select(*key, item).distinct(), [*key, item], "left_anti")
    replaced = added.select(*key).distinct()
    kept = skew.null_safe_join(current, replaced, key, "left_anti").withColumn("replaced", F.lit(False))
    fresh = skew.null_safe_join(extracted, replaced, key, "left_semi").withColumn("replaced", F.lit(True))
    return kept.unionByName(fresh.select(*kept.columns[:-1], "replaced"))
