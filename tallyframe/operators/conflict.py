"""Attribute-level conflicts: detection, the queue of open ones, and applying decisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from . import skew

DASH_CONFIDENCE = 0.9


@dataclass(frozen=True)
class Attribute:
    """How one attribute is compared.

    ``skip_blank`` leaves out null and empty values, ``prefer_value`` prefers a value over '-',
    ``misread`` notes types read with a digit for a letter; ``reason`` and ``sure_reason`` word
    the conflict below and from the review threshold on.
    """

    name: str
    skip_blank: bool = False
    prefer_value: bool = False
    misread: bool = False
    reason: str = fixed.CONFLICT_OTHER
    sure_reason: str | None = None


KEY_ATTRIBUTES = [
    Attribute("name", reason=fixed.CONFLICT_NAME, sure_reason=fixed.CONFLICT_NAME_SURE),
    Attribute("data_type", misread=True, reason=fixed.CONFLICT_TYPE),
    Attribute("scale", skip_blank=True, prefer_value=True, reason=fixed.CONFLICT_SCALE),
    Attribute("unit", skip_blank=True, prefer_value=True, reason=fixed.CONFLICT_UNIT),
]


def candidates(df: DataFrame, entity, attributes, order) -> DataFrame:
    """Rows per (entity, field, value): ``n`` and ``first``, one pass over all attributes."""
    entries = []
    for a in attributes:
        value = F.col(a.name).cast("string")
        keep = (value.isNotNull() & (value != "")) if a.skip_blank else F.lit(True)
        entries.append(F.when(keep, F.struct(F.lit(a.name).alias("field"), value.alias("value"))))
    long = df.select(*entity, *order, F.explode(F.array_compact(F.array(*entries))).alias("_e"))
    return long.groupBy(*entity, "_e.field", "_e.value").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first")
    )


def candidate_sources(df: DataFrame, entity, attributes, source: str) -> DataFrame:
    """The sources behind each candidate value, one row each."""
    entries = [F.struct(F.lit(a.name).alias("field"), F.col(a.name).cast("string").alias("value")) for a in attributes]
    return df.select(*entity, source, F.inline(F.array(*entries)))


def detect(df: DataFrame, entity, attributes, order, threshold=fixed.THRESHOLD) -> DataFrame:
    """Attributes with more than one value: the suggested value, its confidence and reason."""
    found = candidates(df, entity, attributes, order)
    value, rank = F.col("value"), F.struct(-F.col("n"), F.col("first"), F.col("value"))
    wrong, right = list(fixed.TYPE_REPAIRS), list(fixed.TYPE_REPAIRS.values())
    grouped = found.groupBy(*entity, "field").agg(
        F.min_by(F.struct("value", "n"), rank).alias("_w"),
        F.min_by("value", F.when(~value.eqNullSafe("-"), rank)).alias("_value"),
        F.max(value.eqNullSafe("-")).alias("_dash"),
        (F.max(value.isin(wrong)) & F.max(value.isin(right))).alias("_misread"),
        F.sum("n").alias("instance_count"),
        F.count(F.lit(1)).alias("candidate_count"),
    )
    flags = {f: [a.name for a in attributes if getattr(a, f)] for f in ("prefer_value", "misread")}
    field = F.col("field")
    dash_won = field.isin(flags["prefer_value"]) & F.col("_w.value").eqNullSafe("-") & F.col("_value").isNotNull()
    reason, sure = F.lit(None).cast("string"), F.lit(None).cast("string")
    for a in attributes:
        reason = F.when(field == a.name, F.lit(a.reason)).otherwise(reason)
        if a.sure_reason:
            sure = F.when(field == a.name, F.lit(a.sure_reason)).otherwise(sure)
    reason = (
        F.when(field.isin(flags["misread"]) & F.col("_misread"), F.lit(fixed.CONFLICT_MISREAD))
        .when(field.isin(flags["prefer_value"]) & F.col("_dash"), F.concat(reason, F.lit(fixed.CONFLICT_PREFER_VALUE)))
        .when(F.col("confidence") >= threshold, F.coalesce(sure, reason))
        .otherwise(reason)
    )
    return (
        grouped.where(F.col("candidate_count") > 1)
        .withColumn("suggested", F.when(dash_won, F.col("_value")).otherwise(F.col("_w.value")))
        .withColumn(
            "confidence",
            F.when(dash_won, F.lit(DASH_CONFIDENCE)).otherwise(F.col("_w.n") / F.col("instance_count")),
        )
        .withColumn("reason", reason)
        .withColumn("needs_review", F.col("confidence") < threshold)
        .drop("_w", "_value", "_dash", "_misread")
    )


def list_conflicts(children: DataFrame, entity, source, item, body) -> DataFrame:
    """Entities whose child lists (enumeration values, bits) differ between sources.

    Each source's list is compared by sums of its item hashes, so no list is gathered.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*item, *body)])
    digest = F.sha2(text, 256)
    parts = [
        F.sum(F.conv(F.substring("_h", s, 15), 16, 10).cast("decimal(38,0)")).cast("string") for s in (1, 16, 31, 46)
    ]
    per_source = children.withColumn("_h", digest).groupBy(*entity, *source).agg(
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), *parts).alias("_list")
    )
    distinct = per_source.groupBy(*entity, "_list").agg(F.count(F.lit(1)).alias("_n"))
    lists = distinct.groupBy(*entity).agg(F.sum("_n").alias("source_count"), F.count(F.lit(1)).alias("list_count"))
    return lists.where(F.col("list_count") > 1)


def merged_lists(children: DataFrame, entity, item, body, order, keep="last") -> DataFrame:
    """Union of child lists by item; the first or the last definition of an item stays."""
    pick = F.max_by if keep == "last" else F.min_by
    return children.groupBy(*entity, *item).agg(pick(F.struct(*body), F.struct(*order)).alias("_b")).select(
        *entity, *item, "_b.*"
    )


def queue(conflicts: DataFrame) -> DataFrame:
    """Conflicts that need a decision."""
    return conflicts.where("needs_review").withColumn("decision", F.lit(None).cast("string"))


def conflict_summary(conflicts: DataFrame) -> DataFrame:
    """Conflicts by attribute, with how many need review and how many settle themselves."""
    return conflicts.groupBy("field").agg(
        F.count(F.lit(1)).alias("conflicts"),
        F.count_if("needs_review").alias("needs_review"),
        F.count_if(~F.col("needs_review")).alias("auto_resolvable"),
    )


def conflict_totals(conflicts: DataFrame, entity) -> DataFrame:
    per_entity = conflicts.groupBy(*entity).agg(
        F.count(F.lit(1)).alias("_c"), F.count_if("needs_review").alias("_r")
    )
    return per_entity.agg(
        F.count(F.lit(1)).alias("entities_with_conflicts"),
        F.coalesce(F.sum("_c"), F.lit(0)).alias("total_conflicts"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("needs_review"),
        F.coalesce(F.sum(F.col("_c") - F.col("_r")), F.lit(0)).alias("auto_resolvable"),
    )


def record_decisions(queued: DataFrame, decisions: DataFrame, key) -> DataFrame:
    """Write decisions back on the queue, matched on (key, field) so that two fields of a key stay apart."""
    return skew.null_safe_join(queued.drop("decision"), decisions.select(*key, "field", "decision"), [*key, "field"], "left")


def decision_changes(registry: DataFrame, decisions: DataFrame, key, fields) -> DataFrame:
    """Decided items as ``status`` changed, skipped (already that value) or not_found, old and new value."""
    decided = decisions.where(F.col("decision").isNotNull())
    held = registry.select(*key, F.map_from_arrays(
        F.array(*[F.lit(f) for f in fields]), F.array(*[F.col(f).cast("string") for f in fields])
    ).alias("_held"))
    joined = skew.null_safe_join(decided, held, key, "left")
    old = F.try_element_at("_held", F.col("field"))
    status = (
        F.when(F.col("_held").isNull(), F.lit("not_found"))
        .when(old.eqNullSafe(F.col("decision")), F.lit("skipped"))
        .otherwise(F.lit("changed"))
    )
    return joined.select(
        *decided.columns, status.alias("status"), old.alias("old_value"), F.col("decision").alias("new_value")
    )


def apply_decisions(registry: DataFrame, decisions: DataFrame, key, fields, order) -> DataFrame:
    """The registry with decided values; of several decisions on one (key, field) the last stays."""
    decided = decisions.where(F.col("decision").isNotNull())
    last = [
        F.max_by("decision", F.when(F.col("field") == f, F.struct(*order))).alias(f"_new_{f}") for f in fields
    ]
    wide = decided.groupBy(*key).agg(*last)
    joined = skew.null_safe_join(registry, wide, key, "left")
    types = dict(registry.dtypes)
    for f in fields:
        joined = joined.withColumn(f, F.coalesce(F.col(f"_new_{f}").try_cast(types[f]), F.col(f)))
    return joined.select(*registry.columns)


def decision_rollup(adjudications: DataFrame, by, decision="decision") -> DataFrame:
    kinds = ["fix_canonical", "valid_variation", "needs_human"]
    return adjudications.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(decision) == k).alias(k) for k in kinds]
    )
