"""Majority voting over many sources that describe one entity.

Every vote is two aggregations: (entity, value) first, then entity. Both combine before the
shuffle, so an entity with a third of all rows reaches its reducer as a few partial counts.
``order`` names the columns that define which row was seen first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import cut_lineage
from . import skew


def _check(threshold: float, min_sources: int) -> None:
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be between 0 and 1")
    if min_sources < 1:
        raise ValueError("min_sources must be at least 1")


def tally(df: DataFrame, entity, value: str, order, *extra: Column) -> DataFrame:
    """Rows per (entity, value): ``n`` and ``first`` (the smallest order tuple)."""
    if not order:
        raise ValueError("a vote needs order columns to settle ties")
    # One order column keeps its own type in the aggregation buffer, which can then be hashed.
    first = F.min(order[0]) if len(order) == 1 else F.min(F.struct(*order))
    counted = df.groupBy(*entity, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("n"), first.alias("first"), *extra)
    return counted.withColumn("first", F.struct(F.col("first").alias(order[0]))) if len(order) == 1 else counted


def _winner(struct: Column) -> Column:
    return F.min_by(struct, F.struct(-F.col("n"), F.col("first"), F.col("_value")))


def decide(tallies: DataFrame, entity, *extra: Column) -> DataFrame:
    """Winner and counts per entity, from a tally."""
    won = tallies.groupBy(*entity).agg(
        _winner(F.struct("_value", "n", "first")).alias("_w"),
        F.sum("n").alias("total_count"),
        F.count(F.lit(1)).alias("unique_values"),
        *extra,
    )
    return won.select(
        *entity,
        F.col("_w._value").alias("winning_value"),
        F.col("_w.n").alias("agreement_count"),
        F.col("_w.first").alias("winning_order"),
        *[c for c in won.columns if c not in (*entity, "_w")],
        (F.col("_w.n") / F.col("total_count")).alias("agreement_ratio"),
    )


def confidence(ratio, total, threshold=fixed.THRESHOLD, min_sources=fixed.MIN_SOURCES) -> Column:
    enough = total >= min_sources
    return (
        F.when(total == 1, F.lit("single_source"))
        .when((ratio >= fixed.HIGH_RATIO) & enough, F.lit("high"))
        .when((ratio >= threshold) & enough, F.lit("medium"))
        .when(ratio >= threshold, F.lit("low"))
        .otherwise(F.lit("no_consensus"))
    )


def confidence_score(label, ratio) -> Column:
    return (
        F.when(label == "single_source", F.lit(0.5))
        .when(label == "high", ratio)
        .when(label == "medium", ratio * 0.9)
        .when(label == "low", ratio * 0.7)
        .otherwise(ratio * 0.5)
    )


def confidence_rank(label) -> Column:
    out = F.lit(None).cast("int")
    for rank, name in enumerate(fixed.CONFIDENCE_ORDER):
        out = F.when(label == name, F.lit(rank)).otherwise(out)
    return out


def vote(df: DataFrame, entity, value: str, order, threshold=fixed.THRESHOLD, min_sources=fixed.MIN_SOURCES) -> DataFrame:
    """Consensus per entity: winner, counts, confidence label and score."""
    _check(threshold, min_sources)
    result = decide(tally(df, entity, value, order), entity)
    ratio, total = F.col("agreement_ratio"), F.col("total_count")
    result = result.withColumn("confidence", confidence(ratio, total, threshold, min_sources))
    return result.withColumn("confidence_score", confidence_score(F.col("confidence"), ratio)).withColumn(
        "has_consensus", (total == 1) | (ratio >= threshold)
    )


def preliminary(df: DataFrame, entity, value: str, order, threshold=fixed.THRESHOLD) -> DataFrame:
    """First-pass vote: status single_source, unanimous, majority or split."""
    _check(threshold, 1)
    result = decide(tally(df, entity, value, order), entity)
    ratio = F.col("agreement_ratio")
    status = (
        F.when(F.col("total_count") == 1, F.lit("single_source"))
        .when(ratio == 1.0, F.lit("unanimous"))
        .when(ratio >= threshold, F.lit("majority"))
        .otherwise(F.lit("split"))
    )
    return result.withColumn("status", status)


def filter_consensus(votes: DataFrame, require=True, min_confidence: str | None = None) -> DataFrame:
    if min_confidence is not None and min_confidence not in fixed.CONFIDENCE_ORDER:
        raise ValueError(f"unknown confidence level {min_confidence!r}")
    out = votes.where("has_consensus") if require else votes
    if min_confidence:
        floor = fixed.CONFIDENCE_ORDER.index(min_confidence)
        out = out.where(confidence_rank(F.col("confidence")) >= floor)
    return out


def summary(votes: DataFrame, by=(), threshold=fixed.THRESHOLD) -> DataFrame:
    """Groups by level of agreement, over all groups or per ``by`` columns."""
    single, agreed = F.col("total_count") == 1, F.col("unique_values") == 1
    partial = F.col("agreement_ratio") >= threshold
    return votes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_groups"),
        F.coalesce(F.sum("total_count"), F.lit(0)).alias("total_instances"),
        F.count_if(~single & agreed).alias("full_agreement"),
        F.count_if(~single & ~agreed & partial).alias("partial_agreement"),
        F.count_if(~single & ~agreed & ~partial).alias("no_consensus"),
        F.count_if(single).alias("single_source"),
    )


def ballots(df: DataFrame, votes: DataFrame, entity, value: str) -> DataFrame:
    """Every source row with the winner of its entity and ``agrees``.

    This long table is the list of agreeing and disagreeing sources; it has no size limit.
    """
    joined = skew.null_safe_join(df, votes.select(*entity, "winning_value"), entity, "inner")
    return joined.withColumn("agrees", F.col(value).eqNullSafe(F.col("winning_value")))


def outliers(df: DataFrame, votes: DataFrame, entity, value: str) -> DataFrame:
    return ballots(df, votes, entity, value).where(~F.col("agrees")).drop("agrees")


def with_winning_row(votes: DataFrame, df: DataFrame, entity, order, payload) -> DataFrame:
    """Attach columns of the winning source's row; the join key includes the order columns."""
    flat = votes.select("*", *[F.col("winning_order")[c].alias(c) for c in order])
    return skew.null_safe_join(flat, df.select(*entity, *order, *payload), [*entity, *order], "left").drop(*order)


# -- reviewed extractions --------------------------------------------------------------------

NOT_REVIEWED, UNKNOWN = "not_reviewed", "unknown"


def review_columns(review: str, original: str) -> dict[str, Column]:
    """Verdict, confidence and final structure of a review struct<verdict, confidence, corrected_structure>."""
    r, has = F.col(review), F.col(review).isNotNull()
    corrected = F.when(F.length(F.trim(r["corrected_structure"])) > 2, r["corrected_structure"])
    final = F.coalesce(corrected, F.col(original))
    listed = F.try_parse_json(final)
    first = F.coalesce(F.to_json(F.try_variant_get(listed, "$[0]", "variant")), F.lit("{}"))
    return {
        "verdict": F.when(has, F.coalesce(r["verdict"], F.lit(UNKNOWN))).otherwise(F.lit(NOT_REVIEWED)),
        "review_confidence": F.when(has, F.coalesce(r["confidence"], F.lit(UNKNOWN))).otherwise(F.lit(UNKNOWN)),
        "final_structure": F.when(F.ltrim(final).startswith("["), first).otherwise(final),
    }


def determine(reviews: DataFrame, entity, value: str, verdict: str, order, review_confidence: str | None = None) -> DataFrame:
    """Final decision per entity from reviewed rows; ``value`` fingerprints the final structure."""
    low = F.lit(False) if review_confidence is None else F.col(review_confidence) == "low"
    tallies = tally(
        reviews, entity, value, order,
        F.count_if(F.col(verdict) != NOT_REVIEWED).alias("reviewed"),
        F.count_if(F.col(verdict) == "extraction_error").alias("corrected"),
        F.count_if(F.col(verdict).isin("valid_change", "version_bump")).alias("variation"),
        F.count_if(low).alias("low_confidence"),
    )
    sums = [F.sum(c).alias(c) for c in ("reviewed", "corrected", "variation", "low_confidence")]
    result = decide(tallies, entity, *sums)
    agreed, ratio = F.col("unique_values") == 1, F.col("agreement_ratio")
    varied, major = F.col("variation") > 0, ratio >= fixed.THRESHOLD
    decision = (
        F.when(agreed & (F.col("corrected") > 0), F.lit("accepted_with_corrections"))
        .when(agreed, F.lit("accepted"))
        .when(varied, F.lit("valid_variations"))
        .when(major, F.lit("accepted_with_corrections"))
        .otherwise(F.lit("needs_manual_review"))
    )
    level = (
        F.when(agreed, F.when(F.col("agreement_count") >= fixed.MIN_SOURCES, F.lit("high")).otherwise(F.lit("medium")))
        .when(varied, F.lit("medium"))
        .when(major & (ratio >= fixed.HIGH_RATIO), F.lit("medium"))
        .otherwise(F.lit("low"))
    )
    settled = F.col("decision").isin("accepted", "accepted_with_corrections")
    return (
        result.withColumn("decision", decision)
        .withColumn("confidence", level)
        .withColumn("final_value", F.when(settled, F.col("winning_value")))
    )


def variations(reviews: DataFrame, decisions: DataFrame, entity, value: str, verdict: str, order, decision="valid_variations") -> DataFrame:
    """The distinct final structures of entities with one decision, with sources counted.

    With ``decision='needs_manual_review'`` these rows are the unresolved issues.
    """
    forms = tally(reviews, entity, value, order, F.min_by(verdict, F.struct(*order)).alias("verdict"))
    chosen = decisions.where(F.col("decision") == decision).select(*entity)
    return skew.null_safe_join(forms, chosen, entity, "left_semi").withColumnRenamed("_value", "value")


# -- incremental consensus -------------------------------------------------------------------


def new_members(members: DataFrame, canonical: DataFrame, new: DataFrame, entity, source: str, value: str, order) -> DataFrame:
    """Rows of ``new`` that change the state: one per (entity, source, agrees) not yet a member.

    The first row of an entity that ``canonical`` does not have becomes its fingerprint.
    """
    rows = new.select(*entity, F.col(source).alias("source"), F.col(value).alias("fingerprint"), *order)
    known = canonical.select(*entity, F.col("fingerprint").alias("_fp"))
    firsts = rows.groupBy(*entity).agg(F.min_by("fingerprint", F.struct(*order, "source")).alias("_fp"))
    unseen = skew.null_safe_join(firsts, known, entity, "left_anti")
    judged = skew.null_safe_join(rows, known.unionByName(unseen), entity, "inner").withColumn(
        "agrees", F.col("fingerprint").eqNullSafe(F.col("_fp"))
    )
    once = judged.groupBy(*entity, "source", "agrees").agg(
        F.min_by(F.struct("fingerprint", *order), F.struct(*order)).alias("_r")
    )
    once = once.select(*entity, "source", "agrees", "_r.*")
    return skew.null_safe_join(once, members, [*entity, "source", "agrees"], "left_anti")


def fold(canonical: DataFrame, added: DataFrame, entity, order, compat=True) -> DataFrame:
    """The canonical rows after ``added`` (of :func:`new_members`) has come in."""
    state = ["fingerprint", "agreement_count", "total_count", "confidence", "confidence_score"]
    one = F.lit(1).cast("bigint")
    agrees = F.col("agrees").cast("bigint")
    # Counts after each arrival, so that the label of the last agreeing arrival can be found.
    counts = {"_agreed_before": ("sum_before", agrees), "_seen_before": ("sum_before", one)}
    arrivals = skew.ordered(added, entity, [*order, "source"], counts)
    base = canonical.select(*entity, F.col("agreement_count").alias("_a0"), F.col("total_count").alias("_t0"))
    arrivals = skew.null_safe_join(arrivals, base, entity, "left")
    agreed = F.coalesce("_a0", F.lit(0)) + F.coalesce("_agreed_before", F.lit(0)) + agrees
    seen = F.coalesce("_t0", F.lit(0)) + F.coalesce("_seen_before", F.lit(0)) + one
    # The first row of an unseen entity is its start, not an update.
    updating = F.col("_t0").isNotNull() | F.col("_seen_before").isNotNull()
    label = confidence(agreed / seen, seen)
    labelled = updating & F.col("agrees") & (agreed / seen >= fixed.THRESHOLD)
    sequence = F.struct(*order, "source")
    changes = arrivals.groupBy(*entity).agg(
        F.count_if("agrees").alias("_agreed"),
        F.count(F.lit(1)).alias("_seen"),
        F.max_by(label, F.when(labelled, sequence)).alias("_label"),
        F.min_by("fingerprint", sequence).alias("_first"),
    )
    held = canonical.select(*entity, F.struct(*state).alias("_old"))
    both = held.withColumnsRenamed({k: f"_k_{k}" for k in entity}).join(
        changes, [F.col(f"_k_{k}").eqNullSafe(F.col(k)) for k in entity], "full_outer"
    )
    keys = [F.coalesce(F.col(f"_k_{k}"), F.col(k)).alias(k) for k in entity]
    total = F.coalesce(F.col("_old.total_count"), F.lit(0)) + F.coalesce("_seen", F.lit(0))
    agreement = F.coalesce(F.col("_old.agreement_count"), F.lit(0)) + F.coalesce("_agreed", F.lit(0))
    ratio = agreement / total
    grown = F.col("_seen").isNotNull() & (total > 1)
    if compat:
        new_label = F.coalesce("_label", F.col("_old.confidence"), F.lit("single_source"))
        new_score = F.when(grown, F.bround(ratio, 3)).otherwise(F.coalesce(F.col("_old.confidence_score"), F.lit(0.5)))
    else:
        new_label = confidence(ratio, total)
        new_score = confidence_score(new_label, ratio)
    return both.select(
        *keys,
        F.coalesce(F.col("_old.fingerprint"), F.col("_first")).alias("fingerprint"),
        agreement.alias("agreement_count"),
        total.alias("total_count"),
        new_label.alias("confidence"),
        new_score.alias("confidence_score"),
    )


def incremental(canonical: DataFrame, members: DataFrame, new: DataFrame, entity, source: str, value: str, order, compat=True):
    """Fold new sources into a canonical table; returns (canonical, members).

    ``canonical``: entity.., fingerprint, agreement_count, total_count, confidence, confidence_score.
    ``members``: entity.., source, agrees, fingerprint. With ``compat`` a label is only set when a
    source agrees and the ratio then is at least the threshold, and the score is the bare ratio;
    otherwise both are computed as in :func:`vote`.
    """
    added = cut_lineage(new_members(members, canonical, new, entity, source, value, order))
    return fold(canonical, added, entity, order, compat), members.unionByName(added.select(*members.columns))
