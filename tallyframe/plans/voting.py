"""Votes over orders, lines and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import collection, rules, skew, vote
from ..sources import writers
from ..session import cut_lineage
from .base import query, table

LINE_ORDER = ["l_shipdate", "l_linenumber"]

LABELS = """
    CASE WHEN total_count = 1 THEN 'single_source'
         WHEN ratio >= 0.9 AND total_count >= 3 THEN 'high'
         WHEN ratio >= 0.75 AND total_count >= 3 THEN 'medium'
         WHEN ratio >= 0.75 THEN 'low' ELSE 'no_consensus' END"""
SCORE = """
    CASE confidence WHEN 'single_source' THEN 0.5 WHEN 'high' THEN ratio
         WHEN 'medium' THEN ratio * 0.9 WHEN 'low' THEN ratio * 0.7 ELSE ratio * 0.5 END"""
VOTES = f"""
WITH tally AS (
    SELECT l_orderkey, l_linestatus AS v, count(*) AS n,
           min(struct_pack(a := l_shipdate, b := l_linenumber)) AS f
    FROM lineitem GROUP BY ALL),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, f, v) AS r,
           sum(n) OVER (PARTITION BY l_orderkey) AS total_count,
           count(*) OVER (PARTITION BY l_orderkey) AS unique_values
    FROM tally),
won AS (
    SELECT l_orderkey, v AS winning_value, n AS agreement_count, CAST(total_count AS BIGINT) AS total_count,
           unique_values, n / total_count AS ratio FROM ranked WHERE r = 1),
labelled AS (SELECT *, {LABELS} AS confidence FROM won),
votes AS (SELECT *, {SCORE} AS score, (total_count = 1 OR ratio >= 0.75) AS has_consensus FROM labelled)
"""


def line_votes(spark, folder):
    return vote.vote(table(spark, folder, "lineitem"), ["l_orderkey"], "l_linestatus", LINE_ORDER)


def _shown(votes):
    return votes.select(
        "l_orderkey", "winning_value", "agreement_count", "total_count", "unique_values", "confidence",
        F.round("confidence_score", 6).alias("confidence_score"), "has_consensus",
    )


SHOWN = """l_orderkey, winning_value, agreement_count, total_count, unique_values, confidence,
    round(score, 6) AS confidence_score, has_consensus"""


@query(VOTES + f"SELECT {SHOWN} FROM votes")
def vote_consensus(spark, folder):
    return _shown(line_votes(spark, folder))


@query(VOTES + f"SELECT {SHOWN} FROM votes WHERE has_consensus AND confidence IN ('medium', 'high')")
def consensus_filter(spark, folder):
    return _shown(vote.filter_consensus(line_votes(spark, folder), True, "medium"))


@query(VOTES + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, winning_value
FROM lineitem JOIN votes USING (l_orderkey) WHERE l_linestatus <> winning_value""")
def vote_outliers(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus")
    return vote.outliers(lines, line_votes(spark, folder), ["l_orderkey"], "l_linestatus")


@query(VOTES + """
SELECT l_orderkey, count(*) FILTER (l_linestatus = winning_value) AS agreeing,
       count(*) FILTER (l_linestatus <> winning_value) AS disagreeing, count(DISTINCT l_suppkey) AS sources
FROM lineitem JOIN votes USING (l_orderkey) GROUP BY l_orderkey""")
def vote_ballots(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_linestatus")
    ballots = vote.ballots(lines, line_votes(spark, folder), ["l_orderkey"], "l_linestatus")
    per_source = ballots.groupBy("l_orderkey", "l_suppkey").agg(
        F.count_if("agrees").alias("a"), F.count_if(~F.col("agrees")).alias("d")
    )
    return per_source.groupBy("l_orderkey").agg(
        F.sum("a").alias("agreeing"), F.sum("d").alias("disagreeing"), F.count(F.lit(1)).alias("sources")
    )


@query("""
WITH p AS (SELECT l_orderkey, l_linestatus, l_shipdate, l_linenumber, l_partkey, l_suppkey,
    row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS k,
    count(*) OVER (PARTITION BY l_orderkey, l_linestatus) AS n FROM lineitem),
w AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_shipdate, l_linenumber, l_partkey, l_suppkey) AS r FROM p WHERE k = 1)
SELECT l_orderkey, l_linestatus AS winning_value, l_partkey AS winning_part, l_suppkey AS winning_supplier FROM w WHERE r = 1""")
def winning_source(spark, folder):
    lines = table(spark, folder, "lineitem")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    votes = vote.vote(lines, ["l_orderkey"], "l_linestatus", order)
    return votes.select(
        "l_orderkey", "winning_value",
        F.col("winning_order.l_partkey").alias("winning_part"), F.col("winning_order.l_suppkey").alias("winning_supplier"),
    )


@query(VOTES + """
SELECT count(*) AS total_groups, CAST(sum(total_count) AS BIGINT) AS total_instances,
    count(*) FILTER (total_count > 1 AND unique_values = 1) AS full_agreement,
    count(*) FILTER (total_count > 1 AND unique_values > 1 AND ratio >= 0.75) AS partial_agreement,
    count(*) FILTER (total_count > 1 AND unique_values > 1 AND ratio < 0.75) AS no_consensus,
    count(*) FILTER (total_count = 1) AS single_source FROM votes""")
def group_summary(spark, folder):
    return vote.summary(line_votes(spark, folder))


@query(VOTES + """
SELECT count(*) AS total, count(*) FILTER (has_consensus) AS with_consensus,
    count(*) FILTER (NOT has_consensus) AS without_consensus,
    count(*) FILTER (confidence = 'no_consensus') AS no_consensus,
    count(*) FILTER (confidence = 'single_source') AS single_source,
    count(*) FILTER (confidence = 'low') AS low, count(*) FILTER (confidence = 'medium') AS medium,
    count(*) FILTER (confidence = 'high') AS high,
    CAST(sum(total_count - agreement_count) AS BIGINT) AS total_outliers,
    round_even(avg(score), 3) AS average_confidence_score FROM votes""")
def validation_report(spark, folder):
    return rules.validation_summary(line_votes(spark, folder))


@query(VOTES + """
SELECT l_orderkey, has_consensus, confidence, round_even(score, 3) AS confidence_score, winning_value AS fingerprint,
    agreement_count || '/' || total_count AS agreement, total_count - agreement_count AS outlier_count
FROM votes WHERE agreement_count < total_count OR NOT has_consensus""")
def discrepancy_report(spark, folder):
    return rules.serialized(rules.problem_votes(line_votes(spark, folder)), ["l_orderkey"])


@query(VOTES + """
SELECT count(*) AS total_with_issues, CAST(sum(total_count - agreement_count) AS BIGINT) AS total_outliers,
    count(*) FILTER (NOT has_consensus) AS no_consensus_count
FROM votes WHERE agreement_count < total_count OR NOT has_consensus""")
def discrepancy_summary(spark, folder):
    return rules.discrepancy_summary(line_votes(spark, folder))


@query(VOTES + "SELECT l_orderkey, winning_value, total_count FROM votes WHERE NOT has_consensus ORDER BY l_orderkey LIMIT 10")
def without_consensus(spark, folder):
    top = rules.without_consensus(line_votes(spark, folder), ["l_orderkey"], 10)
    return top.select("l_orderkey", "winning_value", "total_count")


@query(VOTES + """
SELECT count(*) FILTER (has_consensus AND confidence IN ('medium', 'high')) AS written,
    count(*) FILTER (NOT has_consensus) AS skipped_no_consensus,
    count(*) FILTER (has_consensus AND confidence NOT IN ('medium', 'high')) AS skipped_low_confidence FROM votes""")
def canonical_counters(spark, folder):
    return writers.canonical_counters(line_votes(spark, folder), True, "medium")


PRELIMINARY = """
WITH tally AS (SELECT o_custkey, o_orderstatus AS v, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) AS r,
    CAST(sum(n) OVER (PARTITION BY o_custkey) AS BIGINT) AS total_count FROM tally),
prelim AS (SELECT o_custkey, v AS winning_value, n AS agreement_count, total_count, n / total_count AS ratio,
    CASE WHEN total_count = 1 THEN 'single_source' WHEN n = total_count THEN 'unanimous'
         WHEN n / total_count >= 0.75 THEN 'majority' ELSE 'split' END AS status FROM ranked WHERE r = 1)
"""


def order_votes(spark, folder):
    return vote.preliminary(table(spark, folder, "orders"), ["o_custkey"], "o_orderstatus", ["o_orderkey"])


@query(PRELIMINARY + "SELECT o_custkey, winning_value, agreement_count, total_count, round(ratio, 6) AS agreement_ratio, status FROM prelim")
def vote_preliminary(spark, folder):
    return order_votes(spark, folder).select(
        "o_custkey", "winning_value", "agreement_count", "total_count",
        F.round("agreement_ratio", 6).alias("agreement_ratio"), "status",
    )


@query(PRELIMINARY + "SELECT status, count(*) AS messages FROM prelim GROUP BY status")
def preliminary_summary(spark, folder):
    return order_votes(spark, folder).groupBy("status").agg(F.count(F.lit(1)).alias("messages"))


# -- reviewed rows ---------------------------------------------------------------------------

REVIEWS = """
WITH reviews AS (SELECT user_id, event_type, event_id, CAST(floor(value / 20) AS BIGINT) AS form,
    CASE WHEN k < 60 THEN 'correct' WHEN k < 75 THEN 'extraction_error' WHEN k < 85 THEN 'valid_change'
         WHEN k < 90 THEN 'version_bump' ELSE 'not_reviewed' END AS verdict
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)),
forms AS (SELECT user_id, event_type, form, count(*) AS n, min(event_id) AS f, arg_min(verdict, event_id) AS first_verdict,
    count(*) FILTER (verdict <> 'not_reviewed') AS reviewed,
    count(*) FILTER (verdict = 'extraction_error') AS corrected,
    count(*) FILTER (verdict IN ('valid_change', 'version_bump')) AS variation FROM reviews GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER w AS r FROM forms WINDOW w AS (PARTITION BY user_id, event_type ORDER BY n DESC, f)),
sums AS (SELECT user_id, event_type, max(form) FILTER (r = 1) AS winner, max(n) FILTER (r = 1) AS agreement_count,
    CAST(sum(n) AS BIGINT) AS total_count, count(*) AS unique_values, CAST(sum(reviewed) AS BIGINT) AS reviewed,
    sum(corrected) AS corrected, sum(variation) AS variation FROM ranked GROUP BY ALL),
decided AS (SELECT *, CASE WHEN unique_values = 1 AND corrected > 0 THEN 'accepted_with_corrections'
        WHEN unique_values = 1 THEN 'accepted' WHEN variation > 0 THEN 'valid_variations'
        WHEN agreement_count / total_count >= 0.75 THEN 'accepted_with_corrections'
        ELSE 'needs_manual_review' END AS decision,
    CASE WHEN unique_values = 1 THEN CASE WHEN agreement_count >= 3 THEN 'high' ELSE 'medium' END
        WHEN variation > 0 THEN 'medium' WHEN agreement_count / total_count >= 0.9 THEN 'medium' ELSE 'low' END AS confidence
    FROM sums)
"""


def reviews(spark, folder):
    k = F.get_json_object("props", "$.k").cast("bigint")
    verdict = (
        F.when(k < 60, F.lit("correct")).when(k < 75, F.lit("extraction_error")).when(k < 85, F.lit("valid_change"))
        .when(k < 90, F.lit("version_bump")).otherwise(F.lit("not_reviewed"))
    )
    return table(spark, folder, "events").select(
        "user_id", "event_type", "event_id", F.floor(F.col("value") / 20).alias("form"), verdict.alias("verdict")
    )


def decisions(spark, folder):
    return vote.determine(reviews(spark, folder), ["user_id", "event_type"], "form", "verdict", ["event_id"])


@query(REVIEWS + """
SELECT user_id, event_type, decision, confidence, agreement_count, total_count, unique_values, reviewed,
    CASE WHEN decision LIKE 'accepted%' THEN winner END AS final_value FROM decided""")
def final_determination(spark, folder):
    return decisions(spark, folder).select(
        "user_id", "event_type", "decision", "confidence", "agreement_count", "total_count", "unique_values", "reviewed", "final_value"
    )


@query(REVIEWS + """
SELECT user_id, event_type, form AS value, n, first_verdict AS verdict
FROM forms JOIN decided USING (user_id, event_type) WHERE decision = 'valid_variations'""")
def valid_variations(spark, folder):
    out = vote.variations(reviews(spark, folder), decisions(spark, folder), ["user_id", "event_type"], "form", "verdict", ["event_id"])
    return out.drop("first")


@query(REVIEWS + """
SELECT user_id, event_type, form AS value, n, first_verdict AS verdict
FROM forms JOIN decided USING (user_id, event_type) WHERE decision = 'needs_manual_review'""")
def unresolved_issues(spark, folder):
    out = vote.variations(
        reviews(spark, folder), decisions(spark, folder), ["user_id", "event_type"], "form", "verdict", ["event_id"], "needs_manual_review"
    )
    return out.drop("first")


# -- incremental -----------------------------------------------------------------------------

CUT = "1996-01-01"
INCREMENTAL = """
WITH rows AS (SELECT o_custkey, o_orderpriority AS source, o_orderstatus AS fp, o_orderdate AS d, o_orderkey AS k FROM orders),
firsts AS (SELECT o_custkey, arg_min(fp, struct_pack(d := d, k := k)) AS fingerprint FROM rows GROUP BY o_custkey),
judged AS (SELECT rows.*, fingerprint, fp = fingerprint AS agrees FROM rows JOIN firsts USING (o_custkey)),
once AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY o_custkey, source, agrees ORDER BY d, k) = 1),
run AS (SELECT *, CAST(sum(agrees::INT) OVER w AS BIGINT) AS a, count(*) OVER w AS t, row_number() OVER w AS pos FROM once
    WINDOW w AS (PARTITION BY o_custkey ORDER BY d, k)),
labelled AS (SELECT *, CASE WHEN a / t >= 0.9 AND t >= 3 THEN 'high' WHEN a / t >= 0.75 AND t >= 3 THEN 'medium' ELSE 'low' END AS label,
    (pos > 1 AND agrees AND a / t >= 0.75) AS sets FROM run)
SELECT o_custkey, any_value(fingerprint) AS fingerprint, max(a) AS agreement_count, max(t) AS total_count,
    coalesce(arg_max(label, pos) FILTER (sets), 'single_source') AS confidence,
    CASE WHEN max(t) = 1 THEN 0.5 ELSE round_even(max(a) / max(t), 3) END AS confidence_score
FROM labelled GROUP BY o_custkey"""


@query(INCREMENTAL)
def incremental_consensus(spark, folder):
    """Orders before a date, then those after it, folded into the same canonical table."""
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_orderkey")
    canonical = spark.createDataFrame(
        [], "o_custkey bigint, fingerprint string, agreement_count bigint, total_count bigint, confidence string, confidence_score double"
    )
    members = spark.createDataFrame([], "o_custkey bigint, source string, agrees boolean, fingerprint string")
    for part in (F.col("o_orderdate") < CUT, F.col("o_orderdate") >= CUT):
        canonical, members = vote.incremental(
            canonical, members, rows.where(part), ["o_custkey"], "o_orderpriority", "o_orderstatus", ["o_orderdate", "o_orderkey"]
        )
        canonical, members = cut_lineage(canonical), cut_lineage(members)
    return canonical


@query(VOTES + """
, notes AS (SELECT * FROM (VALUES ('high', 'settled'), ('low', 'few sources'), ('low', 'check again')) t(level, note))
SELECT l_orderkey, winning_value AS fingerprint, round_even(score, 3) AS confidence_score, note, 'K-' || l_orderkey || '-v' || total_count AS file_key
FROM votes LEFT JOIN notes ON confidence = level""")
def annotations(spark, folder):
    """Canonical records with the annotations of their (name, version)."""
    votes = line_votes(spark, folder).withColumn("name", F.concat(F.lit("K-"), F.col("l_orderkey").cast("string")))
    notes = spark.createDataFrame([("high", "settled"), ("low", "few sources"), ("low", "check again")], "level string, note string")
    dim = votes.select("name", "total_count", "confidence").join(notes, F.col("confidence") == F.col("level"))
    dim = dim.select(F.concat(F.lit(collection.fixed.MESSAGE_PREFIX), "name").alias("name"), F.col("total_count").alias("version"), "note")
    out = collection.canonical(votes, "name", "total_count", dim)
    key = F.substring_index("name", "-", -1).cast("bigint")
    return out.select(key.alias("l_orderkey"), "fingerprint", "confidence_score", F.col("annotation.note").alias("note"), "file_key")


@query("""
WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_suppkey) - 1 AS k FROM lineitem)
SELECT l_orderkey, CAST(k // 3 AS BIGINT) AS part, count(*) AS sources_count, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY k) AS sources
FROM r GROUP BY l_orderkey, k // 3""")
def listed_sources(spark, folder):
    """All sources of each order, in lists of up to three."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    out = skew.listed(lines, ["l_orderkey"], ["l_partkey", "l_linenumber", "l_suppkey"], F.col("l_partkey").cast("string"), "sources", 3)
    return out.withColumn("sources", F.array_join("sources", ","))
