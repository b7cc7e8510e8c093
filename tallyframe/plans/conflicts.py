"""Attribute conflicts of parts that share a name, and decisions on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conflict
from ..operators.conflict import Attribute
from .base import query, table

ATTRIBUTES = [
    Attribute("p_brand", reason="Brand conflict", sure_reason="Brand mismatch"),
    Attribute("p_type", reason="Type mismatch"),
    Attribute("code", misread=True, reason="Code mismatch"),
    Attribute("unit", skip_blank=True, prefer_value=True, reason="Unit differs"),
]


def parts(spark, folder):
    size = F.col("p_size")
    return table(spark, folder, "part").withColumns({
        "code": F.when(size < 8, F.lit("14")).when(size < 40, F.lit("I4")).otherwise(F.lit("U4")),
        "unit": F.when(size < 35, F.lit("-")).when(size < 45, F.lit("ms")).when(size < 48, F.lit("")).otherwise(F.lit("s")),
    })


def part_conflicts(spark, folder):
    return conflict.detect(parts(spark, folder), ["p_name"], ATTRIBUTES, ["p_partkey"])


CONFLICTS = """
WITH p AS (SELECT *, CASE WHEN p_size < 8 THEN '14' WHEN p_size < 40 THEN 'I4' ELSE 'U4' END AS code,
    CASE WHEN p_size < 35 THEN '-' WHEN p_size < 45 THEN 'ms' WHEN p_size < 48 THEN '' ELSE 's' END AS unit FROM part),
long AS (SELECT p_name, 'p_brand' AS field, p_brand AS value, p_partkey FROM p
    UNION ALL SELECT p_name, 'p_type', p_type, p_partkey FROM p
    UNION ALL SELECT p_name, 'code', code, p_partkey FROM p
    UNION ALL SELECT p_name, 'unit', unit, p_partkey FROM p WHERE unit <> ''),
cand AS (SELECT p_name, field, value, count(*) AS n, min(p_partkey) AS f FROM long GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p_name, field ORDER BY n DESC, f) AS r,
    row_number() OVER (PARTITION BY p_name, field ORDER BY (value = '-'), n DESC, f) AS rv FROM cand),
g AS (SELECT p_name, field, max(value) FILTER (r = 1) AS top, max(n) FILTER (r = 1) AS top_n,
    max(value) FILTER (rv = 1 AND value <> '-') AS best_value, bool_or(value = '-') AS dash,
    bool_or(value IN ('11', '12', '14', '18')) AND bool_or(value IN ('I1', 'I2', 'I4', 'I8')) AS misread,
    CAST(sum(n) AS BIGINT) AS instance_count, count(*) AS candidate_count FROM ranked GROUP BY ALL HAVING count(*) > 1),
h AS (SELECT *, field = 'unit' AND top = '-' AND best_value IS NOT NULL AS swapped FROM g),
i AS (SELECT *, CASE WHEN swapped THEN best_value ELSE top END AS suggested,
    CASE WHEN swapped THEN 0.9 ELSE top_n / instance_count END AS confidence FROM h),
conflicts AS (SELECT p_name, field, instance_count, candidate_count, suggested, confidence, confidence < 0.75 AS needs_review,
    CASE WHEN field = 'code' AND misread THEN 'Likely OCR error (I vs 1)'
         WHEN field = 'unit' AND dash THEN 'Unit differs - prefer actual value over ''-'''
         WHEN field = 'p_brand' THEN CASE WHEN confidence >= 0.75 THEN 'Brand mismatch' ELSE 'Brand conflict' END
         WHEN field = 'p_type' THEN 'Type mismatch' WHEN field = 'code' THEN 'Code mismatch' ELSE 'Unit differs' END AS reason FROM i)
"""
COLUMNS = "p_name, field, instance_count, candidate_count, suggested, round(confidence, 6) AS confidence, reason, needs_review"


def _shown(conflicts):
    return conflicts.withColumn("confidence", F.round("confidence", 6))


@query(CONFLICTS + f"SELECT {COLUMNS} FROM conflicts")
def attribute_conflicts(spark, folder):
    return _shown(part_conflicts(spark, folder))


@query(CONFLICTS + "SELECT p_name, field, value, n, f AS first_part FROM cand")
def attribute_candidates(spark, folder):
    found = conflict.candidates(parts(spark, folder), ["p_name"], ATTRIBUTES, ["p_partkey"])
    return found.select("p_name", "field", "value", "n", F.col("first.p_partkey").alias("first_part"))


@query(CONFLICTS + f"SELECT {COLUMNS} FROM conflicts WHERE needs_review")
def adjudication_queue(spark, folder):
    return _shown(conflict.queue(part_conflicts(spark, folder))).drop("decision")


@query(CONFLICTS + """
SELECT field, count(*) AS conflicts, count(*) FILTER (needs_review) AS needs_review,
    count(*) FILTER (NOT needs_review) AS auto_resolvable FROM conflicts GROUP BY field""")
def conflict_summary(spark, folder):
    return conflict.conflict_summary(part_conflicts(spark, folder))


@query(CONFLICTS + """
SELECT count(DISTINCT p_name) AS entities_with_conflicts, count(*) AS total_conflicts,
    count(*) FILTER (needs_review) AS needs_review, count(*) FILTER (NOT needs_review) AS auto_resolvable FROM conflicts""")
def conflict_totals(spark, folder):
    return conflict.conflict_totals(part_conflicts(spark, folder), ["p_name"])


@query("""
WITH lists AS (SELECT p_brand, p_type, string_agg(p_size || '|' || p_name, ',' ORDER BY p_size || '|' || p_name) AS l FROM part GROUP BY ALL)
SELECT p_brand, count(*) AS source_count, count(DISTINCT l) AS list_count FROM lists GROUP BY p_brand HAVING count(DISTINCT l) > 1""")
def list_conflicts(spark, folder):
    return conflict.list_conflicts(table(spark, folder, "part"), ["p_brand"], ["p_type"], ["p_size"], ["p_name"])


@query("SELECT p_brand, p_size, arg_max(p_name, p_partkey) AS p_name, max(p_partkey) AS p_partkey FROM part GROUP BY ALL")
def merged_lists(spark, folder):
    return conflict.merged_lists(table(spark, folder, "part"), ["p_brand"], ["p_size"], ["p_name", "p_partkey"], ["p_partkey"])


DECISIONS = """
WITH decisions AS (SELECT o_orderkey, o_custkey + 100 AS c_custkey,
    CASE WHEN o_orderstatus = 'F' THEN 'c_mktsegment' ELSE 'c_nationkey' END AS field,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'BUILDING' ELSE 'MACHINERY' END
         ELSE CAST(o_custkey % 25 AS VARCHAR) END AS decision FROM orders)
"""


def decided(spark, folder):
    urgent, machinery = F.lit("BUILDING"), F.lit("MACHINERY")
    final = F.col("o_orderstatus") == "F"
    return table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_custkey") + 100).alias("c_custkey"),
        F.when(final, F.lit("c_mktsegment")).otherwise(F.lit("c_nationkey")).alias("field"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .when(final, F.when(F.col("o_orderpriority") == "1-URGENT", urgent).otherwise(machinery))
        .otherwise((F.col("o_custkey") % 25).cast("string")).alias("decision"),
    )


@query(DECISIONS + """
SELECT o_orderkey, c_custkey, field, CASE WHEN c.c_custkey IS NULL THEN 'not_found'
    WHEN decision = CASE field WHEN 'c_mktsegment' THEN c_mktsegment ELSE CAST(c_nationkey AS VARCHAR) END THEN 'skipped' ELSE 'changed' END AS status,
    CASE field WHEN 'c_mktsegment' THEN c_mktsegment ELSE CAST(c_nationkey AS VARCHAR) END AS old_value, decision AS new_value
FROM decisions LEFT JOIN customer c USING (c_custkey) WHERE decision IS NOT NULL""")
def decision_changes(spark, folder):
    out = conflict.decision_changes(table(spark, folder, "customer"), decided(spark, folder), ["c_custkey"], ["c_mktsegment", "c_nationkey"])
    return out.drop("decision")


@query(DECISIONS + """
, last AS (SELECT c_custkey, arg_max(decision, o_orderkey) FILTER (field = 'c_mktsegment') AS seg,
    arg_max(decision, o_orderkey) FILTER (field = 'c_nationkey') AS nat FROM decisions WHERE decision IS NOT NULL GROUP BY c_custkey)
SELECT c_custkey, c_name, coalesce(CAST(nat AS INT), c_nationkey) AS c_nationkey, c_acctbal, coalesce(seg, c_mktsegment) AS c_mktsegment
FROM customer LEFT JOIN last USING (c_custkey)""")
def apply_decisions(spark, folder):
    return conflict.apply_decisions(
        table(spark, folder, "customer"), decided(spark, folder), ["c_custkey"], ["c_mktsegment", "c_nationkey"], ["o_orderkey"]
    )


@query(CONFLICTS + """
, d AS (SELECT p_name, 'p_brand' AS field, min(p_brand) AS decision FROM part GROUP BY p_name)
SELECT p_name, field, suggested, decision FROM conflicts LEFT JOIN d USING (p_name, field) WHERE needs_review""")
def record_decisions(spark, folder):
    queued = conflict.queue(part_conflicts(spark, folder))
    answers = table(spark, folder, "part").groupBy("p_name").agg(F.min("p_brand").alias("decision")).withColumn("field", F.lit("p_brand"))
    return conflict.record_decisions(queued, answers, ["p_name"]).select("p_name", "field", "suggested", "decision")


@query("""
SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'click') AS fix_canonical,
    count(*) FILTER (event_type = 'view') AS valid_variation, count(*) FILTER (event_type = 'error') AS needs_human
FROM events GROUP BY user_id""")
def decision_rollup(spark, folder):
    e = F.col("event_type")
    kind = F.when(e == "click", F.lit("fix_canonical")).when(e == "view", F.lit("valid_variation")).when(e == "error", F.lit("needs_human"))
    return conflict.decision_rollup(table(spark, folder, "events").withColumn("decision", kind), ["user_id"])
