"""Rule checks and reports over lines, parts, customers, orders and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import naming as n
from ..operators import rules
from ..operators.rules import Rule
from .base import query, table

FIELD_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
SIZED = """
WITH f AS (SELECT l_orderkey, l_linenumber * 8 AS o, l_shipdate, l_partkey, l_suppkey, l_extendedprice, 'f' || l_partkey AS field,
    CASE WHEN l_returnflag = 'R' THEN 'U4' WHEN l_returnflag = 'A' THEN 'R8' ELSE 'Q3' END AS dtype,
    CASE WHEN l_returnflag = 'R' THEN 4 WHEN l_returnflag = 'A' THEN 8 ELSE 1 END AS size, CAST(l_quantity AS BIGINT) % 9 AS declared FROM lineitem),
e AS (SELECT *, coalesce(lag(o + size) OVER (PARTITION BY l_orderkey ORDER BY o, l_shipdate, l_partkey, l_suppkey, l_extendedprice), 0) AS expected FROM f),
violations AS (
    SELECT l_orderkey, field, o AS byte_offset, expected AS expected_offset, 'gap' AS issue, 'warning' AS severity, o - expected AS amount FROM e WHERE o > expected
    UNION ALL SELECT l_orderkey, field, o, expected, 'overlap', 'error', expected - o FROM e WHERE o < expected
    UNION ALL SELECT l_orderkey, field, o, expected, 'size_mismatch', 'warning', declared - size FROM e WHERE declared <> size
    UNION ALL SELECT l_orderkey, field, o, expected, 'type_invalid', 'warning', 0 FROM e WHERE dtype = 'Q3')
"""


def sized_fields(spark, folder):
    flag = F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", (F.col("l_linenumber") * 8).alias("byte_offset"), *FIELD_ORDER,
        F.concat(F.lit("f"), F.col("l_partkey").cast("string")).alias("name"),
        F.when(flag == "R", F.lit("U4")).when(flag == "A", F.lit("R8")).otherwise(F.lit("Q3")).alias("dtype"),
        (F.col("l_quantity").cast("bigint") % 9).alias("declared"),
    )


def structure_violations(spark, folder):
    return rules.structure(
        sized_fields(spark, folder), ["l_orderkey"], "name", "byte_offset", n.type_size("dtype"), FIELD_ORDER, "declared", "dtype"
    )


@query(SIZED + "SELECT l_orderkey, field, CAST(byte_offset AS BIGINT) AS byte_offset, CAST(expected_offset AS BIGINT) AS expected_offset, issue, severity, CAST(amount AS BIGINT) AS amount FROM violations")
def structure_rules(spark, folder):
    return structure_violations(spark, folder)


@query(SIZED + """
SELECT l_orderkey, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings, coalesce(errors, 0) = 0 AS is_valid
FROM (SELECT DISTINCT o_orderkey AS l_orderkey FROM orders) LEFT JOIN (SELECT l_orderkey, count(*) FILTER (severity = 'error') AS errors,
    count(*) FILTER (severity = 'warning') AS warnings FROM violations GROUP BY 1) USING (l_orderkey)""")
def structure_status(spark, folder):
    messages = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return rules.structure_status(messages, structure_violations(spark, folder), ["l_orderkey"])


@query(SIZED + """
, ends AS (SELECT l_orderkey, CAST(o + size AS BIGINT) AS computed_length FROM f QUALIFY row_number() OVER (PARTITION BY l_orderkey
    ORDER BY o DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
SELECT l_orderkey, computed_length, CAST(floor(o_totalprice / 10000) AS BIGINT) AS declared FROM ends JOIN orders ON o_orderkey = l_orderkey
WHERE floor(o_totalprice / 10000) <> 0 AND floor(o_totalprice / 10000) <> computed_length""")
def length_rules(spark, folder):
    ends = rules.layout_end(sized_fields(spark, folder), ["l_orderkey"], "byte_offset", n.type_size("dtype"), FIELD_ORDER)
    lengths = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.floor(F.col("o_totalprice") / 10000).alias("declared"))
    return rules.length_mismatch(ends, lengths, ["l_orderkey"], "declared")


@query("SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def empty_layouts(spark, folder):
    messages = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return rules.empty_layouts(messages, table(spark, folder, "lineitem"), ["l_orderkey"])


@query("""
WITH f AS (SELECT user_id, event_id, event_type, CASE WHEN k % 10 = 9 THEN NULL ELSE k END AS o, CASE WHEN k % 7 = 3 THEN NULL ELSE 'U1' END AS dtype, event_type = 'view' AS reserved
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)),
h AS (SELECT *, coalesce(max(o) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS highest FROM f)
SELECT user_id, event_type AS field, event_id, 'missing_offset' AS issue, 'error' AS severity FROM h WHERE o IS NULL
UNION ALL SELECT user_id, event_type, event_id, 'offset_decreases', 'warning' FROM h WHERE o < highest AND NOT reserved
UNION ALL SELECT user_id, event_type, event_id, 'missing_type', 'error' FROM h WHERE o IS NOT NULL AND dtype IS NULL""")
def extraction_rules(spark, folder):
    k = F.get_json_object("props", "$.k").cast("bigint")
    fields = table(spark, folder, "events").select(
        "user_id", "event_id", "event_type", F.when(k % 10 != 9, k).alias("o"), F.when(k % 7 != 3, F.lit("U1")).alias("dtype"),
        (F.col("event_type") == "view").alias("reserved"),
    )
    return rules.extraction_fields(fields, ["user_id"], "event_type", "o", "dtype", "reserved", ["event_id"])


@query("""
WITH d AS (SELECT event_id, user_id % 5 AS kind FROM events)
SELECT event_id, 'error' AS issue, 'error' AS severity FROM d WHERE kind = 0
UNION ALL SELECT event_id, 'missing_message_type', 'error' FROM d WHERE kind = 1
UNION ALL SELECT event_id, 'payload_not_object', 'error' FROM d WHERE kind = 2
UNION ALL SELECT event_id, 'no_fields', 'warning' FROM d WHERE kind = 3
UNION ALL SELECT event_id, 'no_length', 'warning' FROM d WHERE kind = 3
UNION ALL SELECT event_id, 'class_id_not_hex', 'error' FROM d WHERE kind = 3
UNION ALL SELECT event_id, 'end_mismatch', 'warning' FROM d WHERE kind = 4""")
def document_rules(spark, folder):
    kind, head = F.col("user_id") % 5, '{"name":"m","class_id":"0x01","message_id":"0x02"'
    text = (
        F.when(kind == 0, F.lit('{"error":"failed"}'))
        .when(kind == 1, F.lit(head + ',"payload":{}}'))
        .when(kind == 2, F.lit(head + ',"message_type":"output","payload":[1]}'))
        .when(kind == 3, F.lit(head.replace("0x01", "1") + ',"message_type":"output","payload":{"fields":[]}}'))
        .otherwise(F.concat(F.lit(head + ',"message_type":"output","payload":{"length":{"fixed":7},"fields":[{"name":"a","byte_offset":0,"data_type":"U1"},{"name":"'),
                            F.col("event_type"), F.lit('","byte_offset":4,"data_type":"U4"}]}}')))
    )
    return rules.extraction_documents(table(spark, folder, "events").select("event_id", text.alias("structure")), "structure", ["event_id"])


@query("""
SELECT 'has_name' AS rule, count(*) AS checked, count(*) FILTER (c_name IS NULL) AS violations, count(*) FILTER (c_name IS NULL) = 0 AS passed FROM customer
UNION ALL SELECT 'name_format', count(*), count(*) FILTER (NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')), count(*) FILTER (NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')) = 0 FROM customer
UNION ALL SELECT 'balance_range', count(*), count(*) FILTER (c_acctbal < 0), count(*) FILTER (c_acctbal < 0) = 0 FROM customer
UNION ALL SELECT 'mostly_positive', count(*), count(*) FILTER (c_acctbal <= 0), count(*) FILTER (c_acctbal > 0) >= 0.8 * count(*) FROM customer
UNION ALL SELECT 'segment_known', count(*), count(*) FILTER (c_mktsegment = 'FURNITURE'), count(*) FILTER (c_mktsegment = 'FURNITURE') = 0 FROM customer
UNION ALL SELECT 'unique_line', count(*), count(*) FILTER (n > 1), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'unique_order', count(*), count(*) FILTER (n > 1), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)
UNION ALL SELECT 'line_has_order', count(*), count(*) FILTER (NOT found), count(*) FILTER (NOT found) = 0 FROM (SELECT DISTINCT l_orderkey, l_orderkey IN (SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END FROM orders) AS found FROM lineitem)
UNION ALL SELECT 'enough_orders', count(*), greatest(0, 1000 - count(*)), count(*) >= 1000 FROM orders
UNION ALL SELECT 'no_urgent_open', count(*) FILTER (o_orderpriority = '1-URGENT'), count(*) FILTER (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
    count(*) FILTER (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') = 0 FROM orders""")
def constraint_report(spark, folder):
    customers, orders, lines = (table(spark, folder, t) for t in ("customer", "orders", "lineitem"))
    per_row = rules.expect(customers, [
        Rule("has_name", F.col("c_name").isNotNull()),
        Rule("name_format", F.col("c_name").rlike("^Customer#[0-9]{9}$")),
        Rule("balance_range", F.col("c_acctbal") >= 0),
        Rule("mostly_positive", F.col("c_acctbal") > 0, share=0.8),
        Rule("segment_known", F.col("c_mktsegment") != "FURNITURE"),
    ])
    return rules.report(
        per_row,
        rules.unique(lines, ["l_orderkey", "l_linenumber"], "unique_line"),
        rules.unique(orders, ["o_orderkey"], "unique_order"),
        rules.references(lines, orders.withColumn("o_orderkey", F.when(F.col("o_orderstatus") == "P", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))), ["l_orderkey"], ["o_orderkey"], "line_has_order"),
        rules.at_least(orders, "enough_orders", 1000),
        rules.excluded_source(orders, F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus") == "P", "no_urgent_open"),
    )


@query("""
WITH k AS (SELECT 'CFG-' || upper(p_type) || '-' || upper(replace(p_name, ' ', CASE WHEN p_size > 48 THEN '+' ELSE '_' END)) AS name, p_size,
    CASE WHEN p_size < 45 THEN '0x' || lpad(lower(hex(p_partkey)), 8, '0') ELSE '0x' || lower(hex(p_partkey)) END AS key_id,
    CASE WHEN p_size = 3 THEN 'Z9' ELSE 'U' || CASE p_size % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '4' ELSE '8' END END AS t FROM part)
SELECT 'key_id_format' AS rule, count(*) FILTER (NOT regexp_matches(key_id, '^0x[0-9a-fA-F]{8}$')) AS violations FROM k
UNION ALL SELECT 'data_type_known', count(*) FILTER (t = 'Z9') FROM k
UNION ALL SELECT 'described', count(*) FILTER (p_size < 10) FROM k
UNION ALL SELECT 'name_convention', count(*) FILTER (p_size > 48) FROM k
UNION ALL SELECT 'has_sources', count(*) FILTER (p_size = 50) FROM k
UNION ALL SELECT unnest(['has_name', 'has_key_id', 'has_data_type']), 0
UNION ALL SELECT 'has_group', count(*) FILTER (p_size > 48 AND false) FROM k
UNION ALL SELECT 'item_id_format', 0""")
def key_rules(spark, folder):
    size = F.col("p_size")
    name = F.concat_ws("-", F.lit("CFG"), F.upper("p_type"), F.upper(F.replace("p_name", F.lit(" "), F.when(size > 48, F.lit("+")).otherwise(F.lit("_")))))
    keys = table(spark, folder, "part").select(
        name.alias("name"), n.key_group(name).alias("group"),
        F.when(size < 45, F.format_string("0x%08x", "p_partkey")).otherwise(F.format_string("0x%x", "p_partkey")).alias("key_id"),
        F.lit("0x0001").alias("item_id"),
        F.when(size == 3, F.lit("Z9")).otherwise(F.element_at(F.array(*[F.lit(f"U{i}") for i in (1, 2, 4, 8)]), size % 4 + 1)).alias("data_type"),
        F.when(size >= 10, F.col("p_name")).alias("description"), F.when(size == 50, 0).otherwise(1).alias("source_count"),
    )
    return rules.expect(keys, rules.key_rules()).select("rule", "violations")


ENUMS = """
WITH v AS (SELECT CASE WHEN p_size % 9 = 0 THEN 'sigId' ELSE p_brand END AS enum, CASE WHEN p_size % 9 = 0 THEN CASE p_size % 2 WHEN 0 THEN 'gps' ELSE 'other' END END AS context,
    CASE p_size % 3 WHEN 0 THEN 'U1' WHEN 1 THEN 'I1' ELSE 'U2' END AS type, CASE WHEN p_size <> 1 THEN p_partkey % 90 - 10 END AS value, p_type AS name,
    CASE WHEN p_size % 4 <> 0 THEN p_name END AS description, p_size FROM part),
e AS (SELECT n_name AS enum, CASE WHEN n_nationkey % 5 <> 0 THEN CASE WHEN n_nationkey % 7 = 0 THEN 'Z1' ELSE 'U1' END END AS type, CASE WHEN n_nationkey % 6 <> 0 THEN 1 END AS values,
    CASE WHEN n_nationkey % 4 = 0 THEN 2 WHEN n_nationkey % 4 = 1 THEN 0 END AS occurrences, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey % 2 END AS messages, n_nationkey = 10 AS per_context FROM nation)
"""


@query(ENUMS + """
SELECT 'value_present' AS rule, count(*) AS checked, count(*) FILTER (value IS NULL) AS violations, count(*) FILTER (value IS NULL) = 0 AS passed FROM v
UNION ALL SELECT 'value_fits_type', count(*), count(*) FILTER (bad), count(*) FILTER (bad) = 0 FROM (
    SELECT context IS NULL AND (value IS NULL OR CASE type WHEN 'U1' THEN value < 0 OR value > 255 WHEN 'I1' THEN value < -128 OR value > 127 ELSE value < 0 OR value > 65535 END) AS bad FROM v)
UNION ALL SELECT 'described', count(*), count(*) FILTER (description IS NULL), count(description) >= 0.8 * count(*) FROM v
UNION ALL SELECT 'duplicate_value', count(*), count(*) FILTER (n > 1), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY enum, context, value)
UNION ALL SELECT 'duplicate_name', count(*), count(*) FILTER (n > 1), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM v WHERE context IS NULL GROUP BY enum, name)
UNION ALL SELECT 'contexts', 1, CAST(count(DISTINCT context) FILTER (context = 'gps') < 2 AS BIGINT), count(DISTINCT context) FILTER (context = 'gps') >= 2 FROM v WHERE enum = 'sigId'
UNION ALL SELECT 'enumerations', count(DISTINCT enum), greatest(0, 20 - count(DISTINCT enum)), count(DISTINCT enum) >= 20 FROM v
UNION ALL SELECT 'has_type_and_values', count(*), count(*) FILTER (bad), count(*) FILTER (bad) = 0 FROM (SELECT NOT per_context AND (type IS NULL OR values IS NULL) AS bad FROM e)
UNION ALL SELECT 'type_known', count(*), count(*) FILTER (bad), count(*) FILTER (bad) = 0 FROM (SELECT NOT per_context AND type IS DISTINCT FROM 'U1' AS bad FROM e)
UNION ALL SELECT 'occurrences_tracked', count(*), count(*) FILTER (bad), count(*) FILTER (bad) = 0 FROM (SELECT NOT per_context AND occurrences IS NULL AND messages IS NULL AS bad FROM e)
UNION ALL SELECT 'occurrences_listed', count(*), count(*) FILTER (bad), count(*) FILTER (bad) = 0 FROM (SELECT NOT per_context AND coalesce(occurrences, 0) > 0 AND coalesce(messages, 0) = 0 AS bad FROM e)
UNION ALL SELECT 'message_known', count(*), count(*) FILTER (n IS NULL), count(*) FILTER (n IS NULL) = 0 FROM (SELECT DISTINCT s_nationkey % 40 + s_suppkey % 3 AS k FROM supplier) LEFT JOIN (SELECT n_nationkey AS n FROM nation) ON k = n""")
def enum_value_rules(spark, folder):
    """Whole rule sets of enumerations, their values and the messages they name; every table is read once."""
    size, key = F.col("p_size"), F.col("n_nationkey")
    apart = size % 9 == 0
    values = table(spark, folder, "part").select(
        F.when(apart, F.lit("sigId")).otherwise(F.col("p_brand")).alias("enum"), F.when(apart, F.when(size % 2 == 0, F.lit("gps")).otherwise(F.lit("other"))).alias("context"),
        F.element_at(F.array(F.lit("U1"), F.lit("I1"), F.lit("U2")), size % 3 + 1).alias("type"), F.when(size != 1, F.col("p_partkey") % 90 - 10).alias("value"),
        F.col("p_type").alias("name"), F.when(size % 4 != 0, F.col("p_name")).alias("description"))
    nations = table(spark, folder, "nation").select(
        F.col("n_name").alias("enum"), F.when(key % 5 != 0, F.when(key % 7 == 0, F.lit("Z1")).otherwise(F.lit("U1"))).alias("type"), F.when(key % 6 != 0, F.lit(1)).alias("values"),
        F.when(key % 4 == 0, F.lit(2)).when(key % 4 == 1, F.lit(0)).alias("occurrences"), F.when(key % 3 == 0, key % 2).alias("messages"), (key == 10).alias("per_context"),
        key.cast("bigint").alias("message"))
    named = table(spark, folder, "supplier").select((F.col("s_nationkey") % 40 + F.col("s_suppkey") % 3).cast("bigint").alias("message"))
    return rules.check((values, rules.enum_value_set()), (nations, [*rules.enum_set(), *rules.known_messages()]), (named, rules.enum_references()))


# -- roll-ups --------------------------------------------------------------------------------

RESULTS = """
WITH results AS (SELECT d.source, d.doc_id, CASE WHEN quality IS NULL THEN NULL ELSE quality = 1 END AS matches FROM documents d LEFT JOIN labels USING (doc_id)),
status AS (SELECT source, count(*) AS checked, count(matches) AS found, count(*) FILTER (matches) AS matches, count(*) FILTER (NOT matches) AS mismatches,
    CASE WHEN count(*) FILTER (NOT matches) > 0 THEN 'needs_review' WHEN count(*) FILTER (matches) > 0 THEN 'valid' ELSE 'unvalidated' END AS status FROM results GROUP BY source)
"""


def rolled_up(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", (F.col("quality") == 1).alias("matches"))
    results = table(spark, folder, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return rules.rollup(results, ["source"], "matches")


@query(RESULTS + "SELECT * FROM status")
def status_rollup(spark, folder):
    return rolled_up(spark, folder)


@query(RESULTS + """
SELECT (SELECT count(DISTINCT source) FROM documents) + 25 AS total, count(*) AS validated, count(*) FILTER (status = 'valid') AS valid,
    count(*) FILTER (status = 'needs_review') AS needs_review, CAST(25 AS BIGINT) AS remaining FROM status""")
def status_totals(spark, folder):
    sources = table(spark, folder, "documents").select("source")
    others = table(spark, folder, "nation").select(F.col("n_name").alias("source"))
    return rules.status_totals(sources.unionByName(others), rolled_up(spark, folder), ["source"])


@query(RESULTS + "SELECT source, mismatches FROM status WHERE status = 'needs_review' ORDER BY mismatches DESC, source LIMIT 10")
def pending_topk(spark, folder):
    return rules.pending(rolled_up(spark, folder), ["source"], 10).select("source", "mismatches")


@query(RESULTS + "SELECT source, mismatches FROM status WHERE status = 'needs_review'")
def pending(spark, folder):
    return rules.pending(rolled_up(spark, folder), ["source"]).select("source", "mismatches")


@query("""
SELECT e.user_id, e.event_id, unnest(['a_' || event_type, 'b']) AS field, unnest(['size ' || CAST(user_id AS VARCHAR), 'type']) AS issue
FROM events e WHERE event_type IN ('click', 'view')""")
def discrepancy_details(spark, folder):
    e = F.col("event_type")
    listed = F.array(
        F.struct(F.concat(F.lit("a_"), e).alias("field"), F.concat(F.lit("size "), F.col("user_id").cast("string")).alias("issue")),
        F.struct(F.lit("b").alias("field"), F.lit("type").alias("issue")),
    )
    results = table(spark, folder, "events").select(
        "user_id", "event_id", F.when(e.isin("click", "view"), F.lit(False)).when(e == "error", F.lit(True)).alias("matches"), listed.alias("discrepancies")
    )
    return rules.discrepancy_details(results, ["user_id"], "matches", "discrepancies")


# -- coverage --------------------------------------------------------------------------------

TYPED = """WITH f AS (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'X4' ELSE 'U4' END AS t, p_type <> 'SMALL' AS has, p_size % 16 AS bits FROM part)"""


@query(TYPED + """
SELECT p_brand, count(*) AS fields, count(*) FILTER (t = 'X4') AS bit_fields, count(*) FILTER (t = 'X4' AND has) AS bit_fields_defined,
    count(*) FILTER (t = 'X4' AND NOT has) AS bit_fields_missing, CAST(coalesce(sum(bits) FILTER (t = 'X4' AND has), 0) AS BIGINT) AS bits FROM f GROUP BY p_brand""")
def coverage_stats(spark, folder):
    fields = table(spark, folder, "part").withColumn("t", F.when(F.col("p_size") % 2 == 0, F.lit("X4")).otherwise(F.lit("U4")))
    return rules.coverage(fields, ["p_brand"], "t", F.col("p_type") != "SMALL", F.col("p_size") % 16)


@query("""
WITH f AS (SELECT CASE WHEN p_size < 10 THEN 'ESF-' WHEN p_size < 20 THEN 'AID-' WHEN p_size < 25 THEN 'SEC-' ELSE 'NAV-' END || p_brand AS m,
    CASE WHEN p_type = 'SMALL' THEN 'pinBank' WHEN p_size > 40 THEN 'Reserved1' ELSE p_name END AS f FROM part)
SELECT CASE WHEN f = 'pinBank' THEN 'gpio_masks' WHEN m LIKE 'ESF-%' THEN 'adr_esf' WHEN m LIKE 'AID-%' THEN 'legacy' WHEN m LIKE 'SEC-%' THEN 'security'
    WHEN f = 'Reserved1' THEN 'reserved' ELSE 'other' END AS category, count(*) AS fields FROM f GROUP BY 1""")
def missing_categories(spark, folder):
    size = F.col("p_size")
    prefix = F.when(size < 10, F.lit("ESF-")).when(size < 20, F.lit("AID-")).when(size < 25, F.lit("SEC-")).otherwise(F.lit("NAV-"))
    field = F.when(F.col("p_type") == "SMALL", F.lit("pinBank")).when(size > 40, F.lit("Reserved1")).otherwise(F.col("p_name"))
    return table(spark, folder, "part").groupBy(n.missing_bucket(F.concat(prefix, "p_brand"), field).alias("category")).agg(F.count(F.lit(1)).alias("fields"))


@query("SELECT CASE WHEN p_size < 25 THEN p_type ELSE 'OTHER' END AS class, count(*) AS messages FROM part GROUP BY 1")
def class_counts(spark, folder):
    name = F.when(F.col("p_size") < 25, F.concat_ws("-", "p_brand", "p_type")).otherwise(F.col("p_brand"))
    return rules.class_counts(table(spark, folder, "part").select(name.alias("name")), "name")


@query("SELECT count(DISTINCT p_type) AS total_enumerations, (SELECT count(*) FROM (SELECT DISTINCT p_type, p_size FROM part)) AS total_values, count(DISTINCT p_brand) AS messages_with_enums FROM part")
def enum_coverage(spark, folder):
    return rules.enum_coverage(table(spark, folder, "part").select("p_type", F.col("p_size").alias("value"), "p_brand"), "p_type", "p_brand")


@query("SELECT CASE WHEN p_size > 45 THEN 'unknown' ELSE p_type END AS dtype, count(*) AS keys FROM part GROUP BY 1")
def type_counts(spark, folder):
    return rules.type_counts(table(spark, folder, "part").select(F.when(F.col("p_size") <= 45, F.col("p_type")).alias("dtype")), "dtype")
