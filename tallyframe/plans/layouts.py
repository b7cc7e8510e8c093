"""Layouts: fingerprints, differences and version fields over lines and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import layout, version
from ..session import spread
from . import flows
from .base import query, table

LAST = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"]


def lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", F.col("l_quantity").cast("int").alias("size"), *LAST[:4]
    )


@query("""
WITH e AS (SELECT l_orderkey, l_linenumber AS o, lower(l_linestatus) AS s,
    '["' || lower(l_linestatus) || '", ' || l_linenumber || ', "' || l_returnflag || '", ' || CAST(l_quantity AS INT) || ']' AS entry FROM lineitem)
SELECT l_orderkey, substr(sha256('[' || string_agg(entry, ', ' ORDER BY o, s, entry) || ']'), 1, 16) AS fingerprint, count(*) AS field_count
FROM e GROUP BY l_orderkey""")
def fingerprint_layout(spark, folder):
    return layout.fingerprint(lines(spark, folder), ["l_orderkey"], "l_linestatus", "l_linenumber", "l_returnflag", "size")


DIFF = """
WITH last AS (SELECT l_orderkey, l_linenumber, l_linestatus AS s, l_returnflag AS f, CAST(l_quantity AS INT) AS q FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC, l_linestatus DESC) = 1),
pairs AS (SELECT DISTINCT a.l_orderkey AS k FROM lineitem a JOIN lineitem b ON b.l_orderkey = a.l_orderkey + 1),
a AS (SELECT l_orderkey AS k, l_linenumber, s, f, q FROM last WHERE l_orderkey IN (SELECT k FROM pairs)),
b AS (SELECT l_orderkey - 1 AS k, l_linenumber, s, f, q FROM last WHERE l_orderkey - 1 IN (SELECT k FROM pairs)),
diff AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
    CASE WHEN a.k IS NULL THEN 'missing_in_first' WHEN b.k IS NULL THEN 'missing_in_second' ELSE 'field_differs' END AS kind,
    a.s AS s1, a.f AS f1, a.q AS q1, b.s AS s2, b.f AS f2, b.q AS q2
    FROM a FULL JOIN b ON a.k = b.k AND a.l_linenumber = b.l_linenumber
    WHERE a.k IS NULL OR b.k IS NULL OR a.s <> b.s OR a.f <> b.f OR a.q <> b.q)
"""


def neighbours(spark, folder):
    """The layouts of order k and of order k + 1, for every k that has both."""
    rows = lines(spark, folder).withColumnRenamed("l_orderkey", "k")
    after = rows.withColumn("k", F.col("k") - 1)
    both = rows.select("k").distinct().join(after.select("k").distinct(), "k")
    return rows.join(both, "k", "left_semi"), after.join(both, "k", "left_semi")


def differences(spark, folder):
    first, second = neighbours(spark, folder)
    return layout.differences(first, second, ["k"], "l_linenumber", "l_linestatus", "l_returnflag", "size", LAST)


@query(DIFF + "SELECT k, l_linenumber, kind, s1, f1, q1, s2, f2, q2 FROM diff")
def layout_diff(spark, folder):
    d = differences(spark, folder)
    return d.toDF("k", "l_linenumber", "kind", "s1", "f1", "q1", "s2", "f2", "q2")


@query(DIFF + """
, texts AS (SELECT k, l_linenumber, CASE kind WHEN 'missing_in_first' THEN 'missing field at offset ' || l_linenumber
    WHEN 'missing_in_second' THEN 'extra field at offset ' || l_linenumber
    ELSE 'field at offset ' || l_linenumber || ': ' || s1 || '(' || f1 || ') vs ' || s2 || '(' || f2 || ')' END AS t,
    row_number() OVER (PARTITION BY k ORDER BY l_linenumber) AS r FROM diff),
tops AS (SELECT k, count(*) AS mismatch_count, string_agg(t, '; ' ORDER BY r) FILTER (r <= 3) AS shown FROM texts GROUP BY k),
counts AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT k, mismatch_count, a.n - b.n AS field_count_diff,
    CASE WHEN a.n <> b.n THEN 'field count differs by ' || (a.n - b.n) || '; ' ELSE '' END || shown ||
    CASE WHEN mismatch_count > 3 THEN '; ...and ' || (mismatch_count - 3) || ' more differences' ELSE '' END AS summary
FROM tops JOIN counts a USING (k) JOIN counts b ON b.k = tops.k + 1""")
def diff_summary(spark, folder):
    first, second = neighbours(spark, folder)
    counts = [d.groupBy("k").agg(F.count(F.lit(1)).alias(c)) for d, c in ((first, "_a"), (second, "_b"))]
    by = counts[0].join(counts[1], "k").select("k", (F.col("_a") - F.col("_b")).alias("field_count_diff"))
    return layout.summarize(differences(spark, folder), ["k"], "l_linenumber", "l_linestatus", "l_returnflag", by)


@query("""
WITH e AS (SELECT l_orderkey, l_linenumber AS o, lower(l_linestatus) AS s,
    '["' || lower(l_linestatus) || '", ' || l_linenumber || ', "' || l_returnflag || '", ' || CAST(l_quantity AS INT) || ']' AS entry FROM lineitem),
p AS (SELECT l_orderkey // 4 AS e, l_orderkey AS src, string_agg(entry, ', ' ORDER BY o, s, entry) AS fp, count(*) AS n FROM e GROUP BY l_orderkey),
t AS (SELECT e, fp, count(*) AS n, min(src) AS first FROM p GROUP BY ALL),
w AS (SELECT e, fp, first FROM t QUALIFY row_number() OVER (PARTITION BY e ORDER BY n DESC, first) = 1),
x AS (SELECT p.e, p.src, p.n, w.first AS win, q.n AS wn FROM p JOIN w USING (e) JOIN p q ON q.src = w.first WHERE p.fp <> w.fp),
last AS (SELECT l_orderkey, l_linenumber, l_linestatus AS s, l_returnflag AS f, CAST(l_quantity AS INT) AS q FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC, l_linestatus DESC) = 1),
a AS (SELECT x.src AS k, last.* FROM x JOIN last ON l_orderkey = win), b AS (SELECT x.src AS k, last.* FROM x JOIN last ON l_orderkey = src),
texts AS (SELECT coalesce(a.k, b.k) AS k, row_number() OVER (PARTITION BY coalesce(a.k, b.k) ORDER BY coalesce(a.l_linenumber, b.l_linenumber)) AS r,
    CASE WHEN a.k IS NULL THEN 'missing field at offset ' || b.l_linenumber WHEN b.k IS NULL THEN 'extra field at offset ' || a.l_linenumber
    ELSE 'field at offset ' || a.l_linenumber || ': ' || a.s || '(' || a.f || ') vs ' || b.s || '(' || b.f || ')' END AS t
    FROM a FULL JOIN b ON a.k = b.k AND a.l_linenumber = b.l_linenumber WHERE a.k IS NULL OR b.k IS NULL OR a.s <> b.s OR a.f <> b.f OR a.q <> b.q),
tops AS (SELECT k, count(*) AS mismatch_count, string_agg(t, '; ' ORDER BY r) FILTER (r <= 3) AS shown FROM texts GROUP BY k)
SELECT e AS entity, src AS l_orderkey, win AS winning_source, wn - n AS field_count_diff, mismatch_count,
    CASE WHEN wn <> n THEN 'field count differs by ' || (wn - n) || '; ' ELSE '' END || shown ||
    CASE WHEN mismatch_count > 3 THEN '; ...and ' || (mismatch_count - 3) || ' more differences' ELSE '' END AS summary
FROM x LEFT JOIN tops ON k = src""")
def outlier_report(spark, folder):
    """Four orders describe one entity; those that differ from the winner, with their differences."""
    rows = lines(spark, folder).withColumn("entity", F.floor(F.col("l_orderkey") / 4))
    return flows.outlier_report(rows, ["entity"], "l_orderkey", "l_linestatus", "l_linenumber", "l_returnflag", "size", LAST)


@query("""
WITH e AS (SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type, event_id, value FROM events),
f AS (SELECT user_id, k % 7 AS o, CASE WHEN k < 8 THEN 'version' WHEN k < 12 THEN 'msgVer' ELSE event_type END AS name,
    CASE WHEN event_type = 'click' THEN 'U2' ELSE 'U1' END AS t,
    CASE WHEN k % 3 = 0 THEN 'Message version (0x' || lpad(CAST(k % 9 AS VARCHAR), 2, '0') || ')'
         WHEN k % 3 = 1 THEN 'Version ' || (k % 5) ELSE 'no number' END AS d,
    CASE WHEN k % 3 = 0 THEN k % 9 WHEN k % 3 = 1 THEN k % 5 END AS v, event_id AS pos FROM e),
z AS (SELECT user_id, arg_max(struct_pack(name, t, d, v, o), pos) FILTER (o = 0) AS zero,
    arg_max(struct_pack(name, t, d, v, o), pos) FILTER (o = 1) AS one,
    arg_min(struct_pack(name, t, d, v, o), pos) FILTER (name IN ('version', 'msgVer')) AS named FROM f GROUP BY user_id),
c AS (SELECT user_id, zero, one, named, CASE
    WHEN zero.name IN ('version', 'msgVer') AND zero.t = 'U1' THEN 1
    WHEN one.name IN ('version', 'msgVer') AND one.t = 'U1' THEN 2
    WHEN named IS NOT NULL THEN 3
    WHEN lower(zero.d) LIKE '%version%' AND lower(zero.d) LIKE '%message%' THEN 4 ELSE 5 END AS s FROM z)
SELECT user_id, s < 5 AS detected,
    CASE s WHEN 1 THEN zero.name WHEN 2 THEN one.name WHEN 3 THEN named.name WHEN 4 THEN zero.name END AS field_name,
    CASE s WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN named.o WHEN 4 THEN 0 END AS byte_offset,
    CASE s WHEN 1 THEN 'high' WHEN 2 THEN 'high' WHEN 3 THEN CASE WHEN named.t = 'U1' THEN 'medium' ELSE 'low' END WHEN 4 THEN 'medium' ELSE 'none' END AS confidence,
    CASE s WHEN 1 THEN coalesce(zero.v, 1) WHEN 2 THEN coalesce(one.v, 1) WHEN 3 THEN coalesce(named.v, 1) WHEN 4 THEN coalesce(zero.v, 1) ELSE 0 END AS protocol_version
FROM c""")
def version_detect(spark, folder):
    k = F.get_json_object("props", "$.k").cast("bigint")
    fields = table(spark, folder, "events").select(
        "user_id", F.col("event_id").alias("pos"), (k % 7).alias("byte_offset"),
        F.when(k < 8, F.lit("version")).when(k < 12, F.lit("msgVer")).otherwise(F.col("event_type")).alias("name"),
        F.when(F.col("event_type") == "click", F.lit("U2")).otherwise(F.lit("U1")).alias("data_type"),
        F.when(k % 3 == 0, F.format_string("Message version (0x%02d)", k % 9))
        .when(k % 3 == 1, F.concat(F.lit("Version "), (k % 5).cast("string"))).otherwise(F.lit("no number")).alias("description"),
    )
    found = version.detect_version(fields, ["user_id"], "name", "byte_offset", "data_type", "description", ["pos"])
    info = F.col("version_info")
    return found.select("user_id", info["detected"].alias("detected"), info["field_name"].alias("field_name"), info["byte_offset"].alias("byte_offset"), info["confidence"].alias("confidence"), "protocol_version")


@query("""
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 2 WHEN user_id % 3 = 1 THEN 3 ELSE 1 END AS field_count,
  substr(sha256(CASE WHEN user_id % 3 = 0 THEN '[["' || event_type || '", 0, "U4", 4], ["reserved", 4, "U1[' || (user_id % 11) || ']", ' || (user_id % 11) || ']]'
    WHEN user_id % 3 = 1 THEN '[["' || event_type || '", -1, "CH[N]", 0], ["val", 0, "R8", 8], ["caf\\u00e9", 8, "X2", 9]]'
    ELSE '[["' || event_type || '", 0, "U1", 1]]' END), 1, 16) AS fingerprint
FROM events""")
def document_fingerprint(spark, folder):
    """Fingerprints of JSON documents of several shapes, built from the events and read row by row."""
    e, kind = F.col("event_type"), F.col("user_id") % 3
    few = (F.col("user_id") % 11).cast("string")
    bare = F.concat(F.lit('{"fields":[{"name":"Reserved_1","byte_offset":4,"data_type":{"array_of":"U1","count":'), few,
                    F.lit('}},{"name":"'), F.upper(e), F.lit('","byte_offset":0,"data_type":"U4"}]}'))
    nested = F.concat(F.lit('{"' + fixed.WRAPPER + '":{"payload":{"fields":[{"name":"val","data_type":"R8"},{"name":"café","byte_offset":8,"data_type":"X2","size_bytes":9}],"repeated_groups":[{"fields":[{"name":"'), e,
                      F.lit('","byte_offset":"8 + 2*n","data_type":{"array_of":"CH","count":"N"}}]}]}}}'))
    flat = F.concat(F.lit('{"payload_fields":[{"name":"'), e, F.lit('"}],"payload":[]}'))
    documents = spread(table(spark, folder, "events")).select(
        "event_id", F.when(kind == 0, bare).when(kind == 1, nested).otherwise(flat).alias("structure")
    )
    return layout.add_fingerprint(layout.add_fields(documents)).select("event_id", "field_count", "fingerprint")


@query("""
SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 2 ELSE 1 END AS field_count, user_id % 2 = 0 AS wrapped FROM events""")
def document_fields(spark, folder):
    """Field counts over layouts, and bare fields moved into a payload."""
    e = F.col("event_type")
    bare = F.concat(F.lit('{"name":"m","fields":[{"name":"'), e, F.lit('"},{"name":"b"}]}'))
    nested = F.concat(F.lit('{"payload":{"fields":[{"name":"'), e, F.lit('"}]},"fields":[]}'))
    documents = table(spark, folder, "events").select("event_id", F.when(F.col("user_id") % 2 == 0, bare).otherwise(nested).alias("structure"))
    wrapped = documents.withColumn("moved", layout.wrapped_fields())
    return wrapped.select(
        "event_id", layout.count_fields("moved").alias("field_count"),
        F.try_variant_get(F.parse_json("moved"), "$.fields", "variant").isNull().alias("wrapped"),
    )
