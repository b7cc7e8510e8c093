"""Merges and upserts of parts, lines and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keys, merge
from . import flows
from .base import query, table


@query("""
SELECT source, lang, doc_id, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, doc_id) = 1""")
def merge_superset(spark, folder):
    """Per source the longest text of each language."""
    return merge.superset(table(spark, folder, "documents"), ["source"], ["lang"], "text", ["doc_id"], ["doc_id", "n_chars"])


@query("""
WITH owned AS (SELECT DISTINCT p_brand, CASE WHEN p_type = 'SMALL' THEN 'none' ELSE p_type END AS p_type FROM part)
SELECT p_brand, p_type, p_size, p_name, p_partkey FROM part JOIN owned USING (p_brand, p_type) WHERE p_name NOT LIKE '%bolt%'
QUALIFY row_number() OVER (PARTITION BY p_brand, p_type, p_size ORDER BY length(p_name) DESC, p_partkey) = 1""")
def merge_children(spark, folder):
    """Child lists of the fields the winner has, by (brand, type); reserved-like names stay out."""
    parts = table(spark, folder, "part")
    items = parts.withColumn("label", F.replace("p_name", F.lit("bolt"), F.lit("reserved")))
    out = merge.merge_children(
        parts.withColumn("p_type", F.when(F.col("p_type") == "SMALL", F.lit("none")).otherwise(F.col("p_type"))), items, ["p_brand"], ["p_type"], ["p_size"], "p_name", ["p_partkey"],
        ["p_name", "p_partkey"], drop_reserved="label",
    )
    return out


@query("""
WITH f AS (SELECT p_name, arg_min(p_partkey, p_partkey) AS p_partkey, arg_min(p_retailprice, p_partkey) AS p_retailprice, count(*) AS instance_count,
    count(DISTINCT p_brand) AS source_count FROM part GROUP BY p_name),
l AS (SELECT p_name, p_type FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY length(p_type) DESC, p_partkey) = 1),
e AS (SELECT p_name, arg_min(p_size, p_partkey) AS big_size FROM part WHERE p_size > 45 GROUP BY p_name)
SELECT p_name, p_partkey, p_retailprice, p_type, big_size, instance_count, source_count FROM f JOIN l USING (p_name) LEFT JOIN e USING (p_name)""")
def merge_provenance(spark, folder):
    parts = table(spark, folder, "part").withColumn("big_size", F.when(F.col("p_size") > 45, F.col("p_size")))
    return merge.provenance(parts, ["p_name"], "p_brand", ["p_partkey"], ["p_partkey", "p_retailprice"], ["p_type"], ["big_size"])


@query("SELECT DISTINCT p_name, p_brand FROM part")
def provenance_members(spark, folder):
    return merge.members(table(spark, folder, "part"), ["p_name"], "p_brand")


def enum_items(spark, folder):
    """(type, name, size) pairs, seen first by the brand that sorts first."""
    return table(spark, folder, "part").select("p_type", "p_name", "p_size", "p_brand")


UNION = """
WITH RECURSIVE pairs AS (SELECT p_type, p_name, p_size, min(p_brand) AS b FROM part GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY b, p_name, p_size) AS k FROM pairs),
r AS (SELECT DISTINCT p_type, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS names, CAST([] AS INTEGER[]) AS earlier, CAST([] AS INTEGER[]) AS pending, '' AS src, false AS ok FROM part
    UNION ALL SELECT p_type, k, CASE WHEN acc THEN list_append(names, p_name) ELSE names END, before, CASE WHEN acc THEN list_append(now, p_size) ELSE now END, b, acc
    FROM (SELECT *, NOT list_contains(names, p_name) AND NOT list_contains(before, p_size) AS acc
        FROM (SELECT o.p_type, o.k, o.p_name, o.p_size, o.b, names, CASE WHEN src = o.b THEN earlier ELSE list_concat(earlier, pending) END AS before,
            CASE WHEN src = o.b THEN pending ELSE CAST([] AS INTEGER[]) END AS now FROM r JOIN o ON o.p_type = r.p_type AND o.k = r.k + 1))),
accepted AS (SELECT o.p_type, o.p_name, o.p_size, o.b AS added_by FROM r JOIN o ON o.p_type = r.p_type AND o.k = r.k WHERE ok)
"""


@query(UNION + "SELECT * FROM accepted")
def enum_union(spark, folder):
    """Names and numbers per type, merged in brand order."""
    out = merge.enum_union(enum_items(spark, folder), ["p_type"], "p_name", "p_size", ["p_brand"])
    return out.select("p_type", "p_name", "p_size", F.col("added_at.p_brand").alias("added_by"))


@query(UNION + "SELECT DISTINCT p_type, p_name, p_brand FROM part JOIN accepted USING (p_type, p_name) WHERE p_brand >= added_by")
def enum_sources(spark, folder):
    items = enum_items(spark, folder)
    union = merge.enum_union(items, ["p_type"], "p_name", "p_size", ["p_brand"])
    return merge.enum_sources(items, union, ["p_type"], "p_name", "p_brand", ["p_brand"])


@query("""
SELECT count(*) AS keys, count(*) FILTER (p_size > 45) AS with_big, count(*) FILTER (p_type <> '') AS with_p_type FROM part""")
def merge_stats(spark, folder):
    return merge.merge_stats(table(spark, folder, "part").withColumn("big", F.when(F.col("p_size") > 45, F.col("p_size"))), ["big", "p_type"])


UPSERT = """
WITH new AS (SELECT p_partkey + 700 AS p_partkey, p_name, p_brand, p_type, p_size + 1 AS p_size, p_retailprice FROM part),
merged AS (SELECT coalesce(n.p_partkey, o.p_partkey) AS p_partkey, CASE WHEN n.p_partkey IS NULL THEN o.p_name ELSE n.p_name END AS p_name,
    CASE WHEN n.p_partkey IS NULL THEN o.p_size ELSE n.p_size END AS p_size,
    CASE WHEN o.p_partkey IS NULL THEN 'added' WHEN n.p_partkey IS NULL THEN 'kept' ELSE 'updated' END AS status
    FROM part o FULL JOIN new n ON o.p_partkey = n.p_partkey)
"""


def upserted(spark, folder):
    old = table(spark, folder, "part")
    new = old.withColumns({"p_partkey": F.col("p_partkey") + 700, "p_size": F.col("p_size") + 1})
    return merge.upsert(old, new, ["p_partkey"], ["p_size"])


@query(UPSERT + "SELECT p_partkey, p_name, p_size, status FROM merged")
def registry_upsert(spark, folder):
    return upserted(spark, folder).select("p_partkey", "p_name", "p_size", "status")


@query(UPSERT + "SELECT count(*) AS total, count(*) FILTER (status = 'added') AS added, count(*) FILTER (status = 'updated') AS updated FROM merged")
def upsert_counts(spark, folder):
    return merge.upsert_counts(upserted(spark, folder))


@query("SELECT '0x' || lpad(lower(hex(p_size)), 2, '0') AS class_id, CAST(p_partkey % 256 AS VARCHAR) AS message_id, p_name AS name FROM part ORDER BY p_size, p_partkey % 256, p_name")
def sorted_registry(spark, folder):
    rows = table(spark, folder, "part").select(
        F.format_string("0x%02x", F.col("p_size")).alias("class_id"), (F.col("p_partkey") % 256).cast("string").alias("message_id"), F.col("p_name").alias("name")
    )
    return merge.sorted_registry(rows)


VERSIONS = """
WITH es AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
v AS (SELECT DISTINCT l_partkey, s_nationkey * 100 AS version FROM es JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey <> 0)
"""


def _sources(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", F.col("l_suppkey").alias("source"))
    meta = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("source"), (F.col("s_nationkey") * 100).alias("version"))
    return lines, meta


@query(VERSIONS + """
SELECT l_partkey, s.source_count, min(version) AS min_version, max(version) AS max_version, count(version) AS version_count
FROM (SELECT l_partkey, count(*) AS source_count FROM es GROUP BY 1) s LEFT JOIN v USING (l_partkey) GROUP BY ALL""")
def supported_versions(spark, folder):
    return merge.supported_versions(*_sources(spark, folder), ["l_partkey"], "source", "version")


@query(VERSIONS + "SELECT l_partkey, version FROM v")
def entity_versions(spark, folder):
    return merge.entity_versions(*_sources(spark, folder), ["l_partkey"], "source", "version")


VARIANTS = """
WITH messages AS (SELECT p_brand || '-' || p_type AS name, arg_min(lower(p_name), p_partkey) AS message_type,
        'type 0x' || lpad(lower(hex(min(p_size))), 2, '0') AS text, min(p_size) AS d FROM part GROUP BY 1
    UNION ALL SELECT p_brand, 'base', '', NULL FROM part GROUP BY 1),
families AS (SELECT DISTINCT p_brand AS base_name, p_type AS variant, '-' || p_type || CASE WHEN p_brand = 'Brand#2' OR p_type = 'SMALL' THEN '-x' ELSE '' END AS suffix, p_type AS position
    FROM part),
variants AS (SELECT base_name, variant, position, name, message_type, CAST(d AS BIGINT) AS discriminator,
    row_number() OVER (PARTITION BY base_name ORDER BY coalesce(d, 999), position) - 1 AS variant_index
    FROM families JOIN messages ON name = base_name || suffix)
"""


def variant_tables(spark, folder):
    parts = table(spark, folder, "part")
    suffixed = parts.groupBy(F.concat_ws("-", "p_brand", "p_type").alias("name")).agg(
        F.min_by(F.lower("p_name"), "p_partkey").alias("message_type"),
        F.format_string("type 0x%02x", F.min("p_size")).alias("discriminator_text"),
    )
    bases = parts.select(F.col("p_brand").alias("name")).distinct().select("name", F.lit("base").alias("message_type"), F.lit("").alias("discriminator_text"))
    strange = (F.col("base_name") == "Brand#2") | (F.col("p_type") == "SMALL")
    families = parts.select(F.col("p_brand").alias("base_name"), "p_type").distinct().select(
        "base_name", F.col("p_type").alias("variant"), F.concat(F.lit("-"), "p_type", F.when(strange, F.lit("-x")).otherwise(F.lit(""))).alias("suffix"),
        F.lit(None).cast("bigint").alias("value"), F.col("p_type").alias("position"),
    )
    return suffixed.unionByName(bases), families


@query(VARIANTS + """
SELECT name, message_type, CAST(0 AS BIGINT) AS variant_count FROM messages WHERE name NOT IN (SELECT name FROM variants)
UNION ALL SELECT base_name, arg_min(message_type, position), count(*) FROM variants GROUP BY base_name""")
def consolidate_variants(spark, folder):
    return merge.consolidate(*variant_tables(spark, folder))[0]


@query(VARIANTS + "SELECT base_name, variant, discriminator, variant_index FROM variants")
def variant_list(spark, folder):
    found = merge.consolidate(*variant_tables(spark, folder))[1]
    return found.select("base_name", "variant", "discriminator", "variant_index")


@query("""
WITH dim AS (SELECT DISTINCT CASE WHEN p_type = 'SMALL' THEN 'none' ELSE p_type END AS parent, p_type || '-' || p_size % 3 AS variant FROM part)
SELECT p_partkey, coalesce(variant, p_type) AS p_type FROM part LEFT JOIN dim ON parent = p_type""")
def expand_variants(spark, folder):
    parts = table(spark, folder, "part")
    parent = F.when(F.col("p_type") == "SMALL", F.lit("none")).otherwise(F.col("p_type"))
    dim = parts.select(parent.alias("parent"), F.concat_ws("-", "p_type", (F.col("p_size") % 3).cast("string")).alias("variant"))
    return merge.expand_variants(parts.select("p_partkey", "p_type"), dim, "p_type", "parent", "variant")


@query("""
WITH p AS (SELECT o_custkey AS c_custkey, max(o_orderpriority) AS seg FROM orders GROUP BY 1)
SELECT c_custkey, c_name, coalesce(seg, c_mktsegment) AS c_mktsegment, seg IS NOT NULL AND seg <> c_mktsegment AS patched
FROM customer LEFT JOIN p USING (c_custkey)""")
def patch_registry(spark, folder):
    patches = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment"))
    return merge.patch(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), patches, ["c_custkey"], ["c_mktsegment"])


@query("""
WITH cur AS (SELECT p_brand, CASE WHEN p_brand = 'Brand#3' AND p_size >= 25 THEN 'old' ELSE p_type END AS p_type, min(p_partkey) AS v FROM part GROUP BY ALL),
ext AS (SELECT p_brand, CASE WHEN p_brand = 'Brand#3' AND p_size >= 35 THEN 'new' ELSE p_type END AS p_type, max(p_partkey) AS v FROM part GROUP BY ALL),
rep AS (SELECT DISTINCT p_brand FROM ext ANTI JOIN cur USING (p_brand, p_type))
SELECT p_brand, p_type, v, false AS replaced FROM cur WHERE p_brand NOT IN (FROM rep)
UNION ALL SELECT p_brand, p_type, v, true FROM ext WHERE p_brand IN (FROM rep)""")
def replace_lists(spark, folder):
    parts = table(spark, folder, "part")
    named = lambda least, name: F.when((F.col("p_brand") == "Brand#3") & (F.col("p_size") >= least), F.lit(name)).otherwise(F.col("p_type")).alias("p_type")
    current = parts.groupBy("p_brand", named(25, "old")).agg(F.min("p_partkey").alias("v"))
    extracted = parts.groupBy("p_brand", named(35, "new")).agg(F.max("p_partkey").alias("v"))
    return merge.replace_lists(current, extracted, ["p_brand"], "p_type")


@query("SELECT p_name AS name, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand FROM part GROUP BY p_name")
def deduplicate_keys(spark, folder):
    rows = table(spark, folder, "part").select(F.col("p_name").alias("name"), "p_partkey", "p_brand")
    return keys.deduplicate(rows, "name", ["p_partkey"])


@query("""
WITH t AS (SELECT l_orderkey, l_linestatus AS v, count(*) AS n, min(struct_pack(a := l_shipdate, b := l_linenumber)) AS f FROM lineitem GROUP BY ALL),
w AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, f, v) = 1),
g AS (SELECT l.*, w.f FROM lineitem l JOIN w ON w.l_orderkey = l.l_orderkey AND w.v = l.l_linestatus),
o AS (SELECT DISTINCT l_orderkey, l_returnflag FROM g WHERE l_shipdate = f.a AND l_linenumber = f.b)
SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey FROM g JOIN o USING (l_orderkey, l_returnflag) WHERE l_suppkey % 5 <> 0
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linenumber ORDER BY length(CAST(l_partkey AS VARCHAR)) DESC, l_shipdate, l_linenumber, l_partkey) = 1""")
def consensus_merged(spark, folder):
    """Lines of the flags that the winning line has, over all lines that agree with it; some are marked reserved."""
    items = table(spark, folder, "lineitem").withColumns({"label": F.col("l_partkey").cast("string"), "is_reserved": F.col("l_suppkey") % 5 == 0})
    return flows.consensus_merged(
        items, ["l_orderkey"], "l_linestatus", ["l_shipdate", "l_linenumber"], ["l_returnflag"], ["l_linenumber"], "label", ["l_partkey"], reserved="is_reserved"
    )
