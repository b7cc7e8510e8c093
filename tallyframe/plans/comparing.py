"""Gaps and cross-validation between registries derived from parts, lines, orders and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n
from ..operators import compare
from .base import query, table

GAPS = """
WITH e AS (SELECT DISTINCT p_brand || '-' || p_type AS name FROM part),
a AS (SELECT DISTINCT CASE WHEN p_size < 4 THEN p_brand || '-' || p_type
    WHEN p_size < 7 THEN p_brand || '-' || p_type || '-' || replace(p_name, ' ', '_') ELSE 'other-' || p_size END AS name
    FROM part),
m AS (SELECT e.name, a.name AS variant FROM e JOIN a ON starts_with(a.name, e.name || '-')),
gaps AS (SELECT coalesce(e.name, a.name) AS name, e.name IS NOT NULL AS expected, a.name IS NOT NULL AS actual,
    coalesce(e.name, a.name) IN (SELECT name FROM m) AS has_variants,
    CASE WHEN e.name IS NOT NULL AND a.name IS NOT NULL THEN 'covered'
         WHEN e.name IS NOT NULL AND e.name IN (SELECT name FROM m) THEN 'covered_by_variant'
         WHEN e.name IS NOT NULL THEN 'missing' WHEN a.name IN (SELECT variant FROM m) THEN 'variant' ELSE 'orphaned' END AS status
    FROM e FULL JOIN a ON e.name = a.name)
"""


def names(spark, folder):
    parts = table(spark, folder, "part")
    base, size = F.concat_ws("-", "p_brand", "p_type"), F.col("p_size")
    longer = F.concat_ws("-", base, F.replace("p_name", F.lit(" "), F.lit("_")))
    actual = F.when(size < 4, base).when(size < 7, longer).otherwise(F.concat(F.lit("other-"), size.cast("string")))
    return parts.select(base.alias("name")), parts.select(actual.alias("name"))


def gaps(spark, folder):
    return compare.gap(*names(spark, folder), "name", prefix=True)


@query(GAPS + "SELECT * FROM gaps")
def coverage_gap(spark, folder):
    return gaps(spark, folder)


@query(GAPS + "SELECT DISTINCT name, variant FROM m")
def prefix_match(spark, folder):
    expected, actual = names(spark, folder)
    return compare.prefix_matches(expected, actual.withColumnRenamed("name", "variant"), "name", "variant")


SUMMARY = """SELECT count(*) FILTER (expected) AS expected, count(*) FILTER (actual) AS actual, count(*) FILTER (expected AND actual) AS direct_matches,
    count(*) FILTER (has_variants) AS variant_matches, count(*) FILTER (expected AND (actual OR has_variants)) AS covered,
    count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'orphaned') AS orphaned,
    CAST(round_even(100.0 * count(*) FILTER (expected AND (actual OR has_variants)) / count(*) FILTER (expected), 1) AS DOUBLE) AS coverage_percent"""


@query(GAPS + SUMMARY + ", 'names' AS part FROM gaps UNION ALL " + SUMMARY.replace("has_variants", "false") + """, 'types' AS part FROM (
    SELECT e.t IS NOT NULL AS expected, a.t IS NOT NULL AS actual,
        CASE WHEN e.t IS NOT NULL AND a.t IS NOT NULL THEN 'covered' WHEN e.t IS NOT NULL THEN 'missing' ELSE 'orphaned' END AS status
    FROM (SELECT DISTINCT p_brand AS t FROM part) e FULL JOIN (SELECT DISTINCT CASE WHEN p_brand = 'Brand#3' THEN 'none' ELSE p_brand END AS t FROM part) a ON e.t = a.t)""")
def gap_summary(spark, folder):
    parts = table(spark, folder, "part")
    seen = parts.select(F.when(F.col("p_brand") == "Brand#3", F.lit("none")).otherwise(F.col("p_brand")).alias("t"))
    groups = compare.gap(parts.select(F.col("p_brand").alias("t")), seen, "t")
    return compare.gap_report(names=gaps(spark, folder), types=groups)


@query("""
SELECT coalesce(e.g, a.g) AS g, e.g IS NOT NULL AS expected, a.g IS NOT NULL AS actual, false AS has_variants,
    CASE WHEN e.g IS NULL THEN 'orphaned' WHEN a.g IS NULL THEN 'missing' ELSE 'covered' END AS status
FROM (SELECT DISTINCT l_suppkey AS g FROM lineitem) e FULL JOIN
     (SELECT DISTINCT s_suppkey + 3 AS g FROM supplier) a ON e.g = a.g""")
def group_gap(spark, folder):
    expected = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("g"))
    return compare.gap(expected, table(spark, folder, "supplier").select((F.col("s_suppkey") + 3).alias("g")), "g")


@query(GAPS + """
, pairs AS (SELECT DISTINCT p_brand || '-' || p_type AS name, p_name FROM part)
SELECT name, split_part(name, '-', 2) AS class, count(p_name) AS source_count FROM gaps LEFT JOIN pairs USING (name)
WHERE status = 'missing' GROUP BY name""")
def missing_by_class(spark, folder):
    pairs = table(spark, folder, "part").select(F.concat_ws("-", "p_brand", "p_type").alias("entity"), F.col("p_name").alias("source")).distinct()
    return compare.missing_by_class(gaps(spark, folder), "name", pairs)


P = fixed.MESSAGE_PREFIX
OUTLINE = f"""
WITH outline AS (SELECT source, '3.' || doc_id || ' {P}' || upper(lang) || '-' || upper(CAST(n_chars % 9 AS VARCHAR)) || ' (0x01 0x02)' AS title,
    '{P}' || upper(lang) || '-' || CAST(n_chars % 9 AS VARCHAR) AS entity FROM documents
    UNION ALL SELECT source, '5.1 CFG-' || upper(lang) || CASE WHEN n_chars % 9 = 1 THEN 'X' ELSE '' END, NULL FROM documents)
"""


def titles(spark, folder):
    docs = table(spark, folder, "documents")
    few = (F.col("n_chars") % 9).cast("string")
    message = F.concat(F.lit("3."), F.col("doc_id").cast("string"), F.lit(f" {P}"), F.upper("lang"), F.lit("-"), F.upper(few), F.lit(" (0x01 0x02)"))
    group = F.concat(F.lit("5.1 CFG-"), F.upper("lang"), F.when(few == "1", F.lit("X")).otherwise(F.lit("")))
    return docs.select("source", F.explode(F.array(message, group)).alias("title"))


@query(OUTLINE + "SELECT DISTINCT entity, source FROM outline WHERE entity IS NOT NULL")
def inventory(spark, folder):
    return compare.inventory(titles(spark, folder), "source", "title")


@query(OUTLINE + "SELECT entity, count(DISTINCT source) AS source_count FROM outline WHERE entity IS NOT NULL GROUP BY entity")
def inventory_counts(spark, folder):
    return compare.inventory_counts(compare.inventory(titles(spark, folder), "source", "title"), "entity")


@query("SELECT DISTINCT 'CFG-' || upper(lang) || CASE WHEN n_chars % 9 = 1 THEN 'X' ELSE '' END AS entity, source FROM documents")
def group_inventory(spark, folder):
    return compare.inventory(titles(spark, folder), "source", "title", n.group_title)


# -- cross-validation ------------------------------------------------------------------------

REGISTRIES = """
WITH ours AS (SELECT p_brand AS message, CASE WHEN p_size > 30 THEN p_name || ' x' ELSE p_name END AS field, CASE WHEN min(p_size) < 12 THEN 'U1' ELSE 'X4' END AS dtype FROM part GROUP BY ALL),
theirs AS (SELECT CASE WHEN p_brand = 'Brand#3' THEN 'Other#3' ELSE p_brand END AS message, CASE WHEN p_size < 10 THEN p_name || ' y' WHEN p_name LIKE 'small%' THEN replace(p_name, ' ', '_') WHEN p_name LIKE 'hot%' AND p_brand < 'Brand#2' THEN p_name || '_hp'
        WHEN p_name LIKE 'blue%' THEN 'group_' || p_name ELSE p_name END AS field,
    CASE WHEN min(p_size) < 20 THEN 'U001' ELSE 'X004' END AS dtype FROM part GROUP BY ALL),
aliases AS (SELECT DISTINCT p_name AS our_name, replace(p_name, ' ', '_') AS other_name FROM part WHERE p_name LIKE 'small%'),
hp AS (SELECT DISTINCT p_brand AS message, p_name AS our_name, p_name || '_hp' AS other_name FROM part WHERE p_name LIKE 'hot%' AND p_brand < 'Brand#2'),
equal AS (SELECT DISTINCT p_brand AS message, p_name AS field FROM part WHERE p_name LIKE 'red%'),
extras AS (SELECT DISTINCT p_brand AS message, p_name AS field FROM part WHERE p_name LIKE 'old%'),
shared AS (SELECT DISTINCT message FROM theirs SEMI JOIN ours USING (message)),
r AS (SELECT o.*, coalesce(d.field, al.field, h.field) AS other, coalesce(d.dtype, al.dtype, h.dtype) AS other_type FROM ours o SEMI JOIN shared USING (message)
    LEFT JOIN theirs d ON d.message = o.message AND d.field = o.field
    LEFT JOIN aliases a ON a.our_name = o.field LEFT JOIN theirs al ON al.message = o.message AND al.field = a.other_name
    LEFT JOIN hp x ON x.message = o.message AND x.our_name = o.field LEFT JOIN theirs h ON h.message = o.message AND h.field = x.other_name),
issues AS (
    SELECT message, field, 'our_only' AS issue, dtype AS our_type, NULL AS other_type FROM r WHERE other IS NULL
    UNION ALL SELECT message, field, 'type_mismatch', dtype, other_type FROM r WHERE other IS NOT NULL
        AND dtype <> substr(other_type, 1, 1) || CAST(CAST(substr(other_type, 2) AS INT) AS VARCHAR)
        AND NOT EXISTS (SELECT 1 FROM equal q WHERE q.message = r.message AND q.field = r.field)
    UNION ALL SELECT t.message, t.field, CASE WHEN t.field LIKE 'group_%' OR EXISTS (SELECT 1 FROM extras e WHERE e.message = t.message AND e.field = t.field) THEN 'ignored' ELSE 'library_only' END, NULL, t.dtype
        FROM theirs t SEMI JOIN shared USING (message) WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.message = t.message AND r.other = t.field))
"""


def registries(spark, folder):
    parts = table(spark, folder, "part")
    name, brand = F.col("p_name"), F.col("p_brand")
    ours = parts.groupBy(brand.alias("message"), F.when(F.col("p_size") > 30, F.concat(name, F.lit(" x"))).otherwise(name).alias("field")).agg(
        F.when(F.min("p_size") < 12, F.lit("U1")).otherwise(F.lit("X4")).alias("dtype"))
    underscored, hot = F.replace(name, F.lit(" "), F.lit("_")), name.startswith("hot") & (brand < "Brand#2")
    renamed = F.when(F.col("p_size") < 10, F.concat(name, F.lit(" y"))).when(name.startswith("small"), underscored).when(hot, F.concat(name, F.lit("_hp"))).when(name.startswith("blue"), F.concat(F.lit("group_"), name)).otherwise(name)
    theirs = parts.groupBy(F.when(brand == "Brand#3", F.lit("Other#3")).otherwise(brand).alias("message"), renamed.alias("field")).agg(
        F.when(F.min("p_size") < 20, F.lit("U001")).otherwise(F.lit("X004")).alias("dtype"))
    pairs = parts.select(brand.alias("message"), name.alias("field")).distinct()
    aliases = pairs.where(F.col("field").startswith("small")).select(F.col("field").alias("our_name"), F.replace("field", F.lit(" "), F.lit("_")).alias("other_name")).distinct()
    expansions = pairs.where(F.col("field").startswith("hot") & (F.col("message") < "Brand#2")).select("message", F.col("field").alias("our_name"), F.concat("field", F.lit("_hp")).alias("other_name"))
    equal = pairs.where(F.col("field").startswith("red")).select("message", "field", F.lit("X4").alias("a"), F.lit("U1").alias("b"))
    extras = pairs.where(F.col("field").startswith("old"))
    return ours, theirs, aliases, expansions, extras, equal


def cross_issues(spark, folder):
    ours, theirs, aliases, expansions, extras, equal = registries(spark, folder)
    return compare.cross(ours, theirs, "message", "field", "dtype", aliases, expansions, ["group_.*"], extras, equal)


@query(REGISTRIES + "SELECT * FROM issues")
def cross_validate(spark, folder):
    return cross_issues(spark, folder)


OUR_FIELD, THEIR_MESSAGE = "CASE WHEN p_size > 30 THEN p_name || ' x' ELSE p_name END", "CASE WHEN p_brand = 'Brand#3' THEN 'Other#3' ELSE p_brand END"
THEIR_FIELD = """CASE WHEN p_size < 10 THEN p_name || ' y' WHEN p_name LIKE 'small%' THEN replace(p_name, ' ', '_') WHEN p_name LIKE 'hot%' AND p_brand < 'Brand#2' THEN p_name || '_hp'
    WHEN p_name LIKE 'blue%' THEN 'group_' || p_name ELSE p_name END"""
BITS = REGISTRIES + f"""
, ob AS (SELECT p_brand AS message, {OUR_FIELD} || CASE WHEN p_name LIKE 'red%' THEN ' z' ELSE '' END AS field, p_type AS bit, min(p_size) AS bit_offset, 1 + min(p_size) % 4 AS width FROM part GROUP BY ALL),
tb AS (SELECT {THEIR_MESSAGE} AS message, {THEIR_FIELD} AS field, CASE WHEN p_type = 'SMALL' THEN 'small' ELSE p_type END AS bit, max(p_size) AS bit_offset, 1 + min(p_size) % 4 AS width FROM part GROUP BY ALL),
th AS (SELECT DISTINCT r.message, r.field, tb.bit, tb.bit_offset, tb.width FROM r JOIN tb ON tb.message = r.message AND tb.field = r.other WHERE r.dtype LIKE 'X%'),
wb AS (SELECT DISTINCT message, field FROM th), held AS (SELECT * FROM wb SEMI JOIN ob USING (message, field)),
o AS (SELECT * FROM ob SEMI JOIN held USING (message, field)), t AS (SELECT * FROM th SEMI JOIN held USING (message, field)),
j AS (SELECT coalesce(o.message, t.message) AS message, coalesce(o.field, t.field) AS field, coalesce(o.bit, t.bit) AS bit, o.bit AS ob, t.bit AS tb,
    CAST(o.bit_offset AS BIGINT) AS our_offset, CAST(t.bit_offset AS BIGINT) AS other_offset, CAST(o.width AS BIGINT) AS our_width, CAST(t.width AS BIGINT) AS other_width
    FROM o FULL JOIN t ON o.message = t.message AND o.field = t.field AND (o.bit = t.bit OR (o.bit = 'SMALL' AND t.bit = 'small'))),
bit_issues AS (
    SELECT message, field, bit, 'only_ours' AS issue, our_offset, other_offset, our_width, other_width FROM j WHERE tb IS NULL
    UNION ALL SELECT message, field, bit, 'only_theirs', our_offset, other_offset, our_width, other_width FROM j WHERE ob IS NULL
    UNION ALL SELECT message, field, bit, 'offset_mismatch', our_offset, other_offset, our_width, other_width FROM j WHERE our_offset <> other_offset
    UNION ALL SELECT message, field, bit, 'width_mismatch', our_offset, other_offset, our_width, other_width FROM j WHERE our_width <> other_width
    UNION ALL SELECT message, field, NULL, 'missing_bitfield', NULL, NULL, NULL, NULL FROM wb ANTI JOIN ob USING (message, field))
"""


def registry_bits(spark, folder):
    ours, theirs, aliases, expansions, *_ = registries(spark, folder)
    parts = table(spark, folder, "part")
    size, least, kind = F.col("p_size"), F.min("p_size"), F.col("p_type")
    our_field = F.concat(F.expr(OUR_FIELD), F.when(F.col("p_name").startswith("red"), F.lit(" z")).otherwise(F.lit("")))
    our_bits = parts.groupBy(F.col("p_brand").alias("message"), our_field.alias("field"), kind.alias("bit")).agg(least.alias("bit_offset"), (1 + least % 4).alias("width"))
    their_bits = parts.groupBy(F.expr(THEIR_MESSAGE).alias("message"), F.expr(THEIR_FIELD).alias("field"), F.when(kind == "SMALL", F.lit("small")).otherwise(kind).alias("bit")).agg(
        F.max(size).alias("bit_offset"), (1 + least % 4).alias("width"))
    bit_aliases = spark.createDataFrame([("SMALL", "small")], "our_name string, other_name string")
    return compare.cross_bits(ours, theirs, our_bits, their_bits, "message", "field", "dtype", "bit", aliases, bit_aliases, expansions)


@query(BITS + "SELECT * FROM bit_issues")
def cross_bits(spark, folder):
    return registry_bits(spark, folder)


@query(BITS + """
, every AS (SELECT message, issue FROM issues UNION ALL SELECT message, issue FROM bit_issues)
SELECT (SELECT count(DISTINCT message) FROM ours) AS total, (SELECT count(*) FROM shared) AS found,
    count(DISTINCT message) FILTER (issue <> 'ignored') AS with_differences,
    count(DISTINCT message) FILTER (issue IN ('type_mismatch', 'offset_mismatch', 'width_mismatch', 'missing_bitfield')) AS with_real_issues,
    count(DISTINCT message) FILTER (issue = 'missing_bitfield') AS missing_bitfields,
    (SELECT count(*) FROM shared) - count(DISTINCT message) FILTER (issue <> 'ignored') AS fully_matched FROM every""")
def cross_summary(spark, folder):
    ours, theirs, *_ = registries(spark, folder)
    issues = cross_issues(spark, folder).select("message", "issue").unionByName(registry_bits(spark, folder).select("message", "issue"))
    return compare.cross_summary(ours, theirs, issues, "message")


BIT_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bit_offset
FROM lineitem""")
def bit_layout(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", *BIT_ORDER, F.col("l_quantity").cast("bigint").alias("width"))
    return compare.bit_offsets(lines, ["l_orderkey"], BIT_ORDER, "width").drop("width")


@query("""
WITH base AS (SELECT p_brand AS message, p_type AS field, p_name AS bit, min(p_size) AS bit_offset, 1 + min(p_size) % 4 AS width FROM part GROUP BY ALL),
o AS (SELECT message, field, CASE WHEN bit_offset >= 40 THEN bit || ' o' ELSE bit END AS bit, bit_offset, width FROM base),
t AS (SELECT message, field, CASE WHEN bit_offset <= 5 THEN bit || ' t' WHEN bit LIKE 'hot%' THEN replace(bit, ' ', '') ELSE bit END AS bit, bit_offset + CASE WHEN bit LIKE 'red%' THEN 1 ELSE 0 END AS bit_offset,
    width + CASE WHEN bit LIKE 'old%' THEN 1 ELSE 0 END AS width FROM base),
j AS (SELECT coalesce(o.message, t.message) AS message, coalesce(o.field, t.field) AS field, coalesce(o.bit, t.bit) AS bit, o.bit AS ob, t.bit AS tb,
    o.bit_offset AS our_offset, t.bit_offset AS other_offset, o.width AS our_width, t.width AS other_width
    FROM o FULL JOIN t ON o.message = t.message AND o.field = t.field AND (o.bit = t.bit OR (o.bit LIKE 'hot%' AND replace(o.bit, ' ', '') = t.bit)))
SELECT message, field, bit, 'only_ours' AS issue, our_offset, other_offset, our_width, other_width FROM j WHERE tb IS NULL
UNION ALL SELECT message, field, bit, 'only_theirs', our_offset, other_offset, our_width, other_width FROM j WHERE ob IS NULL
UNION ALL SELECT message, field, bit, 'offset_mismatch', our_offset, other_offset, our_width, other_width FROM j WHERE our_offset <> other_offset
UNION ALL SELECT message, field, bit, 'width_mismatch', our_offset, other_offset, our_width, other_width FROM j WHERE our_width <> other_width""")
def compare_bits(spark, folder):
    name = F.col("bit")
    base = table(spark, folder, "part").groupBy(F.col("p_brand").alias("message"), F.col("p_type").alias("field"), F.col("p_name").alias("bit")).agg(F.min("p_size").alias("bit_offset"))
    base = base.withColumn("width", 1 + F.col("bit_offset") % 4)
    joined = F.replace(name, F.lit(" "), F.lit(""))
    theirs = base.select(
        "message", "field", F.when(F.col("bit_offset") <= 5, F.concat(name, F.lit(" t"))).when(name.startswith("hot"), joined).otherwise(name).alias("bit"),
        (F.col("bit_offset") + F.when(name.startswith("red"), 1).otherwise(0)).alias("bit_offset"),
        (F.col("width") + F.when(name.startswith("old"), 1).otherwise(0)).alias("width"),
    )
    aliases = base.where(name.startswith("hot")).select(name.alias("our_name"), joined.alias("other_name")).distinct()
    ours = base.withColumn("bit", F.when(F.col("bit_offset") >= 40, F.concat(name, F.lit(" o"))).otherwise(name))
    return compare.compare_bits(ours, theirs, ["message", "field"], "bit", aliases)


@query(f"""
SELECT DISTINCT name FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN '{P}' ELSE '' END || c_name AS name, c_name FROM customer)
WHERE c_name IN (SELECT 'Customer#' || lpad(CAST(3 * o_custkey AS VARCHAR), 9, '0') FROM orders)""")
def common_messages(spark, folder):
    ours = table(spark, folder, "customer").select(F.concat(F.when(F.col("c_custkey") % 2 == 0, F.lit(P)).otherwise(F.lit("")), "c_name").alias("name"))
    theirs = table(spark, folder, "orders").select(F.format_string("Customer#%09d", 3 * F.col("o_custkey")).alias("name"))
    return compare.common_messages(ours, theirs, "name")


# -- what is left ----------------------------------------------------------------------------


@query("SELECT doc_id, source, lang FROM documents ANTI JOIN labels USING (doc_id)")
def remaining(spark, folder):
    return compare.remaining(table(spark, folder, "documents").select("doc_id", "source", "lang"), table(spark, folder, "labels"), ["doc_id"])


@query("""
SELECT DISTINCT p_partkey, code FROM (SELECT p_partkey, CASE WHEN p_size < 25 THEN 'X' || (1 + p_size % 4) ELSE 'U4' END AS code,
    CASE WHEN p_type <> 'SMALL' THEN p_type END AS bits FROM part) WHERE code LIKE 'X%' AND bits IS NULL""")
def missing_attr(spark, folder):
    code = F.when(F.col("p_size") < 25, F.concat(F.lit("X"), (1 + F.col("p_size") % 4).cast("string"))).otherwise(F.lit("U4"))
    fields = table(spark, folder, "part").select("p_partkey", code.alias("code"), F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("bits"))
    return compare.missing_attribute(fields, "code", "bits").select("p_partkey", "code").distinct()


@query("""
WITH k AS (SELECT DISTINCT o_custkey FROM orders), c AS (SELECT DISTINCT o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderpriority END AS p FROM orders),
r AS (SELECT DISTINCT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'open' ELSE o_orderpriority END AS p FROM orders),
cc AS (SELECT o_custkey, count(*) AS n FROM c GROUP BY 1), rc AS (SELECT o_custkey, count(*) AS n FROM r GROUP BY 1),
m AS (SELECT o_custkey, count(*) AS n FROM (FROM r ANTI JOIN c USING (o_custkey, p)) GROUP BY 1)
SELECT o_custkey, coalesce(cc.n, 0) AS current_count, rc.n AS reference_count, coalesce(m.n, 0) AS missing_count
FROM k LEFT JOIN cc USING (o_custkey) LEFT JOIN rc USING (o_custkey) LEFT JOIN m USING (o_custkey)
WHERE m.n > 0 OR (rc.n IS NULL AND coalesce(cc.n, 0) <= 1)""")
def incomplete_lists(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    named = lambda status: orders.withColumn("o_orderpriority", F.when(F.col("o_orderstatus") == status, F.lit("open")).otherwise(F.col("o_orderpriority")))
    return compare.incomplete_lists(
        named("O"), orders, ["o_custkey"], "o_orderpriority", named("F")
    )


@query("""SELECT DISTINCT doc_id FROM documents WHERE regexp_matches(lower(text), 'license|copyright|password')""")
def issue_keywords(spark, folder):
    words = ["license", "copyright", "password"]
    return compare.keyword_issues(table(spark, folder, "documents"), "doc_id", "text", words)


@query("""
SELECT l_orderkey, l_suppkey, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
    ORDER BY CASE WHEN l_suppkey::VARCHAR LIKE '%7%' THEN 0 WHEN l_suppkey::VARCHAR LIKE '%3%' THEN 1 ELSE 2 END, l_shipdate, l_linenumber, l_partkey, l_suppkey) = 1""")
def best_source(spark, folder):
    lines = table(spark, folder, "lineitem")
    rank = n.preference_rank(F.col("l_suppkey").cast("string"), ["7", "3"])
    return compare.best_source(lines, ["l_orderkey"], rank, ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"], ["l_suppkey", "l_partkey"])


@query("""
WITH won AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'),
m AS (SELECT l.*, w.l_suppkey IS NOT NULL AS w FROM lineitem l LEFT JOIN won w USING (l_orderkey, l_suppkey))
SELECT l_orderkey, l_partkey FROM m QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY w DESC,
    CASE WHEN w THEN epoch(l_shipdate) * -1 ELSE epoch(l_shipdate) END, CASE WHEN w THEN -l_partkey ELSE l_partkey END, CASE WHEN w THEN -l_linenumber ELSE l_linenumber END) = 1""")
def best_reviewable(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_shipdate", "l_linenumber", "l_returnflag")
    winning = lines.where("l_returnflag = 'R'")
    return compare.best_reviewable(lines, ["l_orderkey"], "l_suppkey", winning, ["l_shipdate", "l_partkey", "l_linenumber"], ["l_partkey"])


@query("SELECT split_part(p_brand || '-' || p_type, '-', 2) AS class, count(*) AS messages FROM part GROUP BY 1")
def messages_by_class(spark, folder):
    return compare.by_class(table(spark, folder, "part").select(F.concat_ws("-", "p_brand", "p_type").alias("name")), "name")
