"""Normalisers over texts formed from parts, suppliers, customers, events and page titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n
from ..operators import collection, enums, keys
from ..session import spread
from .base import query, table

P = fixed.MESSAGE_PREFIX


def _number(c, count, offset=0):
    return (F.col(c) % count + offset).cast("string")


@query("""
WITH f AS (SELECT s_suppkey, CASE s_suppkey % 6
    WHEN 0 THEN 'u-blox-20-HPG-2.0' || (s_nationkey % 9) || '_Interface' WHEN 1 THEN 'u-blox-F9-HPG-L1L5-1.' || s_nationkey || '_x'
    WHEN 2 THEN 'M9-ADR-5.' || s_nationkey || '_x' WHEN 3 THEN 'F9-HPS120_x' WHEN 4 THEN 'u-blox_ZED-F9H_x' ELSE 'doc-' || s_suppkey END AS name FROM supplier)
SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'X20' WHEN 1 THEN 'F9' WHEN 2 THEN 'M9' WHEN 3 THEN 'F9' WHEN 4 THEN 'F9' ELSE 'UNKNOWN' END AS family,
    CASE s_suppkey % 6 WHEN 0 THEN 'X20-HPG-2.0' || (s.s_nationkey % 9) WHEN 1 THEN 'F9-HPG-L1L5-1.' || s.s_nationkey WHEN 2 THEN 'M9-ADR-5.' || s.s_nationkey
        WHEN 3 THEN 'F9-HPS-1.20' WHEN 4 THEN 'F9-F9H-1.0' ELSE 'UNKNOWN-UNKNOWN-0.0' END AS short_name,
    CASE s_suppkey % 6 WHEN 0 THEN '20-HPG-2.0' || (s.s_nationkey % 9) WHEN 1 THEN 'F9-HPG-L1L5-1.' || s.s_nationkey WHEN 2 THEN 'M9-ADR-5.' || s.s_nationkey
        WHEN 4 THEN 'F9H' ELSE name END AS full_id,
    CASE s_suppkey % 6 WHEN 0 THEN '20-HPG/2.0' || (s.s_nationkey % 9) WHEN 1 THEN 'F9-HPG-L1L5/1.' || s.s_nationkey ELSE 'unknown/unknown' END AS short_key,
    CASE s_suppkey % 6 WHEN 1 THEN 'F9' WHEN 2 THEN 'M9' WHEN 3 THEN 'F9' WHEN 4 THEN 'F9' END AS manual_family
FROM f JOIN supplier s USING (s_suppkey)""")
def source_parse(spark, folder):
    key, nation = F.col("s_suppkey") % 6, F.col("s_nationkey").cast("string")
    name = (
        F.when(key == 0, F.concat(F.lit("u-blox-20-HPG-2.0"), _number("s_nationkey", 9), F.lit("_Interface")))
        .when(key == 1, F.concat(F.lit("u-blox-F9-HPG-L1L5-1."), nation, F.lit("_x")))
        .when(key == 2, F.concat(F.lit("M9-ADR-5."), nation, F.lit("_x"))).when(key == 3, F.lit("F9-HPS120_x"))
        .when(key == 4, F.lit("u-blox_ZED-F9H_x")).otherwise(F.concat(F.lit("doc-"), F.col("s_suppkey").cast("string")))
    )
    rows = table(spark, folder, "supplier").withColumn("name", name)
    short = n.key_source_short("name")
    return rows.select(
        "s_suppkey", n.source_from_filename("name")["family"].alias("family"), n.source_from_filename("name")["short_name"].alias("short_name"),
        n.key_source_full("name")["full_id"].alias("full_id"), F.concat_ws("/", short["family"], short["version"]).alias("short_key"),
        n.manual_family("name").alias("manual_family"),
    )


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'CFG-I2C-' || p_type || '_ENA_X' WHEN 1 THEN 'CFG-ODO_A_' || p_type WHEN 2 THEN 'KEY A ' || p_type ELSE p_type END AS name,
    CASE p_size % 3 WHEN 0 THEN 'I4' WHEN 1 THEN 'I1' ELSE 'U2' END AS data_type, 'TEMP ' || p_name AS description,
    CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE '1e-' || (p_size % 9) END AS scale,
    CASE WHEN p_size % 5 = 0 THEN CASE p_size % 4 WHEN 0 THEN 'ms' WHEN 2 THEN 'ms' ELSE 's' END
         WHEN p_size % 4 = 1 THEN 's' WHEN p_size % 4 = 3 THEN 'm (or m/s)' END AS unit FROM part""")
def ocr_fix(spark, folder):
    size = F.col("p_size")
    name = F.when(size % 4 == 0, F.concat(F.lit("CFG-12C-"), "p_type", F.lit("_ENNA X"))).when(
        size % 4 == 1, F.concat(F.lit("CFG-0DO A "), "p_type")).when(size % 4 == 2, F.concat(F.lit("KEY Α "), "p_type")).otherwise(F.col("p_type"))
    rows = table(spark, folder, "part").select(
        "p_partkey", name.alias("name"),
        F.when(size % 3 == 0, F.lit("14")).when(size % 3 == 1, F.lit("11")).otherwise(F.lit("U2")).alias("data_type"),
        F.concat(F.lit("ТЕМР "), "p_name").alias("description"),
        F.when(size % 5 == 0, F.lit("ms")).when(size % 5 == 1, F.lit("-")).otherwise(F.concat(F.lit("1e-"), (size % 9).cast("string"))).alias("scale"),
        F.when(size % 4 == 0, F.lit("the unit of the described value")).when(size % 4 == 1, F.lit("S")).when(size % 4 == 3, F.when(size % 5 == 0, F.lit("s")).otherwise(F.lit("m (or\nm/s)"))).alias("unit"),
    )
    return keys.repair(rows).drop("fixed")


@query("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'CFG-I2C-A_' || p_type WHEN 1 THEN 'X_ENA_B' ELSE 'Y_ENA' END AS name, CASE WHEN p_size % 2 = 0 THEN 'I8' ELSE 'E1' END AS data_type,
    CASE WHEN p_size % 4 = 3 THEN '2' END AS scale, CASE WHEN p_size % 4 = 2 THEN 's' END AS unit FROM part""")
def ocr_fix_light(spark, folder):
    size = F.col("p_size")
    rows = table(spark, folder, "part").select(
        "p_partkey",
        F.when(size % 3 == 0, F.concat(F.lit("CFG-12C-A "), "p_type")).when(size % 3 == 1, F.lit("X_ENAA B")).otherwise(F.lit("Y_ENNA")).alias("name"),
        F.when(size % 2 == 0, F.lit("18")).otherwise(F.lit("E1")).alias("data_type"),
        F.when(size % 4 == 0, F.lit("1")).when(size % 4 == 1, F.lit("-")).when(size % 4 == 2, F.lit("")).otherwise(F.lit("2")).alias("scale"),
        F.when(size % 4 == 0, F.lit("-")).when(size % 4 == 1, F.lit("")).when(size % 4 == 2, F.lit("s")).alias("unit"),
    )
    return keys.repair_light(rows)


@query("""
SELECT p_partkey, round(CASE p_size % 6 WHEN 0 THEN power(2, -(p_size % 20)) WHEN 1 THEN power(10.0, -(p_size % 9)) WHEN 2 THEN p_size * 0.5 WHEN 3 THEN power(10.0, p_size % 5) END, 9) AS multiplier,
    CASE p_size % 6 WHEN 0 THEN 'power_of_2' WHEN 1 THEN 'power_of_10' WHEN 3 THEN 'power_of_10' END AS kind,
    CAST(CASE p_size % 6 WHEN 0 THEN 2 WHEN 1 THEN 10 WHEN 3 THEN 10 END AS BIGINT) AS base,
    CAST(CASE p_size % 6 WHEN 0 THEN -(p_size % 20) WHEN 1 THEN -(p_size % 9) WHEN 3 THEN p_size % 5 END AS INT) AS exponent FROM part""")
def scale_parse(spark, folder):
    size = F.col("p_size")
    text = (
        F.when(size % 6 == 0, F.concat(F.lit("2^-"), _number("p_size", 20))).when(size % 6 == 1, F.concat(F.lit("1e-"), _number("p_size", 9)))
        .when(size % 6 == 2, (size * 0.5).cast("string")).when(size % 6 == 3, F.concat(F.lit("10^"), _number("p_size", 5)))
        .when(size % 6 == 4, F.lit("-")).otherwise(F.lit("see text"))
    )
    rows = table(spark, folder, "part").withColumn("s", n.scale(text))
    return rows.select("p_partkey", F.round("s.multiplier", 9).alias("multiplier"), "s.kind", "s.base", "s.exponent")


@query("""
SELECT p_partkey, CAST(CASE p_size % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size + 4 WHEN 2 THEN 0 ELSE 96 END AS BIGINT) AS base,
    CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN 'n*8' WHEN 2 THEN 'len*1,m*' || p_size ELSE 'a*2,b*3' END AS products FROM part""")
def offset_formula(spark, folder):
    size, text = F.col("p_size"), F.col("p_size").cast("string")
    formula = (
        F.when(size % 4 == 0, text).when(size % 4 == 1, F.concat(text, F.lit(" + 4 + n * 8")))
        .when(size % 4 == 2, F.concat(F.lit("len + "), text, F.lit("*m"))).otherwise(F.lit("96 + a*2+3 * b"))
    )
    rows = table(spark, folder, "part").withColumn("o", n.offset_formula(formula))
    shown = F.transform("o.products", lambda p: F.concat(p["field"], F.lit("*"), p["multiplier"].cast("string")))
    return rows.select("p_partkey", "o.base", F.array_join(shown, ",").alias("products"))


@query("""
SELECT p_partkey, '0x' || lpad(lower(hex(p_size)), 2, '0') AS group_id, '0x' || lpad(lower(hex(p_partkey % 65536)), 4, '0') AS item_id, CAST(p_size % 5 AS INT) AS size_code,
    '0x' || (p_size % 5) || '0' || lpad(lower(hex(p_size)), 2, '0') || lpad(lower(hex(p_partkey % 65536)), 4, '0') AS key_id,
    CASE WHEN p_size < 25 THEN 'CFG-' || p_type ELSE p_type END AS "group" FROM part""")
def key_bits(spark, folder):
    size = F.col("p_size")
    key = F.format_string("0x%d0%02x%04x", size % 5, size, F.col("p_partkey") % 65536)
    key = F.when(size % 5 == 0, F.concat(F.lit("0x"), F.format_string("%x", size * 65536 + F.col("p_partkey") % 65536))).otherwise(key)
    name = F.when(size < 25, F.concat_ws("-", F.lit("CFG"), "p_type", "p_name")).otherwise(F.concat_ws("-", "p_type", F.lit("X")))
    rows = table(spark, folder, "part").select("p_partkey", key.alias("key_id"), name.alias("name"), F.lit(None).cast("string").alias("scale"), F.lit("-").alias("unit"))
    out = keys.compliant(rows).withColumn("size_code", n.key_id_parts("key_id")["size_code"])
    return out.select("p_partkey", "group_id", "item_id", "size_code", "key_id", "group")


@query("""
SELECT p_type AS name, '0x' || lpad(lower(hex(arg_min(p_size, p_partkey))), 2, '0') AS group_id FROM part GROUP BY p_type""")
def key_groups(spark, folder):
    rows = table(spark, folder, "part").select(F.col("p_type").alias("group"), F.format_string("0x%02x", "p_size").alias("group_id"), "p_partkey")
    return keys.groups(rows, ["p_partkey"])


# -- enumerations ----------------------------------------------------------------------------

PAIRS = """
WITH f AS (SELECT p_partkey, p_type, p_brand, p_name, p_size, CASE WHEN p_size < 10 THEN 1 WHEN p_size < 25 THEN 2 ELSE 3 END AS shape FROM part),
pairs AS (SELECT p_partkey, CAST(0 AS BIGINT) AS value, p_name AS description FROM f WHERE shape > 1
    UNION ALL SELECT p_partkey, 1, p_brand || ' with <1g' FROM f WHERE shape > 1
    UNION ALL SELECT p_partkey, p_size, p_name || ' (hex)' FROM f WHERE shape = 3)
"""


def described_parts(spark, folder):
    size = F.col("p_size")
    both = F.concat(F.lit("0 = "), "p_name", F.lit(", 1 = "), "p_brand", F.lit(" with <1g"))
    more = F.concat(both, F.lit("; • 0x"), F.lower(F.hex(size)), F.lit(" = "), "p_name", F.lit(" (hex) .\n0 = again"))
    more = F.replace(more, F.lit("; •"), F.lit(" •"))
    text = F.when(size < 10, F.concat(F.lit("3 = "), "p_name")).when(size < 25, both).otherwise(more)
    return spread(table(spark, folder, "part")).withColumn("description", text)


@query(PAIRS + """
SELECT p_partkey, value, description, CASE WHEN value = 1 THEN replace(lower(replace(description, '<', '')), '#', '') ELSE replace(description, ' (hex)', '') END AS raw FROM pairs""")
def enum_values(spark, folder):
    out = enums.extract_enums(described_parts(spark, folder), ["p_partkey"], "description")
    return out.select("p_partkey", "value", "description", F.replace("name", F.lit("_"), F.lit(" ")).alias("raw"))


@query(PAIRS + """
, best AS (SELECT p_type, p_partkey, count(*) OVER (PARTITION BY p_type) AS occurrences,
    row_number() OVER (PARTITION BY p_type ORDER BY shape DESC, p_partkey) AS r FROM f WHERE shape > 1)
SELECT p_type, 'T' || p_type AS type, occurrences, value, description FROM best JOIN pairs USING (p_partkey) WHERE r = 1""")
def canonical_enum(spark, folder):
    fields = described_parts(spark, folder).withColumn("t", F.concat(F.lit("T"), "p_type"))
    out = enums.canonical_enums(fields, "p_type", "p_brand", "t", "description", ["p_partkey"])
    return out.select("p_type", "type", "occurrences", F.inline("values"))


@query(PAIRS + "SELECT p_type, p_brand FROM f WHERE shape > 1")
def enum_messages(spark, folder):
    return enums.enum_messages(described_parts(spark, folder), "p_type", "p_brand", "description")


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '_2d_' || replace(p_name, ' ', '_') WHEN 1 THEN 'dr_' || lower(p_type) WHEN 2 THEN 'gnss_dr' WHEN 3 THEN 'unknown'
    ELSE 'wrist_' || lower(p_type) || '_and_the_rest' || CASE WHEN length(p_type) <= 5 THEN '_of_a' WHEN length(p_type) <= 7 THEN '_of' ELSE '' END END AS name FROM part""")
def enum_name(spark, folder):
    size = F.col("p_size")
    text = (
        F.when(size % 5 == 0, F.concat(F.lit("2D-"), "p_name")).when(size % 5 == 1, F.concat(F.lit("Dead Reckoning "), "p_type"))
        .when(size % 5 == 2, F.lit("GNSS + dead reckoning combined")).when(size % 5 == 3, F.lit("(not used)"))
        .otherwise(F.concat(F.lit("Wrist-worn watch "), "p_type", F.lit(" and the rest of a sentence that is too long")))
    )
    return table(spark, folder, "part").select("p_partkey", n.enum_name(text).alias("name"))


# -- smaller ones ----------------------------------------------------------------------------


@query("""
SELECT c_custkey, CAST(trunc(CAST((c_custkey % 50) || '.' || (10 + c_nationkey) AS DOUBLE) * 100) AS BIGINT) * CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 1 END AS version,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'U' || (1 + c_nationkey) WHEN c_mktsegment = 'FURNITURE' THEN 'C' || c_nationkey ELSE c_mktsegment END AS type,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey WHEN c_mktsegment = 'FURNITURE' THEN c_custkey END AS discriminator FROM customer""")
def small_parsers(spark, folder):
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    text = F.concat((F.col("c_custkey") % 50).cast("string"), F.lit("."), (nation + 10).cast("string"))
    kind = F.when(segment == "BUILDING", F.format_string("U%03d", nation + 1)).when(segment == "FURNITURE", F.format_string("CH[%d]", nation)).otherwise(segment)
    note = F.when(segment == "BUILDING", F.format_string("type (0x%02x) here", nation)).when(segment == "FURNITURE", F.format_string("type (%d for this)", "c_custkey"))
    return table(spark, folder, "customer").select(
        "c_custkey", n.protocol_version(F.when(segment == "MACHINERY", F.lit("n/a")).otherwise(text)).alias("version"),
        n.registry_type(kind).alias("type"), n.discriminator_value(F.coalesce(note, F.lit("none"))).alias("discriminator"),
    )


@query("""
SELECT o_custkey, round(sum(o_orderkey * price_in + o_custkey * price_out) / 1e6, 8) AS cost FROM orders
JOIN (VALUES ('1-URGENT', 0.5, 3.0), ('2-HIGH', 0.1, 0.4), ('3-MEDIUM', 0.3, 2.5), ('4-NOT SPECIFIED', 0.15, 0.6), ('5-LOW', 1.25, 10.0)) p(o_orderpriority, price_in, price_out) USING (o_orderpriority)
GROUP BY o_custkey""")
def adjudication_cost(spark, folder):
    prices = spark.createDataFrame(
        [("1-URGENT", 0.5, 3.0), ("2-HIGH", 0.1, 0.4), ("3-MEDIUM", 0.3, 2.5), ("4-NOT SPECIFIED", 0.15, 0.6), ("5-LOW", 1.25, 10.0)],
        "o_orderpriority string, price_in double, price_out double",
    )
    rows = table(spark, folder, "orders").join(prices, "o_orderpriority")
    return rows.groupBy("o_custkey").agg(F.round(F.sum(n.token_cost("o_orderkey", "o_custkey", "price_in", "price_out")), 8).alias("cost"))


@query(f"""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    nullif(regexp_extract(regexp_extract(html, '<title>([^<]*)</title>', 1), '({P}[A-Z0-9]+-[A-Z0-9]+(?:-[A-Z0-9]+)*)', 1), '') AS message,
    lower(translate(regexp_extract(html, '<title>([^<]*)</title>', 1), 'ΑΒΕ', 'ABE')) AS folded FROM pages""")
def page_titles(spark, folder):
    rows = table(spark, folder, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return rows.select("page_id", "title", n.message_title("title").alias("message"), F.lower(n.unicode_to_ascii("title")).alias("folded"))


DOCUMENTS = """
WITH d AS (SELECT event_id, event_type, user_id, user_id % 7 AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
"""


def adjudicated(spark, folder):
    e, user, k = F.col("event_type"), F.col("user_id").cast("string"), F.get_json_object("props", "$.k")
    kind = F.col("user_id") % 7
    head = '{"num_extractions":4,"adjudication":%s{"canonical_confidence":"high","extraction_verdicts":[{"source":"a"},{"source":"b"},{"source":"a"}],"canonical_structure":%s}%s}'
    nested = F.concat(F.lit('{"name":"M'), user, F.lit('","ubx_class":"0x01","id":"0x02","message_type":"Periodic/Polled","payload":{"length":{"min":4,"max":'), k,
                      F.lit('},"fields":[{"name":"type","offset":0,"type":"U1","description":"Type (0x0'), (F.col("user_id") % 10).cast("string"), F.lit(' for this type)"},{"name":"'), e,
                      F.lit('","byte_offset":"4 + 2*n","reserved":true},{"data_type":"U1"}],"repeated_block":{"name":"g","base_offset":"8 + n*4","fields":[]}}}'))
    flat = F.concat(F.lit('{"' + fixed.WRAPPER + '":{"classId":1,"msg_id":"0x09","description":"'), e, F.lit('","payload_fields":[{"name":"a","data_type":{"array_of":"U1","count":4},"scale":"1e-2","unit":""}],"payload_length":['), k, F.lit(',8]}}'))
    listed = F.concat(F.lit('{"class_id":"0x01","message_id":"0x02","message_type":"poll","payload":[{"name":"x","byte_offset":3}],"payload_length":"4 + 4*'), e, F.lit('"}'))

    def whole(structure, many=False):
        opening, rest = (head % ("[" if many else "", "@", "]" if many else "")).split("@")
        return F.concat(F.lit(opening), structure, F.lit(rest))

    document = (
        F.when(kind == 0, whole(nested)).when(kind == 1, whole(flat, True)).when(kind == 2, whole(listed)).when(kind == 3, F.lit('{"adjudication":{}}'))
        .when(kind == 4, whole(F.lit('"text"'))).when(kind == 5, whole(F.lit('{"class_id":"0x01"}'))).otherwise(F.lit("{broken"))
    )
    return spread(table(spark, folder, "events")).select(F.col("event_id").cast("string").alias("message_name"), document.alias("document"))


@query(DOCUMENTS + """
SELECT CASE kind WHEN 0 THEN 'M' || user_id ELSE CAST(event_id AS VARCHAR) END AS name, CASE kind WHEN 1 THEN '1' ELSE '0x01' END AS class_id, CASE kind WHEN 1 THEN '0x09' ELSE '0x02' END AS message_id,
    CASE kind WHEN 0 THEN 'periodic_polled' WHEN 1 THEN 'output' ELSE 'poll_request' END AS message_type, CASE kind WHEN 1 THEN event_type END AS description,
    CASE kind WHEN 0 THEN 4 WHEN 2 THEN 0 END AS length_base, CASE kind WHEN 0 THEN 4 WHEN 1 THEN least(k, 8) END AS length_min, CASE kind WHEN 0 THEN k WHEN 1 THEN greatest(k, 8) END AS length_max,
    CASE kind WHEN 2 THEN '4 + 4*' || event_type END AS formula,
    CASE kind WHEN 0 THEN 'type@0:U1=' || (user_id % 10) || ',' || event_type || '@4 + 2*n:U1=' WHEN 1 THEN 'a@0:{"array_of":"U1","count":4}=' ELSE 'x@3:U1=' END AS fields,
    CASE kind WHEN 0 THEN 'g@8+n*4' ELSE '' END AS groups, 'a,b' AS source_manuals, 'Confidence: high, Sources: 4' AS comment FROM d WHERE kind < 3""")
def normalise_collection(spark, folder):
    registry, _ = collection.normalize(adjudicated(spark, folder))
    blank = F.lit("")
    fields = F.transform("fields", lambda f: F.concat(f["name"], F.lit("@"), f["byte_offset"], F.lit(":"), f["data_type"], F.lit("="), F.coalesce(f["fixed_value"].cast("string"), blank)))
    groups = F.transform("repeated_groups", lambda g: F.concat(
        g["name"], F.lit("@"), g["base_offset"]["base"].cast("string"), F.lit("+"), g["base_offset"]["products"][0]["field"], F.lit("*"), g["base_offset"]["products"][0]["multiplier"].cast("string")))
    length = F.col("length")
    return registry.select(
        "name", "class_id", "message_id", "message_type", "description", length["base"].alias("length_base"), length["min"].alias("length_min"), length["max"].alias("length_max"),
        length["formula"].alias("formula"), F.array_join(fields, ",").alias("fields"), F.array_join(groups, ",").alias("groups"),
        F.array_join("source_manuals", ",").alias("source_manuals"), "comment",
    )


@query(DOCUMENTS + """
SELECT CAST(event_id AS VARCHAR) AS message_name, CASE kind WHEN 3 THEN 'no canonical structure' WHEN 4 THEN 'canonical_structure is string' WHEN 5 THEN 'no message_id' ELSE 'not JSON' END AS reason
FROM d WHERE kind > 2""")
def collection_rejects(spark, folder):
    return collection.normalize(adjudicated(spark, folder))[1]
