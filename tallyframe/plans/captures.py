"""Frames built from events: encoding, scanning, decoding and what the values mean."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import wire
from ..operators import codec, registry
from ..session import cut_lineage, run_dir, spread
from ..sources import writers
from ..sources.store import Store
from .base import query, table

# class, message and layout of the events' frames: (column, type, offset)
CLASS_ID, MESSAGE_ID = 5, 7
LAYOUT = [("event_id", "U8", 0), ("user_id", "I4", 8), ("value", "R8", 12), ("single", "R4", 20), ("event_type", "CH[8]", 24), ("flags", "X2", 34)]


def events(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    return spread(table(spark, folder, "events")).select(
        "event_id", (F.col("user_id") * -1).alias("user_id"), "value", F.round("value", 0).alias("single"), "event_type", (k * 5).alias("flags"),
    )


def frames(spark, folder):
    return codec.encode_columns(events(spark, folder), F.lit(CLASS_ID), F.lit(MESSAGE_ID), LAYOUT)


def chunks(spark, folder):
    """One chunk per event: noise, then the frame; the captures are those of the users."""
    noise = F.unhex(F.repeat(F.lit("00B5FF62"), (F.col("event_id") % 5).cast("int")))
    rows = frames(spark, folder)
    chunked = rows.select((-F.col("user_id")).alias("capture"), F.col("event_id").alias("seq"), F.concat(noise, F.col("frame")).alias("data"))
    return cut_lineage(chunked)  # written, as captures are


def tables(spark):
    messages = spark.createDataFrame([(CLASS_ID, MESSAGE_ID, "EVENT")], "class_id int, message_id int, message string")
    rows = [(CLASS_ID, MESSAGE_ID, None, i, name, at, kind) for i, (name, kind, at) in enumerate(LAYOUT)]
    fields = spark.createDataFrame(rows, "class_id int, message_id int, variant string, pos int, field string, byte_offset int, data_type string")
    return messages, fields


def scanned(spark, folder):
    return codec.scan(chunks(spark, folder), "capture", "data", "seq", block=1 << 17, fan=4)


def identified(spark, folder):
    return codec.identify(codec.header(scanned(spark, folder)), codec.layouts(*tables(spark)))


def decoded(spark, folder):
    return codec.decode(identified(spark, folder), ["capture", "offset"])


SIZES = "44 + 4 * (event_id % 5)"


@query(f"""
SELECT user_id AS capture, CAST(coalesce(sum({SIZES}) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 4 * (event_id % 5) AS BIGINT) AS "offset",
    CAST(44 AS INT) AS size FROM events""")
def frame_scan(spark, folder):
    return scanned(spark, folder).select("capture", "offset", F.length("frame").alias("size"))


@query("SELECT event_id, CAST(-user_id AS BIGINT) AS user_id, value, event_type, CAST(json_extract(props, '$.k') AS BIGINT) * 5 AS flags, round(value, 0) AS single FROM events")
def frame_roundtrip(spark, folder):
    """Events encoded, concatenated with noise, scanned and decoded again."""
    def number(name):
        return F.max(F.when(F.col("field") == name, F.col("int_value"))).cast("bigint").alias(name)

    def real(name):
        return F.max(F.when(F.col("field") == name, F.col("real_value"))).alias(name)

    wide = decoded(spark, folder).groupBy("capture", "offset").agg(
        number("event_id"), number("user_id"), real("value"), real("single"), number("flags"),
        F.max(F.when(F.col("field") == "event_type", F.col("text_value"))).alias("event_type"),
    )
    return wide.drop("capture", "offset")


@query("SELECT 'ok' AS status, count(*) AS frames FROM events")
def frame_headers(spark, folder):
    return codec.header(scanned(spark, folder)).groupBy("status").agg(F.count(F.lit(1)).alias("frames"))


@query("""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'too_short' WHEN 2 THEN 'bad_sync' WHEN 3 THEN 'truncated' ELSE 'bad_checksum' END AS status FROM events""")
def frame_status(spark, folder):
    """Frames damaged in every way."""
    f, kind = F.col("frame"), F.col("event_id") % 5
    damaged = (
        F.when(kind == 0, f).when(kind == 1, F.substring(f, 1, 7)).when(kind == 2, F.concat(F.unhex(F.lit("B563")), F.substring(f, 3, 100)))
        .when(kind == 3, F.substring(f, 1, 40)).otherwise(F.concat(F.substring(f, 1, 42), F.unhex(F.lit("0000")), F.unhex(F.lit(""))))
    )
    broken = F.when((kind == 4) & (F.substring(f, 43, 2) == F.unhex(F.lit("0000"))), F.concat(F.substring(f, 1, 42), F.unhex(F.lit("0101")))).otherwise(damaged)
    rows = frames(spark, folder).select("event_id", broken.alias("frame"))
    return codec.header(rows).select("event_id", "status")


CHECKSUM = """
WITH b AS (SELECT event_id, event_type || ':' || user_id AS t FROM events),
x AS (SELECT event_id, length(t) AS n, list_transform(range(1, length(t) + 1), lambda i: struct_pack(v := ascii(substr(t, CAST(i AS INT), 1)), i := i)) AS l FROM b)
SELECT event_id, CAST(list_sum(list_transform(l, lambda e: e.v)) % 256 + 256 * (list_sum(list_transform(l, lambda e: e.v * (n - e.i + 1))) % 256) AS INT) AS checksum FROM x"""


@query(CHECKSUM)
def checksum(spark, folder):
    text = F.concat_ws(":", "event_type", F.col("user_id").cast("string")).cast("binary")
    return table(spark, folder, "events").select("event_id", wire.checksum(text).alias("checksum"))


@query(CHECKSUM)
def checksum_builtin(spark, folder):
    text = F.concat_ws(":", "event_type", F.col("user_id").cast("string")).cast("binary")
    return table(spark, folder, "events").select("event_id", wire.checksum_sql(text).alias("checksum"))


@query("""
WITH e AS (SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) * 5 AS flags FROM events)
SELECT event_id, bit, (flags >> start) & ((1 << width) - 1) AS bit_value FROM e, (VALUES ('valid', 0, 1), ('mode', 1, 3), ('rest', 4, 6)) b(bit, start, width)""")
def bit_unpack(spark, folder):
    bits = spark.createDataFrame([("EVENT", "flags", "valid", 0, 1), ("EVENT", "flags", "mode", 1, 3), ("EVENT", "flags", "rest", 4, 6)],
                                 "message string, field string, bit string, bit_start int, width int")
    values = frames(spark, folder).withColumn("capture", F.col("event_id"))
    values = codec.decode(codec.identify(codec.header(values.select("capture", "frame")), codec.layouts(*tables(spark))), ["capture"])
    return codec.unpack_bits(values, bits, ["capture"]).select(F.col("capture").alias("event_id"), "bit", "bit_value")


@query("""
WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) * 5 AS flags FROM events)
SELECT event_id, 'value' AS field, value * CAST(0.5 AS DOUBLE) AS scaled_value, 'm' AS unit, NULL AS label FROM e
UNION ALL SELECT event_id, 'user_id', -user_id * CAST(0.25 AS DOUBLE), 's', NULL FROM e
UNION ALL SELECT event_id, 'flags', CAST(flags AS DOUBLE), NULL, CASE flags WHEN 0 THEN 'none' WHEN 5 THEN 'first' END FROM e""")
def scaled_fields(spark, folder):
    """Scale, unit and label of decoded numbers; reserved fields and later versions drop out."""
    meaning = spark.createDataFrame(
        [("EVENT", "value", 0.5, "m", False, None), ("EVENT", "user_id", 0.25, "s", False, 1800), ("EVENT", "single", 1.0, None, False, 2700),
         ("EVENT", "event_id", 1.0, None, True, None), ("EVENT", "event_type", 1.0, None, True, None)],
        "message string, field string, multiplier double, unit string, reserved boolean, since_version int")
    labels = spark.createDataFrame([("EVENT", "flags", 0, "none"), ("EVENT", "flags", 5, "first")], "message string, field string, value bigint, label string")
    found = codec.identify(codec.header(frames(spark, folder).select("event_id", "frame")), codec.layouts(*tables(spark)))
    values = codec.interpret(codec.decode(found, ["event_id"]), meaning, labels, 2000)
    return values.select("event_id", "field", "scaled_value", "unit", "label")


@query("""
WITH e AS (SELECT event_id, value, user_id, CAST(json_extract(props, '$.k') AS BIGINT) * 5 AS flags FROM events)
SELECT event_id, CASE WHEN flags & 1 = 1 THEN 'angle' ELSE 'length' END AS reading, CAST(-user_id AS DOUBLE) * CASE WHEN flags & 1 = 1 THEN CAST(0.001 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS scaled_value,
    CASE WHEN (flags >> 2) & 1 = 1 THEN value END AS valid_value FROM e""")
def conditional_fields(spark, folder):
    """A field read by a selector bit, and a value that counts only while its flag is set."""
    found = codec.identify(codec.header(frames(spark, folder).select("event_id", "frame")), codec.layouts(*tables(spark)))
    values = codec.decode(found, ["event_id"])
    flags = values.where("field = 'flags'").select("event_id", F.col("int_value").alias("flags"))
    bits = spark.createDataFrame([("EVENT", "flags", "polar", 0, 1)], "message string, field string, bit string, bit_start int, width int")
    selectors = codec.unpack_bits(values, bits, ["event_id"]).drop("field", "idx")
    readings = spark.createDataFrame([("EVENT", "user_id", "polar", 0, "length", "m", 1.0), ("EVENT", "user_id", "polar", 1, "angle", "deg", 0.001)],
                                     "message string, field string, bit string, bit_value bigint, reading string, unit string, multiplier double")
    read = codec.conditional(values, selectors, readings, ["event_id"]).select("event_id", "reading", "scaled_value")
    valid = values.where("field = 'value'").join(flags, "event_id").select("event_id", codec.valid_or_null(F.col("real_value"), F.col("flags"), 2).alias("valid_value"))
    return read.join(valid, "event_id")


VARIANT_FIELDS = [("AA", "kind", 0, "U1"), ("AA", "a", 1, "U4"), ("BB", "kind", 0, "U1"), ("BB", "b", 1, "U2[2]"), ("CC", "c", 0, "U1[9]"), ("DD", "d", 1, "U4")]


def variant_registry(spark):
    messages = spark.createDataFrame([(9, 1, "MULTI"), (9, 2, "PLAIN")], "class_id int, message_id int, message string")
    rules = [("AA", 0, None, None, None, 0, 1), ("BB", 1, None, None, None, 0, 2), ("CC", 2, 9, None, None, None, None), ("DD", 3, None, 10, 12, None, None)]
    variants = spark.createDataFrame([(9, 1, *r) for r in rules], "class_id int, message_id int, variant string, position int, payload_length int, min_length int, max_length int, byte_offset int, value bigint")
    rows = [(9, 1, v, i, f, at, t) for i, (v, f, at, t) in enumerate(VARIANT_FIELDS)] + [(9, 2, None, 0, "tail", 3, "U4")]
    fields = spark.createDataFrame(rows, "class_id int, message_id int, variant string, pos int, field string, byte_offset int, data_type string")
    return codec.layouts(messages, fields, variants)


VARIANT_EVENTS = """
WITH e AS (SELECT event_id, user_id, event_id % 7 AS kind FROM events),
p AS (SELECT *, CASE kind WHEN 0 THEN 'AA' WHEN 1 THEN 'BB' WHEN 2 THEN 'CC' WHEN 3 THEN 'DD' END AS variant FROM e)
"""


def variant_frames(spark, folder):
    kind, user = F.col("event_id") % 7, F.col("user_id")
    low = wire.little_endian_hex(user, F.lit(4))
    hexed = (
        F.when(kind == 0, F.concat(F.lit("01"), low)).when(kind == 1, F.concat(F.lit("02"), low)).when(kind == 2, F.concat(F.lit("07"), low, low))
        .when(kind == 3, F.concat(F.lit("FF"), low, F.lit("00" * 6))).when(kind == 4, F.lit("63")).when(kind == 5, F.concat(F.lit("0A0B0C"), F.substring(low, 1, 4))).otherwise(low)
    )
    message = F.when(kind < 5, F.lit(1)).when(kind == 5, F.lit(2)).otherwise(F.lit(3))
    rows = table(spark, folder, "events").select("event_id", message.alias("m"), F.unhex(hexed).alias("payload"))
    return rows.select("event_id", wire.frame(F.lit(9), F.col("m"), F.col("payload")).alias("frame"))


def variant_identified(spark, folder):
    return codec.identify(codec.header(variant_frames(spark, folder)), variant_registry(spark))


@query(VARIANT_EVENTS + """
SELECT event_id, variant, kind IN (0, 1, 2, 3, 5) AS parsed, CASE WHEN kind = 5 THEN 'PLAIN' WHEN kind < 5 THEN 'MULTI' ELSE 'UNNAMED' END AS message,
    CASE WHEN variant IS NOT NULL THEN 'MULTI-' || variant END AS variant_alias, kind IN (4, 6) AS has_raw FROM p""")
def variant_select(spark, folder):
    out = variant_identified(spark, folder)
    name = F.when(F.col("message").isin("PLAIN", "MULTI"), F.col("message")).otherwise(F.lit("UNNAMED"))
    return out.select("event_id", "variant", "parsed", name.alias("message"), "variant_alias", F.col("payload_raw").isNotNull().alias("has_raw"))


@query(VARIANT_EVENTS + """
SELECT event_id, 'kind' AS field, 0 AS idx, kind + 1 AS v FROM p WHERE kind < 2
UNION ALL SELECT event_id, 'a', 0, user_id FROM p WHERE kind = 0
UNION ALL SELECT event_id, 'b', 0, user_id % 65536 FROM p WHERE kind = 1
UNION ALL SELECT event_id, 'b', 1, user_id // 65536 FROM p WHERE kind = 1
UNION ALL SELECT event_id, 'c', CAST(i AS INT), CASE i WHEN 0 THEN 7 ELSE (user_id >> (8 * CAST((i - 1) % 4 AS INT))) & 255 END FROM p, range(9) r(i) WHERE kind = 2
UNION ALL SELECT event_id, 'd', 0, user_id FROM p WHERE kind = 3
UNION ALL SELECT event_id, 'tail', 0, 0 FROM p WHERE kind = 5""")
def variant_decode(spark, folder):
    """Values of the chosen variants; a number that runs past the end is 0."""
    values = codec.decode(variant_identified(spark, folder), ["event_id"])
    return values.select("event_id", "field", "idx", F.col("int_value").cast("bigint").alias("v"))


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '01' || lpad(lower(hex(user_id % 256)), 2, '0') ELSE 'x' END AS start, CASE WHEN event_id % 2 = 0 THEN 'AA' ELSE 'BB' END AS variant FROM events""")
def variant_encode(spark, folder):
    """Frames encoded from values: the discriminating byte is filled in, missing values are zero."""
    rows = table(spark, folder, "events")
    first = F.col("event_id") % 2 == 0
    requests = rows.select("event_id", F.lit(9).alias("class_id"), F.lit(1).alias("message_id"), F.when(first, F.lit("other")).otherwise(F.lit("BB")).alias("variant"))
    values = rows.select("event_id", F.when(first, F.lit("a")).otherwise(F.lit("b")).alias("field"), F.lit(0).alias("idx"), F.col("user_id").cast(wire.WORD).alias("int_value"),
                         F.lit(None).cast("double").alias("real_value"), F.lit(None).cast("string").alias("text_value"))
    out = codec.encode(requests, values, variant_registry(spark), ["event_id"])
    return out.select("event_id", F.when(F.col("variant") == "AA", F.lower(F.hex(F.substring("payload", 1, 2)))).otherwise(F.lit("x")).alias("start"), "variant")


@query("""
SELECT event_id, field FROM (SELECT event_id, unnest(['event_id', 'value', 'event_type']) AS field FROM events) WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 'value' FROM events WHERE event_id % 3 = 1""")
def round_trip_differences(spark, folder):
    """Values that do not come back: all of a frame with a damaged checksum, one whose number was changed on the way."""
    rows = events(spark, folder)
    blank = F.lit(None)
    parts = [
        F.struct(F.lit("event_id").alias("field"), F.col("event_id").cast(wire.WORD).alias("int_value"), blank.cast("double").alias("real_value"), blank.cast("string").alias("text_value")),
        F.struct(F.lit("value").alias("field"), blank.cast(wire.WORD).alias("int_value"), F.col("value").alias("real_value"), blank.cast("string").alias("text_value")),
        F.struct(F.lit("event_type").alias("field"), blank.cast(wire.WORD).alias("int_value"), blank.cast("double").alias("real_value"), F.col("event_type").alias("text_value")),
    ]
    values = rows.select("event_id", F.inline(F.array(*parts))).withColumn("idx", F.lit(0)).withColumnRenamed("event_id", "id")
    layouts = codec.layouts(*tables(spark))
    requests = rows.select(F.col("event_id").alias("id"), F.lit(CLASS_ID).alias("class_id"), F.lit(MESSAGE_ID).alias("message_id"), blank.cast("string").alias("variant"))
    sent = codec.encode(requests, values, layouts, ["id"]).select("id", "frame")
    third = F.col("id") % 3
    damaged = F.concat(F.expr("substring(frame, 1, length(frame) - 1)"), F.expr("unhex(lpad(hex((conv(hex(substring(frame, length(frame), 1)), 16, 10) + 1) % 256), 2, '0'))"))
    sent = sent.withColumn("frame", F.when(third == 0, damaged).otherwise(F.col("frame")))
    got = codec.decode(codec.identify(codec.header(sent), layouts), ["id"])
    got = got.withColumn("real_value", F.when((third == 1) & (F.col("field") == "value"), F.col("real_value") + 1000).otherwise(F.col("real_value")))
    return codec.round_trip(values, got, ["id"]).select(F.col("id").alias("event_id"), "field")


GROUPED = """WITH e AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events)"""


@query("""
WITH e AS (SELECT event_id, user_id, event_id % 4 AS n, event_id // 4 % 4 AS kind FROM events)
SELECT event_id, CAST(i AS BIGINT) AS instance, 'id' AS field, (user_id + i) % 256 AS v FROM e, range(4) r(i) WHERE i < if(kind = 3, least(n, 1), n)
UNION ALL SELECT event_id, CAST(i AS BIGINT), 'w', (user_id * 3 + i) % 65536 FROM e, range(4) r(i) WHERE i < if(kind = 3, least(n, 1), n)""")
def repeated_groups(spark, folder):
    """Groups repeated as often as a field, or the room that is left, says; an optional one occurs once where there is room."""
    found, _, groups, members = grouped(spark, folder)
    values = codec.decode_groups(found, groups.drop("message"), members.drop("message"), ["event_id"])
    return values.select("event_id", "instance", "field", F.col("int_value").cast("bigint").alias("v"))


def grouped(spark, folder):
    """(identified frames with a repeated group, their fields, groups, members of groups); a message for each kind of repetition."""
    n_groups, kind, user = F.col("event_id") % 4, F.floor(F.col("event_id") / 4) % 4, F.col("user_id")
    rows = spread(table(spark, folder, "events").select("event_id", "user_id"))
    head = F.unhex(F.concat(F.lit("0A"), wire.little_endian_hex(n_groups, F.lit(1))))
    prefixes = rows.select("event_id", kind.alias("kind"), head.alias("payload"))
    one = rows.select("event_id", "user_id", F.explode(F.when(n_groups > 0, F.sequence(F.lit(0), (n_groups - 1).cast("int"))).otherwise(F.array().cast("array<int>"))).alias("i"))
    parts = F.array(
        F.struct(F.lit(0).alias("at"), wire.little_endian_hex((user + F.col("i")) % 256, F.lit(1)).alias("hex")),
        F.struct(F.lit(2).alias("at"), wire.little_endian_hex((user * 3 + F.col("i")) % 65536, F.lit(2)).alias("hex")),
    )
    instances = one.select("event_id", F.col("i").cast("bigint").alias("instance"), F.inline(parts))
    payloads = codec.encode_groups(prefixes, instances, ["event_id"], F.lit(4), F.lit(6))
    sent = payloads.select("event_id", wire.frame(F.lit(9), F.col("kind"), F.col("payload")).alias("frame"))
    messages = spark.createDataFrame([(9, i, f"G{i}") for i in range(4)], "class_id int, message_id int, message string")
    fields = spark.createDataFrame([(9, i, None, 0, "n", 1, "U1") for i in range(4)], "class_id int, message_id int, variant string, pos int, field string, byte_offset int, data_type string")
    groups = spark.createDataFrame(
        [(9, 0, None, "g", "count_field", "n", None, 4, 6), (9, 1, None, "g", "fill_remaining", None, None, 4, 6), (9, 2, None, "g", "constant", None, 4, 4, 6), (9, 3, None, "g", "optional", None, None, 4, 6)],
        "class_id int, message_id int, variant string, group_name string, repetition string, count_field string, count bigint, base bigint, size bigint",
    ).withColumn("products", F.lit(None).cast("array<struct<field:string,multiplier:bigint>>"))
    members = spark.createDataFrame([(9, i, None, "g", j, f, at, t) for i in range(4) for j, (f, at, t) in enumerate([("id", 0, "U1"), ("w", 2, "U2")])],
                                    "class_id int, message_id int, variant string, group_name string, pos int, field string, byte_offset int, data_type string")
    named = lambda rows: rows.join(messages, codec.IDS)
    return codec.identify(codec.header(sent), codec.layouts(messages, fields)), named(fields), named(groups), named(members)


@query("""
WITH e AS (SELECT event_id, user_id, event_id % 4 AS n, event_id // 4 % 4 AS kind, value, event_type, CAST(json_extract(props, '$.k') AS BIGINT) * 5 AS flags FROM events),
i AS (SELECT *, list_transform(range(if(kind = 3, least(n, 1), n)), lambda i: '{"id":' || (user_id + i) % 256 || ',"w":' || (user_id * 3 + i) % 65536 || '}') AS l FROM e)
SELECT event_id, 'G' || kind AS message, '{"g":[' || coalesce(array_to_string(l, ','), '') || '],"n":' || n || '}' AS view FROM i
UNION ALL SELECT event_id, 'EVENT', '{"event_id":' || event_id || ',"event_type":"' || event_type || '","flags":' || flags || ',"user_id":' || -user_id || '}' FROM e""")
def wide_view(spark, folder):
    """Frames of five messages, one row each, written with a partition per message and read back."""
    found, _, groups, members = grouped(spark, folder)
    path = run_dir(spark, "views")
    writers.write_views(codec.wide(found, ["event_id"], groups.drop("message"), members.drop("message")), path)
    plain = codec.layouts(tables(spark)[0], tables(spark)[1].where("field NOT IN ('value', 'single')"))
    writers.write_views(codec.wide(codec.identify(codec.header(frames(spark, folder).select("event_id", "frame")), plain), ["event_id"]), path, append=True)
    return Store(spark, path).read("views").select("event_id", "message", F.to_json("view").alias("view"))


@query("""
WITH e AS (SELECT event_id, user_id, event_id % 4 AS n FROM events WHERE event_id // 4 % 4 = 1)
SELECT event_id, n, i AS instance, (user_id + i) % 256 AS id, (user_id * 3 + i) % 65536 AS w FROM e, range(4) r(i) WHERE i < n""")
def typed_view(spark, folder):
    """One message as a table with typed columns, its group as an array of structs."""
    found, fields, groups, members = grouped(spark, folder)
    views = codec.wide(found, ["event_id"], groups.drop("message"), members.drop("message"))
    rows = codec.typed(views, "G1", ["event_id"], fields, groups, members)
    return rows.select("event_id", "n", F.posexplode("g").alias("instance", "_g")).select("event_id", "n", F.col("instance").cast("bigint").alias("instance"), "_g.*")


@query("""
SELECT p_partkey, 'K-' || p_size AS key_name, CASE WHEN p_size % 3 = 1 THEN NULL WHEN p_size % 3 = 0 THEN p_partkey % 2 ELSE p_partkey END AS v, CASE WHEN p_size % 3 = 1 THEN p_retailprice END AS r FROM part""")
def key_values(spark, folder):
    parts, size = table(spark, folder, "part"), F.col("p_size")
    kind = F.when(size % 3 == 0, F.lit("L")).when(size % 3 == 1, F.lit("R8")).otherwise(F.lit("E4"))
    dim = parts.select(F.format_string("0x%08x", size).alias("key_id"), F.concat(F.lit("K-"), size.cast("string")).alias("name"), kind.alias("data_type")).distinct()
    raw = F.when(size % 3 == 1, wire.float_hex("p_retailprice", F.lit("R8"))).when(size % 3 == 0, wire.little_endian_hex(F.col("p_partkey") % 2, F.lit(1))).otherwise(wire.little_endian_hex("p_partkey", F.lit(4)))
    pairs = parts.select("p_partkey", size.alias("id"), F.unhex(raw).alias("data"))
    out = codec.key_values(pairs, dim, "id", "data")
    return out.select("p_partkey", "key_name", F.col("int_value").cast("bigint").alias("v"), F.col("real_value").alias("r"))


# -- registry lookups ------------------------------------------------------------------------


@query("""
WITH m AS (SELECT p_brand AS name, min(p_partkey) AS seq FROM part GROUP BY 1),
a AS (SELECT DISTINCT p_brand AS name, p_brand || '-' || p_type AS alias FROM part),
i AS (SELECT name AS lookup, name FROM m UNION SELECT alias, name FROM a)
SELECT p_partkey, name FROM (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || '-' || p_type ELSE p_name END AS q FROM part) LEFT JOIN i ON lookup = q""")
def find_by_name(spark, folder):
    parts = table(spark, folder, "part")
    both = F.concat_ws("-", "p_brand", "p_type")
    messages = parts.groupBy(F.col("p_brand").alias("name")).agg(F.min("p_partkey").alias("seq"))
    # One row per alias; a message's aliases need not be gathered into a list.
    listed = parts.select(F.col("p_brand").alias("name"), both.alias("alias")).distinct().join(messages, "name").select("name", "seq", F.array("alias").alias("variant_aliases"))
    kind = F.col("p_size") % 3
    requests = parts.select("p_partkey", F.when(kind == 0, F.col("p_brand")).when(kind == 1, both).otherwise(F.col("p_name")).alias("q"))
    return registry.find_by_name(requests, listed, "q", ["seq"]).select("p_partkey", "name")


@query("SELECT DISTINCT p_brand || '-' || p_type AS alias, p_brand AS name, p_type AS variant FROM part")
def variant_aliases(spark, folder):
    parts = table(spark, folder, "part")
    variants = parts.select(F.col("p_brand").alias("name"), F.col("p_type").alias("variant")).distinct()
    listed = parts.select(F.col("p_brand").alias("name"), F.concat_ws("-", "p_brand", "p_type").alias("alias"))
    return registry.variant_index(variants, listed)


@query("""
SELECT CAST(p_size AS INT) AS class_id, CAST(p_partkey % 256 AS INT) AS message_id, arg_min(p_name, p_partkey) AS name FROM part GROUP BY ALL""")
def find_by_ids(spark, folder):
    rows = table(spark, folder, "part").select(
        F.when(F.col("p_size") % 2 == 0, F.format_string("0x%02X", "p_size")).otherwise(F.col("p_size").cast("string")).alias("class_id"),
        (F.col("p_partkey") % 256).alias("message_id"), F.col("p_name").alias("name"), "p_partkey",
    )
    return registry.id_index(rows, ["p_partkey"])
