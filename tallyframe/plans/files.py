"""Readers and writers over files: the given tables are written as files of the right shape and read back."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import collection, compare, rules, vote
from ..session import cut_lineage, run_dir
from ..sources import captures, ingest, readers, writers
from ..sources.store import Store
from .base import query, table
from .voting import VOTES, line_votes


#: Keys of rows that are put into one file, so that files grow in number and not in size.
PER_FILE = 1000
#: Tasks for each core that write files.
TASKS = 4


def put(rows: DataFrame, spark, kind: str, folder: str | None = None) -> str:
    """Write (name, data) rows as files below a shared folder, by default a new one, a file for each row; returns the folder.

    Rows are dealt over the tasks by name, whatever splits they were read in.
    """
    folder = folder or run_dir(spark, kind)

    def write(batches):
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        made = set()
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place = f"{base}/{name}"
                if (parent := place.rpartition("/")[0]) not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                with store.open_output_stream(place, compression=None) as out:
                    out.write(data)
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    data = rows.select("name", F.col("data").cast("binary").alias("data")).repartition(TASKS * spark.sparkContext.defaultParallelism, "name")
    data.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
    return folder


def listed(rows: DataFrame, by, item, path: str, order) -> DataFrame:
    """One JSON text per ``by``: the items in order, as a list under ``path``."""
    grouped = rows.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, item.alias("_item")))), lambda x: x["_item"]).alias(path))
    return grouped.select(*by, F.to_json(F.struct(path)).alias("data"))


@query("""
SELECT p_name AS message_name, p_brand AS brand, CASE p_brand WHEN 'Brand#1' THEN 0 ELSE 1 END AS suffix, count(*) AS n, CAST(sum(1 + p_size % 3) AS BIGINT) AS fields
FROM part WHERE p_size % 10 <> 0 GROUP BY ALL""")
def extraction_bundles(spark, folder):
    """Parts as bundles of extractions by brand; messages without a name are left out by the reader."""
    rows = readers.extractions(spark, put(bundle_files(spark, folder), spark, "bundles"))
    return rows.groupBy("message_name", brand(), F.col("seq.suffix").alias("suffix")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("field_count").cast("bigint").alias("fields"))


def brand(file: str = "file"):
    """The brand in a file's name."""
    return F.concat(F.lit("Brand#"), F.regexp_extract(file, "^Brand-([0-9]+)_", 1)).alias("brand")


def bundle_files(spark, folder):
    """(name, data, p_brand): parts as bundles, PER_FILE keys of a brand in each."""
    size = F.col("p_size")
    field = F.transform(F.sequence(F.lit(0), size % 3), lambda i: F.struct(F.concat(F.lit("f"), i.cast("string")).alias("name"), i.alias("byte_offset"), F.lit("U1").alias("data_type")))
    item = F.struct(F.when(size % 10 != 0, F.col("p_name")).alias("name"), field.alias("fields"))
    part = F.floor(F.col("p_partkey") / PER_FILE).alias("part")
    files = listed(table(spark, folder, "part").withColumn("part", part), ["p_brand", "part"], item, "messages", ["p_partkey"])
    suffix = F.when(F.col("p_brand") == "Brand#1", F.lit(readers.BUNDLE_SUFFIXES[0])).otherwise(F.lit(readers.BUNDLE_SUFFIXES[1]))
    name = F.concat(F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("_"), F.col("part").cast("string"), suffix)
    return files.select(name.alias("name"), "data", "p_brand")


@query("""
SELECT p_brand AS brand, CAST(CASE WHEN p_brand < 'Brand#3' THEN 0 ELSE 1 END AS BIGINT) AS batch, count(*) AS messages, CAST(sum(1 + p_size % 3) AS BIGINT) AS fields,
    CAST(sum(CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END) AS BIGINT) AS offsets
FROM part WHERE p_size % 10 <> 0 GROUP BY ALL""")
def ingested_bundles(spark, folder):
    """Bundles that arrive in two lots; the third run finds no new file."""
    files, path = bundle_files(spark, folder), run_dir(spark, "ingest")
    for lot in (F.col("p_brand") < "Brand#3", F.col("p_brand") >= "Brand#3", None):
        if lot is not None:
            put(files.where(lot), spark, "ingest", f"{path}/in")
        ingest.ingest(spark, f"{path}/in", f"{path}/table", f"{path}/checkpoint").awaitTermination()
    held = Store(spark, f"{path}/table")
    extraction = held.read("extraction").groupBy(brand(), "batch").agg(F.count(F.lit(1)).alias("messages"))
    field = held.read("field").groupBy(brand("place.file")).agg(
        F.count(F.lit(1)).alias("fields"), F.sum("byte_offset").cast("bigint").alias("offsets"))
    return extraction.join(field, "brand")


def store(spark, folder):
    """A conversation for each customer: a folder per nation, good and bad documents of several kinds."""
    kind, name = F.col("c_custkey") % 6, F.col("c_name")
    fields = F.array(F.struct(F.lit("a").alias("name"), (F.col("c_custkey") % 4).alias("byte_offset"), F.lit("U2").alias("data_type")))
    good = F.to_json(F.struct(name.alias("message_name"), F.struct(fields.alias("fields")).alias("extracted_structure"), F.lit("t").alias("extraction_timestamp"), F.lit("m").alias("model")))
    reviewed = F.to_json(F.struct(name.alias("message_name"), F.struct(fields.alias("fields")).alias("extracted_structure"),
                                  F.struct(F.lit("extraction_error").alias("verdict"), F.lit("low").alias("confidence"), F.struct(F.array().cast("array<string>").alias("fields")).alias("corrected_structure")).alias("review")))
    text = (
        F.when(kind == 0, F.lit("{broken")).when(kind == 1, F.concat(F.lit('{"message_name":"'), name, F.lit('","extracted_structure":{}}')))
        .when(kind == 2, F.concat(F.lit('{"message_name":"'), name, F.lit('","extracted_structure":{"error":"x"}}')))
        .when(kind == 3, F.concat(F.lit('{"extracted_structure":{"fields":[{"name":"'), name, F.lit('"}]}}')))
        .when(kind == 4, reviewed).otherwise(good)
    )
    rows = table(spark, folder, "customer").select(F.concat(F.lit("m"), F.col("c_nationkey").cast("string"), F.lit("/"), name, F.lit(".json")).alias("name"), text.alias("data"))
    return put(rows, spark, "store")


@query("""
SELECT 'm' || c_nationkey AS manual, c_name || '.json' AS file, ['malformed JSON', 'no structure', 'error in structure', 'no message name'][c_custkey % 6 + 1] AS reason
FROM customer WHERE c_custkey % 6 < 4""")
def conversation_rejects(spark, folder):
    return readers.conversations(spark, store(spark, folder))[1]


@query("SELECT 'm' || c_nationkey AS manual, c_name AS message_name, 1 AS field_count, c_name AS adjudicated, 'm' || c_nationkey AS source FROM customer WHERE c_custkey % 6 >= 4")
def conversation_store(spark, folder):
    """Accepted extractions, and what of them goes to adjudication."""
    rows, _ = readers.conversations(spark, store(spark, folder))
    sent = readers.adjudication_input(rows).select(F.col("message_name").alias("adjudicated"), "source")
    kept = rows.select("manual", "message_name", "field_count")
    return kept.join(sent, (kept.message_name == sent.adjudicated) & (kept.manual == sent.source))


@query("""
SELECT c_name AS message_name, CASE WHEN c_custkey % 6 = 4 THEN 'extraction_error' ELSE 'not_reviewed' END AS verdict,
    CASE WHEN c_custkey % 6 = 4 THEN 'low' ELSE 'unknown' END AS review_confidence, CASE WHEN c_custkey % 6 = 4 THEN 0 ELSE 1 END AS field_count FROM customer WHERE c_custkey % 6 >= 4""")
def reviewed_store(spark, folder):
    rows, _ = readers.conversations(spark, store(spark, folder), reviewed=True)
    return rows.select("message_name", "verdict", "review_confidence", "field_count")


@query("""
SELECT '0x' || lpad(lower(hex(p_partkey)), 8, '0') AS key_id, p_name AS name, CASE WHEN p_size % 2 = 0 THEN 's' END AS unit, 1 + p_size % 3 AS n_values, p_size % 2 AS n_bits FROM part""")
def key_bundles(spark, folder):
    """Parts as bundles of keys by brand, with values listed or mapped and some bits."""
    size = F.col("p_size")
    numbers = F.sequence(F.lit(0), size % 3)
    as_list = F.to_json(F.transform(numbers, lambda i: F.struct(F.concat(F.lit("V"), i.cast("string")).alias("name"), i.alias("value"))))
    as_map = F.to_json(F.map_from_entries(F.transform(numbers, lambda i: F.struct(F.concat(F.lit("V"), i.cast("string")), F.struct(i.alias("value"))))))
    bits = F.when(size % 2 == 1, F.lit(',"bitfield":{"bits":[{"name":"b"}]}')).otherwise(F.lit(""))
    unit = F.when(size % 2 == 0, F.lit(',"unit":"s"')).otherwise(F.lit(""))
    item = F.concat(
        F.lit('{"name":'), F.to_json(F.struct(F.col("p_name").alias("n"))).substr(F.lit(6), F.length("p_name") + 2), F.lit(',"key_id":"'), F.format_string("0x%08x", "p_partkey"),
        F.lit('","inline_enum":{"values":'), F.when(F.col("p_partkey") % 2 == 0, as_list).otherwise(as_map), F.lit("}"), bits, unit, F.lit("}"))
    part = F.floor(F.col("p_partkey") / PER_FILE)
    grouped = table(spark, folder, "part").groupBy("p_brand", part.alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("t")))), lambda x: x["t"]), ",").alias("items"))
    data = F.concat(F.lit('{"keys":['), "items", F.lit("]}"))
    name = F.concat(F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("_"), F.col("part").cast("string"), F.lit(readers.KEY_BUNDLE_SUFFIX))
    path = put(grouped.select(name.alias("name"), data.alias("data")), spark, "keys")
    keys = readers.config_keys(spark, path)
    values = readers.key_enum_items(keys).groupBy("key_id").agg(F.count(F.lit(1)).cast("int").alias("n_values"))
    marks = readers.key_bits(keys).groupBy("key_id").agg(F.count(F.lit(1)).cast("int").alias("n_bits"))
    out = keys.select("key_id", "name", "unit").join(values, "key_id").join(marks, "key_id", "left")
    return out.withColumn("n_bits", F.coalesce("n_bits", F.lit(0)))


@query("""
SELECT n_name AS source, 'FW ' || n_regionkey AS firmware_version, CAST(100 * n_nationkey AS INT) AS protocol_version FROM nation""")
def metadata_file(spark, folder):
    nations = table(spark, folder, "nation")
    entry = F.struct(F.concat(F.lit("FW "), F.col("n_regionkey").cast("string")).alias("firmware_version"), (F.col("n_nationkey") * 100).alias("protocol_version"))
    text = nations.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("n_name", entry))).alias("manuals"))).alias("data"))
    path = put(text.select(F.lit("m.json").alias("name"), "data"), spark, "metadata")
    return readers.manual_metadata(spark, path).select("source", "firmware_version", "protocol_version")


@query("SELECT DISTINCT p_type AS entity, p_brand AS source FROM part UNION ALL SELECT p_name, min(p_type) FROM part WHERE p_name NOT LIKE 'old%' GROUP BY p_name")
def inventory_and_mapping(spark, folder):
    """An inventory file per type and a mapping file per brand; names that begin with _ are comments."""
    parts = table(spark, folder, "part")
    sources = parts.groupBy("p_type").agg(F.array_sort(F.collect_set("p_brand")).alias("s"))
    text = sources.select(F.concat("p_type", F.lit(".json")).alias("name"), F.to_json(F.struct(F.map_from_arrays(F.array("p_type"), F.array("s")).alias("messages"))).alias("data"))
    found = readers.inventory(spark, put(text, spark, "inventory"))
    ours = F.when(F.col("p_name").startswith("old"), F.concat(F.lit("_"), "p_name")).otherwise(F.col("p_name"))
    names = parts.groupBy(ours.alias("k")).agg(F.min("p_type").alias("v")).select(F.concat(F.xxhash64("k").cast("string"), F.lit(".json")).alias("name"), F.to_json(F.struct(F.map_from_arrays(F.array("k"), F.array("v")).alias("field_aliases"))).alias("data"))
    aliases = readers.name_mapping(spark, put(names, spark, "mapping"), "field_aliases")
    return found.select("entity", "source").unionByName(aliases.select(F.col("our_name").alias("entity"), F.col("other_name").alias("source")))


@query("""
SELECT c_name AS name, '0x' || lpad(lower(hex(c_nationkey)), 2, '0') AS class_id, CASE WHEN c_custkey % 2 = 0 THEN 'V' || c_nationkey END AS variant, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 9 AS BIGINT) END AS value FROM customer""")
def registry_files(spark, folder):
    """Customers as registry files, one per market segment, and the variants of some."""
    even = F.col("c_custkey") % 2 == 0
    variant = F.array(F.struct(F.concat(F.lit("V"), F.col("c_nationkey").cast("string")).alias("name"), F.struct(F.lit(0).alias("byte_offset"), (F.col("c_custkey") % 9).alias("value")).alias("discriminator")))
    item = F.struct(F.col("c_name").alias("name"), F.format_string("0x%02x", "c_nationkey").alias("class_id"), F.lit("0x00").alias("message_id"), F.when(even, variant).alias("variants"))
    files = listed(table(spark, folder, "customer"), ["c_mktsegment"], item, "messages", ["c_custkey"])
    messages = readers.registry(spark, put(files.select(F.concat("c_mktsegment", F.lit(".json")).alias("name"), "data"), spark, "registry"))
    found = readers.registry_variants(messages).select("name", "variant", "value")
    return messages.select("name", "class_id").join(found, "name", "left")


# -- two registries as raw JSON ----------------------------------------------------------------


def two_registries(spark, folder):
    """A message for each customer in our registry and in the other: (our fields, our bits, their fields, their bits)."""
    customers = table(spark, folder, "customer").withColumn("part", F.floor(F.col("c_custkey") / PER_FILE))
    k, name = F.col("c_custkey") % 8, F.to_json(F.struct(F.col("c_name").alias("n"))).substr(F.lit(6), F.length("c_name") + 2)
    when = lambda number, text: F.when(k == number, F.lit(text)).otherwise(F.lit(""))
    ours = F.concat(
        F.lit('{"name":'), name, F.lit(',"class_id":"0x01","message_id":"0x02","payload":{"fields":[{"name":"zz","data_type":"U4"},{"name":"flags","data_type":"X1"'),
        F.when(k != 6, F.concat(
            F.lit(',"bitfield":[{"name":"valid","bit_offset":0,"bit_width":3},{"name":"moved","width":1,"bit_offset":'), F.when(k == 7, F.lit("4")).otherwise(F.lit("3")), F.lit("}"),
            when(3, ',{"name":"mine","bit_offset":6,"width":1}'), F.lit("]"))).otherwise(F.lit("")),
        F.lit('},{"name":"height","data_type":"I4"},{"name":"reserved0","data_type":"U1"}'), when(5, ',{"name":"own","data_type":"U1"}'), F.lit("]}}"))
    theirs = F.concat(
        name, F.lit(':{"zz":'), F.when(k == 1, F.lit('"I004"')).otherwise(F.lit('"U004"')),
        F.lit(',"flags":["X001",{"valid":"U003","a_moved":"'), F.when(k == 2, F.lit("U002")).otherwise(F.lit("U001")), F.lit('"'), when(1, ',"aa":"U002"'),
        F.lit('}],"hMSL":["I004",1e-07],"reserved1":"U001","group":["numSvs",{"svId":"U001","bits":["X001",{"b":"U001","a":"U002"}]}]'),
        when(3, ',"extra":"U001"'), when(4, ',"svs_1":"U001"'), F.lit("}"))

    def put_all(item, start, end, kind):
        items = customers.groupBy("c_mktsegment", "part").agg(F.array_sort(F.collect_list(F.struct("c_custkey", item.alias("t")))).alias("l"))
        data = F.concat(F.lit(start), F.array_join(F.transform("l", lambda x: x["t"]), ","), F.lit(end))
        return put(items.select(F.concat("c_mktsegment", F.lit("_"), F.col("part").cast("string"), F.lit(".json")).alias("name"), data.alias("data")), spark, kind)

    # Written, as the fields and the bits are both read from it.
    mine = cut_lineage(readers.registry_fields(readers.registry(spark, put_all(ours, '{"messages":[', "]}", "ours"))))
    fields, bits = readers.second_registry(spark, put_all(theirs, "{", "}", "theirs"))
    return mine.withColumnRenamed("name", "message"), readers.registry_bits(mine).withColumnRenamed("name", "message"), fields, bits


ALIASES = "our_name string, other_name string"


@query("""
SELECT c_name AS message, field, issue, our_type, other_type FROM customer, (VALUES
    (1, 'zz', 'type_mismatch', 'U4', 'I004'), (3, 'extra', 'library_only', NULL, 'U001'), (4, 'svs_1', 'ignored', NULL, 'U001'), (5, 'own', 'our_only', 'U1', NULL)) v(k, field, issue, our_type, other_type)
WHERE c_custkey % 8 = k""")
def registries_compared(spark, folder):
    """Both registries read from raw JSON and compared; every kind of issue comes up."""
    ours, _, theirs, _ = two_registries(spark, folder)
    aliases = spark.createDataFrame([("height", "hMSL")], ALIASES)
    top = theirs.where("size(path) = 0").withColumnRenamed("type", "data_type")
    return compare.cross(ours, top, "message", "field", "data_type", aliases, ignore_patterns=["svs_"])


@query("""
SELECT c_name AS message, 'flags' AS field, bit, issue, CAST(our_offset AS BIGINT) AS our_offset, CAST(other_offset AS BIGINT) AS other_offset, CAST(our_width AS BIGINT) AS our_width, CAST(other_width AS BIGINT) AS other_width
FROM customer, (VALUES (6, NULL, 'missing_bitfield', NULL, NULL, NULL, NULL), (7, 'moved', 'offset_mismatch', 4, 3, 1, 1), (2, 'moved', 'width_mismatch', 3, 3, 1, 2),
    (1, 'aa', 'only_theirs', NULL, 4, NULL, 2), (3, 'mine', 'only_ours', 6, NULL, 1, NULL)) v(k, bit, issue, our_offset, other_offset, our_width, other_width)
WHERE c_custkey % 8 = k""")
def registries_bits_compared(spark, folder):
    """Bits of the matched fields; those of the other registry begin where the ones before them in the text end."""
    ours, our_bits, theirs, bits = two_registries(spark, folder)
    placed = compare.bit_offsets(bits.where("size(path) = 0"), ["message", "field"], ["pos"], "width")
    top = theirs.where("size(path) = 0").withColumnRenamed("type", "data_type")
    return compare.cross_bits(
        ours, top, our_bits, placed.select("message", "field", "bit", "bit_offset", "width"), "message", "field", "data_type", "bit",
        spark.createDataFrame([("height", "hMSL")], ALIASES), spark.createDataFrame([("moved", "a_moved")], ALIASES))


@query("""
SELECT c_name AS message, path, pos, field, kind, type, scale, count_field FROM customer, (VALUES
    ('', 0, 'zz', 'plain', NULL, NULL, NULL), ('', 1, 'flags', 'bitfield', 'X001', NULL, NULL), ('', 2, 'hMSL', 'scaled', 'I004', CAST(1e-07 AS DOUBLE), NULL), ('', 3, 'reserved1', 'plain', 'U001', NULL, NULL),
    ('', 4, 'group', 'group', 'group', NULL, 'numSvs'), ('group', 0, 'svId', 'plain', 'U001', NULL, NULL), ('group', 1, 'bits', 'bitfield', 'X001', NULL, NULL)) v(path, pos, field, kind, ptype, scale, count_field),
    (SELECT CASE WHEN field = 'zz' THEN CASE WHEN c_custkey % 8 = 1 THEN 'I004' ELSE 'U004' END ELSE ptype END AS type)
UNION ALL SELECT c_name, '', 5, CASE c_custkey % 8 WHEN 3 THEN 'extra' ELSE 'svs_1' END, 'plain', 'U001', NULL, NULL FROM customer WHERE c_custkey % 8 IN (3, 4)""")
def second_registry(spark, folder):
    """The other registry as rows, members of groups among them, in the order of the text."""
    found = two_registries(spark, folder)[2]
    return found.withColumn("path", F.array_join("path", ".")).drop("rest")


@query("""
SELECT source AS message, CAST(doc_id AS VARCHAR) AS manual, CASE WHEN quality IS NULL THEN NULL ELSE quality = 1 END AS matches, CASE WHEN quality = 0 THEN 'size ' || n_chars END AS issue
FROM documents LEFT JOIN labels USING (doc_id)""")
def report_files(spark, folder):
    """Validation reports, a file for each source and about PER_FILE of its rows."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    rows = table(spark, folder, "documents").select("doc_id", "source", "n_chars").join(labels, "doc_id", "left")
    # A source of many documents gives many files, so no file and no group grows with the table.
    files = rows.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / PER_FILE).alias("files"))
    rows = rows.join(files, "source").withColumn("part", F.pmod(F.xxhash64("doc_id", "n_chars", "quality"), "files"))
    found = F.when(F.col("quality") == 0, F.array(F.struct(F.lit("f").alias("field"), F.concat(F.lit("size "), F.col("n_chars").cast("string")).alias("issue"))))
    item = F.struct(F.col("doc_id").cast("string").alias("manual"), (F.col("quality") == 1).alias("matches"), found.alias("discrepancies"))
    grouped = rows.groupBy("source", "part").agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("i")))), lambda x: x["i"]).alias("results"))
    data = grouped.select(F.concat("source", F.lit("_"), F.col("part").cast("string"), F.lit(readers.VALIDATION_SUFFIX)).alias("name"), F.to_json(F.struct(F.col("source").alias("message"), "results")).alias("data"))
    read = readers.validation_results(spark, put(data, spark, "reports"))
    return read.select("message", "manual", "matches", F.try_element_at("discrepancies", F.lit(1))["issue"].alias("issue"))


@query("SELECT 'doc-' || doc_id AS capture, CAST(strlen(text) AS BIGINT) AS bytes, CAST((strlen(text) + 999) // 1000 AS BIGINT) AS pieces, sha256(text) AS digest FROM documents WHERE strlen(text) > 0")
def capture_files(spark, folder):
    """Texts as files, read whole and in pieces of 1,000 bytes."""
    rows = table(spark, folder, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"), F.col("text").alias("data"))
    path = put(rows, spark, "captures")
    name = F.substring_index("capture", "/", -1)
    pieces = readers.capture_pieces(spark, path, piece=1000).groupBy(name.alias("capture")).agg(
        F.sum(F.length("data")).cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("pieces"))
    whole = readers.captures(spark, path).select(name.alias("capture"), F.sha2("data", 256).alias("digest"))
    return pieces.join(whole, "capture")


@query("SELECT 'doc-' || doc_id AS capture, CAST(strlen(text) AS BIGINT) AS bytes, CAST((strlen(text) + 999) // 1000 AS BIGINT) AS pieces, sha256(text) AS digest, true AS same FROM documents WHERE strlen(text) > 0")
def capture_source(spark, folder):
    """Texts as capture files, read as byte ranges in a batch and as a stream of two arrivals; both give the same pieces."""
    rows = table(spark, folder, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"), F.col("text").alias("data"), "doc_id")
    path = run_dir(spark, "captures")
    captures.register(spark)
    for lot in (F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 == 1):
        put(rows.where(lot).drop("doc_id"), spark, "captures", f"{path}/in")
        stream = spark.readStream.format("capture_pieces").option("piece", 1000).load(f"{path}/in")
        query_ = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
        query_.start(f"{path}/out").awaitTermination()
    whole = lambda pieces: pieces.groupBy(F.substring_index("capture", "/", -1).alias("capture")).agg(
        F.sum(F.length("data")).cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("pieces"),
        F.sha2(F.expr("listagg(data) WITHIN GROUP (ORDER BY seq)"), 256).alias("digest"))
    batch = whole(spark.read.format("capture_pieces").option("piece", 1000).option("split", 5000).load(f"{path}/in"))
    streamed = whole(spark.read.schema(captures.SCHEMA).parquet(f"{path}/out")).select("capture", F.struct("bytes", "pieces", "digest").alias("_streamed"))
    both = batch.join(streamed, "capture", "left").withColumn("same", F.col("_streamed").eqNullSafe(F.struct("bytes", "pieces", "digest")))
    return both.drop("_streamed")


# -- writers ---------------------------------------------------------------------------------


@query(VOTES + """
SELECT 'K-' || l_orderkey || '-v0' AS file_key, winning_value AS fingerprint, confidence, round_even(score, 3) AS confidence_score, agreement_count AS sources, total_count - agreement_count AS outliers
FROM votes WHERE has_consensus""")
def written_canonical(spark, folder):
    votes = line_votes(spark, folder).withColumns({"name": F.concat(F.lit("K-"), F.col("l_orderkey").cast("string")), "version": F.lit(0)})
    path = run_dir(spark, "canonical")
    writers.write_canonical(votes, path, "name", "version")
    return Store(spark, path).read("manifest")


@query(VOTES + """
SELECT l_orderkey, l_linestatus = winning_value AS agrees, l_suppkey AS source, l_linestatus AS fingerprint FROM lineitem JOIN votes USING (l_orderkey) WHERE has_consensus""")
def written_sources(spark, folder):
    """The sources of each canonical record and its outliers."""
    lines = table(spark, folder, "lineitem").withColumn("version", F.lit(0))
    votes = vote.vote(lines, ["l_orderkey", "version"], "l_linestatus", ["l_shipdate", "l_linenumber"])
    ballots = vote.ballots(lines, votes, ["l_orderkey", "version"], "l_linestatus")
    path = run_dir(spark, "canonical")
    writers.write_canonical(votes, path, "l_orderkey", "version", ballots=ballots, source="l_suppkey", value="l_linestatus")
    return Store(spark, path).read("sources").select("l_orderkey", "source", "fingerprint", "agrees")


PRELIMINARY = """
WITH t AS (SELECT o_custkey, o_orderstatus AS v, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) AS k, sum(n) OVER (PARTITION BY o_custkey) AS total FROM t)
"""


@query(PRELIMINARY + """
SELECT o_custkey, v AS winning_value, CASE WHEN total = 1 THEN 'single_source' WHEN n = total THEN 'unanimous' WHEN n / total >= 0.75 THEN 'majority' ELSE 'split' END AS status FROM r WHERE k = 1""")
def written_preliminary(spark, folder):
    votes = vote.preliminary(table(spark, folder, "orders"), ["o_custkey"], "o_orderstatus", ["o_orderkey"])
    path = run_dir(spark, "preliminary")
    writers.write_preliminary(votes, path)
    return Store(spark, path).read("by_status").select("o_custkey", "winning_value", "status")


@query("""
WITH t AS (SELECT o_custkey, o_orderstatus AS v, count(*) AS n, min(o_orderkey) AS f, count(*) FILTER (o_orderpriority = '1-URGENT') AS e FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) AS k, sum(n) OVER (PARTITION BY o_custkey) AS total, count(*) OVER (PARTITION BY o_custkey) AS u, sum(e) OVER (PARTITION BY o_custkey) AS c FROM t)
SELECT o_custkey, v AS winning_value, CASE WHEN u = 1 OR n / total >= 0.75 THEN 'canonical' ELSE 'manual_review' END AS list FROM r WHERE k = 1""")
def written_final(spark, folder):
    """Decisions by list; an urgent order stands for a corrected extraction."""
    rows = table(spark, folder, "orders").withColumn("verdict", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("extraction_error")).otherwise(F.lit("confirmed")))
    decisions = vote.determine(rows, ["o_custkey"], "o_orderstatus", "verdict", ["o_orderkey"])
    path = run_dir(spark, "final")
    writers.write_final(decisions, path)
    return Store(spark, path).read("decisions").select("o_custkey", "winning_value", "list")


@query("SELECT p_partkey, p_name AS name, p_brand AS kind FROM part UNION ALL SELECT min(p_partkey), p_type, 'group' FROM part GROUP BY p_type UNION ALL SELECT max(p_partkey), p_type, 'queue' FROM part GROUP BY p_type")
def written_keys_and_conflicts(spark, folder):
    parts = table(spark, folder, "part")
    path = run_dir(spark, "keys")
    groups = parts.groupBy(F.col("p_type").alias("name")).agg(F.min("p_partkey").alias("p_partkey"))
    queue = parts.groupBy(F.col("p_type").alias("name")).agg(F.max("p_partkey").alias("p_partkey"))
    keys = parts.select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("kind"))
    writers.write_keys(keys, groups, path)
    writers.write_conflicts(keys, queue, f"{path}/x")
    read = lambda place, part, kind: Store(spark, place).read(part).select("p_partkey", "name", kind.alias("kind"))
    conflicts = read(f"{path}/x", "conflicts", F.col("kind"))
    return conflicts.unionByName(read(path, "groups", F.lit("group"))).unionByName(read(f"{path}/x", "queue", F.lit("queue")))


@query("SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS BIGINT) AS recorded FROM orders")
def appended_rows(spark, folder):
    """Orders appended to those that are held already, and a record of some twice; every write is repeated once."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = run_dir(spark, "held")
    for _ in range(2):
        writers.append_new(orders.where("o_orderstatus = 'F'"), f"{path}/held", ["o_orderkey"], force=True, batch=("first", 0))
        writers.append_new(orders, f"{path}/held", ["o_orderkey"])
        writers.record_variation(orders, f"{path}/variations", ("all", 0))
        writers.record_variation(orders.where("o_orderstatus = 'P'"), f"{path}/variations", ("some", 0))
    times = Store(spark, f"{path}/variations").read("rows").where("recorded_at is not null").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("recorded"))
    return Store(spark, f"{path}/held").read("rows").select("o_orderkey", "o_custkey").join(times, "o_orderkey")


@query(VOTES + """
SELECT l_orderkey, winning_value AS fingerprint FROM votes WHERE NOT has_consensus OR agreement_count < total_count""")
def written_report(spark, folder):
    votes = line_votes(spark, folder)
    path = run_dir(spark, "report")
    writers.write_report(votes, path, ["l_orderkey"])
    return Store(spark, path).read("issues").select("l_orderkey", "fingerprint")


# -- functions without a query of their own ---------------------------------------------------


@query("""
SELECT rule, count(*) AS checked, count(*) FILTER (bad) AS violations FROM (
    SELECT unnest(['has_class_id', 'has_message_id', 'has_message_type']) AS rule, unnest([p_size % 7 = 0, false, p_size % 5 = 0]) AS bad FROM part) GROUP BY rule""")
def message_rules(spark, folder):
    size = F.col("p_size")
    rows = table(spark, folder, "part").select(
        F.when(size % 7 != 0, F.lit("0x01")).alias("class_id"), F.lit("0x02").alias("message_id"), F.when(size % 5 != 0, F.lit("input")).alias("message_type"))
    return rules.expect(rows, rules.message_rules()).select("rule", "checked", "violations")


@query("SELECT p_partkey FROM part WHERE p_size % 4 <> 0")
def fixed_length(spark, folder):
    size = F.col("p_size")
    rows = table(spark, folder, "part").select("p_partkey", F.struct(F.when(size % 4 != 0, size).alias("fixed")).alias("length"))
    return collection.fixed_length(rows).select("p_partkey")


