"""Readers: definition documents, key bundles, registries, metadata, reports and captures.

A definition file is one JSON document with polymorphic leaves, so files are read whole and
parsed as VARIANT; what cannot be used goes to a second DataFrame with the reason.
"""

from __future__ import annotations

import fnmatch
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import naming as n
from ..operators import layout, version
from ..session import cut_lineage

# Bundle file suffixes, in reading order
BUNDLE_SUFFIXES = ["_anthropic.json", "_gemini.json"]
KEY_BUNDLE_SUFFIX = "_gemini_config_keys.json"
VALIDATION_SUFFIX = "_validation.json"


#: Tasks for each core that list and read files, and about how many bytes and files a task gives at once.
TASKS = 4
BATCH_BYTES, BATCH_FILES = 1 << 22, 1000


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _listed(spark: SparkSession, path: str, pattern: str, recursive=False) -> DataFrame | None:
    """(place, size) of the files below a folder that pyarrow reaches, listed in tasks; None for paths that only Spark's readers know.

    ``place`` begins behind the folder's own address. With ``recursive`` the folders in it are listed side by side. Spark's
    readers list in the driver and give a task some thirty files; here tasks are as many as the cores need.
    """
    if any(c in path for c in "*?[]{}%#") or any(c in pattern for c in "{}[]\\^"):
        return None
    try:
        store, base = pyarrow.fs.FileSystem.from_uri(_uri(path))
        if store.get_file_info(base).type != pyarrow.fs.FileType.Directory:
            return None
    except (OSError, ValueError, NotImplementedError):
        return None
    tasks = TASKS * spark.sparkContext.defaultParallelism
    address = _uri(path)
    schema = "place string, size bigint"

    def found(store, root: str, place: str, deep: bool):
        base = f"{root}{place}"
        held = store.get_file_info(pyarrow.fs.FileSelector(base, recursive=deep))
        for at in range(0, len(held), BATCH_FILES):
            places, sizes = [], []
            for info in held[at : at + BATCH_FILES]:
                below = f"{place}{info.path[len(base):]}"
                if any(_hidden(name) for name in below.split("/")[1:]):
                    continue
                if info.type == pyarrow.fs.FileType.File and fnmatch.fnmatchcase(info.base_name, pattern):
                    places.append(below)
                    sizes.append(info.size)
                elif info.type == pyarrow.fs.FileType.Directory and recursive and not deep:
                    places.append(below)
                    sizes.append(-1)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.string()), pa.array(sizes, pa.int64())], ["place", "size"])

    def top(batches):
        store, root = pyarrow.fs.FileSystem.from_uri(address)
        for batch in batches:
            for _ in range(batch.num_rows):
                yield from found(store, root.rstrip("/"), "", False)

    def below(batches):
        store, root = pyarrow.fs.FileSystem.from_uri(address)
        root = root.rstrip("/")
        for batch in batches:
            for place, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if size >= 0:
                    yield pa.RecordBatch.from_arrays([pa.array([place]), pa.array([size], pa.int64())], ["place", "size"])
                else:
                    yield from found(store, root, place, True)

    files = spark.range(0, 1, 1, 1).mapInArrow(top, schema)
    return files.repartition(tasks, "place").mapInArrow(below, schema) if recursive else files


def _uri(path: str) -> str:
    """An address that pyarrow takes: Spark writes local ones with one slash."""
    local = path.removeprefix("file:")
    return f"file://{local}" if path.startswith("file:/") and not local.startswith("//") else path


def _contents(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """(place, content) of files of :func:`_listed`; as with Spark's readers, empty files have no row."""
    address = _uri(path)

    def read(batches):
        store, root = pyarrow.fs.FileSystem.from_uri(address)
        root = root.rstrip("/")
        places, contents, size = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(places, pa.string()), pa.array(contents, pa.binary())], ["place", "content"])

        for some in batches:
            for place in some.column(0).to_pylist():
                with store.open_input_stream(f"{root}{place}", compression=None) as file:
                    content = file.read()
                if places and (size + len(content) > BATCH_BYTES or len(places) == BATCH_FILES):
                    yield batch()
                    places, contents, size = [], [], 0
                places.append(place)
                contents.append(content)
                size += len(content)
        if places:
            yield batch()

    dealt = files.where("size > 0").select("place").repartition(TASKS * spark.sparkContext.defaultParallelism, "place")
    return dealt.mapInArrow(read, "place string, content binary")


def documents(spark: SparkSession, path: str, pattern: str = "*.json", recursive=False, stream=False) -> DataFrame:
    """(file, folder, stem, text, document): one row per JSON file; document is null for bad JSON.

    With ``stream`` the files are a stream, of which each comes once. Folders with folders, which may hold very many files, are
    listed and read in tasks where pyarrow reaches them.
    """
    files = _listed(spark, path, pattern, True) if recursive and not stream and pattern.endswith(".json") else None
    if files is not None:
        top = F.lit(_uri(path).rstrip("/").rpartition("/")[2])
        parts = F.split("place", "/")
        rows = _contents(spark, path, files).select(
            F.element_at(parts, -1).alias("file"),
            F.when(F.size(parts) > 2, F.get(parts, F.size(parts) - 2)).otherwise(top).alias("folder"),
            F.col("content").cast("string").alias("text"),
        )
        stem = F.regexp_replace("file", r"\.[^.]*$", "")
        return rows.select("file", "folder", stem.alias("stem"), "text", F.try_parse_json("text").alias("document"))
    reader = (spark.readStream if stream else spark.read).option("wholetext", True).option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    parts = F.split(F.col("_metadata.file_path"), "/")
    rows = reader.text(path).select(
        F.url_decode(F.element_at(parts, -1)).alias("file"),
        F.url_decode(F.get(parts, F.size(parts) - 2)).alias("folder"),
        F.col("value").alias("text"),
    )
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    return rows.select("file", "folder", stem.alias("stem"), "text", F.try_parse_json("text").alias("document"))


def _get(path: str, kind: str = "variant", of: str = "document") -> Column:
    return F.try_variant_get(F.col(of), path, kind)


def _items(path: str, of: str = "document") -> Column:
    """(pos, item) rows of an array in the document."""
    return F.posexplode(_get(path, "array<variant>", of)).alias("pos", "item")


def extractions(spark: SparkSession, path: str) -> DataFrame:
    """Extraction bundles as one row per named message, with source, fields, fingerprint and version.

    ``seq`` is the reading order: suffix, file name, position.
    """
    return extraction_rows(documents(spark, path, "*.json"))


def extraction_rows(files: DataFrame) -> DataFrame:
    """:func:`extractions` of documents."""
    rank = F.lit(None).cast("int")
    for i, suffix in enumerate(BUNDLE_SUFFIXES):
        rank = F.when(F.col("file").endswith(suffix), F.lit(i)).otherwise(rank)
    rows = files.withColumn("_rank", rank).where("_rank is not null").select("file", "_rank", _items("$.messages"))
    rows = rows.select(
        F.struct(F.col("_rank").alias("suffix"), "file", "pos").alias("seq"),
        n.source_from_filename("file").alias("source"),
        "file",
        F.try_variant_get("item", "$.name", "string").alias("message_name"),
        F.to_json("item").alias("structure"),
    )
    named = rows.where((F.col("message_name").isNotNull()) & (F.col("message_name") != ""))
    return described(named)


def described(rows: DataFrame, structure: str = "structure") -> DataFrame:
    """Rows with their flattened fields, fingerprint and version; no shuffle."""
    with_fields = layout.add_fingerprint(layout.add_fields(rows, structure))
    document = layout.unwrapped(F.try_parse_json(F.col(structure)))
    own = with_fields.withColumn("_own", F.size(layout.own_fields(document)))
    return version.add_version(own, "fields", "_own").drop("_own")


def conversations(spark: SparkSession, path: str, reviewed=False) -> tuple[DataFrame, DataFrame]:
    """Conversation store (folder per manual, file per message) as (extractions, rejects).

    With ``reviewed`` the version is 0 and the review is kept.
    """
    return conversation_rows(documents(spark, path, "*.json", recursive=True), reviewed)


def conversation_rows(files: DataFrame, reviewed=False) -> tuple[DataFrame, DataFrame]:
    """:func:`conversations` of documents."""
    rows = files.select(
        F.col("folder").alias("manual"), "file",
        F.col("document").isNull().alias("_bad"),
        _get("$.message_name", "string").alias("message_name"),
        _get("$.extracted_structure").alias("_structure"),
        _get("$.review").alias("_review"),
        _get("$.extraction_timestamp", "string").alias("extraction_timestamp"),
        _get("$.model", "string").alias("model"),
    )
    text = F.to_json("_structure")
    kind = F.schema_of_variant("_structure")
    error = kind.startswith("OBJECT") & F.try_variant_get("_structure", "$.error", "variant").isNotNull()
    error = error | ((kind == "STRING") & text.contains("error"))
    reason = (
        F.when(F.col("_bad"), F.lit("malformed JSON"))
        .when(F.col("_structure").isNull() | text.isin("null", "{}", "[]", '""', "0", "false"), F.lit("no structure"))
        .when(error, F.lit("error in structure"))
        .when(F.coalesce("message_name", F.lit("")) == "", F.lit("no message name"))
    )
    rows = rows.withColumn("reason", reason)
    rejects = rows.where("reason is not null").select("manual", "file", "reason")
    good = rows.where("reason is null").withColumn("structure", text)
    part = lambda path: F.try_variant_get("_review", path, "variant")
    review = F.struct(
        part("$.verdict").try_cast("string").alias("verdict"),
        part("$.confidence").try_cast("string").alias("confidence"),
        F.to_json(part("$.corrected_structure")).alias("corrected_structure"),
    )
    has_review = F.schema_of_variant("_review").startswith("OBJECT") & (F.to_json("_review") != "{}")
    columns = ["manual", "message_name", "structure", "extraction_timestamp", "model"]
    if not reviewed:
        return described(good.select(*columns)), rejects
    from ..operators import vote

    out = good.withColumn("review", F.when(has_review, review)).select(*columns, "review")
    out = out.withColumns(vote.review_columns("review", "structure"))
    out = layout.add_fingerprint(layout.add_fields(out, "final_structure"))
    return out.withColumn("protocol_version", F.lit(0).cast("bigint")), rejects


def adjudication_input(extracted: DataFrame) -> DataFrame:
    """(message_name, source, structure): everything that is adjudicated together, one row per source."""
    kept = extracted.where((F.col("message_name") != "") & F.col("structure").isNotNull())
    return kept.select("message_name", F.col("manual").alias("source"), "structure")


def config_keys(spark: SparkSession, path: str) -> DataFrame:
    """Key bundles as one row per key that has an id, in file order."""
    return key_rows(documents(spark, path, f"*{KEY_BUNDLE_SUFFIX}"))


def key_rows(files: DataFrame) -> DataFrame:
    """:func:`config_keys` of documents."""
    files = files.select("file", _items("$.keys"))
    part = lambda name: F.try_variant_get("item", f"$.{name}", "string")
    blank = F.lit("")
    rows = files.select(
        part("key_id").alias("key_id"),
        *[F.coalesce(part(c), blank).alias(c) for c in ("name", "data_type", "description")],
        part("scale").alias("scale"),
        part("unit").alias("unit"),
        F.try_variant_get("item", "$.inline_enum.values", "variant").alias("_enum"),
        F.try_variant_get("item", "$.bitfield.bits", "array<variant>").alias("_bits"),
        "file",
        n.key_source_short("file").alias("source_short"),
        n.key_source_full("file")["full_id"].alias("source"),
        F.struct("file", "pos").alias("seq"),
    )
    return rows.where("key_id is not null and key_id <> ''")


def key_enum_items(keys: DataFrame) -> DataFrame:
    """Enumeration values of keys, from either the list or the map form."""
    listed = F.transform(
        F.col("_enum").try_cast("array<variant>"),
        lambda v: F.struct(F.try_variant_get(v, "$.name", "string").alias("name"), v.alias("item")),
    )
    mapped = F.transform(
        F.map_entries(F.col("_enum").try_cast("map<string,variant>")),
        lambda e: F.struct(e["key"].alias("name"), e["value"].alias("item")),
    )
    rows = keys.select("key_id", "source", "seq", F.explode(F.coalesce(listed, mapped)).alias("_v")).where("_v.name is not null")
    value = F.try_variant_get("_v.item", "$.value", "bigint")
    value = F.when(F.try_variant_get("_v.item", "$.value", "variant").isNull(), F.lit(0).cast("bigint")).otherwise(value)
    return rows.select(
        "key_id", "source", "seq", F.col("_v.name").alias("name"), value.alias("value"),
        F.coalesce(F.try_variant_get("_v.item", "$.description", "string"), F.lit("")).alias("description"),
    )


def key_bits(keys: DataFrame) -> DataFrame:
    part = lambda name, kind: F.try_variant_get("item", f"$.{name}", kind)
    rows = keys.select("key_id", "source", "seq", F.posexplode("_bits").alias("pos", "item"))
    return rows.select(
        "key_id", "source", "seq", "pos", part("name", "string").alias("name"), part("data_type", "string").alias("data_type"),
        part("bit_start", "int").alias("bit_start"), part("bit_end", "int").alias("bit_end"), part("description", "string").alias("description"),
    )


def registry(spark: SparkSession, path: str, key: str = "messages", pattern: str = "*.json") -> DataFrame:
    """Registry files as one row per message; a file without the list is one message."""
    return registry_rows(documents(spark, path, pattern), key)


def registry_rows(files: DataFrame, key: str = "messages") -> DataFrame:
    """:func:`registry` of documents."""
    many = _get(f"$.{key}", "array<variant>")
    rows = files.select("file", F.posexplode(F.coalesce(many, F.array("document"))).alias("pos", "item"))
    part = lambda name, kind="string": F.try_variant_get("item", f"$.{name}", kind)
    return rows.select(
        F.struct("file", "pos").alias("seq"), part("name").alias("name"), part("class_id").alias("class_id"),
        part("message_id").alias("message_id"), part("message_type").alias("message_type"),
        part("description").alias("description"), part("variant_aliases", "array<string>").alias("variant_aliases"),
        F.to_json("item").alias("structure"),
    ).where("name is not null")


def registry_fields(messages: DataFrame) -> DataFrame:
    """(name, pos, field, data_type, bits) of registry rows; bits are JSON, null where a field has none."""
    rows = messages.select("name", F.posexplode(F.try_variant_get(F.parse_json("structure"), "$.payload.fields", "array<variant>")).alias("pos", "item"))
    part = lambda name, kind: F.try_variant_get("item", f"$.{name}", kind)
    bits = F.to_json(part("bitfield", "variant"))
    return rows.select(
        "name", "pos", part("name", "string").alias("field"), part("data_type", "string").alias("data_type"), F.when(~bits.isin("[]", "{}", "null"), bits).alias("bits"),
    ).where("field is not null")


def registry_bits(fields: DataFrame) -> DataFrame:
    """(name, field, bit, bit_offset, width) of the bits listed in :func:`registry_fields`."""
    listed = F.try_variant_get(F.try_parse_json("bits"), "$", "array<variant>")
    rows = fields.select("name", "field", F.explode(listed).alias("item"))
    part = lambda name, kind="bigint": F.try_variant_get("item", f"$.{name}", kind)
    return rows.select(
        "name", "field", part("name", "string").alias("bit"), part("bit_offset").alias("bit_offset"),
        F.coalesce(F.when(part("bit_width") != 0, part("bit_width")), part("width")).alias("width"),
    ).where("bit is not null")


def second_registry(spark: SparkSession, path: str, pattern: str = "*.json", depth: int = 4) -> tuple[DataFrame, DataFrame]:
    """The other registry, files of {message: {field: type}}, as (fields, bits), both in the order of the text.

    ``fields``: message, path (the groups around a field), pos, field, kind, type, scale, count_field, rest. Members of
    groups have rows of their own; a group below ``depth`` others keeps its members as JSON in ``rest``.
    ``bits``: message, path, field, pos, bit, width. Objects are read as maps of texts, which keep their order. Each level is
    written once: the levels below it, the fields and the bits are read from there, and the files are not taken apart again.
    """
    mapped = "map<string,string>"
    level = documents(spark, path, pattern).select(F.explode(F.from_json("text", mapped)).alias("message", "_members"))
    level = level.withColumn("path", F.array().cast("array<string>"))
    levels = []
    for number in range(1, depth + 1):
        entries = F.posexplode(F.map_entries(F.from_json("_members", mapped))).alias("pos", "_e")
        rows = level.select("message", "path", entries)
        rows = rows.select("message", "path", "pos", F.col("_e.key").alias("field"), n.registry_form("_e.value").alias("form"))
        rows = cut_lineage(rows)
        # Deeper groups are not taken apart.
        levels.append(rows.withColumn("rest", F.col("form.fields") if number == depth else F.lit(None).cast("string")))
        level = rows.where("form.kind = 'group'").select("message", F.array_append("path", F.col("field")).alias("path"), F.col("form.fields").alias("_members"))
    found = reduce(DataFrame.unionByName, levels)
    fields = found.select("message", "path", "pos", "field", "form.kind", "form.type", "form.scale", "form.count_field", "rest")
    entries = F.posexplode(F.map_entries(F.from_json("form.bits", mapped))).alias("pos", "_b")
    bits = found.where("form.bits is not null").select("message", "path", "field", entries)
    width = F.col("_b.value")
    sized = F.when(width.rlike("^U[0-9]+$"), F.substring(width, 2, 9).cast("bigint")).otherwise(F.lit(1).cast("bigint"))
    return fields, bits.select("message", "path", "field", "pos", F.col("_b.key").alias("bit"), sized.alias("width"))


def registry_variants(messages: DataFrame) -> DataFrame:
    """Variants of registry rows with their discriminators."""
    rows = messages.select(
        "name", "class_id", "message_id",
        F.posexplode(F.try_variant_get(F.parse_json("structure"), "$.variants", "array<variant>")).alias("position", "item"),
    )
    part = lambda name, kind: F.try_variant_get("item", f"$.{name}", kind)
    return rows.select(
        "name", "class_id", "message_id", "position", part("name", "string").alias("variant"),
        part("discriminator.payload_length", "int").alias("payload_length"),
        part("discriminator.payload_length_range.min", "int").alias("min_length"),
        part("discriminator.payload_length_range.max", "int").alias("max_length"),
        part("discriminator.byte_offset", "int").alias("byte_offset"),
        part("discriminator.value", "bigint").alias("value"),
        F.to_json(part("payload", "variant")).alias("payload"),
    )


def map_entries(spark: SparkSession, path: str, json_path: str, columns: dict[str, str], pattern="*.json") -> DataFrame:
    """A JSON map as rows: ``key`` and the named parts of each value (name -> 'json path:type')."""
    files = documents(spark, path, pattern).select(_get(json_path, "map<string,variant>").alias("_m"))
    rows = files.select(F.explode("_m").alias("key", "item"))
    parts = []
    for name, spec in columns.items():
        where, kind = spec.rsplit(":", 1)
        parts.append(F.try_variant_get("item", where, kind).alias(name))
    return rows.select("key", *parts)


def manual_metadata(spark: SparkSession, path: str) -> DataFrame:
    rows = map_entries(spark, path, "$.manuals", {
        "firmware_version": "$.firmware_version:string", "protocol_version": "$.protocol_version:int",
        "protocol_version_str": "$.protocol_version_str:string", "version_identifier": "$.version_identifier:string",
    })
    return rows.withColumnRenamed("key", "source").withColumn("device_family", n.manual_family("source"))


def inventory(spark: SparkSession, path: str, part: str = "messages") -> DataFrame:
    """(entity, source) pairs of an inventory file."""
    rows = map_entries(spark, path, f"$.{part}", {"sources": "$:array<string>"})
    return rows.select(F.col("key").alias("entity"), F.explode("sources").alias("source"))


def name_mapping(spark: SparkSession, path: str, part: str) -> DataFrame:
    """(our_name, other_name) aliases of a mapping file; keys that start with '_' are comments."""
    rows = map_entries(spark, path, f"$.{part}", {"other_name": "$:string"})
    return rows.where(~F.col("key").startswith("_")).withColumnRenamed("key", "our_name")


def validation_results(spark: SparkSession, path: str) -> DataFrame:
    """Validation reports as one row per (message, manual) with three-valued ``matches``."""
    files = documents(spark, path, f"*{VALIDATION_SUFFIX}")
    # Taken out first, so that the rows of a file do not carry the whole file.
    files = files.select(_get("$.message", "string").alias("message"), _get("$.results", "array<variant>").alias("results"))
    rows = files.select("message", F.posexplode("results").alias("pos", "item"))
    part = lambda name, kind="string": F.try_variant_get("item", f"$.{name}", kind)
    listed = F.coalesce(part("discrepancies", "array<variant>"), F.array().cast("array<variant>"))
    names = ("field", "issue", "canonical_value", "pdf_value")
    return rows.select(
        "message", part("manual").alias("manual"), part("matches", "boolean").alias("matches"),
        part("protocol_version").alias("protocol_version"), part("device_family").alias("device_family"),
        F.transform(listed, lambda d: F.struct(*[F.try_variant_get(d, f"$.{k}", "string").alias(k) for k in names])).alias("discrepancies"),
    )


def _address(spark: SparkSession, path: str) -> str:
    """A folder's address as Spark's readers give it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def captures(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Capture files as (capture, data), one row per file of at most 2 GiB; larger ones: :func:`capture_pieces`."""
    files = _listed(spark, path, pattern)
    if files is not None:
        return _contents(spark, path, files).select(F.concat(F.lit(_address(spark, path)), "place").alias("capture"), F.col("content").alias("data"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("capture"), F.col("content").alias("data"))


def capture_pieces(spark: SparkSession, path: str, pattern: str = "*", piece: int = 1 << 22) -> DataFrame:
    """Capture files of any length as (capture, seq, data), a row for each ``piece`` bytes.

    Files and their lengths are listed first; tasks read their ranges through pyarrow, so the address must be
    one that pyarrow and all executors reach.
    """
    files, root = _listed(spark, path, pattern), None
    if files is not None:
        root = _address(spark, path), _uri(path)
        files = files.select(F.concat(F.lit(root[0]), "place").alias("path"), F.col("size").alias("length"))
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length")
    last = F.floor((F.col("length") - 1) / piece)
    wanted = files.where("length > 0").select(F.col("path").alias("capture"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("seq"))

    def read(batches):
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            captures, numbers, pieces = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(captures), pa.array(numbers, pa.int64()), pa.array(pieces, pa.binary())], ["capture", "seq", "data"])

        if root is not None:
            store, base = pyarrow.fs.FileSystem.from_uri(root[1])
        for some in batches:
            for capture, seq in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                if root is not None:
                    place = f"{base.rstrip('/')}{capture[len(root[0]):]}"
                else:
                    store, place = pyarrow.fs.FileSystem.from_uri(capture)
                with store.open_input_file(place) as file:
                    file.seek(seq * piece)
                    data = file.read(piece)
                if held and (size + len(data) > BATCH_BYTES or len(held) == BATCH_FILES):
                    yield batch()
                    held, size = [], 0
                held.append((capture, seq, data))
                size += len(data)
        if held:
            yield batch()

    dealt = wanted.repartition(TASKS * spark.sparkContext.defaultParallelism, "capture", "seq")
    return dealt.mapInArrow(read, "capture string, seq bigint, data binary")
