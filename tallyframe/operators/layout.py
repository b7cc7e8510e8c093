"""Layouts: flattening definition documents, structural fingerprints and their differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n
from .skew import null_safe_join

EMPTY_TEXT = "no_fields"


# -- JSON text pieces ------------------------------------------------------------------------


def json_text(c) -> Column:
    """A quoted JSON string with non-ASCII characters escaped."""
    c = n._col(c)
    units = F.regexp_extract_all(F.hex(F.encode(c, "UTF-16BE")), F.lit("([0-9A-F]{4})"))

    def unit(u):
        ascii_text = F.char(F.conv(u, 16, 10).cast("bigint"))
        return (
            F.when(u == "0022", F.lit('\\"'))
            .when(u == "005C", F.lit("\\\\"))
            .when(u == "000A", F.lit("\\n"))
            .when(u == "000D", F.lit("\\r"))
            .when(u == "0009", F.lit("\\t"))
            .when(u == "0008", F.lit("\\b"))
            .when(u == "000C", F.lit("\\f"))
            .when((u < "0020") | (u > "007E"), F.concat(F.lit("\\u"), F.lower(u)))
            .otherwise(ascii_text)
        )

    escaped = F.array_join(F.transform(units, unit), "")
    plain = c.rlike(r'^[ !#-\[\]-~]*$')
    return F.concat(F.lit('"'), F.when(plain, c).otherwise(escaped), F.lit('"'))


def _spaced_json(variant: Column) -> Column:
    text = F.regexp_replace(F.to_json(variant), r'":', '": ')
    return F.regexp_replace(text, r',(?=["{\[0-9-]|null|true|false)', ", ")


def entry_text(name, offset, dtype, size_text) -> Column:
    """One field as it enters the fingerprint."""
    return F.concat(
        F.lit("["), json_text(name), F.lit(", "), n._col(offset).cast("string"), F.lit(", "),
        json_text(dtype), F.lit(", "), n._col(size_text).cast("string"), F.lit("]"),
    )


def digest_of(entries: Column) -> Column:
    """Fingerprint of a sorted array of entry texts."""
    text = F.concat(F.lit("["), F.array_join(entries, ", "), F.lit("]"))
    empty = F.concat(F.lit("empty_"), F.substring(F.sha2(F.lit(EMPTY_TEXT), 256), 1, 12))
    return F.when(F.size(entries) == 0, empty).otherwise(F.substring(F.sha2(text, 256), 1, 16))


# -- documents -------------------------------------------------------------------------------


def _kind(variant: Column) -> Column:
    return F.schema_of_variant(variant)


def _part(variant: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(variant, path, kind)


def _nonempty(array: Column) -> Column:
    return F.when(F.size(array) > 0, array)


def unwrapped(document: Column) -> Column:
    """The definition inside an optional wrapper object."""
    return F.coalesce(_part(document, f"$.{fixed.WRAPPER}"), document)


def own_fields(document: Column, order=("$.fields", "$.payload.fields", "$.payload_fields")) -> Column:
    """The first non-empty field list of a definition, as array<variant>."""
    found = [_nonempty(_part(document, path, "array<variant>")) for path in order]
    return F.coalesce(*found, F.array().cast("array<variant>"))


def group_fields(document: Column) -> Column:
    groups = F.coalesce(_part(document, "$.payload.repeated_groups", "array<variant>"), F.array().cast("array<variant>"))
    empty = F.array().cast("array<variant>")
    return F.flatten(F.transform(groups, lambda g: F.coalesce(_part(g, "$.fields", "array<variant>"), empty)))


def _type_parts(kind: Column, variant: Column, base: Column, base_kind: Column, count: Column, count_kind: Column) -> Column:
    text, base_text = variant.try_cast("string"), base.try_cast("string")
    number = F.when(count.isNull(), F.lit(1).cast("bigint")).otherwise(F.try_variant_get(count, "$", "bigint"))
    count_text = F.when(count_kind == "VOID", F.lit("None")).otherwise(count.try_cast("string"))

    def pair(t, size):
        return F.struct(t.alias("text"), size.cast("bigint").alias("size"))

    array_type = F.when(
        count.isNull() | (count_kind == "BIGINT"),
        pair(F.concat(base_text, F.lit("["), number.cast("string"), F.lit("]")), n.wire_size(base_text) * number),
    ).otherwise(pair(F.concat(base_text, F.lit("["), count_text, F.lit("]")), F.lit(0)))
    is_object = kind.startswith("OBJECT")
    return (
        F.when(variant.isNull(), pair(F.lit("U1"), F.lit(1)))
        .when(kind == "STRING", pair(text, n.wire_size(text)))
        .when(is_object & base.isNotNull() & ~base_kind.startswith("OBJECT"), array_type)
        .when(is_object | kind.startswith("ARRAY"), pair(_spaced_json(variant), F.lit(1)))
        .when(kind == "VOID", pair(F.lit("None"), F.lit(1)))
        .otherwise(pair(text, F.lit(1)))
    )


def data_type(variant: Column) -> Column:
    """Struct (text, size) of a polymorphic data type; a missing one is U1."""

    def parts(v):
        inner = F.struct(
            v["t"].alias("t"), _kind(v["t"]).alias("k"), v["b"].alias("b"), _kind(v["b"]).alias("bk"), v["c"].alias("c"), _kind(v["c"]).alias("ck")
        )
        return n.let(inner, lambda p: _type_parts(p["k"], p["t"], p["b"], p["bk"], p["c"], p["ck"]))

    return n.let(F.struct(variant.alias("t"), _part(variant, "$.array_of").alias("b"), _part(variant, "$.count").alias("c")), parts)


def field_struct(field: Column, position: Column) -> Column:
    """A raw field variant as a typed struct; offsets that are not integers become -1."""
    offset, size = _part(field, "$.byte_offset"), _part(field, "$.size_bytes")
    raw = F.struct(
        offset.alias("o"), _kind(offset).alias("ok"), size.alias("s"), _kind(size).alias("sk"),
        data_type(_part(field, "$.data_type")).alias("t"), F.coalesce(_part(field, "$.name", "string"), F.lit("")).alias("n"),
        _part(field, "$.description", "string").alias("d"),
    )

    def typed(r):
        minus, zero = F.lit(-1).cast("bigint"), F.lit(0).cast("bigint")
        byte_offset = F.when(r["o"].isNull(), zero).when(r["ok"] == "BIGINT", F.try_variant_get(r["o"], "$", "bigint")).otherwise(minus)
        declared = F.when(r["sk"] == "STRING", json_text(r["s"].try_cast("string"))).when(r["sk"] == "VOID", F.lit("null")).otherwise(
            r["s"].try_cast("string")
        )
        number = F.try_variant_get(r["s"], "$", "bigint")
        return F.struct(
            byte_offset.alias("byte_offset"),
            n.field_name(r["n"]).alias("name"),
            position.alias("pos"),
            r["n"].alias("original_name"),
            r["t"]["text"].alias("data_type"),
            F.when(r["s"].isNull(), r["t"]["size"]).otherwise(number).alias("size"),
            F.when(r["s"].isNull(), r["t"]["size"].cast("string")).otherwise(declared).alias("size_text"),
            number.alias("size_declared"),
            r["d"].alias("description"),
        )

    return n.let(raw, typed)


def add_fields(documents: DataFrame, structure: str = "structure") -> DataFrame:
    """Add ``fields``: the flattened field structs of each definition, row by row."""
    document = F.try_parse_json(F.col(structure))
    return (
        documents.withColumn("_document", unwrapped(document))
        .withColumn("_raw", F.concat(own_fields(F.col("_document")), group_fields(F.col("_document"))))
        .withColumn("fields", F.transform("_raw", field_struct))
        .drop("_document", "_raw")
    )


def add_fingerprint(documents: DataFrame, fields: str = "fields") -> DataFrame:
    """Add ``fingerprint`` and ``field_count`` from a ``fields`` array; no shuffle."""
    entries = F.transform(
        F.array_sort(F.col(fields)), lambda f: entry_text(f["name"], f["byte_offset"], f["data_type"], f["size_text"])
    )
    return documents.withColumn("fingerprint", digest_of(entries)).withColumn("field_count", F.size(fields))


def field_table(documents: DataFrame, fields: str = "fields") -> DataFrame:
    """One row per field; documents without fields have none."""
    kept = [c for c in documents.columns if c != fields]
    return documents.select(*kept, F.explode(fields).alias("_f")).select(*kept, "_f.*")


def count_fields(structure: str = "structure") -> Column:
    document = unwrapped(F.try_parse_json(F.col(structure)))
    return F.size(own_fields(document, ("$.payload.fields", "$.payload_fields", "$.fields")))


def wrapped_fields(structure: str = "structure") -> Column:
    """JSON text in which bare fields are moved into a payload."""
    document = F.try_parse_json(F.col(structure))
    fields = _part(document, "$.fields")
    bare = fields.isNotNull() & _part(document, "$.payload").isNull()
    kept = F.map_filter(document.try_cast("map<string,variant>"), lambda k, _: k != "fields")
    payload = F.create_map(F.lit("payload"), F.parse_json(F.concat(F.lit('{"fields":'), F.to_json(fields), F.lit("}"))))
    return F.when(bare, F.to_json(F.map_concat(kept, payload))).otherwise(F.col(structure))


# -- field tables ----------------------------------------------------------------------------


def fingerprint(fields: DataFrame, entity, name: str, offset: str, dtype: str, size: str, pos=()) -> DataFrame:
    """``entity.., fingerprint, field_count`` of a field table.

    One rule for layouts of any size: the entries, in order, are one text, whose digest is the fingerprint. The
    entries of a layout meet in one row; one too large for a row fails the job.
    """
    rows = fields.select(
        *entity,
        F.coalesce(F.col(offset).cast("bigint"), F.lit(-1)).alias("_offset"),
        n.field_name(name).alias("_name"),
        *[F.col(p) for p in pos if p not in entity],
        entry_text(
            n.field_name(name), F.coalesce(F.col(offset).cast("bigint"), F.lit(-1)),
            F.col(dtype).cast("string"), F.coalesce(F.col(size).cast("string"), F.lit("null")),
        ).alias("_entry"),
    )
    listed = rows.groupBy(*entity).agg(F.array_sort(F.collect_list(F.struct("_offset", "_name", *pos, "_entry"))).alias("_fields"))
    return listed.select(
        *entity,
        digest_of(F.transform("_fields", lambda f: f["_entry"])).alias("fingerprint"),
        F.size("_fields").cast("bigint").alias("field_count"),
    )


def last_per_offset(fields: DataFrame, keys, offset: str, columns, order) -> DataFrame:
    """One row per (key, offset): of rows on one offset the last in ``order`` stays."""
    row = F.struct(*columns)
    return fields.groupBy(*keys, offset).agg(F.max_by(row, F.struct(*order)).alias("_f")).select(*keys, offset, "_f.*")


def differences(first: DataFrame, second: DataFrame, keys, offset: str, name: str, dtype: str, size: str, order) -> DataFrame:
    """Field by field difference of two layouts: ``kind`` is missing_in_first, missing_in_second or field_differs."""
    mark = F.lit(True)
    return sided_differences(first.withColumn("_first", mark).unionByName(second.withColumn("_first", ~mark), True), "_first", keys, offset, name, dtype, size, order)


def sided_differences(fields: DataFrame, is_first: str, keys, offset: str, name: str, dtype: str, size: str, order) -> DataFrame:
    """:func:`differences` of the rows where ``is_first`` holds and those where it does not, in one aggregation."""
    columns = [name, dtype, size]
    row, side = F.struct(*columns), F.col(is_first)
    # The last row of each side per (key, offset).
    last = lambda side: F.max_by(row, F.when(side, F.struct(*order)))
    both = fields.groupBy(*keys, offset).agg(last(side).alias("first"), last(~side).alias("second"))
    kind = (
        F.when(F.col("first").isNull(), F.lit("missing_in_first"))
        .when(F.col("second").isNull(), F.lit("missing_in_second"))
        .otherwise(F.lit("field_differs"))
    )
    return both.where(~F.col("first").eqNullSafe(F.col("second"))).select(
        *keys,
        offset,
        kind.alias("kind"),
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("first", "second") for c in columns],
    )


def difference_text(offset: str, name: str, dtype: str) -> Column:
    at = F.concat(F.lit(" at offset "), F.col(offset).cast("string"))

    def shown(side):
        return F.concat(F.col(f"{side}_{name}"), F.lit("("), F.col(f"{side}_{dtype}").cast("string"), F.lit(")"))

    return (
        F.when(F.col("kind") == "missing_in_first", F.concat(F.lit("missing field"), at))
        .when(F.col("kind") == "missing_in_second", F.concat(F.lit("extra field"), at))
        .otherwise(F.concat(F.lit("field"), at, F.lit(": "), shown("first"), F.lit(" vs "), shown("second")))
    )


def summarize(diff: DataFrame, keys, offset: str, name: str, dtype: str, count_diff: DataFrame | None = None, carried=None) -> DataFrame:
    """One line per key: the field count difference, three differences, and how many more there are.

    ``count_diff`` has the keys and ``field_count_diff``; with ``carried``, a list of further columns of it, all its keys come
    out, those without a difference too. The rank limit keeps three rows per key in each task before the shuffle, whatever
    the number of differences. Texts, counts and ``count_diff`` meet in one aggregation of a few rows a key.
    """
    texts = diff.select(*keys, offset, difference_text(offset, name, dtype).alias("_text"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(offset))
    top = texts.withColumn("_rank", rank).where(F.col("_rank") <= 3)
    parts = [
        top.select(*keys, F.struct("_rank", "_text").alias("_line")),
        texts.groupBy(*keys).agg(F.count(F.lit(1)).alias("mismatch_count")),
    ]
    if count_diff is not None:
        kept = F.struct("field_count_diff", *(carried or []))
        parts.append(count_diff.select(*keys, kept.alias("_sized")))
    joined = reduce(lambda x, y: x.unionByName(y, True), parts)
    if count_diff is None:
        joined = joined.withColumn("_sized", F.lit(None).cast("struct<field_count_diff:bigint>"))
    # Three lines a key at most, as ranks are of all tasks.
    out = joined.groupBy(*keys).agg(F.array_sort(F.collect_list("_line")).alias("_lines"), F.max("mismatch_count").alias("mismatch_count"), F.max("_sized").alias("_sized"))
    out = out.where(F.col("mismatch_count").isNotNull() if carried is None else F.col("_sized").isNotNull())
    sized = F.col("_sized.field_count_diff")
    lead = F.when(sized != 0, F.concat(F.lit("field count differs by "), sized.cast("string")))
    more = F.when(
        F.col("mismatch_count") > 3,
        F.concat(F.lit("...and "), (F.col("mismatch_count") - 3).cast("string"), F.lit(" more differences")),
    )
    shown = F.when(F.size("_lines") > 0, F.array_join(F.transform("_lines", lambda x: x["_text"]), "; "))
    text = F.when(F.col("mismatch_count").isNotNull(), F.concat_ws("; ", lead, shown, more))
    extra = ["field_count_diff"] * (count_diff is not None) + list(carried or [])
    return out.select(*keys, "mismatch_count", *[F.col(f"_sized.{c}").alias(c) for c in extra], text.alias("summary"))
