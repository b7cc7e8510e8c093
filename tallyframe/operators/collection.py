"""The published registry: adjudicated documents in one normal form, and canonical records of votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _truthy_text(v: Column) -> Column:
    """Text of a scalar that is not null, empty, zero or false."""
    kind, text = F.schema_of_variant(v), v.try_cast("string")
    empty = ((kind == "STRING") & (text == "")) | ((kind == "BIGINT") & (text == "0")) | ((kind == "BOOLEAN") & (text == "false"))
    return F.when(v.isNotNull() & (kind != "VOID") & ~empty, text)


def _first_of(v: Column, names) -> Column:
    return F.coalesce(*[_truthy_text(_get(v, f"$.{name}")) for name in names])


def _list_or_first(v: Column) -> Column:
    listed = F.schema_of_variant(v).startswith("ARRAY")
    return F.when(listed, _get(v, "$[0]")).otherwise(v)


def _field(f: Column) -> Column:
    given = _get(f, "$.byte_offset", "string")
    offset = F.coalesce(given, _get(f, "$.offset", "string"), F.lit("0"))
    description = F.coalesce(_get(f, "$.description", "string"), F.lit(""))
    name = _get(f, "$.name", "string")
    as_type = (name == "type") & (offset == "0")
    in_text = F.coalesce(*[n.hex_to_long(n.extract(description, p)) for p in fixed.FIXED_VALUE_PATTERNS])
    fixed_value = F.when(_get(f, "$.fixed_value").isNotNull(), _get(f, "$.fixed_value", "bigint")).when(as_type, in_text)
    dtype = F.coalesce(*[_truthy(_get(f, f"$.{k}")) for k in ("data_type", "type", "dataType")], F.lit("U1"))
    return F.struct(
        name.alias("name"),
        offset.alias("byte_offset"),
        dtype.alias("data_type"),
        fixed_value.alias("fixed_value"),
        n.blank_to_null(description).alias("description"),
        _truthy(_get(f, "$.unit")).alias("unit"),
        _truthy(_get(f, "$.scale")).alias("scale"),
        F.coalesce(_truthy(_get(f, "$.reserved")) != "false", F.lit(False)).alias("reserved"),
        _truthy(_get(f, "$.bitfield")).alias("bitfield"),
        _truthy(_get(f, "$.enumeration")).alias("inline_enum"),
    )


def _truthy(v: Column) -> Column:
    """Text of a scalar, JSON of an object; null for anything empty."""
    nested = F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")
    text = F.to_json(v)
    return F.when(nested, F.when(~text.isin("{}", "[]"), text)).otherwise(_truthy_text(v))


def _length(v: Column, kind: Column) -> Column:
    """Struct (fixed, base, min, max, formula) of the length shapes in use."""
    fixed_length, variable = _get(v, "$.fixed"), _get(v, "$.variable")
    low, high = _get(v, "$.min", "bigint"), _get(v, "$.max", "bigint")
    listed = F.array_sort(v.try_cast("array<bigint>"))

    def shape(fixed_=None, base=None, low_=None, high_=None, formula=None):
        def typed(value, as_type):
            return (F.lit(None) if value is None else value).cast(as_type)

        return F.struct(
            typed(fixed_, "bigint").alias("fixed"), typed(base, "bigint").alias("base"), typed(low_, "bigint").alias("min"),
            typed(high_, "bigint").alias("max"), typed(formula, "string").alias("formula"),
        )

    zero = F.lit(0)
    return (
        F.when(v.isNull() | (kind == "VOID"), shape(fixed_=zero))
        .when(kind.startswith("OBJECT") & fixed_length.isNotNull(), shape(fixed_=_get(v, "$.fixed", "bigint")))
        .when(
            kind.startswith("OBJECT") & variable.isNotNull(),
            shape(base=_get(variable, "$.base", "bigint"), low_=_get(variable, "$.min", "bigint"), high_=_get(variable, "$.max", "bigint"), formula=_get(variable, "$.formula", "string")),
        )
        .when(kind.startswith("OBJECT") & (low.isNotNull() | high.isNotNull()), shape(base=F.coalesce(low, zero), low_=low, high_=high))
        .when(kind.startswith("OBJECT"), shape(fixed_=zero))
        .when(kind.startswith("ARRAY"), shape(low_=F.get(listed, F.lit(0)), high_=F.try_element_at(listed, F.lit(-1))))
        .when(kind == "STRING", shape(base=zero, formula=v.try_cast("string")))
        .otherwise(shape(fixed_=v.try_cast("bigint")))
    )


def _group(g: Column) -> Column:
    base = _get(g, "$.base_offset")
    formula = n.offset_formula(base.try_cast("string"))
    products = F.transform(
        F.coalesce(_get(base, "$.add_field_products", "array<variant>"), F.array().cast("array<variant>")),
        lambda p: F.struct(_get(p, "$.field", "string").alias("field"), F.coalesce(_get(p, "$.multiplier", "bigint"), F.lit(1).cast("bigint")).alias("multiplier")),
    )
    given = F.struct(F.coalesce(_get(base, "$.base", "bigint"), F.lit(0).cast("bigint")).alias("base"), products.alias("products"))
    listed = F.coalesce(_get(g, "$.fields", "array<variant>"), F.array().cast("array<variant>"))
    return F.struct(
        _get(g, "$.name", "string").alias("name"),
        _get(g, "$.repetition_type", "string").alias("repetition"),
        _get(g, "$.count_field", "string").alias("count_field"),
        _get(g, "$.count", "bigint").alias("count"),
        _get(g, "$.group_size_bytes", "bigint").alias("size"),
        F.when(F.schema_of_variant(base).startswith("OBJECT"), given).when(base.isNotNull(), formula).alias("base_offset"),
        F.transform(listed, _field).alias("fields"),
    )


def normalize(documents: DataFrame, document: str = "document", name: str = "message_name") -> tuple[DataFrame, DataFrame]:
    """Adjudicated documents as (registry, rejects with a reason); row by row, no shuffle."""
    d = F.try_parse_json(F.col(document))
    rows = documents.withColumn("_d", d)
    rows = rows.withColumn("_adj", _list_or_first(_get(F.col("_d"), "$.adjudication")))
    rows = rows.withColumn("_raw", _get(F.col("_adj"), "$.canonical_structure"))
    rows = rows.withColumn("_c", _list_or_first(F.col("_raw")))
    wrapped = _get(F.col("_c"), f"$.{fixed.WRAPPER}")
    rows = rows.withColumn("_c", F.when(F.schema_of_variant(wrapped).startswith("OBJECT"), wrapped).otherwise(F.col("_c")))
    c, raw = F.col("_c"), F.col("_raw")
    blank = raw.isNull() | F.to_json(raw).isin("null", "{}", "[]", '""')
    rows = rows.withColumns({
        "_class": _first_of(c, fixed.ID_SYNONYMS["class_id"]), "_msg": _first_of(c, fixed.ID_SYNONYMS["message_id"]),
    })
    reason = (
        F.when(F.col("_d").isNull(), F.lit("not JSON"))
        .when(blank, F.lit("no canonical structure"))
        .when(F.schema_of_variant(raw) == "STRING", F.lit(fixed.REJECTED_STRING))
        .when(~F.coalesce(F.schema_of_variant(c).startswith("OBJECT"), F.lit(False)), F.lit(fixed.REJECTED_SHAPE))
        .when(F.col("_class").isNull(), F.lit(fixed.REJECTED_CLASS))
        .when(F.col("_msg").isNull(), F.lit(fixed.REJECTED_MESSAGE))
    )
    # A generated column: filters on it are not rewritten into copies of all the parsing above.
    rows = rows.select("*", F.explode(F.array(reason)).alias("reason"))
    rejects = rows.where("reason is not null").select(name, "reason")

    payload = _get(c, "$.payload")
    none = F.lit(None).cast("variant")
    shapes = [
        (F.schema_of_variant(payload).startswith("ARRAY"), payload, _get(c, "$.payload_length"), none),
        (_has_items(_get(payload, "$.fields")), _get(payload, "$.fields"), _get(payload, "$.length"), _get(payload, "$.repeated_groups")),
        (_has_items(_get(c, "$.fields")), _get(c, "$.fields"), _get(c, "$.length"), _get(c, "$.repeated_groups")),
        (_has_items(_get(c, "$.payload_fields")), _get(c, "$.payload_fields"), _get(c, "$.payload_length"), _get(c, "$.repeated_groups")),
        (_has_items(_get(c, "$.payload_structure")), _get(c, "$.payload_structure"), F.coalesce(_get(c, "$.length_bytes"), _get(c, "$.payload_length")), _get(c, "$.repeated_groups")),
    ]

    empty = F.array().cast("array<variant>")
    block = _get(payload, "$.repeated_block")
    # Each shape is picked once, as a column, so that later expressions stay small.
    rows = rows.where("reason is null").withColumns({
        "_shape": n._first_case([(F.coalesce(s[0], F.lit(False)), F.lit(i)) for i, s in enumerate(shapes)], F.lit(-1)),
        "_payload_groups": F.when(block.isNotNull(), F.array(block)),
    })

    def pick(index, otherwise):
        return n._first_case([(F.col("_shape") == i, s[index]) for i, s in enumerate(shapes)], otherwise)

    rows = rows.withColumns({
        "_fields": F.coalesce(pick(1, none).try_cast("array<variant>"), empty),
        "_length": pick(2, _get(payload, "$.length")),
        "_groups": F.coalesce("_payload_groups", pick(3, _get(payload, "$.repeated_groups")).try_cast("array<variant>"), empty),
    })
    rows = rows.withColumn("_length_kind", F.schema_of_variant("_length"))
    named = F.filter("_fields", lambda f: F.coalesce(_get(f, "$.name", "string"), F.lit("")) != "")
    kind = F.lower(F.coalesce(_get(c, "$.message_type", "string"), F.lit("output")))
    types = F.create_map(*[F.lit(x) for pair in fixed.MESSAGE_TYPES.items() for x in pair])
    verdicts = F.coalesce(_get(F.col("_adj"), "$.extraction_verdicts", "array<variant>"), empty)
    sources = F.array_distinct(
        F.filter(F.transform(verdicts, lambda v: _get(v, "$.source", "string")), lambda s: F.coalesce(s, F.lit("")) != "")
    )
    level = F.coalesce(_get(F.col("_adj"), "$.canonical_confidence", "string"), F.lit("unknown"))
    count = F.coalesce(_get(F.col("_d"), "$.num_extractions", "string"), F.lit("0"))
    registry = rows.select(
        F.coalesce(_get(c, "$.name", "string"), F.col(name)).alias("name"),
        F.col("_class").alias("class_id"),
        F.col("_msg").alias("message_id"),
        F.coalesce(F.try_element_at(types, kind), F.lit("output")).alias("message_type"),
        n.blank_to_null(_get(c, "$.description", "string")).alias("description"),
        _length(F.col("_length"), F.col("_length_kind")).alias("length"),
        F.transform(named, _field).alias("fields"),
        F.transform("_groups", _group).alias("repeated_groups"),
        sources.alias("source_manuals"),
        F.concat(F.lit("Confidence: "), level, F.lit(", Sources: "), count).alias("comment"),
    )
    return registry, rejects


def _has_items(v: Column) -> Column:
    return F.coalesce(F.size(v.try_cast("array<variant>")) > 0, F.lit(False))


def fixed_length(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("length.fixed").isNotNull())


def canonical(votes: DataFrame, entity_name: str, version: str, annotations: DataFrame, structure: str | None = None) -> DataFrame:
    """Votes as canonical records with annotations looked up by (prefixed name, version).

    ``annotations``: name, version, plus any columns; one row per annotation of a record.
    """
    name = F.col(entity_name)
    full = F.when(name.startswith(fixed.MESSAGE_PREFIX), name).otherwise(F.concat(F.lit(fixed.MESSAGE_PREFIX), name))
    notes = [c for c in annotations.columns if c not in ("name", "version")]
    dim = annotations.select(F.col("name").alias("_name"), F.col("version").alias("_version"), F.struct(*notes).alias("annotation"))
    joined = votes.withColumn("_full", full).join(
        dim, (F.col("_full") == F.col("_name")) & (F.col(version) == F.col("_version")), "left"
    )
    missing = F.col("winning_value").isNull() if structure is None else F.col(structure).isNull()
    return joined.select(
        entity_name, version,
        F.col("winning_value").alias("fingerprint"),
        "agreement_count", "total_count", "confidence",
        F.bround("confidence_score", 3).alias("confidence_score"),
        *([structure] if structure else []),
        "annotation",
        F.when(missing, F.lit(fixed.NO_WINNER)).alias("error"),
        n.canonical_key(entity_name, version).alias("file_key"),
    )


