"""Rule checks and reports. A rule turns rows into violations; reports count them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n
from . import skew

# -- layout structure ------------------------------------------------------------------------


def structure(fields: DataFrame, message, name: str, offset: str, size: Column, order, declared: str | None = None, dtype: str | None = None) -> DataFrame:
    """Violations of a layout: gap, overlap, size_mismatch, type_invalid, size_unknown.

    A field is expected where the one before it (by offset, then ``order``) ends. ``size`` is the
    computed size; null means it cannot be known.
    """
    end = F.col(offset).cast("bigint") + F.coalesce(F.col("_size"), F.lit(0))
    sized = fields.withColumn("_size", size.cast("bigint"))
    rows = skew.ordered(sized, message, [offset, *order], {"_expected": ("lag", end)})
    expected = F.coalesce("_expected", F.lit(0).cast("bigint"))
    at = F.col(offset).cast("bigint")

    def issue(condition, kind, severity, amount):
        fields_ = (F.lit(kind).alias("issue"), F.lit(severity).alias("severity"), amount.cast("bigint").alias("amount"))
        return F.when(condition, F.struct(*fields_))

    checks = [
        issue(at > expected, "gap", "warning", at - expected),
        issue(at < expected, "overlap", "error", expected - at),
        issue(F.col("_size").isNull(), "size_unknown", "warning", F.lit(0)),
    ]
    if declared:
        checks.append(issue(F.col(declared) != F.col("_size"), "size_mismatch", "warning", F.col(declared) - F.col("_size")))
    if dtype:
        plain = ~F.col(dtype).contains("[")
        checks.append(issue(plain & ~F.col(dtype).isin(list(fixed.WIRE_SIZES)), "type_invalid", "warning", F.lit(0)))
    found = F.explode(F.array_compact(F.array(*checks)))
    return rows.select(*message, F.col(name).alias("field"), at.alias("byte_offset"), expected.alias("expected_offset"), found.alias("_i")).select(
        *message, "field", "byte_offset", "expected_offset", "_i.*"
    )


def layout_end(fields: DataFrame, message, offset: str, size: Column, order) -> DataFrame:
    """Where the last field (by offset, then ``order``) ends."""
    end = F.col(offset).cast("bigint") + F.coalesce(size.cast("bigint"), F.lit(0))
    return fields.groupBy(*message).agg(F.max_by(end, F.struct(offset, *order)).alias("computed_length"))


def length_mismatch(ends: DataFrame, lengths: DataFrame, message, declared: str) -> DataFrame:
    joined = skew.null_safe_join(ends, lengths.select(*message, declared), message, "inner")
    return joined.where((F.col(declared) != 0) & (F.col("computed_length") != F.col(declared)))


def empty_layouts(messages: DataFrame, fields: DataFrame, message) -> DataFrame:
    return skew.null_safe_join(messages.select(*message).distinct(), fields.select(*message).distinct(), message, "left_anti")


def structure_status(messages: DataFrame, violations: DataFrame, message) -> DataFrame:
    """Per message: errors, warnings and whether it is valid (warnings are allowed)."""
    counts = violations.groupBy(*message).agg(
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )
    out = skew.null_safe_join(messages.select(*message).distinct(), counts, message, "left")
    zero = F.lit(0).cast("bigint")
    out = out.withColumn("errors", F.coalesce("errors", zero)).withColumn("warnings", F.coalesce("warnings", zero))
    return out.withColumn("is_valid", F.col("errors") == 0)


def failed(status: DataFrame) -> DataFrame:
    return status.where(~F.col("is_valid"))


def extraction_fields(fields: DataFrame, message, name: str, offset: str, dtype: str, reserved: str, order) -> DataFrame:
    """Violations of raw extracted fields: missing offset or type, and offsets that go back."""
    rows = skew.ordered(fields, message, order, {"_highest": ("max_before", F.col(offset).cast("bigint"))})
    at = F.col(offset).cast("bigint")

    def issue(condition, kind, severity):
        return F.when(condition, F.struct(F.lit(kind).alias("issue"), F.lit(severity).alias("severity")))

    found = F.array_compact(F.array(
        issue(at.isNull(), "missing_offset", "error"),
        issue(at.isNotNull() & (at < F.coalesce("_highest", F.lit(-1))) & ~F.coalesce(F.col(reserved), F.lit(False)), "offset_decreases", "warning"),
        issue(at.isNotNull() & F.col(dtype).isNull(), "missing_type", "error"),
    ))
    return rows.select(*message, F.col(name).alias("field"), *order, F.explode(found).alias("_i")).select(*message, "field", *order, "_i.*")


REQUIRED = ["name", "class_id", "message_id", "message_type", "payload"]


def extraction_documents(documents: DataFrame, structure_column: str, keys) -> DataFrame:
    """Violations of whole extracted documents, row by row: error, required parts, payload shape, length, ids."""
    doc = F.try_parse_json(F.col(structure_column))

    def part(path, kind="variant"):
        return F.try_variant_get(doc, path, kind)

    def issue(condition, kind, severity):
        return F.when(condition, F.struct(F.lit(kind).alias("issue"), F.lit(severity).alias("severity")))

    failed_doc = part("$.error").isNotNull()
    missing = [part(f"$.{r}").isNull() for r in REQUIRED]
    incomplete = reduce(lambda a, b: a | b, missing)
    is_object = F.schema_of_variant(part("$.payload")).startswith("OBJECT")
    ok = ~failed_doc & ~incomplete & is_object
    fields = part("$.payload.fields", "array<variant>")
    empty = fields.isNull() | (F.size(fields) == 0)
    last = F.element_at(fields, -1)
    last_type = F.try_variant_get(last, "$.data_type", "variant")
    last_end = F.coalesce(F.try_variant_get(last, "$.byte_offset", "bigint"), F.lit(0)) + n.wire_size(last_type.try_cast("string"))
    fixed_length = part("$.payload.length.fixed", "bigint")
    no_length = part("$.payload.length").isNull() | (F.to_json(part("$.payload.length")) == "{}")

    def bad_id(name):
        text = part(f"$.{name}", "string")
        return ok & (text != "") & ~text.startswith("0x")

    found = [issue(failed_doc, "error", "error")]
    found += [issue(~failed_doc & m, f"missing_{r}", "error") for r, m in zip(REQUIRED, missing)]
    found += [
        issue(~failed_doc & ~incomplete & ~is_object, "payload_not_object", "error"),
        issue(ok & empty, "no_fields", "warning"),
        issue(ok & no_length, "no_length", "warning"),
        issue(ok & ~empty & (F.schema_of_variant(last_type) == "STRING") & (last_end != fixed_length), "end_mismatch", "warning"),
        issue(bad_id("class_id"), "class_id_not_hex", "error"),
        issue(bad_id("message_id"), "message_id_not_hex", "error"),
    ]
    return documents.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("_i")).select(*keys, "_i.*")


# -- constraints -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A condition every row must meet, or with ``share`` the smallest share of rows that must.

    """

    name: str
    condition: Column
    share: float = 1.0


def expect(df: DataFrame, rules) -> DataFrame:
    """One row per rule: rows checked, violations and whether the rule passed. One pass over ``df``."""
    checks = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.coalesce(r.condition, F.lit(False)).alias("ok"), F.lit(float(r.share)).alias("share"))
        for r in rules
    ])
    counted = df.select(F.inline(checks)).groupBy("rule", "share").agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(~F.col("ok")).alias("violations")
    )
    met = (F.col("checked") - F.col("violations")) >= F.col("share") * F.col("checked")
    return counted.select("rule", "checked", "violations", met.alias("passed"))


@dataclass(frozen=True)
class Keyed:
    """A rule over the rows of one key; rows where ``where`` does not hold are passed over.

    ``unique``: no key has two rows. ``group``: a key has at least ``least`` different items, null ones not counted.
    ``reference``: every key is among those of the ``known`` rows of the same rule name, mostly of another table.
    ``total``: there are at least ``least`` different items in all.
    """

    name: str
    kind: str
    key: tuple[Column, ...] = ()
    item: Column | None = None
    least: int = 1
    where: Column | None = None


def check(*tables: tuple[DataFrame, list[Rule | Keyed]]) -> DataFrame:
    """One row per rule of whole rule sets, as of :func:`expect`: each table is read once, for rules of every kind.

    A row gives one entry (rule, key, item) for each of its rules; the entries are counted by all three, by rule and key, and
    by rule. Entries without a key are counted before the shuffle, and a key of very many rows is a few partial counts.
    """

    def entry(rule: Rule | Keyed) -> Column:
        keyed = isinstance(rule, Keyed)
        text = lambda columns: F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
        none, item = F.lit(None).cast("string"), getattr(rule, "item", None)
        fields = F.struct(
            F.lit(rule.name).alias("rule"), F.lit("row" if not keyed else "reference" if rule.kind == "known" else rule.kind).alias("kind"),
            F.lit(1.0 if keyed else float(rule.share)).alias("share"), F.lit(rule.least if keyed else 1).alias("least"),
            (text(rule.key) if keyed and rule.key else none).alias("key"),
            (none if item is None else F.when(item.isNotNull(), text((item,)))).alias("item"),
            (F.lit(True) if keyed else F.coalesce(rule.condition, F.lit(False))).alias("ok"), F.lit(keyed and rule.kind == "known").alias("known"),
        )
        where = rule.where if keyed else None
        return fields if where is None else F.when(where, fields)

    entries = [df.select(F.inline(F.array_compact(F.array(*[entry(r) for r in rules])))) for df, rules in tables]
    of = ["rule", "kind", "share", "least", "key"]
    # The known side says nothing about how many items a rule wants.
    items = reduce(DataFrame.unionByName, entries).groupBy(*of, "item").agg(
        F.count_if(~F.col("known")).alias("n"), F.count_if(~F.col("ok")).alias("bad"), F.max("known").alias("known")
    )
    keys = items.groupBy(*of).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.max("known").alias("known"), F.count("item").alias("items"))
    kind, used = F.col("kind"), (F.col("n") > 0).cast("bigint")
    short = F.greatest(F.lit(0).cast("bigint"), F.col("least") - F.col("items"))
    checked = F.when(kind == "row", F.col("n")).when(kind == "total", F.col("items")).otherwise(used)
    broken = (
        F.when(kind == "row", F.col("bad")).when(kind == "unique", (F.col("n") > 1).cast("bigint"))
        .when(kind == "group", (short > 0).cast("bigint")).when(kind == "total", short).otherwise(used * (~F.col("known")).cast("bigint"))
    )
    counted = keys.groupBy("rule", "kind").agg(F.sum(checked).alias("checked"), F.sum(broken).alias("violations"), F.max("share").alias("share"))
    met = F.when(F.col("kind") == "row", F.col("checked") - F.col("violations") >= F.col("share") * F.col("checked")).otherwise(F.col("violations") == 0)
    return counted.select("rule", "checked", "violations", met.alias("passed"))


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    return df.where(~F.coalesce(rule.condition, F.lit(False)))


def _outcome(df: DataFrame, name: str, checked: Column, broken: Column) -> DataFrame:
    out = df.agg(checked.alias("checked"), F.coalesce(broken, F.lit(0)).cast("bigint").alias("violations"))
    return out.select(F.lit(name).alias("rule"), "checked", "violations", (F.col("violations") == 0).alias("passed"))


def unique(df: DataFrame, key, name: str) -> DataFrame:
    """Values of ``key`` that occur more than once."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return _outcome(counts, name, F.count(F.lit(1)), F.count_if(F.col("_n") > 1))


def references(df: DataFrame, target: DataFrame, key, target_key, name: str) -> DataFrame:
    """Distinct key values without a counterpart in ``target``."""
    used = df.select(*key).distinct()
    known = target.select(*[F.col(t).alias(k) for k, t in zip(key, target_key)]).distinct().withColumn("_ok", F.lit(True))
    return _outcome(skew.null_safe_join(used, known, key, "left"), name, F.count(F.lit(1)), F.count_if(F.col("_ok").isNull()))


def at_least(df: DataFrame, name: str, minimum: int) -> DataFrame:
    out = df.agg(F.count(F.lit(1)).alias("checked"))
    return out.select(
        F.lit(name).alias("rule"), "checked",
        F.greatest(F.lit(0).cast("bigint"), F.lit(minimum).cast("bigint") - F.col("checked")).alias("violations"),
        (F.col("checked") >= minimum).alias("passed"),
    )


def report(*outcomes: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, outcomes)


def fits_type(value, dtype) -> Column:
    """Whether a number fits a wire type; types without a known range fit."""
    dtype = n._col(dtype)
    low = high = F.lit(None).cast("decimal(20,0)")
    for size in (1, 2, 4, 8):
        top = 2 ** (8 * size)
        for kinds, least, most in (([f"U{size}", f"X{size}", f"E{size}"], 0, top - 1), ([f"I{size}"], -(top // 2), top // 2 - 1)):
            low = F.when(dtype.isin(kinds), F.lit(str(least)).cast("decimal(20,0)")).otherwise(low)
            high = F.when(dtype.isin(kinds), F.lit(str(most)).cast("decimal(20,0)")).otherwise(high)
    return F.coalesce(n._col(value).cast("decimal(20,0)").between(low, high), low.isNull())


def key_rules() -> list[Rule]:
    """Rules for configuration keys (name, key_id, item_id, data_type, description, source_count)."""
    return [
        *[Rule(f"has_{c}", F.col(c).isNotNull()) for c in ("name", "key_id", "data_type", "group")],
        Rule("key_id_format", F.col("key_id").rlike(fixed.KEY_ID)),
        Rule("item_id_format", F.col("item_id").isNull() | F.col("item_id").rlike(fixed.ITEM_ID)),
        Rule("data_type_known", F.col("data_type").isin(fixed.KEY_TYPES)),
        Rule("described", F.length(F.coalesce("description", F.lit(""))) > 0, share=0.9),
        Rule("name_convention", F.col("name").rlike(fixed.KEY_NAME), share=0.95),
        Rule("has_sources", F.col("source_count") > 0),
    ]


def enum_rules() -> list[Rule]:
    """Rules for enumeration values (enum, type, value, name, description)."""
    return [
        Rule("value_present", F.col("value").isNotNull() & F.col("name").isNotNull()),
        Rule("value_fits_type", F.col("value").isNotNull() & fits_type("value", "type")),
        Rule("described", F.length(F.coalesce("description", F.lit(""))) > 0, share=0.8),
    ]


#: Types of enumerations, the contexts of the one that depends on them, and how many enumerations there are at least
ENUM_TYPES = ["U1", "U2", "U4", "U8", "I1", "I2", "I4", "I8"]
CONTEXTS = ["gps", "galileo", "beidou", "glonass"]
CONTEXT_ENUM = "sigId"
LEAST_ENUMS = 20


def enum_value_set() -> list[Rule | Keyed]:
    """All rules of enumeration values (enum, context, type, value, name, description); context is null where there is none."""
    plain = F.col("context").isNull()
    return [
        Rule("value_present", F.col("value").isNotNull() & F.col("name").isNotNull()),
        Rule("value_fits_type", ~plain | (F.col("value").isNotNull() & fits_type("value", "type"))),
        Rule("described", F.length(F.coalesce("description", F.lit(""))) > 0, share=0.8),
        Keyed("duplicate_value", "unique", (F.col("enum"), F.col("context"), F.col("value")), where=F.col("value").isNotNull()),
        Keyed("duplicate_name", "unique", (F.col("enum"), F.col("name")), where=plain & F.col("name").isNotNull()),
        Keyed("contexts", "group", (F.col("enum"),), F.when(F.col("context").isin(CONTEXTS), F.col("context")), 2, F.col("enum") == CONTEXT_ENUM),
        Keyed("enumerations", "total", (), F.col("enum"), LEAST_ENUMS),
    ]


def enum_set() -> list[Rule | Keyed]:
    """All rules of enumerations (enum, type, values, occurrences, messages, per_context); messages counts those listed, null without a list."""
    apart = F.col("per_context")
    listed = F.coalesce(F.col("messages") > 0, F.lit(False))
    return [
        Rule("has_type_and_values", apart | (F.col("type").isNotNull() & F.col("values").isNotNull())),
        Rule("type_known", apart | F.col("type").isin(ENUM_TYPES)),
        Rule("occurrences_tracked", apart | F.col("occurrences").isNotNull() | F.col("messages").isNotNull()),
        Rule("occurrences_listed", apart | (F.coalesce("occurrences", F.lit(0)) <= 0) | listed),
    ]


def enum_references() -> list[Keyed]:
    """Messages that enumerations name: rows (enum, message)."""
    return [Keyed("message_known", "reference", (F.col("message"),))]


def known_messages() -> list[Keyed]:
    """The messages there are: rows (message)."""
    return [Keyed("message_known", "known", (F.col("message"),))]


def message_rules() -> list[Rule]:
    return [Rule(f"has_{c}", F.col(c).isNotNull()) for c in ("class_id", "message_id", "message_type")]


def excluded_source(items: DataFrame, item: Column, source: Column, name: str) -> DataFrame:
    """A source that must not be listed for an item."""
    return _outcome(items, name, F.count_if(item), F.count_if(item & source))


# -- roll-ups --------------------------------------------------------------------------------


def rollup(results: DataFrame, entity, matches: str, zero_found="unvalidated") -> DataFrame:
    """Status per entity from three-valued ``matches`` (null: not found there).

    ``zero_found`` is the status of an entity found nowhere: unvalidated, or valid in batch mode.
    """
    out = results.groupBy(*entity).agg(
        F.count(F.lit(1)).alias("checked"),
        F.count(F.col(matches)).alias("found"),
        F.count_if(F.col(matches)).alias("matches"),
        F.count_if(~F.col(matches)).alias("mismatches"),
    )
    status = (
        F.when(F.col("mismatches") > 0, F.lit("needs_review"))
        .when(F.col("matches") > 0, F.lit("valid"))
        .otherwise(F.lit(zero_found))
    )
    return out.withColumn("status", status)


def status_totals(entities: DataFrame, status: DataFrame, entity) -> DataFrame:
    rows = skew.null_safe_join(entities.select(*entity).distinct(), status.select(*entity, "status"), entity, "left")
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("status").alias("validated"),
        F.count_if(F.col("status") == "valid").alias("valid"),
        F.count_if(F.col("status") == "needs_review").alias("needs_review"),
        F.count_if(F.col("status").isNull()).alias("remaining"),
    )


def pending(status: DataFrame, entity, limit: int | None = None) -> DataFrame:
    """Entities that need review, most mismatches first."""
    out = status.where(F.col("status") == "needs_review").orderBy(F.desc("mismatches"), *entity)
    return out if limit is None else out.limit(limit)


def discrepancy_details(results: DataFrame, entity, matches: str, discrepancies: str) -> DataFrame:
    """One row per discrepancy of the sources that do not match."""
    kept = [c for c in results.columns if c not in (matches, discrepancies)]
    return results.where(~F.col(matches)).select(*kept, F.inline_outer(discrepancies))


# -- reports ---------------------------------------------------------------------------------


def validation_summary(votes: DataFrame) -> DataFrame:
    level = F.col("confidence")
    return votes.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("has_consensus").alias("with_consensus"),
        F.count_if(~F.col("has_consensus")).alias("without_consensus"),
        *[F.count_if(level == c).alias(c) for c in fixed.CONFIDENCE_ORDER],
        F.coalesce(F.sum(F.when(level != "single_source", F.col("total_count") - F.col("agreement_count"))), F.lit(0)).alias("total_outliers"),
        F.bround(F.coalesce(F.avg("confidence_score"), F.lit(0.0)), 3).alias("average_confidence_score"),
    )


def serialized(votes: DataFrame, entity) -> DataFrame:
    return votes.select(
        *entity, "has_consensus", "confidence", F.bround("confidence_score", 3).alias("confidence_score"),
        F.col("winning_value").alias("fingerprint"),
        F.concat(F.col("agreement_count").cast("string"), F.lit("/"), F.col("total_count").cast("string")).alias("agreement"),
        (F.col("total_count") - F.col("agreement_count")).alias("outlier_count"),
    )


def problem_votes(votes: DataFrame) -> DataFrame:
    """Votes with an outlier or without consensus."""
    return votes.where((F.col("agreement_count") < F.col("total_count")) | ~F.col("has_consensus"))


def discrepancy_summary(votes: DataFrame) -> DataFrame:
    return problem_votes(votes).agg(
        F.count(F.lit(1)).alias("total_with_issues"),
        F.coalesce(F.sum(F.col("total_count") - F.col("agreement_count")), F.lit(0)).alias("total_outliers"),
        F.count_if(~F.col("has_consensus")).alias("no_consensus_count"),
    )


def without_consensus(votes: DataFrame, entity, limit: int = 10) -> DataFrame:
    return votes.where(~F.col("has_consensus")).orderBy(*entity).limit(limit)


def coverage(fields: DataFrame, by, dtype: str, has_bits: Column, bit_count: Column) -> DataFrame:
    """Fields, bit-typed fields with and without bits, and bits, per ``by``."""
    bit_typed = F.col(dtype).startswith("X")
    return fields.groupBy(*by).agg(
        F.count(F.lit(1)).alias("fields"),
        F.count_if(bit_typed).alias("bit_fields"),
        F.count_if(bit_typed & has_bits).alias("bit_fields_defined"),
        F.count_if(bit_typed & ~has_bits).alias("bit_fields_missing"),
        F.coalesce(F.sum(F.when(bit_typed & has_bits, bit_count)), F.lit(0)).cast("bigint").alias("bits"),
    )


def class_counts(messages: DataFrame, name: str) -> DataFrame:
    cls = n.name_part(name, 1, "OTHER")
    return messages.groupBy(cls.alias("class")).agg(F.count(F.lit(1)).alias("messages"))


def enum_coverage(values: DataFrame, enum: str, message: str) -> DataFrame:
    """Enumerations, their values and the messages they occur in; one row per (enum, value, message)."""
    pairs = values.select(F.col(enum), F.col("value")).distinct().agg(F.count(F.lit(1)).alias("total_values"))
    names = values.select(F.col(enum)).distinct().agg(F.count(F.lit(1)).alias("total_enumerations"))
    covered = values.select(F.col(message)).distinct().agg(F.count(F.lit(1)).alias("messages_with_enums"))
    return names.select("total_enumerations", pairs.select("total_values").scalar().alias("total_values"), covered.select("messages_with_enums").scalar().alias("messages_with_enums"))


def type_counts(keys: DataFrame, dtype: str) -> DataFrame:
    return keys.groupBy(F.coalesce(F.col(dtype), F.lit("unknown")).alias(dtype)).agg(F.count(F.lit(1)).alias("keys"))


def by_confidence(votes: DataFrame) -> DataFrame:
    return votes.groupBy("confidence").agg(F.count(F.lit(1)).alias("groups"))
