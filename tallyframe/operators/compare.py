"""Set comparison of registries: gaps, cross-validation, missing and incomplete parts, best sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n
from . import skew


# -- inventory -------------------------------------------------------------------------------


def inventory(outline: DataFrame, source: str, title: str, find=n.message_title) -> DataFrame:
    """Distinct (entity, source) pairs named in outline titles."""
    return outline.select(find(title).alias("entity"), F.col(source).alias("source")).where("entity is not null").distinct()


def inventory_counts(pairs: DataFrame, by: str) -> DataFrame:
    other = "source" if by == "entity" else "entity"
    return pairs.groupBy(by).agg(F.count(F.lit(1)).alias(f"{other}_count"))


# -- gaps ------------------------------------------------------------------------------------


def prefix_matches(bases: DataFrame, names: DataFrame, base: str, name: str, separator="-") -> DataFrame:
    """(base, name) for every name that starts with base + separator.

    Each name is expanded into its own prefixes and joined by equality; nothing is compared pairwise.
    """
    parts = F.split(F.col(name), separator, -1)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), separator)
    )
    expanded = (
        names.select(name).distinct().where(F.col(name).contains(separator))
        .select(F.col(name), F.explode(prefixes).alias("_prefix"))
    )
    known = bases.select(F.col(base).alias("_prefix")).distinct()
    return expanded.join(known, "_prefix").select(F.col("_prefix").alias(base), name)


def gap(expected: DataFrame, actual: DataFrame, key: str, prefix=False, separator="-") -> DataFrame:
    """Every key of either side with ``status`` covered, covered_by_variant, missing or orphaned."""
    left = expected.select(key).distinct()
    right = actual.select(key).distinct()
    both = left.withColumn("_e", F.lit(True)).join(right.withColumn("_a", F.lit(True)), key, "full_outer")
    by_variant = variant = F.lit(False)
    if prefix:
        matches = prefix_matches(left, right.withColumnRenamed(key, "_name"), key, "_name", separator)
        bases = matches.select(key).distinct().withColumn("_base", F.lit(True))
        variants = matches.select(F.col("_name").alias(key)).distinct().withColumn("_variant", F.lit(True))
        both = both.join(bases, key, "left").join(variants, key, "left")
        by_variant, variant = F.coalesce("_base", F.lit(False)), F.coalesce("_variant", F.lit(False))
    status = (
        F.when(F.col("_e").isNotNull() & F.col("_a").isNotNull(), F.lit("covered"))
        .when(F.col("_e").isNotNull() & by_variant, F.lit("covered_by_variant"))
        .when(F.col("_e").isNotNull(), F.lit("missing"))
        .when(variant, F.lit("variant"))
        .otherwise(F.lit("orphaned"))
    )
    return both.select(
        key, F.col("_e").isNotNull().alias("expected"), F.col("_a").isNotNull().alias("actual"),
        by_variant.alias("has_variants"), status.alias("status"),
    )


def gap_summary(gaps: DataFrame) -> DataFrame:
    covered = F.col("expected") & (F.col("actual") | F.col("has_variants"))
    out = gaps.agg(
        F.count_if("expected").alias("expected"),
        F.count_if("actual").alias("actual"),
        F.count_if(F.col("expected") & F.col("actual")).alias("direct_matches"),
        F.count_if("has_variants").alias("variant_matches"),
        F.count_if(covered).alias("covered"),
        F.count_if(F.col("status") == "missing").alias("missing"),
        F.count_if(F.col("status") == "orphaned").alias("orphaned"),
    )
    share = F.bround(100.0 * F.col("covered") / F.col("expected"), 1)
    return out.withColumn("coverage_percent", F.when(F.col("expected") > 0, share).otherwise(F.lit(0.0)))


def missing_by_class(gaps: DataFrame, key: str, pairs: DataFrame | None = None) -> DataFrame:
    """Missing entities with their class (second name part) and the number of sources that name them."""
    missing = gaps.where(F.col("status") == "missing").select(key, n.name_part(key, 1).alias("class"))
    if pairs is None:
        return missing
    counts = inventory_counts(pairs, "entity").withColumnRenamed("entity", key)
    return missing.join(counts, key, "left").withColumn("source_count", F.coalesce("source_count", F.lit(0)))


def gap_report(**parts: DataFrame) -> DataFrame:
    """The summaries of several gap tables, one row per part."""
    rows = [gap_summary(g).withColumn("part", F.lit(name)) for name, g in parts.items()]
    return reduce(DataFrame.unionByName, rows)


# -- cross-validation ------------------------------------------------------------------------


def resolve_names(ours: DataFrame, theirs: DataFrame, message: str, field: str, aliases: DataFrame, expansions: DataFrame | None = None) -> DataFrame:
    """Our fields with the name the other registry uses: direct, then alias, then per-message expansion.

    ``aliases``: our_name, other_name. ``expansions``: message, our_name, other_name.
    """
    known = theirs.select(F.col(message), F.col(field).alias("_known")).distinct()

    def lookup(df, candidate, out):
        hit = skew.shuffled(known.withColumnsRenamed({message: "_m", "_known": out}))
        return df.join(hit, (df[message] == hit["_m"]) & (df[candidate] == hit[out]), "left").drop("_m")

    out = lookup(ours.withColumn("_direct_name", F.col(field)), "_direct_name", "_direct")
    dim = aliases.select(F.col("our_name").alias("_our"), F.col("other_name").alias("_alias_name"))
    out = out.join(dim, out[field] == dim["_our"], "left").drop("_our")
    out = lookup(out, "_alias_name", "_alias")
    found = [F.col("_direct"), F.col("_alias")]
    if expansions is not None:
        dim = expansions.select(F.col("message").alias("_em"), F.col("our_name").alias("_our"), F.col("other_name").alias("_exp_name"))
        out = out.join(dim, (out[message] == dim["_em"]) & (out[field] == dim["_our"]), "left").drop("_em", "_our")
        out = lookup(out, "_exp_name", "_exp")
        found.append(F.col("_exp"))
    how = F.when(F.col("_direct").isNotNull(), F.lit("direct"))
    how = how.when(F.coalesce(*found).isNotNull(), F.lit("alias"))
    out = out.withColumn("resolved", F.coalesce(*found)).withColumn("match", how)
    return out.drop("_direct_name", "_direct", "_alias_name", "_alias", "_exp_name", "_exp")


def cross(
    ours: DataFrame, theirs: DataFrame, message: str, field: str, dtype: str, aliases: DataFrame,
    expansions: DataFrame | None = None, ignore_patterns=(), extras: DataFrame | None = None,
    equivalences: DataFrame | None = None, group_marker="group",
) -> DataFrame:
    """Differences of two registries: (message, field, issue, our_type, other_type).

    Issues: our_only, library_only, ignored, type_mismatch. Messages the other registry does not
    have give no rows. ``extras``: message, field. ``equivalences``: message, field, a, b.
    """
    shared = theirs.select(message).distinct()
    mine = ours.join(skew.shuffled(shared), message, "left_semi")
    resolved = resolve_names(mine, theirs, message, field, aliases, expansions)
    left = resolved.select(
        F.col(message), F.col(field).alias("_ours"), F.col(dtype).alias("our_type"), F.coalesce("resolved", F.concat(F.lit("\u0000"), field)).alias("_key")
    )
    mine_messages = ours.select(message).distinct()
    right = theirs.join(skew.shuffled(mine_messages), message, "left_semi").select(
        F.col(message), F.col(field).alias("_key"), F.col(field).alias("_theirs"), F.col(dtype).alias("other_type")
    )
    both = left.join(right, [message, "_key"], "full_outer")
    field_name = F.coalesce("_ours", "_theirs")
    ignored = reduce(lambda a, b: a | b, [F.col("_theirs").rlike(f"^(?:{p})") for p in ignore_patterns], F.lit(False))
    if extras is not None:
        e = extras.select(F.col("message").alias("_em"), F.col("field").alias("_ef")).distinct()
        both = both.join(e, (F.col(message) == F.col("_em")) & (F.col("_theirs") == F.col("_ef")), "left").drop("_em")
        ignored = ignored | F.col("_ef").isNotNull()
    a, b = n.registry_type("our_type"), n.registry_type("other_type")
    same = a == b
    if equivalences is not None:
        q = equivalences.select(F.col("message").alias("_qm"), F.col("field").alias("_qf"), F.col("a").alias("_qa"), F.col("b").alias("_qb"))
        both = both.join(q, (F.col(message) == F.col("_qm")) & (F.col("_ours") == F.col("_qf")), "left").drop("_qm", "_qf")
        pair = ((a == F.col("_qa")) & (b == F.col("_qb"))) | ((a == F.col("_qb")) & (b == F.col("_qa")))
        same = same | F.coalesce(pair, F.lit(False))
    reserved = field_name.startswith("reserved")
    issue = (
        F.when(F.col("_theirs").isNull() & ~reserved, F.lit("our_only"))
        .when(F.col("_theirs").isNull() | (F.col("_ours").isNull() & (reserved | (F.col("_theirs") == group_marker))), F.lit(None))
        .when(F.col("_ours").isNull() & ignored, F.lit("ignored"))
        .when(F.col("_ours").isNull(), F.lit("library_only"))
        .when(~F.col("_ours").startswith("reserved") & ~same, F.lit("type_mismatch"))
    )
    return both.select(message, field_name.alias(field), issue.alias("issue"), "our_type", "other_type").where("issue is not null")


def bit_offsets(bits: DataFrame, keys, order, width: str) -> DataFrame:
    """Bits listed only by width, with ``bit_offset`` = the widths before."""
    out = skew.ordered(bits, keys, order, {"bit_offset": ("sum_before", F.col(width).cast("bigint"))})
    return out.withColumn("bit_offset", F.coalesce("bit_offset", F.lit(0).cast("bigint")))


def compare_bits(ours: DataFrame, theirs: DataFrame, keys, bit: str, aliases: DataFrame) -> DataFrame:
    """Bit differences: only_ours, only_theirs, offset_mismatch, width_mismatch.

    Both sides: keys.., bit, bit_offset, width. ``aliases``: our_name, other_name.
    """
    known = theirs.select(*keys, F.col(bit).alias("_known")).distinct()
    dim = aliases.select(F.col("our_name").alias(bit), F.col("other_name").alias("_alias"))
    left = ours.join(dim, bit, "left")

    def lookup(df, candidate, out):
        hit = skew.shuffled(known.withColumn(out, F.col("_known")).withColumnRenamed("_known", f"_hit_{out}"))
        return skew.null_safe_join(df.withColumn(out, F.col(candidate)), hit, [*keys, out], "left")

    left = lookup(lookup(left, bit, "_d"), "_alias", "_al")
    target = F.coalesce("_hit__d", "_hit__al", F.concat(F.lit("\u0000"), F.col(bit)))
    left = left.select(*keys, target.alias("_key"), F.struct(F.col(bit).alias("b"), "bit_offset", "width").alias("_o"))
    right = theirs.select(*keys, F.col(bit).alias("_key"), F.struct(F.col(bit).alias("b"), "bit_offset", "width").alias("_t"))
    both = left.join(right, [*keys, "_key"], "full_outer")
    o, t = F.col("_o"), F.col("_t")
    name = F.coalesce(o["b"], t["b"])
    matched = o.isNotNull() & t.isNotNull()
    issues = F.array_compact(F.array(
        F.when(t.isNull() & ~name.startswith("reserved"), F.lit("only_ours")),
        F.when(o.isNull() & ~name.startswith("reserved"), F.lit("only_theirs")),
        F.when(matched & ~o["bit_offset"].eqNullSafe(t["bit_offset"]), F.lit("offset_mismatch")),
        F.when(matched & ~o["width"].eqNullSafe(t["width"]), F.lit("width_mismatch")),
    ))
    return both.select(*keys, name.alias(bit), F.explode(issues).alias("issue"), o["bit_offset"].alias("our_offset"), t["bit_offset"].alias("other_offset"), o["width"].alias("our_width"), t["width"].alias("other_width"))


def cross_bits(
    ours: DataFrame, theirs: DataFrame, our_bits: DataFrame, their_bits: DataFrame, message: str, field: str, dtype: str, bit: str,
    aliases: DataFrame, bit_aliases: DataFrame, expansions: DataFrame | None = None,
) -> DataFrame:
    """Bit issues of the matched X fields whose other side has bits: (message, field, bit, issue, offsets, widths).

    A field without bits of ours gives one missing_bitfield; otherwise the bits are compared under our field's
    name. ``our_bits`` and ``their_bits``: message, field, bit, bit_offset, width, by each side's field names.
    """
    matched = resolve_names(ours, theirs, message, field, aliases, expansions)
    matched = matched.where(F.col("resolved").isNotNull() & ~F.col(field).startswith("reserved") & F.col(dtype).startswith("X"))
    names = matched.select(message, field, F.col("resolved").alias("_other")).distinct()
    theirs_here = names.join(skew.shuffled(their_bits.withColumnRenamed(field, "_other")), [message, "_other"]).drop("_other")
    with_bits = theirs_here.select(message, field).distinct()
    bare = with_bits.join(skew.shuffled(our_bits), [message, field], "left_anti")
    none = F.lit(None).cast("bigint")
    missing = bare.select(
        message, field, F.lit(None).cast("string").alias(bit), F.lit("missing_bitfield").alias("issue"), none.alias("our_offset"), none.alias("other_offset"), none.alias("our_width"), none.alias("other_width"))
    held = with_bits.join(skew.shuffled(our_bits), [message, field], "left_semi")
    known = lambda bits: bits.join(skew.shuffled(held), [message, field], "left_semi")
    compared = compare_bits(known(our_bits), known(theirs_here), [message, field], bit, bit_aliases)
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("our_offset", "other_offset", "our_width", "other_width")]
    return compared.select(message, field, bit, "issue", *numbers).unionByName(missing)


REAL_ISSUES = ["type_mismatch", "offset_mismatch", "width_mismatch", "missing_bitfield"]


def cross_summary(ours: DataFrame, theirs: DataFrame, issues: DataFrame, message: str) -> DataFrame:
    """Totals of a cross-validation over all our messages; ``issues`` has (message, issue)."""
    names = ours.select(message).distinct()
    known = theirs.select(message).distinct().withColumn("_found", F.lit(True))
    counted = F.col("issue") != "ignored"
    flags = issues.groupBy(message).agg(
        F.max(counted).alias("_diff"),
        F.max(F.col("issue").isin(REAL_ISSUES)).alias("_real"),
        F.max(F.col("issue") == "missing_bitfield").alias("_bits"),
    )
    rows = names.join(known, message, "left").join(flags, message, "left")
    found, diff = F.coalesce("_found", F.lit(False)), F.coalesce("_diff", F.lit(False))
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(found).alias("found"),
        F.count_if(diff).alias("with_differences"),
        F.count_if(F.coalesce("_real", F.lit(False))).alias("with_real_issues"),
        F.count_if(F.coalesce("_bits", F.lit(False))).alias("missing_bitfields"),
        F.count_if(found & ~diff).alias("fully_matched"),
    )


def common_messages(ours: DataFrame, theirs: DataFrame, name: str, prefix=fixed.MESSAGE_PREFIX) -> DataFrame:
    """Our names that the other registry has, as they are or without the prefix."""
    known = theirs.select(F.col(name).alias("_n")).distinct()
    mine = ours.select(name).distinct()
    bare = F.regexp_replace(F.col(name), f"^{prefix}", "")
    keyed = mine.select(name, F.explode(F.array_distinct(F.array(F.col(name), bare))).alias("_n"))
    return keyed.join(known, "_n", "left_semi").select(name).distinct()


# -- what is left to do ----------------------------------------------------------------------


def remaining(registry: DataFrame, done: DataFrame, key, force=False) -> DataFrame:
    """Rows not done yet; all of them with ``force``."""
    return registry if force else skew.null_safe_join(registry, done.select(*key).distinct(), key, "left_anti")


def missing_attribute(fields: DataFrame, dtype: str, attribute: str, prefix="X") -> DataFrame:
    """Fields of a type that lack the attribute it calls for."""
    return fields.where(F.col(dtype).startswith(prefix) & F.col(attribute).isNull())


def incomplete_lists(current: DataFrame, keys: DataFrame, key, item: str, reference: DataFrame | None = None) -> DataFrame:
    """Keys whose list lacks items of the reference; without a reference list, those with at most one item.

    ``keys`` holds every key to check; ``current`` and ``reference`` hold (key.., item).
    """
    here = current.select(*key, item).distinct()
    counts = here.groupBy(*key).agg(F.count(F.lit(1)).alias("current_count"))
    out = skew.null_safe_join(keys.select(*key).distinct(), counts, key, "left")
    out = out.withColumn("current_count", F.coalesce("current_count", F.lit(0).cast("bigint")))
    if reference is None:
        out = out.withColumn("reference_count", F.lit(None).cast("bigint")).withColumn("missing_count", F.lit(0).cast("bigint"))
    else:
        ref = reference.select(*key, item).distinct()
        lacking = missing_items(here, ref, key, item).groupBy(*key).agg(F.count(F.lit(1)).alias("missing_count"))
        sizes = ref.groupBy(*key).agg(F.count(F.lit(1)).alias("reference_count"))
        out = skew.null_safe_join(skew.null_safe_join(out, sizes, key, "left"), lacking, key, "left")
        out = out.withColumn("missing_count", F.coalesce("missing_count", F.lit(0).cast("bigint")))
    few = F.col("reference_count").isNull() & (F.col("current_count") <= 1)
    return out.where((F.col("missing_count") > 0) | few)


def missing_items(current: DataFrame, reference: DataFrame, key, item: str) -> DataFrame:
    return skew.null_safe_join(reference, current, [*key, item], "left_anti")


def keyword_issues(discrepancies: DataFrame, message: str, issue: str, keywords=None) -> DataFrame:
    """Messages with a discrepancy that mentions a structural keyword."""
    words = fixed.STRUCTURAL_KEYWORDS if keywords is None else keywords
    return discrepancies.where(F.lower(issue).rlike("|".join(words))).select(message).distinct()


def best_source(df: DataFrame, entity, rank: Column, order, columns) -> DataFrame:
    """The row with the lowest rank per entity, the first on a tie."""
    best = df.groupBy(*entity).agg(F.min_by(F.struct(*columns), F.struct(rank.alias("_rank"), *order)).alias("_b"))
    return best.select(*entity, "_b.*")


def best_reviewable(df: DataFrame, entity, source: str, winning: DataFrame, order, columns) -> DataFrame:
    """Per entity the last row whose source is a winning one, else the first row.

    ``winning`` holds (entity.., source).
    """
    marked = winning.select(*entity, source).distinct().withColumn("_won", F.lit(True))
    rows = skew.null_safe_join(df, marked, [*entity, source], "left")
    rank, body = F.struct(*order), F.struct(*columns)
    picked = rows.groupBy(*entity).agg(
        F.max_by(body, F.when(F.col("_won"), rank)).alias("_w"), F.min_by(body, rank).alias("_f")
    )
    return picked.select(*entity, F.coalesce("_w", "_f").alias("_b")).select(*entity, "_b.*")


def by_class(messages: DataFrame, name: str) -> DataFrame:
    cls = n.name_part(name, 1)
    return messages.where(cls.isNotNull()).groupBy(cls.alias("class")).agg(F.count(F.lit(1)).alias("messages"))
