"""Column expressions that normalise names, types and values. None of them shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _first_case(pairs, otherwise) -> Column:
    """CASE over ordered (condition, value) pairs."""
    out = None
    for condition, value in pairs:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise)


def blank_to_null(c) -> Column:
    c = _col(c)
    return F.when(c != "", c)


def extract(c, pattern: str, group: int = 1) -> Column:
    """First match of a group, null when the pattern or the group does not match."""
    return blank_to_null(F.regexp_extract(_col(c), pattern, group))


def hex_to_long(c) -> Column:
    return F.conv(_col(c), 16, 10).cast("decimal(20,0)").cast("bigint")


def hex_text(c, width: int) -> Column:
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(_col(c))), width, "0"))


def parse_id(c) -> Column:
    """'0x1F' or '31' as a number; other text is null."""
    c = _col(c)
    return F.when(c.rlike("^0[xX][0-9a-fA-F]+$"), hex_to_long(F.substring(c, 3, 64))).otherwise(
        c.try_cast("bigint")
    )


# -- layout fields ---------------------------------------------------------------------------


def field_name(c) -> Column:
    c = F.lower(F.coalesce(_col(c), F.lit("")))
    return F.when(c.startswith("reserved"), F.lit("reserved")).otherwise(c)


def wire_size(c, unknown: int = 1) -> Column:
    """Bytes of a scalar wire type; an unknown type counts ``unknown``."""
    c = _col(c)
    return _first_case(
        ((c.isin([t for t, n in fixed.WIRE_SIZES.items() if n == size]), F.lit(size)) for size in (1, 2, 4, 8)),
        F.lit(unknown),
    )


def type_base(c) -> Column:
    return F.regexp_extract(_col(c), r"^([^\[]*)", 1)


def type_count(c) -> Column:
    """Element count of 'T[n]': n, 0 when it is empty or symbolic, 1 for a scalar."""
    c = _col(c)
    inside = F.regexp_extract(c, r"\[(.*?)\]*$", 1)
    return F.when(c.contains("["), F.coalesce(inside.try_cast("int"), F.lit(0))).otherwise(F.lit(1))


def type_size(c) -> Column:
    """Bytes of 'T' or 'T[n]'."""
    sizes = F.when(_col(c).isin("RU1_3"), F.lit(1)).when(_col(c).isin("RU2_5"), F.lit(2))
    return F.coalesce(sizes, wire_size(type_base(c)) * type_count(c))


# -- version values --------------------------------------------------------------------------


def version_value(description) -> Column:
    description = F.coalesce(_col(description), F.lit(""))
    found = [hex_to_long(extract(description, p)) for p in fixed.VERSION_VALUE_PATTERNS_HEX]
    found += [extract(description, p).cast("bigint") for p in fixed.VERSION_VALUE_PATTERNS_DEC]
    return F.coalesce(*found)


def is_version_name(c) -> Column:
    return F.lower(_col(c)).isin(fixed.VERSION_NAMES)


def is_version_lookalike(c) -> Column:
    name = F.lower(_col(c))
    return _any(name.startswith(p) for p in fixed.VERSION_LOOKALIKES)


def protocol_version(text) -> Column:
    """'27.50' -> 2750, by truncation; 0 when it is not a number."""
    scaled = F.trim(_col(text)).try_cast("double") * 100
    return F.coalesce(scaled.try_cast("bigint"), F.lit(0).cast("bigint"))


# -- source names ----------------------------------------------------------------------------


def _template(c, pattern: str, template: str) -> Column:
    """A literal in which '$n' stands for group n of the pattern."""
    parts = []
    for i, piece in enumerate(template.split("$")):
        if i == 0:
            parts += [F.lit(piece)] if piece else []
        else:
            parts.append(F.regexp_extract(c, pattern, int(piece[0])))
            parts += [F.lit(piece[1:])] if piece[1:] else []
    return F.concat(*parts)


def source_by_rules(filename, rules, names, fallback) -> Column:
    """A struct filled by the first matching rule; rules are (pattern, template, ...)."""
    c = _col(filename)
    cases = []
    for pattern, *templates in rules:
        values = [_template(c, pattern, t).alias(n) for n, t in zip(names, templates)]
        cases.append((c.rlike(pattern), F.struct(*values)))
    return _first_case(cases, F.struct(*[v.alias(n) for n, v in zip(names, fallback)]))


def source_from_filename(filename) -> Column:
    """Struct (family, firmware_type, firmware_version, short_name) of an extraction file."""
    c = _col(filename)

    def struct(family, kind, version):
        values = (family.alias("family"), kind.alias("firmware_type"), version.alias("firmware_version"))
        return F.struct(*values, F.concat_ws("-", family, kind, version).alias("short_name"))

    cases = [
        (c.rlike(p), struct(*[_template(c, p, t) for t in templates]))
        for p, *templates in fixed.SOURCE_PATTERNS
    ]
    kind = F.regexp_extract(c, fixed.LEGACY_SOURCE, 2)
    f9 = (F.regexp_extract(c, fixed.LEGACY_SOURCE, 1) != "") | kind.isin(fixed.LEGACY_F9_TYPES)
    family = F.when(f9, F.lit("F9")).otherwise(F.lit("UNKNOWN"))
    cases.append((c.rlike(fixed.LEGACY_SOURCE), struct(family, kind, F.lit("1.20"))))
    cases.append((c.contains("ZED-F9H"), struct(F.lit("F9"), F.lit("F9H"), F.lit("1.0"))))
    cases.append((c.contains("M8") | c.contains("u-blox8"), struct(F.lit("M8"), F.lit("SPG"), F.lit("0.0"))))
    return _first_case(cases, struct(F.lit("UNKNOWN"), F.lit("UNKNOWN"), F.lit("0.0")))


def key_source_short(filename) -> Column:
    unknown = (F.lit("unknown"), F.lit("unknown"))
    rules = [rule[:3] for rule in fixed.KEY_SOURCE_PATTERNS_SHORT]
    return source_by_rules(filename, rules, ("family", "version"), unknown)


def key_source_full(filename) -> Column:
    fallback = (F.lit("unknown"), F.lit("unknown"), _col(filename))
    return source_by_rules(filename, fixed.KEY_SOURCE_PATTERNS_FULL, ("family", "version", "full_id"), fallback)


def manual_family(name) -> Column:
    c = _col(name)
    cases = [(_any(c.contains(s) for s in keys), F.lit(family)) for keys, family in fixed.MANUAL_FAMILIES]
    return _first_case(cases, F.lit(None).cast("string"))


def preference_rank(name, order=None) -> Column:
    """Rank of the first preferred substring found in the name; unlisted names come last."""
    c = _col(name)
    order = fixed.SOURCE_PREFERENCE if order is None else order
    return _first_case(((c.contains(p), F.lit(i)) for i, p in enumerate(order)), F.lit(len(order)))


def bitfield_preference_rank(name, order=None) -> Column:
    c = F.lower(_col(name))
    order = fixed.BITFIELD_SOURCE_PREFERENCE if order is None else order
    cases = (
        (reduce(lambda a, b: a & b, [c.contains(p) for p in parts]), F.lit(i)) for i, parts in enumerate(order)
    )
    return _first_case(cases, F.lit(len(order)))


# -- outline titles --------------------------------------------------------------------------


def message_title(title) -> Column:
    return extract(title, fixed.MESSAGE_TITLE)


def group_title(title) -> Column:
    name = extract(title, fixed.GROUP_TITLE)
    return F.when(~name.isin(fixed.NOT_GROUPS), name)


def name_part(name, index: int = 1, missing=None) -> Column:
    """The index-th dash-separated part of a name."""
    return F.coalesce(F.get(F.split(_col(name), "-"), F.lit(index)), F.lit(missing))


def canonical_key(name, version) -> Column:
    bare = F.regexp_replace(_col(name), f"^{fixed.MESSAGE_PREFIX}", "")
    return F.concat(bare, F.lit("-v"), _col(version).cast("string"))


# -- misread text ----------------------------------------------------------------------------


def unicode_to_ascii(c) -> Column:
    return F.translate(_col(c), *fixed.LOOKALIKES)


def repair_name(c, repairs) -> Column:
    return reduce(lambda acc, r: F.replace(acc, F.lit(r[0]), F.lit(r[1])), repairs, _col(c))


def repair_type(c) -> Column:
    c = _col(c)
    return _first_case(((c == wrong, F.lit(right)) for wrong, right in fixed.TYPE_REPAIRS.items()), c)


# -- scales and offsets ----------------------------------------------------------------------

SCALE_TYPE = "struct<raw:string,multiplier:double,kind:string,base:bigint,exponent:int>"


def scale(c) -> Column:
    """Struct (raw, multiplier, kind, base, exponent) of '1e-7', '2^-7' or a number; else null."""
    c = _col(c)
    power = r"^(\d+)\^(-?\d+)"
    base, exponent = extract(c, power, 1).cast("bigint"), extract(c, power, 2).cast("int")
    number = c.try_cast("double")
    ten = extract(F.lower(c), r"^1e(-?\d+)").cast("int")
    has_e = F.lower(c).contains("e")
    multiplier = F.coalesce(number, F.pow(base.cast("double"), exponent.cast("double")))
    kind = F.when(has_e & ten.isNotNull(), F.lit("power_of_10")).when(
        ~has_e & base.isNotNull(), F.when(base == 2, F.lit("power_of_2")).otherwise(F.lit("power_of_10"))
    )
    known = c.isNotNull() & ~c.isin("", "-", "None") & multiplier.isNotNull()
    value = F.struct(
        c.alias("raw"),
        multiplier.alias("multiplier"),
        kind.alias("kind"),
        F.when(has_e & ten.isNotNull(), F.lit(10)).when(~has_e, base).cast("bigint").alias("base"),
        F.when(has_e, ten).otherwise(exponent).alias("exponent"),
    )
    return F.when(known, value)


def offset_formula(c) -> Column:
    """Struct (base, products[(field, multiplier)]) of a sum such as '96 + nValA*8'."""
    terms = F.filter(F.split(F.replace(_col(c), F.lit(" "), F.lit("")), r"\+"), lambda t: t != "")
    number = r"^-?\d+$"

    def product(term):
        parts = F.split(term, r"\*")
        left, right = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        swapped = left.rlike(number)
        factor = F.when(swapped, left).when(right.rlike(number), right).cast("bigint")
        return F.struct(
            F.when(right.isNotNull() & swapped, right).otherwise(left).alias("field"),
            F.when(right.isNotNull(), F.coalesce(factor, F.lit(1).cast("bigint")))
            .otherwise(F.lit(1).cast("bigint"))
            .alias("multiplier"),
        )

    base = F.aggregate(
        F.filter(terms, lambda t: t.rlike(number)), F.lit(0).cast("bigint"), lambda a, t: a + t.cast("bigint")
    )
    products = F.transform(
        F.filter(terms, lambda t: ~t.rlike(number) & (F.size(F.split(t, r"\*")) <= 2)), product
    )
    return F.struct(base.alias("base"), products.alias("products"))


# -- enumeration names -----------------------------------------------------------------------


def enum_name(description, max_length: int = 30) -> Column:
    c = F.trim(_col(description))
    for pattern in fixed.ENUM_REMOVALS:
        c = F.regexp_replace(c, f"(?i){pattern}", "")
    for pattern, replacement in fixed.ENUM_SUBSTITUTIONS:
        c = F.regexp_replace(c, f"(?i){pattern}", replacement)
    for pattern, replacement in fixed.ENUM_SIGNS:
        c = F.regexp_replace(c, pattern, replacement)
    c = F.lower(c)
    for pattern, replacement in fixed.ENUM_SPELLING:
        c = F.regexp_replace(c, pattern, replacement)
    c = F.when(c.rlike(r"^\d"), F.concat(F.lit("_"), c)).otherwise(c)
    # Longest run of whole words that fits, counting one separator per word.
    fitting = F.regexp_extract(c, rf"^(.{{0,{max_length - 1}}}_)", 1)
    words = F.regexp_replace(fitting, "_$", "")
    cut = F.when(fitting != "", words).otherwise(F.substring(c, 1, max_length))
    c = F.when(F.length(c) > max_length, cut).otherwise(c)
    return F.when(c == "", F.lit("unknown")).otherwise(c)


def discriminator_value(description) -> Column:
    """0xNN, else '(N for', in a description."""
    as_hex, as_decimal = fixed.DISCRIMINATOR_PATTERNS
    return F.coalesce(
        hex_to_long(extract(description, as_hex)), extract(description, as_decimal).cast("bigint")
    )


# -- second-registry types -------------------------------------------------------------------


def registry_form(text) -> Column:
    """Struct (kind, type, scale, bits, count_field, fields) of a second-registry type, given as JSON.

    A text is a plain type, ["I004", 1e-07] a scaled one, ["X001", {..}] a bitfield and ["count", {..}] a group;
    bits and fields stay JSON.
    """
    text = _col(text)
    v = F.try_parse_json(text)
    # Read as texts: an object keeps the order of its entries, which a VARIANT does not.
    parts = F.from_json(text, "array<string>")
    listed = F.schema_of_variant(v).startswith("ARRAY")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    nested = F.schema_of_variant(F.try_variant_get(v, "$[1]", "variant")).startswith("OBJECT")
    bits = listed & nested & first.startswith("X")
    kind = F.when(bits, "bitfield").when(listed & nested, "group").when(listed, "scaled").when(v.isNotNull(), "plain")
    # A text within a map of texts has lost its quotes.
    plain = F.coalesce(v.try_cast("string"), F.when(v.isNull() & ~text.rlike(r"^\s*[\[{]"), text))
    kind = F.coalesce(kind, F.when(plain.isNotNull() & text.rlike(r"^[A-Z]+[0-9\[]"), F.lit("plain")))
    return F.struct(
        kind.alias("kind"), F.when(kind == "group", F.lit("group")).when(listed, first).when(kind == "plain", plain).alias("type"),
        F.when(kind == "scaled", F.try_variant_get(v, "$[1]", "double")).alias("scale"), F.when(bits, second).alias("bits"),
        F.when(kind == "group", first).alias("count_field"), F.when(kind == "group", second).alias("fields"),
    )


def registry_type(c) -> Column:
    """'U004' -> 'U4', 'CH[30]' -> 'C30'."""
    c = _col(c)
    return (
        F.when(c.rlike("^[UIXRC][0-9]{3}$"), F.concat(F.substring(c, 1, 1), F.substring(c, 2, 3).cast("int").cast("string")))
        .when(c.rlike(r"^CH\[.*\]$"), F.concat(F.lit("C"), F.regexp_extract(c, r"^CH\[(.*)\]$", 1)))
        .otherwise(c)
    )


def missing_bucket(message, field) -> Column:
    message, field = _col(message), _col(field)
    cases = [(field.isin(fixed.GPIO_FIELDS), F.lit("gpio_masks"))]
    cases += [(_any(message.contains(p) for p in parts), F.lit(name)) for name, parts in fixed.MISSING_BUCKETS]
    cases.append((F.lower(field).contains("reserved"), F.lit("reserved")))
    return _first_case(cases, F.lit("other"))


# -- configuration key ids -------------------------------------------------------------------


def key_group(name) -> Column:
    """'CFG-GROUP-ITEM' -> 'CFG-GROUP'; shorter names keep their first part."""
    parts = F.split(_col(name), "-")
    return F.when(F.size(parts) >= 3, F.concat_ws("-", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).otherwise(
        F.get(parts, F.lit(0))
    )


def padded_key_id(c) -> Column:
    c = _col(c)
    short = c.startswith("0x") & (F.length(c) < 10)
    return F.when(short, F.concat(F.lit("0x"), F.lpad(F.substring(c, 3, 8), 8, "0"))).otherwise(c)


def key_id_parts(c) -> Column:
    """Struct (group_id, item_id, size_code) from the bits of a key id; bad ids give zeros."""
    c = _col(c)
    value = F.coalesce(
        F.when(c.rlike("^(0[xX])?[0-9a-fA-F]{1,15}$"), hex_to_long(F.regexp_replace(c, "^0[xX]", ""))),
        F.lit(0).cast("bigint"),
    )
    return F.struct(
        hex_text(F.shiftright(value, 16).bitwiseAND(F.lit(0xFF).cast("bigint")), 2).alias("group_id"),
        hex_text(value.bitwiseAND(F.lit(0xFFFF).cast("bigint")), 4).alias("item_id"),
        F.shiftright(value, 28).bitwiseAND(F.lit(0x7).cast("bigint")).cast("int").alias("size_code"),
    )


# -- prices ----------------------------------------------------------------------------------


def token_cost(tokens_in, tokens_out, price_in, price_out) -> Column:
    return (_col(tokens_in) * _col(price_in) + _col(tokens_out) * _col(price_out)) / F.lit(1_000_000)
