"""Framed binary captures: scanning, decoding against a registry, encoding, and round trips.

Registry tables:
``messages``  class_id, message_id, message
``variants``  class_id, message_id, variant, position, payload_length, min_length, max_length, byte_offset, value
``fields``    class_id, message_id, variant, pos, field, byte_offset, data_type
``groups``    class_id, message_id, variant, group_name, repetition, count_field, count, base, products, size
``group_fields`` class_id, message_id, variant, group_name, pos, field, byte_offset, data_type

Ids are single bytes, so a registry has at most 65,536 messages. It is written once and joined without a hint:
Spark broadcasts it if its size allows, and otherwise splits hot ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, wire
from ..functions import naming as n
from ..session import cut_lineage, small_batches
from . import skew
from .rules import fits_type

IDS = ["class_id", "message_id"]
BLOCK = 1 << 22
HALO = fixed.MAX_FRAME
FAN = 1024


# -- scanning --------------------------------------------------------------------------------


def _frame_starts(data: np.ndarray, block_bytes: int):
    """Positions in the block at which a whole frame could be cut, and where each would end."""
    if len(data) < fixed.FRAME_OVERHEAD:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    sync = (data[:-1] == fixed.SYNC[0]) & (data[1:] == fixed.SYNC[1])
    at = np.flatnonzero(sync[:block_bytes])
    at = at[at + fixed.FRAME_OVERHEAD <= len(data)]
    length = data[at + 4].astype(np.int64) + 256 * data[at + 5].astype(np.int64)
    end = at + length + fixed.FRAME_OVERHEAD
    whole = end <= len(data)
    return at[whole], end[whole]


def _last(following: np.ndarray) -> np.ndarray:
    """For each number the end of the chain that begins with it; the end of a chain follows itself.

    All chains are halved at once, so the number of steps grows with the logarithm of the longest.
    """
    while True:
        further = following[following]
        if np.array_equal(further, following):
            return following
        following = further


def _chain(following: np.ndarray, first: int) -> np.ndarray:
    """The chain that begins with ``first``, without its end, in steps that double."""
    own, chain = following, np.array([first], dtype=np.int64)
    while following[chain[-1]] != chain[-1]:
        chain = np.concatenate((chain, following[chain]))
        following = following[following]
    return chain[own[chain] != chain]


def _exits(data: np.ndarray, block_bytes: int):
    """Where scanning leaves the block for each place it may enter: (last entry of a run, exit) pairs.

    Entries are offsets below the largest frame, exits are offsets from the block's end.
    """
    at, end = _frame_starts(data, block_bytes)
    own = np.arange(len(at) + 1)
    # A frame that runs over the block's end is the last, and so is the place behind all frames.
    following = np.append(np.where(end >= block_bytes, own[:-1], np.searchsorted(at, end)), len(at))
    leave = np.append(np.maximum(end - block_bytes, 0), 0)[_last(following)[:-1]]
    reach = int(np.searchsorted(at, HALO))
    position, value = at[: reach + 1], leave[: reach + 1]
    ends = np.append(np.flatnonzero(value[1:] != value[:-1]), len(value) - 1) if len(value) else np.zeros(0, dtype=np.int64)
    return [*position[ends].tolist(), max(HALO, block_bytes)], [*value[ends].tolist(), 0]


def _leave(uppers, exits, entry: int) -> int:
    return int(exits[int(np.searchsorted(np.asarray(uppers), entry))])


def _cut(data: np.ndarray, block_bytes: int, entry: int):
    """The frames of a block whose scan enters at ``entry``, as (start, end)."""
    at, end = _frame_starts(data, block_bytes)
    chain = _chain(np.append(np.searchsorted(at, end), len(at)), int(np.searchsorted(at, entry)))
    return list(zip(at[chain].tolist(), end[chain].tolist()))


def _cut_whole(data: np.ndarray, block_bytes: int):
    """The frames of a whole capture, a block at a time."""
    out, entry = [], 0
    for first in range(0, len(data), block_bytes):
        spans = _cut(data[first : first + block_bytes + HALO], block_bytes, entry)
        out += [(first + a, first + b) for a, b in spans]
        # Frames run on over the block's end by less than a block.
        entry = max(0, (spans[-1][1] if spans else 0) - block_bytes, entry - block_bytes)
    return out


def chunk_offsets(chunks: DataFrame, capture: str, seq: str, data: str, **chunking) -> DataFrame:
    """(capture, seq, at, size, copies): the offset of each chunk in its capture.

    Lengths are written out first, so the bytes are read once for this and never sorted. A chunk that is
    repeated counts once; chunks of one capture and seq with different bytes fail the job.
    """
    size, digest = F.length(data).cast("bigint"), F.xxhash64(data)
    rows = chunks.groupBy(capture, seq).agg(
        F.max(size).alias("size"), F.count(F.lit(1)).alias("copies"),
        F.assert_true(F.min(F.struct(size, digest)).eqNullSafe(F.max(F.struct(size, digest))), "chunks of one capture and seq differ").alias("_same"),
    )
    sizes = cut_lineage(rows.where("_same is null").drop("_same"))
    placed = skew.ordered(sizes, [capture], [seq], {"at": ("sum_before", F.col("size"))}, **chunking)
    return cut_lineage(placed.withColumn("at", F.coalesce("at", F.lit(0).cast("bigint"))))


def blocks(placed: DataFrame, capture: str, data: str, block: int = BLOCK) -> DataFrame:
    """Captures cut into blocks of ``block`` bytes, each with the bytes a frame may run on into.

    A block's group holds at most ``block`` + the largest frame, however long the capture is.
    """
    if block <= HALO:
        raise ValueError("a block must be longer than the largest frame")
    size, at = F.length(data).cast("bigint"), F.col("at")
    low = F.greatest(F.lit(0).cast("bigint"), F.floor((at - HALO) / block))
    high = F.floor((at + size - 1) / block)
    spread = placed.where(size > 0).withColumn("block", F.explode(F.sequence(low, high)))
    start = F.greatest(at, F.col("block") * block)
    stop = F.least(at + size, (F.col("block") + 1) * block + HALO)
    piece = F.substring(F.col(data), (start - at + 1).cast("int"), (stop - start).cast("int"))
    pieces = spread.where(stop > start).select(capture, "block", start.alias("at"), piece.alias("bytes"))
    return pieces.groupBy(capture, "block").agg(F.expr("listagg(bytes) WITHIN GROUP (ORDER BY at)").alias("window"))


def _chained(tables, entry: int) -> int:
    for uppers, exits in tables:
        entry = _leave(uppers, exits, entry)
    return entry


def block_entries(windows: DataFrame, capture: str, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Where the scan enters each block.

    Each block is summed up as a step function from entry to exit. The functions of ``fan`` blocks
    are chained into one, those are chained along the capture, and the entries are handed down.
    """
    key_type = dict(windows.dtypes)[capture]

    def step(batches):
        for pdf in batches:
            tables = [_exits(np.frombuffer(w, dtype=np.uint8), block) for w in pdf["window"]]
            yield pd.DataFrame({
                capture: pdf[capture], "block": pdf["block"],
                "uppers": [t[0] for t in tables], "exits": [t[1] for t in tables],
            })

    schema = f"`{capture}` {key_type}, block bigint, uppers array<bigint>, exits array<bigint>"
    steps = small_batches(windows).mapInPandas(step, schema).withColumn("_span", F.floor(F.col("block") / fan))

    def span(key, pdf):
        tables = list(zip(*[pdf.sort_values("block")[c] for c in ("uppers", "exits")]))
        first = [int(u) for u in tables[0][0]]
        exits = [_chained(tables, upper) for upper in first]
        return pd.DataFrame([(key[0], key[1], first, exits)], columns=[capture, "_span", "uppers", "exits"])

    spans = steps.groupBy(capture, "_span").applyInPandas(
        span, f"`{capture}` {key_type}, _span bigint, uppers array<bigint>, exits array<bigint>"
    )

    def along(key, pdf):
        entry, out = 0, []
        for row in pdf.sort_values("_span").itertuples(index=False):
            out.append((key[0], int(row[1]), entry))
            entry = _leave(row[2], row[3], entry)
        return pd.DataFrame(out, columns=[capture, "_span", "_entry"])

    # One row per fan * block bytes (4 GiB by default) of a capture.
    starts = spans.groupBy(capture).applyInPandas(along, f"`{capture}` {key_type}, _span bigint, _entry bigint")

    def down(key, pdf):
        pdf = pdf.sort_values("block")
        entry, out = int(pdf["_entry"].iloc[0]), []
        for b, uppers, exits in zip(pdf["block"], pdf["uppers"], pdf["exits"]):
            out.append((key[0], int(b), entry))
            entry = _leave(uppers, exits, entry)
        return pd.DataFrame(out, columns=[capture, "block", "entry"])

    joined = steps.join(starts, [capture, "_span"])
    return joined.groupBy(capture, "_span").applyInPandas(down, f"`{capture}` {key_type}, block bigint, entry bigint")


def scan(chunks: DataFrame, capture: str, data: str, seq: str | None = None, block: int = BLOCK, fan: int = FAN, **chunking) -> DataFrame:
    """Frames of captures: (capture, offset, frame), found by one greedy pass over each capture.

    ``seq`` orders the chunks of a capture (neither it nor the capture is null; a repeated chunk counts once);
    without it every row is a whole capture, which is cut in its own task without a shuffle. Captures in chunks
    that are longer than a block are scanned in blocks that run in parallel; the result is that of a single pass.
    """
    key_type = dict(chunks.dtypes)[capture]
    schema = f"`{capture}` {key_type}, offset bigint, frame binary"

    def cut_rows(batches):
        for pdf in batches:
            for i, whole in enumerate(pdf["_data"]):
                spans = _cut_whole(np.frombuffer(whole or b"", dtype=np.uint8), block)
                yield pd.DataFrame({
                    capture: pdf[capture].take([i] * len(spans)).reset_index(drop=True),
                    "offset": np.array([a for a, _ in spans], dtype="int64"), "frame": [whole[a:b] for a, b in spans],
                })

    if seq is None:
        return small_batches(chunks.select(capture, F.col(data).alias("_data"))).mapInPandas(cut_rows, schema)
    offsets = chunk_offsets(chunks, capture, seq, data, **chunking)
    longest, copies = offsets.agg(F.max(F.col("at") + F.col("size")), F.max("copies")).first()
    placed = chunks.select(capture, seq, F.col(data).alias("_data")).join(offsets.drop("size", "copies"), [capture, seq])
    if (copies or 0) > 1:
        placed = placed.dropDuplicates([capture, seq])
    windows = blocks(placed, capture, "_data", block)
    if (longest or 0) <= block:
        joined = windows.withColumn("entry", F.lit(0).cast("bigint"))
    else:
        joined = windows.join(block_entries(windows, capture, block, fan), [capture, "block"])

    def cut(batches):
        for pdf in batches:
            keys, offsets, found = [], [], []
            for i, (number, window, entry) in enumerate(zip(pdf["block"], pdf["window"], pdf["entry"])):
                spans = _cut(np.frombuffer(window, dtype=np.uint8), block, int(entry))
                keys += [i] * len(spans)
                offsets += [number * block + a for a, _ in spans]
                found += [window[a:b] for a, b in spans]
            yield pd.DataFrame({
                capture: pdf[capture].take(keys).reset_index(drop=True),
                "offset": np.array(offsets, dtype="int64"), "frame": found,
            })

    return small_batches(joined.select(capture, "block", "window", "entry")).mapInPandas(cut, schema)


# -- headers ---------------------------------------------------------------------------------


def header(frames: DataFrame, frame: str = "frame") -> DataFrame:
    """Add status (ok, too_short, bad_sync, truncated, bad_checksum), class_id, message_id, payload."""
    f = F.col(frame)
    size = F.length(f)
    length = wire.unsigned(wire.slice_bytes(f, F.lit(4), F.lit(2))).cast("int")
    shape = (
        F.when(size < fixed.FRAME_OVERHEAD, F.lit("too_short"))
        .when(F.substring(f, 1, 2) != F.lit(fixed.SYNC), F.lit("bad_sync"))
        .when(size < length + fixed.FRAME_OVERHEAD, F.lit("truncated"))
    )
    rows = frames.withColumn("payload_length", length).withColumn("_shape", shape)
    body = F.when(F.col("_shape").isNull(), wire.slice_bytes(f, F.lit(2), F.col("payload_length") + 4))
    stored = wire.unsigned(wire.slice_bytes(f, F.col("payload_length") + 6, F.lit(2))).cast("int")
    rows = rows.withColumn("_sum", wire.checksum(body)).withColumn(
        "status", F.coalesce("_shape", F.when(F.col("_sum") != stored, F.lit("bad_checksum")), F.lit("ok"))
    )
    good = F.col("status") == "ok"
    parts = F.struct(
        F.when(good, wire.unsigned(F.substring(f, 3, 1)).cast("int")).alias("class_id"),
        F.when(good, wire.unsigned(F.substring(f, 4, 1)).cast("int")).alias("message_id"),
        F.when(good, wire.slice_bytes(f, F.lit(6), F.col("payload_length"))).alias("payload"),
    )
    # Generated columns: later filters on them are not rewritten into copies of the work above.
    return rows.select("*", F.inline(F.array(parts))).drop("_shape", "_sum")


# -- layouts ---------------------------------------------------------------------------------


def _shape():
    """Base type, bytes per element and element count of ``data_type``, worked out once per registry row."""
    base = n.type_base("data_type")
    return base.alias("base"), n.type_size(base).alias("size"), n.type_count("data_type").alias("count")


def layouts(messages: DataFrame, fields: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """One row per message with its variants and fields nested; sized by the registry, not the data.

    Written to the shared folder: later joins know its size, broadcast it if it is small and else split hot ids.
    """
    body = F.struct("pos", "variant", "field", "byte_offset", "data_type", *_shape())
    nested = fields.groupBy(*IDS).agg(F.array_sort(F.collect_list(body)).alias("fields"))
    out = messages.join(nested, IDS, "left")
    if variants is None:
        return cut_lineage(out.withColumn("variants", F.lit(None).cast("array<struct<position:int,variant:string>>")))
    choice = F.struct("position", "variant", "payload_length", "min_length", "max_length", "byte_offset", "value")
    return cut_lineage(out.join(variants.groupBy(*IDS).agg(F.array_sort(F.collect_list(choice)).alias("variants")), IDS, "left"))


def _choose_variant(variants, payload, has_rules: bool) -> Column:
    """The first variant whose length, length range or discriminating byte fits the payload."""
    if not has_rules:
        return F.lit(None).cast("string")
    size = F.length(payload)

    def fits(v):
        ranged = v["min_length"].isNotNull() | v["max_length"].isNotNull()
        in_range = (size >= F.coalesce(v["min_length"], F.lit(0))) & (v["max_length"].isNull() | (size <= v["max_length"]))
        byte = wire.unsigned(wire.slice_bytes(payload, v["byte_offset"], F.lit(1))).cast("bigint")
        by_value = (v["byte_offset"] < size) & (byte == v["value"])
        return (
            F.coalesce(v["payload_length"] == size, F.lit(False))
            | F.coalesce(ranged & in_range, F.lit(False))
            | F.coalesce(by_value, F.lit(False))
        )

    return F.try_element_at(F.filter(variants, fits), F.lit(1))["variant"]


def identify(frames: DataFrame, registry: DataFrame) -> DataFrame:
    """Add message, variant, parsed and the field list that applies; ``registry`` is from :func:`layouts`."""
    has_rules = "payload_length" in registry.schema["variants"].dataType.elementType.names
    # Bad frames have no ids: each gets a class of its own that no registry has, so they do not meet in one task.
    spread = F.coalesce(F.col("class_id"), -1 - F.pmod(F.xxhash64("frame"), F.lit(1 << 16)).cast("int"))
    dim = registry.withColumnsRenamed({"class_id": "_class", "message_id": "_id"})
    joined = frames.withColumn("_spread", spread).join(dim, (F.col("_spread") == F.col("_class")) & F.coalesce("message_id", F.lit(-1)).eqNullSafe(F.col("_id")), "left")
    joined = joined.drop("_spread", "_class", "_id")
    joined = joined.withColumn("variant", _choose_variant(F.col("variants"), F.col("payload"), has_rules))
    many = F.coalesce(F.size("variants") > 0, F.lit(False))
    parsed = F.col("message").isNotNull() & (~many | F.col("variant").isNotNull())
    unnamed = F.concat_ws("-", F.lit(fixed.MESSAGE_PREFIX.rstrip("-")), F.lpad(F.hex("class_id"), 2, "0"), F.lpad(F.hex("message_id"), 2, "0"))
    own = F.filter("fields", lambda f: f["variant"].eqNullSafe(F.col("variant")))
    alias = F.when(F.col("variant").isNotNull(), F.concat_ws("-", "message", "variant"))
    return joined.withColumns({
        "parsed": parsed,
        "fields": F.when(parsed, own),
        "variant_alias": alias,
        "payload_raw": F.when(~parsed, F.lower(F.hex("payload"))),
        "message": F.coalesce("message", unnamed),
    }).drop("variants")


# -- decoding --------------------------------------------------------------------------------


def _elements(f: Column) -> Column:
    """Element numbers of a field: 0 for a scalar or text, 0..n-1 for an array, none when variable."""
    count = F.when(f["base"] == "CH", F.least(f["count"], F.lit(1))).otherwise(f["count"])
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _typed(rows: DataFrame, keys, at: Column) -> DataFrame:
    """Value columns of the elements in ``_f`` and ``idx``: numbers past the end are 0, text is cut."""
    f = F.col("_f")
    is_text, is_real = f["base"] == "CH", f["base"].isin("R4", "R8")
    offset = at + F.col("idx") * f["size"]
    raw = wire.slice_bytes(F.col("payload"), offset, F.when(is_text, f["count"]).otherwise(f["size"]))
    cut = rows.select(*keys, "_f", "idx", raw.alias("_raw"))
    raw, whole = F.col("_raw"), F.length("_raw") == f["size"]
    return cut.select(
        *keys, f["field"].alias("field"), "idx",
        F.when(~is_text & ~is_real, F.when(whole, wire.integer_value(raw, f["base"])).otherwise(F.lit(0).cast(wire.WORD))).alias("int_value"),
        F.when(is_real, F.when(whole, wire.float_value(raw)).otherwise(F.lit(0.0))).alias("real_value"),
        F.when(is_text, wire.text_value(raw)).alias("text_value"),
    )


def decode(identified: DataFrame, keys) -> DataFrame:
    """Values of parsed frames: (keys.., message, variant, field, idx, int_value, real_value, text_value).

    Fields without a fixed offset or beyond the payload are left out; arrays give a row per element.
    """
    keys = [*keys, "message", "variant"]
    long = identified.where("parsed").select(*keys, "payload", F.explode("fields").alias("_f"))
    at = F.col("_f.byte_offset")
    long = long.where(at.isNotNull() & (at >= 0) & (at < F.length("payload")))
    return _typed(long.select("*", F.explode(_elements(F.col("_f"))).alias("idx")), keys, at)


def integer_at(fields: Column, payload: Column, name: Column) -> Column:
    """The number in a frame's field, by name; 0 when it has no such field."""
    hits = F.transform(
        F.filter(fields, lambda f: f["field"] == name),
        lambda f: wire.integer_value(wire.slice_bytes(payload, f["byte_offset"], f["size"]), f["base"]).cast("bigint"),
    )
    return F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit(0).cast("bigint"))


def decode_groups(identified: DataFrame, groups: DataFrame, group_fields: DataFrame, keys) -> DataFrame:
    """Values of repeated groups: (keys.., message, group_name, instance, field, idx, values..).

    Repetition is count_field, constant, optional or fill_remaining; ``products`` is an
    array<struct<field, multiplier>> added to ``base``.
    """
    names = [*IDS, "variant", "group_name"]
    body = F.struct("pos", "field", "byte_offset", "data_type", *_shape())
    nested = group_fields.groupBy(*names).agg(F.array_sort(F.collect_list(body)).alias("_members"))
    dim = skew.null_safe_join(groups, nested, names, "inner").withColumnsRenamed({"variant": "_gv"})
    rows = identified.where("parsed").join(cut_lineage(dim), IDS, "inner").where(F.col("variant").eqNullSafe(F.col("_gv")))
    # A struct of the dimension's columns, as in the nested form.
    base, times = _repeats({c: F.col(c) for c in ("base", "products", "size", "repetition", "count_field", "count")}, F.col("fields"), F.col("payload"))
    rows = rows.withColumns({"_base": base, "_times": times})
    numbers = F.when(F.col("_times") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("_times") - 1))
    keys = [*keys, "message", "group_name", "instance"]
    long = rows.select(
        *keys[:-1], "payload", "_base", F.col("size").alias("_size"), "_members",
        F.explode(numbers).alias("instance"),
    )
    long = long.select(*keys, "payload", "_base", "_size", F.explode("_members").alias("_f"))
    at = F.col("_base") + F.col("instance") * F.col("_size") + F.col("_f.byte_offset")
    long = long.where(at < F.length("payload")).select("*", F.explode(_elements(F.col("_f"))).alias("idx"))
    return _typed(long, keys, at)


# -- one row per message -----------------------------------------------------------------------


def _element(payload: Column, f: Column, at: Column) -> Column:
    """One element as a VARIANT: as in :func:`decode`, numbers past the end are 0 and texts are cut."""
    is_text, is_real = f["base"] == "CH", f["base"].isin("R4", "R8")

    def value(raw):
        whole = F.length(raw) == f["size"]
        number = F.when(whole, wire.integer_value(raw, f["base"])).otherwise(F.lit(0).cast(wire.WORD))
        real = F.when(whole, wire.float_value(raw)).otherwise(F.lit(0.0))
        return F.when(is_text, wire.text_value(raw).cast("variant")).when(is_real, real.cast("variant")).otherwise(number.cast("variant"))

    return n.let(wire.slice_bytes(payload, at, F.when(is_text, f["count"]).otherwise(f["size"])), value)


def _entries(payload: Column, fields: Column, base: Column) -> Column:
    """(name, VARIANT) of the fields that begin inside the payload; a type with a count of elements gives an array."""
    here = lambda f: base + f["byte_offset"]
    many = lambda f: f["data_type"].contains("[") & (f["base"] != "CH")

    def value(f):
        listed = F.transform(_elements(f), lambda i: _element(payload, f, here(f) + i * f["size"]))
        return F.when(many(f), F.to_variant_object(listed)).otherwise(_element(payload, f, here(f)))

    held = F.filter(fields, lambda f: (f["byte_offset"] >= 0) & (here(f) < F.length(payload)) & (many(f) | (f["count"] > 0)))
    return F.transform(held, lambda f: F.struct(f["field"].alias("key"), value(f).alias("value")))


def _object(entries: Column) -> Column:
    """A VARIANT object; of entries with one name the first counts."""
    names = F.transform(entries, lambda x: x["key"])
    fresh = F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    return F.to_variant_object(F.map_from_entries(F.when(F.size(F.array_distinct(names)) == F.size(entries), entries).otherwise(fresh)))


def wide(identified: DataFrame, keys, groups: DataFrame | None = None, group_fields: DataFrame | None = None) -> DataFrame:
    """One row per parsed frame: (keys.., message, variant, view); all messages in one pass and without a shuffle of frames.

    ``view`` is a VARIANT object from field name to value: numbers, texts, arrays of elements, and for a repeated group
    an array of objects, one per instance. Values are those of :func:`decode` and :func:`decode_groups`. A group that does
    not occur is an empty array; a field beyond the payload has no entry.
    """
    rows = identified.where("parsed").withColumn("_entries", _entries(F.col("payload"), F.col("fields"), F.lit(0)))
    if groups is not None:
        names = [*IDS, "variant", "group_name"]
        members = group_fields.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("pos", "field", "byte_offset", "data_type", *_shape()))).alias("members"))
        body = F.struct("variant", "group_name", "repetition", "count_field", "count", "base", "products", "size", "members")
        nested = skew.null_safe_join(groups, members, names, "inner").groupBy(*IDS).agg(F.array_sort(F.collect_list(body)).alias("_groups"))
        rows = rows.join(cut_lineage(nested), IDS, "left")
        mine = F.filter(F.coalesce("_groups", F.array().cast(nested.schema["_groups"].dataType)), lambda g: g["variant"].eqNullSafe(F.col("variant")))

        def placed(g):
            base, times = _repeats(g, F.col("fields"), F.col("payload"))
            return F.struct(g["group_name"].alias("name"), g["size"].alias("size"), g["members"].alias("members"), base.alias("base"), times.alias("times"))

        def instances(g):
            numbers = F.when(g["times"] > 0, F.sequence(F.lit(0).cast("bigint"), g["times"] - 1)).otherwise(F.array().cast("array<bigint>"))
            return F.transform(numbers, lambda i: F.struct(g["name"].alias("name"), g["members"].alias("members"), (g["base"] + i * g["size"]).alias("at")))

        def listed(g):
            held = F.filter("_objects", lambda o: o["name"] == g["name"])
            return F.struct(g["name"].alias("key"), F.to_variant_object(F.transform(held, lambda o: o["value"])).alias("value"))

        # Column by column: functions within functions would take the analyzer many rounds.
        rows = rows.withColumn("_placed", F.transform(mine, placed)).withColumn("_instances", F.flatten(F.transform("_placed", instances)))
        rows = rows.withColumn("_parts", F.transform("_instances", lambda x: F.struct(x["name"].alias("name"), _entries(F.col("payload"), x["members"], x["at"]).alias("entries"))))
        rows = rows.withColumn("_objects", F.transform("_parts", lambda x: F.struct(x["name"].alias("name"), _object(x["entries"]).alias("value"))))
        rows = rows.withColumn("_entries", F.concat("_entries", F.transform("_placed", listed)))
    return rows.select(*keys, "message", "variant", _object(F.col("_entries")).alias("view"))


def _repeats(g, fields: Column, payload: Column) -> tuple[Column, Column]:
    """(first byte, instances) of a repeated group in a payload."""
    total = F.length(payload).cast("bigint")
    none = F.array().cast("array<struct<field:string,multiplier:bigint>>")
    base = g["base"] + F.aggregate(
        F.coalesce(g["products"], none), F.lit(0).cast("bigint"), lambda acc, p: acc + integer_at(fields, payload, p["field"]) * p["multiplier"]
    )
    room = F.greatest(F.lit(0).cast("bigint"), F.floor((total - base) / g["size"]))
    times = (
        F.when(g["repetition"] == "count_field", integer_at(fields, payload, g["count_field"]))
        .when(g["repetition"] == "constant", g["count"])
        .when(g["repetition"] == "optional", F.least(room, F.lit(1).cast("bigint")))
        .otherwise(room)
    )
    # A count field may claim more than the payload holds; instances start inside the payload.
    return base, F.least(times, F.ceil((total - base) / g["size"]))


def _sql_type(dtype: str) -> str:
    base, _, count = dtype.partition("[")
    plain = "string" if base == "CH" else "double" if base in ("R4", "R8") else "decimal(20,0)" if base in ("U8", "X8") else "bigint"
    return f"array<{plain}>" if count and base != "CH" else plain


def typed(views: DataFrame, message: str, keys, fields: DataFrame, groups: DataFrame | None = None, group_fields: DataFrame | None = None, variant: str | None = None) -> DataFrame:
    """The frames of one message as a table: keys.., a column per field, and an array of structs per group.

    Column types come from the registry rows of the message (as many as it has fields), which are read at once.
    """
    def named(rows):  # noqa: ANN001
        here = rows.where(F.col("message").eqNullSafe(message) & F.col("variant").eqNullSafe(variant))
        return {r.field: _sql_type(r.data_type) for r in here.orderBy("pos").collect()}

    columns = named(fields)
    for g in groups.where(F.col("message") == message).orderBy("base").collect() if groups is not None else []:
        inner = named(group_fields.where(F.col("group_name") == g.group_name))
        columns[g.group_name] = f"array<struct<{','.join(f'`{k}`:{t}' for k, t in inner.items())}>>"
    picked = [F.try_variant_get("view", f"$['{name}']", kind).alias(name) for name, kind in columns.items()]
    return views.where((F.col("message") == message) & F.col("variant").eqNullSafe(variant)).select(*keys, *picked)


# -- meaning of values -----------------------------------------------------------------------


def unpack_bits(values: DataFrame, bits: DataFrame, keys) -> DataFrame:
    """Bits of decoded numbers; ``bits``: message, field, bit, bit_start, width. Opaque fields have no bits."""
    joined = values.join(cut_lineage(bits), ["message", "field"])
    return joined.select(*keys, "message", "field", "idx", "bit", wire.bit_field("int_value", "bit_start", "width").alias("bit_value"))


def interpret(values: DataFrame, meaning: DataFrame, enums: DataFrame | None = None, protocol_version: int | None = None) -> DataFrame:
    """Scaled values, units and labels of decoded fields.

    ``meaning``: message, field, multiplier, unit, reserved, since_version. Reserved fields, and with
    ``protocol_version`` fields introduced later, drop out. ``enums``: message, field, value, label.
    """
    joined = values.join(cut_lineage(meaning), ["message", "field"], "left")
    joined = joined.where(~F.coalesce("reserved", F.lit(False)))
    if protocol_version is not None:
        joined = joined.where(F.coalesce(F.col("since_version") <= protocol_version, F.lit(True)))
    number = F.coalesce(F.col("int_value").cast("double"), "real_value")
    joined = joined.withColumn("scaled_value", number * F.coalesce("multiplier", F.lit(1.0)))
    if enums is not None:
        dim = enums.select("message", "field", F.col("value").cast(wire.WORD).alias("int_value"), "label")
        joined = joined.join(cut_lineage(dim), ["message", "field", "int_value"], "left")
    return joined.drop("multiplier", "reserved", "since_version")


def valid_or_null(value: Column, flags: Column, bit: int) -> Column:
    """A value that counts only while a bit of ``flags`` is set."""
    return F.when(wire.bit_field(flags, F.lit(bit), F.lit(1)) == 1, value)


def conditional(values: DataFrame, selectors: DataFrame, readings: DataFrame, keys) -> DataFrame:
    """Name, unit and scale of fields whose reading depends on a selector bit of the same frame.

    ``selectors``: keys.., message, bit, bit_value. ``readings``: message, field, bit, bit_value,
    reading, unit, multiplier.
    """
    chosen = selectors.withColumnRenamed("bit_value", "_bv").join(
        cut_lineage(readings.withColumnRenamed("bit_value", "_rv")), ["message", "bit"]
    ).where(F.col("_bv") == F.col("_rv"))
    joined = values.join(chosen.select(*keys, "message", "field", "reading", "unit", "multiplier"), [*keys, "message", "field"])
    return joined.withColumn("scaled_value", F.coalesce(F.col("int_value").cast("double"), "real_value") * F.coalesce("multiplier", F.lit(1.0)))


# -- encoding --------------------------------------------------------------------------------


def _number_hex(value: Column, base: Column, size: Column) -> Column:
    """Hex of an integer; one that does not fit its type is written as zeros."""
    safe = F.when(fits_type(value, base), value).otherwise(F.lit(0).cast(wire.WORD))
    return wire.little_endian_hex(F.coalesce(safe, F.lit(0).cast(wire.WORD)), size)


def element_hex(f: Column, int_value: Column, real_value: Column, text_value: Column) -> Column:
    """Hex of one element of a registry field from typed value columns."""
    is_real = f["base"].isin("R4", "R8")
    reals = wire.float_hex(F.when(is_real, F.coalesce(real_value, int_value.cast("double"))), f["base"])
    texts = wire.text_hex(F.coalesce(text_value, F.lit("")), f["count"])
    return F.when(f["base"] == "CH", texts).when(is_real, reals).otherwise(_number_hex(int_value, f["base"], f["size"]))


def assemble(parts: Column) -> Column:
    """Payload from an array of struct(at, .., hex) in writing order: gaps are zeros, parts are appended."""
    joined = F.aggregate(
        parts, F.lit(""),
        lambda acc, p: F.concat(acc, F.repeat(F.lit("00"), F.greatest(F.lit(0), p["at"] - (F.length(acc) / 2).cast("int"))), p["hex"]),
    )
    return F.unhex(joined)


def encode(requests: DataFrame, values: DataFrame, registry: DataFrame, keys) -> DataFrame:
    """Frames from field values: (keys.., class_id, message_id, variant, payload, frame).

    ``requests``: keys.., class_id, message_id, variant (null: the first one). ``values``: keys..,
    field, idx, int_value, real_value, text_value. Fields without a value are zero; a payload has at
    most 65,535 bytes, which bounds the parts that meet in one row.
    """
    # Generated ids: when all requests name one message, constants would turn the join into a nested loop.
    ids = F.inline(F.array(F.struct(*IDS)))
    asked = requests.select(*keys, F.col("variant").alias("_wanted"), ids).distinct()
    joined = asked.join(registry, IDS, "inner")
    listed = F.transform(F.coalesce("variants", F.array().cast(registry.schema["variants"].dataType)), lambda v: v["variant"])
    variant = F.when(F.array_contains(listed, F.col("_wanted")), F.col("_wanted")).otherwise(F.get(listed, F.lit(0)))
    joined = joined.withColumn("variant", variant).withColumn("_disc", _discriminator(registry))
    own = F.filter("fields", lambda f: f["variant"].eqNullSafe(F.col("variant")) & (f["byte_offset"] >= 0))
    wanted = joined.select(*keys, *IDS, "variant", "_disc", F.explode_outer(own).alias("_f"))
    wanted = wanted.select("*", F.explode_outer(_elements(F.col("_f"))).alias("idx"))
    wanted = wanted.withColumn("field", F.col("_f.field"))
    given = values.groupBy(*keys, "field", "idx").agg(F.max(F.struct("int_value", "real_value", "text_value")).alias("_v"))
    filled = skew.null_safe_join(wanted, given, [*keys, "field", "idx"], "left")
    chosen = F.when(F.col("field") == F.col("_disc.field"), F.col("_disc.value").cast(wire.WORD))
    number = F.coalesce(F.col("_v.int_value").cast(wire.WORD), chosen)
    at = (F.col("_f.byte_offset") + F.col("idx") * F.col("_f.size")).cast("int")
    hexed = filled.withColumn("hex", element_hex(F.col("_f"), number, F.col("_v.real_value"), F.col("_v.text_value")))
    part = F.when(F.col("hex").isNotNull(), F.struct(at.alias("at"), F.col("_f.pos").alias("pos"), "idx", "hex"))
    rows = hexed.groupBy(*keys, *IDS, "variant").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    payload = rows.withColumn("payload", assemble(F.col("_parts"))).drop("_parts")
    return payload.withColumn("frame", wire.frame("class_id", "message_id", F.col("payload")))


def _discriminator(registry: DataFrame) -> Column:
    """Field and value that mark the chosen variant: the field at the discriminating offset."""
    if "value" not in registry.schema["variants"].dataType.elementType.names:
        return F.lit(None).cast("struct<field:string,value:bigint>")
    rule = F.try_element_at(F.filter("variants", lambda v: v["variant"] == F.col("variant")), F.lit(1))
    marks = F.filter("fields", lambda f: f["variant"].eqNullSafe(F.col("variant")) & (f["byte_offset"] == rule["byte_offset"]))
    return F.struct(F.try_element_at(marks, F.lit(1))["field"].alias("field"), rule["value"].cast("bigint").alias("value"))


def encode_columns(df: DataFrame, class_id: Column, message_id: Column, layout) -> DataFrame:
    """Add ``payload`` and ``frame`` from columns; ``layout`` lists (column, type, offset). No shuffle."""
    parts = []
    for column, dtype, offset in layout:
        value, kind = F.col(column), F.lit(dtype)
        base = dtype.split("[")[0]
        if base == "CH":
            hexed = wire.text_hex(F.coalesce(value, F.lit("")), n.type_size(kind))
        elif base in ("R4", "R8"):
            hexed = wire.float_hex(value.cast("double"), kind)
        else:
            hexed = _number_hex(value.cast(wire.WORD), kind, n.type_size(kind))
        parts.append(F.struct(F.lit(offset).alias("at"), hexed.alias("hex")))
    payload = df.withColumn("payload", assemble(F.array(*parts)))
    return payload.select("*", F.explode(F.array(wire.frame(class_id, message_id, F.col("payload")))).alias("frame"))


def encode_groups(prefixes: DataFrame, instances: DataFrame, keys, base: Column, size: Column) -> DataFrame:
    """Payloads with repeated groups appended.

    ``prefixes``: keys.., payload. ``instances``: keys.., instance, at, hex (parts of an instance).
    ``base`` is where the group starts, ``size`` the bytes each instance is padded to.
    """
    one = instances.groupBy(*keys, "instance").agg(F.array_sort(F.collect_list(F.struct("at", "hex"))).alias("_p"))
    one = one.withColumn("_hex", F.hex(assemble(F.col("_p"))))
    rows = one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("instance", "_hex"))).alias("_i"))
    joined = skew.null_safe_join(prefixes, rows, keys, "left").withColumn("_b", base.cast("int")).withColumn("_s", size.cast("int"))
    head = F.hex("payload")
    gap = F.repeat(F.lit("00"), F.greatest(F.lit(0), F.col("_b") - F.length("payload")))
    tail = F.array_join(
        F.transform(F.coalesce("_i", F.array().cast("array<struct<instance:bigint,_hex:string>>")),
                    lambda i: F.concat(i["_hex"], F.repeat(F.lit("00"), F.greatest(F.lit(0), F.col("_s") - (F.length(i["_hex"]) / 2).cast("int"))))),
        "",
    )
    return joined.withColumn("payload", F.unhex(F.concat(head, gap, tail))).drop("_i", "_b", "_s")


def round_trip(values: DataFrame, decoded: DataFrame, keys, tolerance=1e-3) -> DataFrame:
    """Values that do not come back from encoding and decoding: one row per difference."""
    key = [*keys, "field", "idx"]
    sent = values.select(*key, F.struct("int_value", "real_value", "text_value").alias("_a"))
    got = decoded.select(*key, F.struct("int_value", "real_value", "text_value").alias("_b"))
    both = sent.join(got, key, "left")
    a, b = F.col("_a"), F.col("_b")
    number_a = F.coalesce(a["int_value"].cast("double"), a["real_value"])
    number_b = F.coalesce(b["int_value"].cast("double"), b["real_value"])
    same = F.when(a["text_value"].isNotNull(), a["text_value"].eqNullSafe(b["text_value"])).when(
        a["real_value"].isNotNull(), F.abs(number_a - number_b) < tolerance
    ).otherwise(number_a.eqNullSafe(number_b))
    return both.where(~F.coalesce(same, F.lit(False))).select(*key, "_a", "_b")


# -- configuration values --------------------------------------------------------------------


def key_values(pairs: DataFrame, keys: DataFrame, key_id: str, payload: str) -> DataFrame:
    """Configuration values (key id number, value bytes) with the key's name and typed number.

    ``keys``: key_id (0x text), name, data_type.
    """
    dim = keys.select(n.parse_id("key_id").alias("_id"), F.col("name").alias("key_name"), "data_type")
    joined = pairs.join(dim, pairs[key_id].cast("bigint") == dim["_id"], "left").drop("_id")
    base = F.regexp_replace("data_type", "^E", "U")
    raw = F.col(payload)
    real = F.when(base.startswith("R"), wire.float_value(raw))
    number = F.when(F.col("data_type") == "L", wire.unsigned(raw) % 2).when(~base.startswith("R"), wire.integer_value(raw, base))
    return joined.withColumns({"int_value": number.cast(wire.WORD), "real_value": real})
