"""Suffix-array dedup: bytes of passages that stand somewhere earlier are found by refining buckets of suffixes.

Suffixes are sorted into buckets by their first GRAM bytes. A bucket whose members go on differently is refined by the
identifiers of the buckets that later offsets of its members are in, and these longer identifiers are used in turn, up
to WINDOW bytes: 85 bytes from the grams of 37 at four offsets, 97 from four of 85, 100 from four of 97. What is asked
is which strings of WINDOW bytes are equal, so buckets are left as soon as they hold one suffix or one text.

Only suffixes that start at an anchor, the gram with the least hash within a string of WINDOW bytes, are sorted: equal
strings have the same anchor at the same place, so an anchor stands for all strings it is the anchor of. There is one
in about thirty bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import by_arrow, free_name, raw, small_batches

#: Bytes of the strings that are compared.
WINDOW = 100
#: Bytes of the first buckets. A string of WINDOW bytes has 64 of them.
GRAM = 37
PLACES = WINDOW - GRAM + 1
#: Starts of strings, of the PLACES around an anchor, that a bucket of each round stands for. Its bytes are those which
#: all these strings have: WINDOW - step + 1.
STEPS = [16, 4, 1]
#: Bytes that are worked on at once, so that numbers stay in the processor's cache; longer texts are cut into overlapping pieces.
BLOCK = 1 << 17
#: A place holds the first string of a member and, in so many low bits, its form: how far the anchor and the last string are.
FORM_BITS = 20
#: Bytes of a text whose spans are brought together in one row.
PART = 1 << 20

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64((1 << 32) - 1)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One identifier of two, in order."""
    out = left * _A + (right ^ right >> np.uint64(29)) * _B
    out ^= out >> np.uint64(32)
    out *= _A
    out ^= out >> np.uint64(29)
    return out


_BYTES = _mixed(np.arange(256, dtype=np.uint64), np.arange(1, 257, dtype=np.uint64))


class Identifiers:
    """Bucket identifiers of the suffixes of some bytes, each put together from those of later offsets."""

    def __init__(self, data: np.ndarray):
        ids, size = _BYTES[data], 1
        while size < 32:
            ids = _mixed(ids[:-size], ids[size:])
            size *= 2
        self.short = ids
        self.gram = _mixed(ids[: -(GRAM - 32)], ids[GRAM - 32 :])

    def round(self, step: int) -> np.ndarray:
        """Of the buckets of a round, WINDOW - step + 1 bytes, from four later offsets of the round before."""
        ids = self.gram if step * 4 == PLACES else self.round(step * 4)
        end = len(ids) - 3 * step
        first, second, third, fourth = (ids[k * step : k * step + end] for k in range(4))
        return _mixed(_mixed(first, second), _mixed(third, fourth))

    def check(self, at: np.ndarray) -> np.ndarray:
        """Another identifier of WINDOW bytes, so that equal strings are told by 128 bits."""
        return _mixed(_mixed(self.short[at + (WINDOW - 32)], self.short[at + 64]), _mixed(self.short[at + 32], self.short[at]))

    def text(self, first: np.ndarray, last: np.ndarray, form: np.ndarray) -> np.ndarray:
        """Of the bytes from ``first`` to the end of the string at ``last``, less than PLACES later."""
        return _mixed(_mixed(self.check(first), self.check(last)), form.astype(np.uint64))


def _blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, first byte of each piece, row of each, place of each in its text) of texts, about BLOCK bytes at once."""

    def joined(held):
        sizes = np.array([len(p) for _, _, p in held], np.int64)
        rows, bases = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
        return np.frombuffer(b"".join([p for _, _, p in held]), np.uint8), np.concatenate(([0], np.cumsum(sizes))), rows, bases

    held, size = [], 0
    for row, text in enumerate(raw(column)):
        for base in range(0, len(text or b"") - WINDOW + 1, BLOCK):
            held.append((row, base, text[base : base + BLOCK + WINDOW - 1]))
            size += len(held[-1][2])
            if size >= BLOCK:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def anchors(ids: Identifiers, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, anchor, first, last): the strings that start from ``first`` to ``last`` have that anchor.

    The anchor of a string is the gram with the least hash, the first of equals. ``starts`` are the first bytes of the
    pieces and the end of the last; strings do not reach across.
    """
    keys = ids.gram & ~_LOW | np.arange(len(ids.gram), dtype=np.uint64)
    size = 1
    while size < PLACES:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    at = (keys & _LOW).astype(np.int64)
    n = len(at)
    left = np.repeat(starts[1:], np.diff(starts))[:n] - np.arange(n)
    inside = left >= WINDOW
    same = inside[1:] & inside[:-1] & (at[1:] == at[:-1])
    first = np.flatnonzero(inside & ~np.concatenate(([False], same)))
    last = np.flatnonzero(inside & ~np.concatenate((same, [False])))
    return np.searchsorted(starts, first, "right") - 1, at[first], first, last


def _signed(ids: np.ndarray) -> pa.Array:
    return pa.array(ids.view(np.int64))


def _keys(df: DataFrame) -> list[str]:
    """The columns that name a text, of those of a table."""
    return [c for c in ("doc", "mark") if c in df.columns]


def _schema(df: DataFrame, carried: str = "") -> str:
    kinds = dict(df.dtypes)
    return f"bucket bigint, text bigint, {', '.join(f'{k} {kinds[k]}' for k in _keys(df))}, place bigint{carried}"


def _batch(bucket, text, keys: dict[str, pa.Array], place, **carried: pa.Array) -> pa.RecordBatch:
    """A batch of what _schema() names."""
    return pa.RecordBatch.from_pydict({"bucket": _signed(bucket), "text": _signed(text), **keys, "place": pa.array(place), **carried})


def _form() -> Column:
    return F.col("place").bitwiseAND((1 << FORM_BITS) - 1)


def _members(df: DataFrame) -> DataFrame:
    """(bucket, text, keys.., place): a row for each anchor of (keys.., text) rows.

    In ``text`` is the identifier of all bytes of the strings of the anchor. Where that stands earlier in the same piece
    the strings are known to be repeated: runs of them come out once, with their number and PLACES squared as the form.
    """
    keys = _keys(df)

    def found(batches):
        for batch in batches:
            for data, starts, rows, bases in _blocks(batch.column("text")):
                ids = Identifiers(data)
                piece, at, first, last = anchors(ids, starts)
                form = (at - first) * PLACES + (last - first)
                bucket, text = ids.gram[at], ids.text(first, last, form)
                key = _mixed(_mixed(bucket, text), piece.astype(np.uint64))
                order = np.argsort(key, kind="stable")
                known = np.zeros(len(key), bool)
                known[order[1:]] = key[order[1:]] == key[order[:-1]]
                goes_on = known[1:] & known[:-1] & (piece[1:] == piece[:-1])
                begins = np.flatnonzero(known & ~np.concatenate(([False], goes_on)))
                ends = np.flatnonzero(known & ~np.concatenate((goes_on, [False])))
                form[begins] = last[ends] - first[begins] + 1 + PLACES * PLACES
                chosen = np.flatnonzero(~known | np.isin(np.arange(len(known)), begins))
                bucket, text, form = bucket[chosen], text[chosen], form[chosen]
                passed = form >= PLACES * PLACES
                bucket[passed] = _mixed(text[passed], first[chosen][passed].astype(np.uint64))  # deals them out evenly
                own, piece = pa.array(rows[piece[chosen]]), piece[chosen]
                place = first[chosen] - starts[piece] + bases[piece]
                yield _batch(bucket, text, {k: batch.column(k).take(own) for k in keys}, place << FORM_BITS | form)

    return small_batches(df).mapInArrow(found, _schema(df))


def _runs_of(step: int, data: np.ndarray, starts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, bucket, text, first, last, form) of the next round: strings dealt by their distance to the anchor.

    Rows are the bytes of some strings of one anchor each, from ``starts`` on; first and last are places in them.
    """
    ids = Identifiers(data)
    round_ids = ids.round(step)
    gap, more = form // PLACES, form % PLACES
    anchor = starts + gap
    # The runs of a row: from that of its last string, which is next to the anchor, to that of its first.
    low_run = (gap - more) // step
    counts = gap // step - low_run + 1
    row = np.repeat(np.arange(len(form)), counts)
    place = (low_run[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    first = anchor[row] - np.minimum(gap[row], place + step - 1)
    last = anchor[row] - np.maximum(gap[row] - more[row], place)
    shape = (anchor[row] - first) * PLACES + (last - first)
    bucket = _mixed(round_ids[anchor[row] - place], place.astype(np.uint64))
    return row, bucket, ids.text(first, last, shape), first - starts[row], last - starts[row], shape


def _split(df: DataFrame, step: int) -> DataFrame:
    """(bucket, text, keys.., place, bytes) of the next round.

    Of (keys.., text, places) rows with the places of members, or of (keys.., place, bytes) rows of an earlier round.
    ``bytes`` are those of the strings, and are left out in the last round.
    """
    keys, low = _keys(df), (1 << FORM_BITS) - 1
    from_text = "places" in df.columns

    def pieces(batch):
        """(row, place, bytes) of each member."""
        if not from_text:
            yield from zip(range(batch.num_rows), *(batch.column(c).to_pylist() for c in ("place", "bytes")), strict=True)
            return
        for row, (text, places) in enumerate(zip(raw(batch.column("text")), batch.column("places"), strict=True)):
            for place in places.as_py():
                at = place >> FORM_BITS
                yield row, place, text[at : at + (place & low) % PLACES + WINDOW]

    def found(batches):
        for batch in batches:
            held, size = [], 0
            for piece in pieces(batch):
                held.append(piece)
                size += len(piece[2])
                if size >= BLOCK:
                    yield dealt(batch, held)
                    held, size = [], 0
            if held:
                yield dealt(batch, held)

    def dealt(batch, held):
        rows, places = (np.array([h[k] for h in held], np.int64) for k in range(2))
        joined = b"".join([h[2] for h in held])
        forms = places & low
        sizes = forms % PLACES + WINDOW
        starts = np.cumsum(sizes) - sizes
        row, bucket, text, first, last, form = _runs_of(step, np.frombuffer(joined, np.uint8), starts, forms)
        own = pa.array(rows[row])
        place = (places[row] >> FORM_BITS) + first << FORM_BITS | form
        carried = {}
        if step > 1:
            begin, end = (starts[row] + first).tolist(), (starts[row] + last + WINDOW).tolist()
            carried["bytes"] = pa.array([joined[a:b] for a, b in zip(begin, end, strict=True)], pa.binary())
        return _batch(bucket, text, {k: batch.column(k).take(own) for k in keys}, place, **carried)

    return small_batches(df).mapInArrow(found, _schema(df, ", bytes binary" if step > 1 else ""))


def _refined(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated strings, members that are to be refined) of the members of buckets.

    Members with equal texts repeat the first of them, by key and place. The first of each text goes on if its bucket
    holds other texts. Firsts are counted before the shuffle and joined back by equality, so that a bucket or a text
    of very many members is split.
    """
    here, carried = [*_keys(members), "place"], [c for c in members.columns if c == "bytes"]
    texts = members.groupBy("bucket", "text").agg(F.min(F.struct(*here, *carried)).alias("first"), F.count(F.lit(1)).alias("n"))
    texts = cut_lineage(texts, "zstd")
    firsts = texts.where("n > 1").select("bucket", "text", F.struct(*[F.col(f"first.{c}").alias(c) for c in here]).alias("first"))
    repeated = members.drop(*carried).join(firsts, ["bucket", "text"]).where(~F.struct(*here).eqNullSafe(F.col("first")))
    mixed = texts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    open_ = texts.join(mixed, "bucket", "left_semi").select("first.*")
    return repeated.select(*here, (_form() % PLACES + 1).alias("n")), open_


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of some ranges."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.concatenate(([True], starts[1:] > ends[:-1])) if len(starts) else np.zeros(0, bool)
    return starts[new], ends[np.concatenate((new[1:], [True]))] if len(starts) else ends


@by_arrow(pa.list_(_SPAN))
def _runs(listed: pa.Array) -> pa.Array:
    """Ranges as maximal runs."""
    values, sizes, starts, ends = listed.flatten(), [], [], []
    edges = np.concatenate(([0], np.cumsum(np.diff(listed.offsets.to_numpy()))))
    begin, end = (values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        first, last = _covered(begin[a:b], end[a:b])
        starts.append(first)
        ends.append(last)
        sizes.append(len(first))
    whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends)]
    rows = pa.StructArray.from_arrays([pa.array(x) for x in whole], fields=list(_SPAN))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int32)), rows)


def _cut(text: bytes | None, ranges: list[dict] | None) -> tuple[int, int, list[tuple[int, int]], bytes]:
    """(bytes, bytes removed, runs removed, what is left) of a text."""
    text = text or b""
    if not ranges:
        return len(text), 0, [], text
    starts, ends = (np.array([r[k] for r in ranges], np.int64) for k in ("start", "end"))
    spans = list(zip(*(x.tolist() for x in _covered(starts, ends)), strict=True))
    edges = [0, *(x for span in spans for x in span), len(text)]
    return len(text), sum(b - a for a, b in spans), spans, b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])


_DONE = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(_SPAN)), ("kept", pa.binary())])


@by_arrow(_DONE)
def _done(texts: pa.Array, ranges: pa.Array) -> pa.Array:
    rows = [_cut(t, r.as_py()) for t, r in zip(raw(texts), ranges, strict=True)]
    return pa.array([dict(zip(("n_bytes", "n_removed", "spans", "kept"), (n, m, [{"start": a, "end": b} for a, b in s], k), strict=True)) for n, m, s, k in rows], _DONE)


def repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, ranges) or, where keys are unique, (doc, ranges): for each text with bytes of repeated strings, the ranges of these bytes; see deduplicated().

    ``mark`` is that of _rows(). Ranges are runs within each part of about PART bytes and may overlap from part to part.
    """
    rows = _rows(df, key, text)
    keys = _keys(rows)
    members = _members(rows)
    often = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("bucket").alias("_bucket"))
    # A gram that stands once in all texts is in no repeated string.
    known = _form() >= PLACES * PLACES
    held = cut_lineage(members.join(often, F.col("bucket") == F.col("_bucket"), "left").where(F.col("_bucket").isNotNull() | known).drop("_bucket"), "zstd")
    found, some = _refined(held.where(~known))
    found = held.where(known).select(*keys, "place", (_form() - PLACES * PLACES).alias("n")).unionByName(found)
    lists = some.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.collect_list("place").alias("places"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    some = rows.join(lists, same).select(*keys, "text", "places")
    for step in STEPS:
        more, some = _refined(cut_lineage(_split(some, step), "zstd"))
        found = found.unionByName(more)
    start = F.shiftright("place", FORM_BITS)
    span = F.struct(start.alias("start"), (start + F.col("n") + (WINDOW - 1)).alias("end"))
    spans = found.select(*keys, (start / PART).cast("int").alias("part"), span.alias("span"))
    parts = spans.groupBy(*keys, "part").agg(_runs(F.collect_list("span")).alias("ranges"))
    return parts.groupBy(*keys).agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, mark, text): rows with their key and, where keys are not unique or null, a 64-bit hash of the text."""
    content = F.col(f"`{text}`").cast("string")
    rows = df.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(content).alias("mark"), content.alias("text"))
    clear = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc IS NULL").isEmpty()
    return rows.drop("mark") if clear else rows


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", into: str = "repeats") -> DataFrame:
    """All columns of ``df`` and the struct ``into``: n_bytes, n_removed, spans, kept.

    A byte of a text in UTF-8 is removed if a string of WINDOW bytes that covers it also starts earlier: in a text with
    a smaller key, or further left in the same text. ``spans`` are the maximal runs (start, end) of removed bytes,
    ``kept`` is what is left, as bytes, for a character may be cut apart. The column ``text`` stays as it is. Null texts
    count as empty; texts of less than WINDOW bytes keep all. Null keys are less than all others; texts with equal
    keys are put in order by a 64-bit hash. Rows with equal key and text are one text that is given more than once: they
    get equal results and none counts as earlier than the other. A column named ``into`` is replaced; an empty table
    gives no rows.

    Every string is looked at, however often it stands; equal strings are told by 128 bits.
    """
    found = repeats(df, key, text)
    names = {k: free_name(df, f"_{k}") for k in found.columns}
    found = found.withColumnsRenamed(names)
    content = F.col(f"`{text}`").cast("string")
    own = {"doc": df[f"`{key}`"], "mark": F.xxhash64(content)}
    same = reduce(Column.__and__, [own[k].eqNullSafe(found[names[k]]) for k in names if k in own])
    joined = small_batches(df).join(found, same, "left")
    return joined.withColumn(into, _done(content, F.col(names["ranges"]))).drop(*names.values())
