"""Benchmark decontamination with a generalised suffix automaton of the normalised test items."""

from __future__ import annotations

import math
import re
import uuid
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from ..session import cut_lineage
from .common import by_arrow, free_name, raw, small_batches, structs

WINDOW = 10
#: Words of test items that one automaton holds. More items are worked through in blocks of about this size.
BLOCK_WORDS = 1 << 20
#: Longer items are cut into overlapping pieces with the same windows, so that blocks stay near their size.
PIECE_WORDS = 1 << 16
#: A document of which more than this share of words is hit goes as a whole; else its hit spans go.
MAX_COVERAGE = 0.5

#: A-Z become a-z, other ASCII characters that are no letter or digit become spaces; all else is part of words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_HITS = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])
_PIECE = pa.struct([("words", pa.binary()), ("n", pa.int64())])
_STATE = pa.struct([("text", pa.string()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("changed", pa.bool_())])


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Every run of words of every item is a path from state 0; a state stands for the runs that end alike."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: Items whose words pass through a state; before spread() only at the states of their own prefixes.
        self.items: list[set] = [set()]
        self.whole: dict[int, set] = {}  # items shorter than a window, by the state of the whole item
        self.shortest = window
        for name, words in items:
            if not words:
                continue
            state, ids = 0, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            for i in ids:
                state = self._extend(state, i)
                self.items[state].add(name)
            if len(ids) < window:
                self.shortest = min(self.shortest, len(ids))
        for name, words in items:
            if 0 < len(words) < window:
                state = 0
                for w in words:
                    state = self.next[state][self.vocabulary[w]]
                self.whole.setdefault((state, len(words)), set()).add(name)
        self._spread()
        self.whole_at: dict[int, list[int]] = {}
        for state, size in self.whole:
            self.whole_at.setdefault(state, []).append(size)

    def _extend(self, last: int, word: int) -> int:
        """The state of the run so far with one word more; ``last`` is the state of the run so far."""
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, word, known)
        state = self._add(self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
            return state
        known = self.next[at][word]
        self.link[state] = known if self.length[known] == self.length[at] + 1 else self._clone(at, word, known)
        return state

    def _add(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.items.append(set())
        return len(self.link) - 1

    def _clone(self, at: int, word: int, known: int) -> int:
        """Split off the shorter runs of ``known`` that are reached from ``at``."""
        twin = self._add(self.length[at] + 1)
        self.next[twin] = dict(self.next[known])
        self.link[twin] = self.link[known]
        self.link[known] = twin
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = twin
            at = self.link[at]
        return twin

    def _spread(self) -> None:
        """Give each state with runs of a window's length the items of all states below it."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            above = self.link[state]
            if self.length[above] >= self.window:
                self.items[above] |= self.items[state]
            if self.length[state] < self.window:
                self.items[state] = set()

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Runs of hit words as (first, end), in order and apart, and the items with occurring windows."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        spans: list[list[int]] = []
        items: set = set()
        # Words that no item has lead back to state 0, so only runs of known words are walked.
        for first, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - first >= self.shortest:
                self._walk(ids[first:end].tolist(), first, spans, items)
        return [(a, b) for a, b in spans], items

    def _walk(self, ids: list[int], first: int, spans: list[list[int]], items: set) -> None:
        following, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for place, word in enumerate(ids, first + 1):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            size = 0
            if matched >= window:
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                items |= self.items[at]
                size = window
            if self.whole:
                at = state
                while at > 0:
                    for short in self.whole_at.get(at, ()):
                        if short <= matched:
                            items |= self.whole[at, short]
                            size = max(size, short)
                    at = link[at]
            if size:
                start = place - size
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, place])


_held: dict[str, Automaton] = {}


def _automaton(key: str, items, window: int) -> Automaton:
    """The automaton of a block, built once in each task."""
    if key not in _held:
        _held.clear()
        _held[key] = Automaton([(name, words.split()) for name, words in items], window)
    return _held[key]


class Blocks:
    """The normalised items, dealt by hash into blocks of about ``block_words`` words.

    The driver and each task hold one block at a time.
    """

    def __init__(self, benchmark: DataFrame, item: str, text: str, window: int, block_words: int, least_words: int = 1):
        @by_arrow(pa.list_(_PIECE))
        def cut(texts: pa.Array) -> pa.Array:
            rows = []
            for t in raw(texts):
                words = normal_words(t or b"")
                starts = range(0, max(1, len(words) - window + 1), PIECE_WORDS - window + 1)
                parts = [words[s : s + PIECE_WORDS] for s in starts]
                rows.append([{"words": b" ".join(p), "n": len(p)} for p in parts if p])
            return pa.array(rows, pa.list_(_PIECE))

        named = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
        pieces = named.select("item", F.explode(cut("text")).alias("piece")).select("item", "piece.words", "piece.n").distinct()
        self.window, self.pieces = window, cut_lineage(pieces.where(F.col("n") >= min(least_words, window)))
        words = self.pieces.agg(F.sum("n")).first()[0] or 0
        self.count = max(1, math.ceil(words / block_words))

    def load(self, spark, block: int):
        """A function, for use in tasks, that gives the automaton of a block."""
        mine = F.pmod(F.xxhash64("item", "words"), F.lit(self.count)) == block
        rows = [(r.item, bytes(r.words)) for r in self.pieces.where(mine).select("item", "words").collect()]
        held, key, window = spark.sparkContext.broadcast(rows), uuid.uuid4().hex, self.window
        return lambda: _automaton(key, held.value, window)


def _marker(load):
    @by_arrow(_HITS)
    def marks(texts: pa.Array) -> pa.Array:
        automaton, rows = load(), []
        for t in raw(texts):
            words = normal_words(t or b"")
            spans, items = automaton.hits(words)
            rows.append({"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items - {None})})
        return pa.array(rows, _HITS)

    return marks


def _cleaner(load):
    @by_arrow(_STATE)
    def clean(texts: pa.Array) -> pa.Array:
        automaton, rows = load(), []
        for t in raw(texts):
            words = normal_words(t or b"")
            total, hit, (spans, _) = len(words), 0, automaton.hits(words)
            while spans:
                hit += sum(b - a for a, b in spans)
                t = cut_words(t, spans)
                spans, _ = automaton.hits(normal_words(t))
            rows.append((None if t is None else t.decode(), total, hit, hit > 0))
        return structs(_STATE, rows)

    return clean


def find(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
    into: str = "hits",
) -> DataFrame:
    """All columns of ``df`` and the struct ``into``: n_words, spans, items.

    Spans are the runs of words inside an occurrence of a window of any item, as places of words, end
    exclusive; items are the ids, as strings in order, of the items with such windows. A window is ``window``
    consecutive words of an item, or a shorter item as a whole. A null or empty text has no words and no hits;
    an item without words is never hit, one without an id counts for spans only, and items that share an id
    are one item. Each row is streamed by itself, so repeated rows get equal results. A benchmark too large
    for one automaton is worked through in blocks, each pass writing its rows to the shared folder. A column
    of that name is replaced.
    """
    blocks = Blocks(benchmark, item, item_text, window, block_words)
    df, other = small_batches(df).drop(into), free_name(df, "_hits")
    for block in range(blocks.count):
        load = blocks.load(df.sparkSession, block)

        now = _marker(load)(F.col(f"`{text}`").cast("string"))
        if not block:
            df = df.withColumn(into, now)
            continue
        df = cut_lineage(df).withColumn(other, now)
        items = F.array_sort(F.array_distinct(F.concat(f"{into}.items", f"{other}.items")))
        spans = _united(F.concat(f"{into}.spans", f"{other}.spans"))
        df = df.withColumn(into, F.struct(f"{into}.n_words", spans.alias("spans"), items.alias("items"))).drop(other)
    return df


def _united(spans):
    """Overlapping and touching spans as one."""

    def add(done, span):
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        before = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(last["end"] >= span["start"], F.concat(before, F.array(grown))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start: bigint, end: bigint>>"), add)


def n_hit(hits: str = "hits"):
    """The number of hit words."""
    return F.aggregate(F.col(f"{hits}.spans"), F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the stretches from the first to the last word of each span."""
    firsts, lasts = {a for a, _ in spans}, {b - 1 for _, b in spans}
    out, done = [], 0
    for place, word in enumerate(re.finditer(rb"[^ ]+", text.translate(_FOLD))):
        if place in firsts:
            out.append(text[done : word.start()])
        if place in lasts:
            done = word.end()
    return b"".join([*out, text[done:]])


def cleaned(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS, least_words: int = 1,
) -> DataFrame:
    """``df`` without the hit spans of its texts, and without rows of which more than ``max_coverage`` of the words are hit.

    What is left of a text is scanned again until nothing is hit, as the words around a removed span meet.
    Null texts and texts without hits stay as they are. Items of fewer than ``least_words`` words, a window at most,
    are left in the texts and count for nothing here. Rows are treated one by one, so repeated rows stay equal; columns
    keep their names. An empty table gives no rows, and without items nothing changes.
    """
    blocks = Blocks(benchmark, item, item_text, window, block_words, least_words)
    state, latest = free_name(df, "_state"), free_name(df, "_latest")
    df = small_batches(df).withColumn(state, F.lit(None).cast(from_arrow_type(_STATE)))
    again = True
    while again:
        for block in range(blocks.count):
            load = blocks.load(df.sparkSession, block)

            before, now = F.col(state), F.col(latest)
            df = df.withColumn(latest, _cleaner(load).asNondeterministic()(F.coalesce(before["text"], F.col(f"`{text}`").cast("string"))))
            df = df.withColumn(state, F.struct(
                now["text"].alias("text"), F.coalesce(before["n_words"], now["n_words"]).alias("n_words"),
                (F.coalesce(before["n_hit"], F.lit(0)) + now["n_hit"]).alias("n_hit"), (now["changed"] | (before["changed"] if block else F.lit(False))).alias("changed"),
            )).drop(latest)
            if blocks.count > 1:
                df = cut_lineage(df)
        # With one automaton each text has been cleaned to the end in its own task.
        again = blocks.count > 1 and not df.where(F.col(state)["changed"]).isEmpty()
    kept = F.col(state)["n_hit"] <= max_coverage * F.col(state)["n_words"]
    return df.where(kept).withColumn(text, F.col(state)["text"]).drop(state)
