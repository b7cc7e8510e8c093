"""Substring dedup by sliding sentence spans: runs of consecutive sentences that stand elsewhere before are removed."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import by_arrow, free_name, raw, small_batches

#: A span is the shortest run of at least two sentences from its first on that has this many words.
SPAN_WORDS = 20
#: In each run of this many words within a sentence there is a cut after the word with the least hash, the last of
#: equals, so cuts depend on the words around them only and equal passages are cut alike. Cuts that lie REACH - 1 words
#: inside a passage are the same wherever it stands and at most REACH apart, so any passage of 4 * REACH + SPAN_WORDS - 3
#: words, 49, without line ends holds a whole span.
REACH = 8
#: Spans that a task gives at once.
BATCH = 100_000

_ENDS = np.isin(np.arange(256), list(b".!?"))
#: Characters of scripts without spaces between words (Chinese, Japanese, Thai, Lao, Burmese, Khmer) and full-width
#: forms: each is a word. Any other run without white space is one.
_SINGLE = rb"[\xe3-\xe9][\x80-\xbf]{2}|\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|\xef[\xa4-\xab\xbc-\xbe][\x80-\xbf]|\xf0[\xa0-\xaf][\x80-\xbf]{2}"
_SINGLES, _WORD = re.compile(_SINGLE), re.compile(rb"(?:" + _SINGLE + rb")|(?:(?!" + _SINGLE + rb")\S)+")
_FULL_ENDS = {c.encode() for c in "。！？．｡"}
_CLOSING = np.isin(np.arange(256), list(b"\"')]}"))


def _pattern(text: bytes) -> re.Pattern | None:
    """What finds the words of a text, none where white space parts them all."""
    return _WORD if _SINGLES.search(text) else None


class Sentences:
    """The words of a text, in lower case with one space between them, and the sentences that they make.

    A sentence ends after a word that ends with . ! or ?, after their full-width forms, at the end of a line, at a
    cut, and with the text.
    """

    def __init__(self, text: bytes | None):
        words, line_ends = [], []
        pattern = _pattern(text or b"")
        for line in (text or b"").lower().split(b"\n"):
            words += pattern.findall(line) if pattern else line.split()
            line_ends.append(len(words) - 1)
        n = len(words)
        self.joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        self.ends = np.cumsum(sizes + 1) - 1  # of the words, in bytes
        self.starts = self.ends - sizes
        if not n:
            self.firsts = self.lasts = np.zeros(0, np.int64)
            return
        data = np.frombuffer(self.joined, np.uint8)
        final = data[self.ends - 1]
        before = data[np.maximum(self.ends - 2, self.starts)]
        stop = _ENDS[final] | (_CLOSING[final] & _ENDS[before])
        stop[[i for i in line_ends if i >= 0]] = True
        stop[-1] = True
        if pattern:
            stop |= np.fromiter(map(_FULL_ENDS.__contains__, words), bool, n)
        stop |= self._cuts(words, stop)
        #: The first and the last word of each sentence.
        self.lasts = np.flatnonzero(stop)
        self.firsts = np.concatenate(([0], self.lasts[:-1] + 1))

    @staticmethod
    def _cuts(words: list[bytes], stop: np.ndarray) -> np.ndarray:
        """Words that are the least, the last of equals, of some REACH words within their sentence."""
        n = len(words)
        hashes = np.fromiter(map(zlib.crc32, words), np.int64, n)
        sentence = np.cumsum(stop) - stop
        earlier, later = np.zeros(n, np.int64), np.zeros(n, np.int64)
        left, right = np.ones(n, bool), np.ones(n, bool)
        for k in range(1, min(REACH, n)):
            same = sentence[k:] == sentence[:-k]
            left[:k] = right[n - k :] = False
            left[k:] &= same & (hashes[:-k] >= hashes[k:])
            right[: n - k] &= same & (hashes[k:] > hashes[: n - k])
            earlier += left
            later += right
        return earlier + later + 1 >= REACH

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) sentence of every span."""
        n = len(self.firsts)
        last = np.maximum(np.searchsorted(self.lasts, self.firsts + SPAN_WORDS - 1, "left"), np.arange(n) + 1)
        some = np.flatnonzero(last < n)
        return some, last[some]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """(first sentence, 128-bit hash as two numbers) of every span."""
        first, last = self.spans()
        places = zip(self.starts[self.firsts[first]].tolist(), self.ends[self.lasts[last]].tolist(), strict=True)
        digests = b"".join([xxhash.xxh3_128_digest(self.joined[a:b]) for a, b in places])
        return first, np.frombuffer(digests, "<i8").reshape(-1, 2)


def _spans(df: DataFrame) -> DataFrame:
    """(key, place, high, low) of every span of (key, text) rows; a place is the text's checksum and the sentence."""

    def found(batches):
        for batch in batches:
            keys, rows, places, bits, held = batch.column("key"), [], [], [], 0

            def gathered(keys, rows, places, bits):
                both = np.concatenate(bits)
                columns = [keys.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(places))]
                columns += [pa.array(both[:, 0]), pa.array((both[:, 1] >> 32).astype(np.int32))]
                return pa.RecordBatch.from_arrays(columns, ["key", "place", "high", "low"])

            for row, text in enumerate(raw(batch.column("text"))):
                first, mine = Sentences(text).hashes()
                rows.append(np.full(len(first), row))
                places.append(first + ((zlib.crc32(text) << 32) - (1 << 63)))
                bits.append(mine)
                held += len(first)
                if held >= BATCH:
                    yield gathered(keys, rows, places, bits)
                    rows, places, bits, held = [], [], [], 0
            if held:
                yield gathered(keys, rows, places, bits)

    return small_batches(df).select("key", "text").mapInArrow(found, f"key {dict(df.dtypes)['key']}, place bigint, high bigint, low int")


_CLEAN = pa.struct([("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64())])


def removed(text: bytes | None, firsts: list[int] | None) -> tuple[bytes | None, int, int]:
    """(text without the sentences of the spans that begin at ``firsts``, number of sentences, number removed)."""
    found = Sentences(text)
    if not firsts:
        return text, len(found.firsts), 0
    first, last = found.spans()
    edges = np.zeros(len(found.firsts) + 1, np.int64)
    chosen = np.isin(first, firsts)
    np.add.at(edges, first[chosen], 1)
    np.add.at(edges, last[chosen] + 1, -1)
    covered = np.cumsum(edges[:-1]) > 0
    # A sentence reaches from its first word to the first word of the next.
    begins = [m.start() for m in (_pattern(text) or re.compile(rb"\S+")).finditer(text)]
    cuts = [begins[i] for i in found.firsts.tolist()] + [len(text)]
    kept = [text[: cuts[0]], *(text[cuts[i] : cuts[i + 1]] for i in np.flatnonzero(~covered).tolist())]
    return b"".join(kept), len(found.firsts), int(covered.sum())


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", into: str = "spans") -> DataFrame:
    """All columns of ``df``, ``text`` without repeated spans, and the struct ``into``: n_sentences, n_removed.

    Of equal spans the one with the least key (null keys are less than all), and there the first, stays; every
    sentence covered by another goes, also where spans overlap. A text with less than two sentences or twenty
    words has no spans; null and empty texts stay as they are. Rows with equal key and text are one text that
    is repeated: they get equal results and none counts as a repetition of the other. A column of that name is
    replaced.
    """
    words = F.col(f"`{text}`").cast("string")
    spans = _spans(df.select(F.col(f"`{key}`").alias("key"), words.alias("text")).where("text is not null"))
    here = F.struct("key", "place")
    # Counted before the shuffle, so a span of a third of all texts arrives as a row of each task.
    repeated = spans.groupBy("high", "low").agg(F.min(here).alias("first"), F.max(here).alias("last")).where("first != last").select("high", "low", "first")
    others = spans.join(cut_lineage(repeated), ["high", "low"]).where(~here.eqNullSafe(F.col("first")))
    own = F.shiftright("place", 32) + (1 << 31)
    number, mark, starts = free_name(df, "_key"), free_name(df, "_text"), free_name(df, "_starts")
    marks = others.groupBy(F.col("key").alias(number), own.alias(mark)).agg(F.collect_set(F.col("place").bitwiseAND((1 << 32) - 1)).alias(starts))
    marks = cut_lineage(marks)
    same = df[f"`{key}`"].eqNullSafe(marks[number]) & (F.crc32(df[f"`{text}`"].cast("string").cast("binary")) == marks[mark])
    joined = df.join(marks, same, "left")

    @by_arrow(_CLEAN)
    def clean(texts: pa.Array, firsts: pa.Array) -> pa.Array:
        rows = [removed(t, f.as_py()) for t, f in zip(raw(texts), firsts, strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        return pa.StructArray.from_arrays([pa.array(columns[0], pa.binary()).cast(pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], fields=list(_CLEAN))

    found = joined.withColumn(mark, clean(words, F.col(starts)))
    done = F.struct(F.col(f"{mark}.n_sentences").alias("n_sentences"), F.col(f"{mark}.n_removed").alias("n_removed"))
    return found.withColumn(text, F.col(f"{mark}.text")).withColumn(into, done).drop(number, mark, starts)
