"""Toxicity by compression distance: windows are compressed with a dictionary of toxic and one of ordinary text.

A window is a word with a space on either side, in lower case. Windows that shrink more with the toxic
dictionary than with the ordinary one speak for toxic text, by a weight for each difference that is read off
the training rows; a logistic curve on their sum and on the largest difference gives the score.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import by_arrow, raw, remainder, small_batches, structs

#: The model is fitted on at most this many training rows of either label, the first by hash of the id, and on
#: at most this many characters of each, from a place drawn by hash. Weights and curve are read off more ordinary
#: rows than the dictionaries, as their rare words decide what is taken for toxic by mistake.
FIT_TOXIC, FIT_ORDINARY, FIT_CHARS = 2000, 4000, 16384
CALIBRATE_ORDINARY = 12_000
#: Windows of ordinary rows, evenly drawn, that the ordinary dictionary is trained on.
FIT_WINDOWS = 300_000
ORDINARY_BYTES, TOXIC_BYTES = 65536, 8192
#: Each byte is written as a code of four, so that lengths tell quarters of a letter's cost apart.
CODE_BYTES = 4
LEVEL, MIN_MATCH = 19, 4
GRAMS = (4, 6, 8)
#: A fragment is typical of toxic text when it is in at least this share of the toxic rows and this many times
#: as frequent there as in ordinary rows.
LEAST_SHARE, LEAST_LIFT = 0.005, 8.0
LARGEST = 24  # differences are counted from -LARGEST to LARGEST
THRESHOLD = 0.7
#: Lengths a task remembers.
REMEMBERED = 400_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CODES = [bytes(row) for row in np.random.default_rng(7).integers(0, 256, (256, CODE_BYTES), dtype=np.uint8)]


def windows(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def coded(window: bytes) -> bytes:
    return b"".join([_CODES[b] for b in window])


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    #: Weight of each difference, and the curve: constant, per unit of the sum, per unit of the largest.
    weights: list[float] = field(default_factory=lambda: [0.0] * (2 * LARGEST + 1))
    curve: list[float] = field(default_factory=lambda: [-30.0, 0.0, 0.0])
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


class Ruler:
    """Differences of compressed lengths with the two dictionaries of a model."""

    def __init__(self, model: Model):
        self.lengths = [self._length(model.ordinary), self._length(model.toxic)]
        self.known: dict[bytes, int] = {}

    @staticmethod
    def _length(content: bytes):
        dictionary = zstandard.ZstdCompressionDict(content)
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=256, dict_size=len(content), min_match=MIN_MATCH, write_checksum=0, write_content_size=0, write_dict_id=0
        )
        dictionary.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings).compress

    def difference(self, window: bytes) -> int:
        found = self.known.get(window)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            data = coded(b" " + window + b" ")
            ordinary, toxic = (len(length(data)) for length in self.lengths)
            found = self.known[window] = max(-LARGEST, min(LARGEST, ordinary - toxic))
        return found

    def histogram(self, text: bytes | None) -> np.ndarray:
        """How many windows have each difference, from -LARGEST on."""
        counts = Counter(windows(text))
        places = np.fromiter(map(self.difference, counts), np.int64, len(counts)) + LARGEST
        return np.bincount(places, np.fromiter(counts.values(), np.int64, len(counts)), 2 * LARGEST + 1)


_held: dict[str, Ruler] = {}


def _ruler(model: Model) -> Ruler:
    if model.key not in _held:
        _held.clear()
        _held[model.key] = Ruler(model)
    return _held[model.key]


def _training(documents: DataFrame, labels: DataFrame, key: str, text: str, learn: Column) -> DataFrame:
    """The bounded sample (piece, toxic, fit): at most FIT_TOXIC + CALIBRATE_ORDINARY rows of FIT_CHARS characters."""
    marks = labels.where("toxic in (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    ids = documents.where(learn).select(F.col(f"`{key}`").alias("_id")).distinct().join(marks, "_id")
    order = [F.xxhash64("_id"), F.col("_id")]
    first = lambda label, most: ids.where(F.col("toxic") == label).orderBy(*order).limit(most)
    fit = first(1, FIT_TOXIC).union(first(0, FIT_ORDINARY)).withColumn("fit", F.lit(True))
    chosen = cut_lineage(first(1, FIT_TOXIC).union(first(0, CALIBRATE_ORDINARY)).join(F.broadcast(fit.select("_id", "fit")), "_id", "left"))
    words = F.col(f"`{text}`").cast("string")
    start = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit(1)), F.greatest(F.char_length(words) - FIT_CHARS, F.lit(1)))
    piece = F.when(F.char_length(words) <= FIT_CHARS, words).otherwise(F.substring(words, start.cast("int") + 1, F.lit(FIT_CHARS)))
    rows = documents.where(words.isNotNull()).select(F.col(f"`{key}`").alias("_id"), piece.alias("piece"))
    # The chosen ids are bounded by the limits.
    rows = rows.join(F.broadcast(chosen), "_id").select(F.xxhash64("_id").alias("order"), "piece", "toxic", F.coalesce("fit", F.lit(False)).alias("fit"))
    return cut_lineage(rows.orderBy("order", "piece").limit(FIT_TOXIC + CALIBRATE_ORDINARY))


def _grams(word: bytes):
    word = b" " + word + b" "
    return ((i, word[i : i + n]) for n in GRAMS for i in range(len(word) - n + 1))


def _fragments(rows: list[tuple[bytes, int]]) -> Counter:
    """Stretches of words in toxic rows that consist of fragments typical of them, with their numbers."""
    seen = {0: Counter(), 1: Counter()}
    total = Counter(label for _, label in rows)
    for text, label in rows:
        seen[label].update({g for w in set(windows(text)) for _, g in _grams(w)})
    least = max(2, LEAST_SHARE * total[1])
    typical = {g for g, n in seen[1].items() if n >= least and n / total[1] * total[0] >= LEAST_LIFT * (seen[0][g] + 0.5)}
    out: Counter = Counter()
    for text, label in rows:
        if label:
            for w, n in Counter(windows(text)).items():
                covered = bytearray(len(w) + 2)
                for i, g in _grams(w):
                    if g in typical:
                        covered[i : i + len(g)] = b"\1" * len(g)
                if any(covered):
                    kept = bytes(b if c else 0 for b, c in zip(b" " + w + b" ", covered, strict=True))
                    for part in filter(None, kept.split(b"\0")):
                        out[part] += n
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples: they are the dictionary
        return b"".join(samples)[-size:]


def fit(documents: DataFrame, labels: DataFrame, key: str, text: str, learn: Column) -> Model:
    """A model of the training rows; one that scores next to 0 everywhere if a label has none.

    Null texts and keys without a label of 0 or 1 are not learnt from; a key with both labels is toxic. Rows are chosen by
    the hash of their key; repeated rows of a chosen key count each, up to the bound of rows. Other columns are not read.

    The toxic dictionary is the one of ordinary text followed by the fragments typical of toxic text, the most
    frequent last: both then shrink ordinary words alike, and lengths differ where such fragments stand.
    """
    sample = _training(small_batches(documents), labels, key, text, learn)
    rows = [(r.piece.encode(), r.toxic) for r in sample.where("fit").orderBy("order", "piece").collect()]
    if len({label for _, label in rows}) < 2:
        return Model()
    words = [w for t, label in rows if not label for w in windows(t)]
    step = max(1, len(words) // FIT_WINDOWS)
    ordinary = _dictionary([coded(b" " + w + b" ") for w in words[::step]], ORDINARY_BYTES)
    fragments = sorted(_fragments(rows).items(), key=lambda x: (-x[1], x[0]))
    content, size = [], 0
    for fragment, _ in fragments:
        if (size := size + CODE_BYTES * len(fragment)) > TOXIC_BYTES:
            break
        content.append(coded(fragment))
    model = Model(ordinary, ordinary + b"".join(reversed(content)))
    _calibrate(model, sample)
    return model


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Weights and curve from the sample, whose windows are measured in tasks."""
    spark = sample.sparkSession
    held = spark.sparkContext.broadcast(vars(model))

    @by_arrow(pa.list_(pa.int64()))
    def measured(texts: pa.Array) -> pa.Array:
        ruler = _ruler(Model(**held.value))
        return pa.array([ruler.histogram(t).astype(int).tolist() for t in raw(texts)], pa.list_(pa.int64()))

    dealt = sample.repartition(max(8, spark.sparkContext.defaultParallelism))
    found = dealt.select(measured("piece").alias("counts"), F.col("toxic").alias("label"), "order").orderBy("order", "label").collect()
    counts, labels = np.array([r.counts for r in found], float), np.array([r.label for r in found], float)
    shares = [(counts[labels == y].sum(0) + 0.5) / (counts[labels == y].sum() + 0.5 * counts.shape[1]) for y in (0, 1)]
    weights = np.log(shares[1] / shares[0])
    # A greater difference never weighs less: single windows of rare differences say little.
    weights[LARGEST:] = np.maximum.accumulate(weights[LARGEST:])
    model.weights = weights.tolist()
    model.curve = _logistic(np.array([_features(c, weights) for c in counts]), labels).tolist()
    model.key = uuid.uuid4().hex


def _features(counts: np.ndarray, weights: np.ndarray) -> tuple[float, float, float]:
    some = np.flatnonzero(counts)
    largest = float(max(0, some[-1] - LARGEST)) if len(some) else 0.0
    return 1.0, float(np.clip(counts @ weights, -20, 20)) / 4, largest / 4


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's steps."""
    curve = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        gradient = x.T @ (y - p) - penalty * curve
        move = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty * np.eye(len(curve)), gradient)
        curve += np.clip(move, -3, 3)
    return curve


_SCORED = pa.struct([("score", pa.float64()), ("largest", pa.int64()), ("n_windows", pa.int64())])


def score(df: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """All columns of ``df`` and the struct ``into``: score (0 to 1), largest difference, n_windows, predicted.

    Every window of each whole text is measured. A null text counts as an empty one, whose score is that of a
    row without windows. Rows are scored one by one, so repeated rows get equal results. A column of that name
    is replaced.
    """
    held = df.sparkSession.sparkContext.broadcast(vars(model))

    @by_arrow(_SCORED)
    def scored(texts: pa.Array) -> pa.Array:
        model, rows = Model(**held.value), []
        if not model.ordinary:
            return structs(_SCORED, [(0.0, 0, len(windows(t))) for t in raw(texts)])
        ruler, weights = _ruler(model), np.array(model.weights)
        for t in raw(texts):
            counts = ruler.histogram(t)
            features = _features(counts, weights)
            z = sum(a * b for a, b in zip(model.curve, features, strict=True))
            rows.append((1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), int(4 * features[2]), int(counts.sum())))
        return structs(_SCORED, rows)

    found = small_batches(df).withColumn(into, scored(F.col(f"`{text}`").cast("string")))
    predicted = (F.col(f"{into}.score") >= THRESHOLD).cast("int").alias("predicted")
    return found.withColumn(into, F.struct(f"{into}.score", f"{into}.largest", f"{into}.n_windows", predicted))


def held_out(key: Column) -> Column:
    """Rows that are not learnt from: crc32 of the key as text leaves 1 modulo 3, or there is no key."""
    return F.coalesce(remainder(key, 3) == 1, F.lit(True))
