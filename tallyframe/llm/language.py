"""Language identification by nearest centroid: TF-IDF vectors of hashed n-grams, several centroids a language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import by_arrow, free_name, raw, remainder, small_batches, structs

BUCKETS = 1 << 13
#: Lengths of n-grams, in UTF-8 bytes.
SIZES = (2, 3)
CENTROIDS = 4
ROUNDS = 12
#: Centroids are clustered on at most this many training rows of a language, the first by hash of the id. The
#: document frequencies behind the IDF are counted over all training rows.
FIT_ROWS = 1500
#: Shares by which the ids of a language are ranked first.
RANK_SHARES = 64
#: Languages whose centroids the driver and each task hold at once; more are learnt and scored in blocks.
LANGUAGES = 200
#: A text less similar than this to every centroid is rejected.
LEAST_SIMILARITY = 0.15
#: Texts are hashed in stretches of this many bytes.
STRETCH = 1 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def counts(text: bytes) -> np.ndarray:
    """How often each bucket's n-grams occur, words apart from each other by one space."""
    data = np.frombuffer(b" " + b" ".join(text.translate(_FOLD).split()) + b" ", np.uint8)
    out = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(data), STRETCH):
        part = data[start : start + STRETCH + max(SIZES) - 1].astype(np.uint32)
        for size in SIZES:
            n = min(len(part) - size + 1, STRETCH)
            if n <= 0:
                continue
            code = part[:n].copy()
            for k in range(1, size):
                code = (code << np.uint32(8)) | part[k : k + n]
            hashed = (code * np.uint32(2654435761) + np.uint32(size * 40503)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            out += np.bincount(hashed, minlength=BUCKETS)
    return out


def vector(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The TF-IDF vector of length 1 (all zero without n-grams); counts are damped by their logarithm."""
    weights = np.where(found > 0, 1 + np.log(np.maximum(found, 1)), 0) * idf
    norm = np.linalg.norm(weights)
    return (weights / norm if norm else weights).astype(np.float32)


def has_letter(text: bytes | None) -> bool:
    return text is not None and _LETTER.search(text.decode()) is not None


@dataclass
class Model:
    """The centroids of the first LANGUAGES languages in order of their names, and further blocks of them as tables."""

    languages: list[str] = field(default_factory=list)  # of each centroid
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS), np.float32))
    idf: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    further: list[DataFrame] = field(default_factory=list)

    def blocks(self) -> Iterator[Model]:
        """Models without further blocks, one loaded at a time."""
        yield Model(self.languages, self.centroids, self.idf)
        for rows in self.further:
            yield _loaded(rows, self.idf)


def clustered(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Up to ``k`` centroids by spherical k-means, begun at vectors far from each other; the same for any run."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        far = int(np.argmin(nearest))
        if nearest[far] > 0.999:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, vectors @ vectors[far])
    centroids = vectors[chosen]
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[own == i].sum(0) if (own == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids.astype(np.float32)


def _idf(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Inverse document frequencies over all rows: each batch is summed up before the shuffle."""

    def summed(batches):
        for batch in batches:
            found = np.zeros(BUCKETS, np.int64)
            for t in raw(batch.column(0)):
                found += counts(t) > 0
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(found[some], batch.num_rows), pa.int64())], ["bucket", "n"])

    totals = rows.mapInArrow(summed, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS + 1 rows at most
    seen = {r.bucket: r.n for r in totals}
    n = seen.pop(-1, 0)
    idf = np.full(BUCKETS, np.log(n + 1.0) + 1)
    for bucket, number in seen.items():
        idf[bucket] = np.log((n + 1) / (number + 1)) + 1
    return idf, n


def _loaded(rows: DataFrame, idf: np.ndarray) -> Model:
    found = rows.orderBy("lang", "n").collect()  # LANGUAGES * CENTROIDS rows at most
    return Model([r.lang for r in found], np.stack([np.frombuffer(r.centroid, np.float32) for r in found]), idf)


def fit(df: DataFrame, key: str, text: str, lang: str, learn: Column) -> Model:
    """Centroids of the rows for which ``learn`` holds, with a language, a key and a letter in the text.

    Null and empty texts and null languages are not learnt from; null keys are one key. Of a repeated key of a language one
    row counts, that of the least hash of its text, the document frequencies count every row. Equal hashes are ordered by
    key. Other columns are not read. Without a usable row the model knows no language.
    """
    spark = df.sparkSession
    words, language = F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string")
    usable = small_batches(df).where(learn & words.rlike(r"\p{L}") & language.isNotNull())
    idf, n = _idf(usable.select(words.alias("text")))
    if not n:
        return Model()
    named = usable.select(F.col(f"`{key}`").alias("_id"), language.alias("_lang"), words.alias("text"))
    # Only ids are ranked, each once: first within shares of a language, which drop those beyond the bound, so that the
    # second ranking has RANK_SHARES * FIT_ROWS ids of a language at most. Of an id that is repeated one row is kept, by
    # the hash of its text, combined before the shuffle.
    ids = named.groupBy("_id", "_lang").agg(F.min(F.xxhash64("text")).alias("_hash"))
    ids = ids.withColumn("_order", F.xxhash64("_id")).withColumn("_share", F.pmod(F.xxhash64("_order"), F.lit(RANK_SHARES)))
    for by in (["_lang", "_share"], ["_lang"]):
        ids = ids.withColumn("_rank", F.row_number().over(W.partitionBy(*by).orderBy("_order", "_id"))).where(F.col("_rank") <= FIT_ROWS)
    # Written, as its size is bounded: Spark then knows it before it deals out the texts.
    chosen = cut_lineage(ids.select("_id", "_lang", "_hash"))
    sample = named.withColumn("_hash", F.xxhash64("text")).join(chosen, ["_id", "_lang", "_hash"], "left_semi")
    sample = sample.groupBy("_id", "_lang").agg(F.min("text").alias("text"))
    held = spark.sparkContext.broadcast(idf)

    @by_arrow(pa.binary())
    def vectors(texts: pa.Array) -> pa.Array:
        return pa.array([vector(counts(t), held.value).astype(np.float16).tobytes() for t in raw(texts)], pa.binary())

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_order", "vector"]).head(FIT_ROWS)
        found = clustered(np.stack([np.frombuffer(v, np.float16) for v in group["vector"]]).astype(np.float32))
        return pd.DataFrame({"lang": group["_lang"].iloc[0], "n": range(len(found)), "centroid": [c.tobytes() for c in found]})

    grouped = sample.select("_lang", F.xxhash64("_id").alias("_order"), vectors("text").alias("vector")).groupBy("_lang")
    rows = cut_lineage(grouped.applyInPandas(centroids, "lang string, n int, centroid binary"))
    # Every LANGUAGES-th name begins a block.
    names = W.orderBy("lang")
    edges = [r.lang for r in rows.select("lang").distinct().withColumn("_place", F.row_number().over(names)).where(F.col("_place") % LANGUAGES == 1 % LANGUAGES).orderBy("lang").collect()]
    parts = [rows.where((F.col("lang") >= a) & (F.col("lang") < b if b is not None else F.lit(True))) for a, b in zip(edges, [*edges[1:], None], strict=True)]
    model = _loaded(parts[0], idf)
    model.further = parts[1:]
    return model


_FOUND = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("nearest", pa.string()), ("rejected", pa.bool_())])


def predict(df: DataFrame, model: Model, text: str = "text", into: str = "language", least: float = LEAST_SIMILARITY) -> DataFrame:
    """All columns of ``df`` and the struct ``into``: lang, score, nearest, rejected.

    ``nearest`` is the language of the centroid with the greatest cosine similarity to the whole text, the
    first in order of equals, and ``score`` that similarity; ``lang`` is the same unless the text is rejected
    for a similarity below ``least``, then it is ``und``. A null text, one without a letter, and any text
    where nothing was learnt get ``und`` in both with score 0. Rows are judged one by one. A column of that
    name is replaced.
    """
    df, best = small_batches(df).drop(into), free_name(df, "_best")
    for number, block in enumerate(model.blocks()):
        now = _scorer(df.sparkSession, block, least)(F.col(f"`{text}`").cast("string"))
        if not number:
            df = df.withColumn(into, now)
            continue
        # Names of later blocks come after those of earlier ones, which stay the first of equals.
        df = cut_lineage(df).withColumn(best, now)
        df = df.withColumn(into, F.when(F.col(best)["score"] > F.col(into)["score"], F.col(best)).otherwise(F.col(into))).drop(best)
    return df


def _scorer(spark, model: Model, least: float):
    held = spark.sparkContext.broadcast({"languages": model.languages, "centroids": model.centroids, "idf": model.idf})

    @by_arrow(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        model, rows = Model(**held.value), []
        for t in raw(texts):
            if not model.languages or not has_letter(t):
                rows.append(("und", 0.0, "und", True))
                continue
            similar = model.centroids @ vector(counts(t), model.idf)
            best = int(np.argmax(similar))
            score = float(min(1.0, max(0.0, similar[best])))
            name = model.languages[best]
            rows.append((name if score >= least else "und", score, name, score < least))
        return structs(_FOUND, rows)

    return found


def held_out(key: Column) -> Column:
    """Rows that are not learnt from: crc32 of the key as text leaves 2 modulo 4, or there is no key."""
    return F.coalesce(remainder(key, 4) == 2, F.lit(True))
