"""The corpus pipeline: documents go in, the token ids of the documents worth training on come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, pieces, quality, secrets, simhash
from tallyframe.llm.common import free_name, own
from tallyframe.plans.base import table
from tallyframe.session import cut_lineage


#: Words of the shortest benchmark items that are cut out of texts.
LEAST_ITEM = 5


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules keep.

    Each row is judged by itself: repeated rows stay or go together, null and empty texts go. Columns stay as they are.
    """
    verdict = free_name(docs, "verdict")
    return quality.rules(docs, into=verdict).where(f"{verdict}.kept").select(*own(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least key, null keys last.

    Of repeated rows one stays; null and empty texts are one group. Columns stay as they are; an empty table stays empty.
    """
    return simhash.deduplicated(docs)


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without passages of benchmark items; documents that mostly consist of such passages go.

    Items of fewer than LEAST_ITEM words, such as "yes" or "what is it", stand in ordinary texts and stay. Each row is
    judged by itself; null and empty texts stay as they are, and so does everything where there are no items.
    """
    found = decontaminate.cleaned(docs, table(spark, folder, "benchmark"), least_words=LEAST_ITEM)
    return _with_length(found).select(*own(docs))


def secret_scans(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with a mark in place of each secret.

    Each row is treated by itself; null and empty texts stay as they are. ``n_chars`` follows the text.
    """
    return _with_length(secrets.redacted(docs)).select(*own(docs))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, source, lang, ids, n_pieces, round_trip, nbest): the token ids, whether they decode to the text, and the best segmentations.

    ``nbest`` has (score, ids) of the pieces.BEST best segmentations of the text, ``ids`` being the first. Each row is
    encoded by itself; an empty text has no ids and no segmentations, a null text null in ids, number and segmentations.
    """
    model = pieces.load(pieces.public_model())
    code = free_name(docs, "code")
    found = pieces.encoded(docs, model, into=code)
    return found.select(
        "doc_id", "source", "lang", F.col(f"{code}.ids").alias("ids"), F.size(f"{code}.ids").cast("bigint").alias("n_pieces"),
        F.col(f"{code}.round_trip").alias("round_trip"), F.col(f"{code}.nbest").alias("nbest"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: SQL has neither zstandard nor a piece lattice; tests hold the rows against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read by the next.

    Rows with null, empty, long, equal and repeated texts fare as each stage says; an empty table gives no rows.
    """
    docs = table(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if not number else cut_lineage(docs), folder)
    return docs
