"""Definition files into tables, each file once: a file stream that runs until no new file is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import naming as n
from ..operators import layout
from ..session import cut_lineage
from . import readers
from .store import Store

Parts = dict[str, DataFrame]


def _unread(files: DataFrame, lists: str) -> DataFrame:
    """(file, reason) of the files that have no list at that place."""
    reason = F.when(F.col("document").isNull(), F.lit("malformed JSON")).when(F.try_variant_get("document", lists, "array<variant>").isNull(), F.lit("no list"))
    return files.select("file", reason.alias("reason")).where("reason is not null")


def extractions(files: DataFrame) -> Parts:
    """Extraction bundles: ``extraction`` and ``field``, by device family, and ``reject``."""
    rows = readers.extraction_rows(files).withColumn("family", F.coalesce(F.nullif(F.col("source.family"), F.lit("")), F.lit("unknown")))
    held = cut_lineage(rows)
    own = ["source", "message_name", F.col("seq").alias("place"), "protocol_version", "family"]
    bundles = files.where(" OR ".join(f"endswith(file, '{suffix}')" for suffix in readers.BUNDLE_SUFFIXES))
    return {"extraction": held.drop("fields"), "field": layout.field_table(held.select(*own, "fields")), "reject": _unread(bundles, "$.messages")}


def conversations(files: DataFrame) -> Parts:
    """A conversation store: ``extraction`` and ``field``, by device family of the manual, and ``reject``."""
    good, rejects = readers.conversation_rows(files)
    held = cut_lineage(good.withColumn("family", F.coalesce(n.manual_family("manual"), F.lit("unknown"))))
    own = ["manual", "message_name", "protocol_version", "family"]
    return {"extraction": held.drop("fields"), "field": layout.field_table(held.select(*own, "fields")), "reject": rejects}


def keys(files: DataFrame) -> Parts:
    """Key bundles: ``key``, ``value`` (of enumerations) and ``bit``."""
    rows = readers.key_rows(files)
    plain = [c for c in rows.columns if not c.startswith("_")]
    return {"key": rows.select(*plain), "value": readers.key_enum_items(rows), "bit": readers.key_bits(rows), "reject": _unread(files, "$.keys")}


def registry(files: DataFrame) -> Parts:
    """Registry files: ``message``, ``field``, ``bit`` and ``variant``."""
    rows = cut_lineage(readers.registry_rows(files))
    fields = readers.registry_fields(rows)
    return {"message": rows, "field": fields, "bit": readers.registry_bits(fields), "variant": readers.registry_variants(rows)}


def ingest(
    spark: SparkSession, path: str, table: str, checkpoint: str, parse: Callable[[DataFrame], Parts] = extractions, pattern="*.json",
    recursive=False, partition_by: tuple[str, ...] = ("family",), trigger=None,
):
    """Start a query that adds what ``parse`` makes of the files below ``path`` to the store at ``table``.

    The checkpoint knows the files that have been read, by name, so the next run reads new ones only; a file that is
    rewritten under its name is not read again. All tables of a micro-batch are one commit under its number, so a batch
    that is repeated adds nothing. Each row has the ``batch`` that brought it.
    """

    def add(batch: DataFrame, number: int) -> None:
        store = Store(batch.sparkSession, table)
        if store.state().holds((checkpoint, number)):
            return
        files = cut_lineage(batch.select("file", "folder", "stem", "text")).withColumn("document", F.try_parse_json("text"))
        parts = {name: rows.withColumn("batch", F.lit(number).cast("bigint")) for name, rows in parse(files).items()}
        by = {name: [c for c in partition_by if c in rows.columns] for name, rows in parts.items()}
        store.commit(parts, (checkpoint, number), append=True, partition_by={name: columns for name, columns in by.items() if columns})

    files = readers.documents(spark, path, pattern, recursive, stream=True).drop("document")
    writer = files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
