"""Incremental consensus over a stream of new sources, with its state in a log.

A batch appends the entities that it changes and the members it adds, nothing else; readers take the newest row of each
entity. When the rows appended since the last compaction outnumber those it left, the log is merged, so a row is rewritten
a number of times that grows with the logarithm of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import skew, vote
from ..session import cut_lineage
from ..sources.store import Conflict, State, Store

_STATE = ["fingerprint", "agreement_count", "total_count", "confidence", "confidence_score"]
_MEMBER = ["source", "agrees", "fingerprint"]


def _schemas(new: T.StructType, entity, source: str, value: str) -> dict[str, T.StructType]:
    keys = [T.StructField(k, new[k].dataType) for k in entity]
    written = T.StructField("batch", T.LongType())
    canonical = T.StructType([
        *keys, T.StructField("fingerprint", new[value].dataType), T.StructField("agreement_count", T.LongType()),
        T.StructField("total_count", T.LongType()), T.StructField("confidence", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()), written,
    ])
    members = T.StructType([
        *keys, T.StructField("source", new[source].dataType), T.StructField("agrees", T.BooleanType()),
        T.StructField("fingerprint", new[value].dataType), written,
    ])
    return {"canonical": canonical, "members": members}


def _bucket(entity, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*entity), F.lit(buckets)).cast("int")


def _newest(log: DataFrame, entity) -> DataFrame:
    """The row of each entity that was written last."""
    rows = log.groupBy(*entity).agg(F.max_by(F.struct(*_STATE, "batch"), "batch").alias("_r"))
    return rows.select(*entity, "_r.*")


def _commit(store: Store, parts: dict[str, DataFrame], entity, buckets: int, **how) -> State:
    dealt = {name: rows.withColumn("bucket", _bucket(entity, buckets)).repartition("bucket") for name, rows in parts.items()}
    return store.commit(dealt, partition_by=dict.fromkeys(parts, ["bucket"]), **how)


def _grown(state: State) -> bool:
    """Whether the rows since the last compaction outnumber those it left."""
    rows = state.rows("canonical")
    return len(rows) > 1 and sum(rows[1:]) > rows[0]


def compact(spark: SparkSession, table: str, entity, buckets=64, keep=1, older_than_ms=3_600_000) -> None:
    """Merge the log into one row per entity, and remove the files that none of the newest ``keep`` commits holds.

    Where another batch is committed meanwhile the log stays as it is.
    """
    store = Store(spark, table)
    state = store.state()
    canonical = _newest(store.read("canonical", state=state), entity)
    members = store.read("members", state=state).drop("bucket")
    try:
        _commit(store, {"canonical": canonical, "members": members}, entity, buckets, after=state.version)
    except Conflict:
        return
    store.clear(keep, older_than_ms)


def consensus(
    stream: DataFrame, table: str, checkpoint: str, entity, source: str, value: str, order, compat=True, trigger=None, buckets=64,
    older_than_ms=3_600_000,
):
    """Start a query that folds each micro-batch into the state below ``table``.

    State is partitioned by ``buckets`` of entities, so a batch reads the partitions that its entities are in. A
    batch is committed under its number, and one that is repeated finds itself in the log and writes nothing.
    """
    schemas = _schemas(stream.schema, entity, source, value)
    entity = list(entity)

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        store = Store(spark, table)
        state, writer = store.state(), (checkpoint, number)
        if state.holds(writer):
            return
        touched = cut_lineage(batch.select(*entity).distinct())
        numbers = [r[0] for r in touched.select(_bucket(entity, buckets)).distinct().collect()]  # ``buckets`` rows at most
        if not numbers:
            return

        def held(part: str) -> DataFrame:
            if part not in state.parts:
                return spark.createDataFrame([], schemas[part])
            log = store.read(part, state=state).where(F.col("bucket").isin(numbers)).drop("bucket")
            return skew.null_safe_join(log, touched, entity, "left_semi")

        canonical = cut_lineage(_newest(held("canonical"), entity)).drop("batch")
        members = held("members").drop("batch")
        added = cut_lineage(vote.new_members(members, canonical, batch, entity, source, value, order))
        changed = skew.null_safe_join(canonical, added.select(*entity).distinct(), entity, "left_semi")
        now = F.lit(number).cast("bigint")
        parts = {
            "canonical": vote.fold(changed, added, entity, order, compat).select(*entity, *_STATE, now.alias("batch")),
            "members": added.select(*entity, *_MEMBER, now.alias("batch")),
        }
        if _grown(_commit(store, parts, entity, buckets, batch=writer, append=True)):
            compact(spark, table, entity, buckets, older_than_ms=older_than_ms)

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def latest(spark: SparkSession, table: str, kind: str = "canonical", entity=None, version: int | None = None) -> DataFrame:
    """The state after the last batch, or as of a version: ``canonical`` has one row per entity, ``members`` all sources."""
    log = Store(spark, table).read(kind, version).drop("bucket")
    if kind == "members":
        return log.drop("batch")
    keys = list(entity) if entity else [c for c in log.columns if c not in (*_STATE, "batch")]
    return _newest(log, keys).drop("batch")
