"""Streaming forms, run over the tables as file streams until they are used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import skew
from ..session import run_dir
from ..streaming import consensus as consensus_stream
from ..streaming import frames as frame_stream
from . import captures, voting
from .base import query, table


def file_stream(rows, path, files=3):
    """A table written as ``files`` files, read as a stream of one file for each micro-batch."""
    rows.repartition(files).write.parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query(voting.INCREMENTAL)
def stream_consensus(spark, folder):
    """Orders before a date arrive, then the rest; the query runs after each arrival and takes up where it stopped."""
    path = run_dir(spark, "consensus")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_orderkey")
    for number, part in enumerate((F.col("o_orderdate") < voting.CUT, F.col("o_orderdate") >= voting.CUT)):
        orders.where(part).write.parquet(f"{path}/in/part={number}")
        rows = spark.readStream.schema(orders.schema).parquet(f"{path}/in/part=*")
        consensus_stream.consensus(
            rows, f"{path}/table", f"{path}/checkpoint", ["o_custkey"], "o_orderpriority", "o_orderstatus", ["o_orderdate", "o_orderkey"]
        ).awaitTermination()
    return consensus_stream.latest(spark, f"{path}/table")


@query(f"""
WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events)
SELECT user_id AS capture, CAST(coalesce(sum({captures.SIZES}) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 4 * (event_id % 5) AS BIGINT) AS "offset",
    CAST(44 AS INT) AS size FROM e""")
def stream_frames(spark, folder):
    """Chunks of each user's capture, numbered by batch, reassembled into frames as they arrive."""
    path = run_dir(spark, "chunks")
    chunks = captures.chunks(spark, folder)
    counted = skew.ordered(chunks.select("capture", "seq"), ["capture"], ["seq"], {"n": ("sum_before", F.lit(1).cast("bigint"))})
    numbered = chunks.join(counted, ["capture", "seq"]).select("capture", F.coalesce("n", F.lit(0).cast("bigint")).alias("seq"), "data")
    # Dealt over several micro-batches at random, so chunks arrive late and early.
    stream = file_stream(numbered, f"{path}/in")
    found = frame_stream.frames(stream, "capture", "seq", "data")
    found.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{path}/out").select("capture", "offset", F.length("frame").alias("size"))
