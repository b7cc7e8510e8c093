"""Session settings that the operators read."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session comes from outside."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyframe")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Where it is unset, a session on one machine (tests) gets a temporary folder; on a cluster that is an error,
    as executors would write to their own disks.
    """
    held = spark.conf.get("spark.checkpoint.dir", None)
    if not held:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        held = tempfile.mkdtemp(prefix="tallyframe-")
        spark.conf.set("spark.checkpoint.dir", held)
    return held


_made: list[str] = []


def run_dir(spark: SparkSession, kind: str) -> str:
    """A new folder below the shared one; :func:`clear` removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Remove the folders that this process had made below the shared one, once all results on them have been read."""
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back, so that loops keep short plans and survive lost executors.

    ``compression`` is that of the files; by default the session's.
    """
    spark = df.sparkSession
    path = run_dir(spark, "cut")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


#: Tasks for each core, and for each split of a table, where rows are costly.
SPREAD = 8


def spread(df: DataFrame) -> DataFrame:
    """``df``, whose rows take long, dealt out over several tasks a core; a larger input, of more splits, over more tasks."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(SPREAD * max(cores, df.rdd.getNumPartitions()))


#: Bytes that go to a Python worker at once, whatever the number of rows.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in whose session Arrow batches now hold at most BATCH_BYTES, so that long rows do not add up."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", df.sparkSession.conf.get(name).lower()).groups()
    if not 0 < int(number) << 10 * " kmgt".index(unit or " ") <= BATCH_BYTES:
        df.sparkSession.conf.set(name, str(BATCH_BYTES))
    return df
