"""Capture files as a data source, ``capture_pieces``: byte ranges in parallel, or a stream that follows growing files.

    register(spark)
    spark.read.format("capture_pieces").option("piece", 1 << 22).load(folder)
    spark.readStream.format("capture_pieces").load(folder)

Rows are (capture, seq, data): the address of the file, the number of the piece in it from 0 on without gaps, and its bytes:
``piece`` of them, fewer only in the last. Files are opened through pyarrow, so the address must be one that it and all executors
reach; ``pattern`` chooses names. Tasks read ranges of about ``split`` bytes: parts of large files, many small ones. What would be more
than MOST_TASKS tasks is dealt over so many, of several ranges each. Empty files have no rows.

The stream's offset holds the bytes that have been read of each file, by its name in the folder, so a micro-batch that is repeated reads the same bytes.
Files that appear whole are read at once. With ``settle``, a number of seconds, a file may grow: its whole pieces come as they
are there, the last one when the file has not changed for so long. A file that grows after its last piece came fails the query.
"""

from __future__ import annotations

import fnmatch
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "capture string, seq bigint, data binary"
PIECE, SPLIT = 1 << 22, 1 << 26
#: Tasks of one read beyond which tasks take more instead.
MOST_TASKS = 1000
#: Bytes and pieces that a task gives at once, if a single piece is not more.
BATCH_BYTES, BATCH_PIECES = 1 << 22, 4096


class Ranges(InputPartition):
    """(name, first byte, end) of byte ranges that begin with a piece each: one of a large file, or several small files."""

    def __init__(self, parts: list[tuple[str, int, int]]):
        self.parts = parts


class _Files:
    """What the batch and the stream reader share."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.pattern = options.get("pattern", "*")
        self.piece = int(options.get("piece", PIECE))
        self.settle = float(options.get("settle", 0))
        self.split = max(1, int(options.get("split", SPLIT)) // self.piece) * self.piece
        if "://" not in self.path:
            self.path = f"file://{self.path.removeprefix('file:')}"

    def sizes(self) -> dict[str, int]:
        """Bytes of each file that are ready, by name."""
        store, place = pyarrow.fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(pyarrow.fs.FileSelector(place))
        files = [f for f in found if f.type == pyarrow.fs.FileType.File and not f.base_name.startswith((".", "_")) and fnmatch.fnmatch(f.base_name, self.pattern)]
        ready = lambda f: f.size if time.time() - f.mtime_ns / 1e9 >= self.settle else f.size // self.piece * self.piece
        sizes = {f.base_name: ready(f) for f in sorted(files, key=lambda f: f.base_name)}
        return {name: size for name, size in sizes.items() if size}

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Ranges]:
        """What has come between two states, in partitions of about ``split`` bytes, or more where they would be too many."""
        # Checkpoints may hold whole addresses.
        start, end = ({name.removeprefix(f"{self.path}/"): size for name, size in state.items()} for state in (start, end))
        room = max(self.split, -(-sum(last - start.get(name, 0) for name, last in end.items()) // MOST_TASKS))
        out, held, size = [], [], 0
        for name, last in sorted(end.items()):
            first = start.get(name, 0)
            if first < last and first % self.piece:
                raise ValueError(f"{self.path}/{name} has grown after its last piece was read; give a time to settle")
            for at in range(first, last, self.split):
                held.append((name, at, min(last, at + self.split)))
                size += held[-1][2] - at
                if size >= room:
                    out.append(Ranges(held))
                    held, size = [], 0
        return [*out, Ranges(held)] if held else out

    def rows(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        store, place = pyarrow.fs.FileSystem.from_uri(self.path)
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            captures, numbers, pieces = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(captures), pa.array(numbers, pa.int64()), pa.array(pieces, pa.binary())], ["capture", "seq", "data"])

        for name, start, end in partition.parts:
            with store.open_input_file(f"{place}/{name}") as file:
                file.seek(start)
                for at in range(start, end, self.piece):
                    data = file.read(min(self.piece, end - at))
                    if held and (size + len(data) > BATCH_BYTES or len(held) == BATCH_PIECES):
                        yield batch()
                        held, size = [], 0
                    held.append((f"{self.path}/{name}", at // self.piece, data))
                    size += len(data)
        if held:
            yield batch()


class CaptureReader(DataSourceReader):
    def __init__(self, options):
        self.files = _Files(options)

    def partitions(self) -> list[Ranges]:
        return self.files.ranges({}, self.files.sizes())

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        return self.files.rows(partition)


class CaptureStreamReader(DataSourceStreamReader):
    """Offsets are {name: bytes}."""

    def __init__(self, options):
        self.files = _Files(options)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.files.sizes()

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        return self.files.ranges(start, end)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        return self.files.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class CaptureSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "capture_pieces"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CaptureReader:
        return CaptureReader(self.options)

    def streamReader(self, schema) -> CaptureStreamReader:
        return CaptureStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CaptureSource)
