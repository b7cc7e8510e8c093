"""Frames from a stream of capture chunks."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions import fixed
from ..operators.codec import _chain, _frame_starts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Bytes of early chunks that a device may have waiting.
MOST_WAITING = 1 << 26
#: Numbers of chunks whose digests, or whose bytes while they wait, are one entry of the state.
BLOCK = 256
#: Blocks of a device that a task holds, and bytes of consecutive chunks that are scanned at once.
MOST_BLOCKS, AT_ONCE = 64, 1 << 20


def _advance(buffer: bytes):
    """Frames at the front of a buffer, and where the undecided rest begins."""
    data = np.frombuffer(buffer, dtype=np.uint8)
    if len(data) < fixed.FRAME_OVERHEAD:
        return [], 0
    starts, ends = _frame_starts(data, len(data))
    marks = np.flatnonzero((data[:-1] == fixed.SYNC[0]) & (data[1:] == fixed.SYNC[1]))
    # A mark whose frame may still be arriving ends the chain, and so does the place behind all marks.
    following = np.arange(len(marks) + 1)
    whole = np.searchsorted(marks, starts)
    following[whole] = np.searchsorted(marks, ends)
    chain = _chain(following, 0)
    at = np.searchsorted(starts, marks[chain])
    found = list(zip(starts[at].tolist(), ends[at].tolist()))
    end = int(following[chain[-1]]) if len(chain) else 0
    if end < len(marks):
        return found, int(marks[end])
    tail = len(data) - 1 if data[-1] == fixed.SYNC[0] else len(data)
    return found, max(found[-1][1] if found else 0, tail)


def _digest(chunk: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little", signed=True)


def _packed(chunks: dict[int, bytes]) -> bytes:
    return b"".join(struct.pack("<qq", number, len(chunk)) + chunk for number, chunk in sorted(chunks.items()))


def _unpacked(entry: bytes) -> dict[int, bytes]:
    chunks, at = {}, 0
    while at < len(entry):
        number, size = struct.unpack_from("<qq", entry, at)
        chunks[number] = entry[at + 16 : at + 16 + size]
        at += 16 + size
    return chunks


class _Blocks:
    """A map of the state with an entry for each block of numbers, read and written once for many chunks."""

    def __init__(self, state, read, write):
        self.state, self.read, self.write = state, read, write
        self.kept, self.changed = {}, set()

    def of(self, number: int, change: bool = False) -> dict:
        """The entries of the block of a number."""
        block = number // BLOCK
        if block not in self.kept:
            entry = self.state.getValue((block,))
            self.kept[block] = self.read(bytes(entry[0])) if entry else {}
        if change:
            self.changed.add(block)
        return self.kept[block]

    def store(self) -> None:
        for block in self.changed:
            if self.kept[block]:
                self.state.updateValue((block,), (self.write(self.kept[block]),))
            else:
                self.state.removeKey((block,))
        self.kept, self.changed = {}, set()


class Reassembly(StatefulProcessor):
    """Chunks of one device. Early chunks wait in blocks of neighbouring numbers, each read and written once for all chunks of a batch."""

    def __init__(self, device: str, seq: str, data: str, first: int, give_up_ms: int | None, most_waiting: int):
        self.device, self.seq, self.data = device, seq, data
        self.first, self.give_up_ms, self.most_waiting = first, give_up_ms, most_waiting

    def init(self, handle) -> None:
        self.handle = handle
        self.front = handle.getValueState("front", "carry binary, at bigint, next bigint, waiting bigint, timer bigint")
        self.held = handle.getMapState("early", "block bigint", "chunks binary")
        self.used = handle.getMapState("used", "block bigint", "digests binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        carry, at, expected, waiting, timer = self.front.get() or (b"", 0, self.first, 0, None)
        carry = bytes(carry)
        used = _Blocks(self.used, lambda e: dict(struct.iter_unpack("<qq", e)), lambda d: b"".join(struct.pack("<qq", *x) for x in sorted(d.items())))
        held = _Blocks(self.held, _unpacked, _packed)
        for batch in rows:
            out, run, size = [], [], 0

            def scan() -> None:
                """Cut the frames of the chunks of the run."""
                nonlocal carry, at, run, size
                buffer = b"".join([carry, *run])
                cut, rest = _advance(buffer)
                out.extend((None if at is None else at + start, buffer[start:end], None, None) for start, end in cut)
                at, carry, run, size = None if at is None else at + rest, buffer[rest:], [], 0

            def take(chunk: bytes) -> None:
                nonlocal expected, size
                used.of(expected, True)[expected] = _digest(chunk)
                run.append(chunk)
                expected, size = expected + 1, size + len(chunk)
                if size >= AT_ONCE:
                    scan()

            for number, chunk in sorted(zip(batch[self.seq].tolist(), batch[self.data]), key=lambda x: x[0]):
                chunk = bytes(chunk or b"")
                if number < expected:
                    known = used.of(number).get(number)
                    if known != _digest(chunk):
                        out.append((None, chunk, number, "late" if known is None else "differs"))
                elif number == expected:
                    take(chunk)
                    while waiting and expected in held.of(expected):
                        early = held.of(expected, True).pop(expected)
                        waiting -= len(early) + 1
                        take(early)
                elif waiting and number in held.of(number):
                    if held.of(number)[number] != chunk:
                        out.append((None, chunk, number, "differs"))
                elif waiting + len(chunk) + 1 > self.most_waiting:
                    out.append((None, chunk, number, "no room"))
                else:
                    held.of(number, True)[number] = chunk
                    waiting += len(chunk) + 1
                for blocks in (used, held):
                    if len(blocks.kept) > MOST_BLOCKS:
                        blocks.store()
            if run:
                scan()
            yield self._rows(key, out)
        used.store()
        held.store()
        if self.give_up_ms is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = timerValues.getCurrentProcessingTimeInMs() + self.give_up_ms if waiting else None
            if timer is not None:
                self.handle.registerTimer(timer)
        self.front.update((carry, at, expected, waiting, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, _, expected, waiting, timer = self.front.get()
        if timer != expiredTimerInfo.getExpiryTimeInMs() or not waiting:
            return
        for block in sorted(k[0] for k in self.held.keys()):
            early = _unpacked(bytes(self.held.getValue((block,))[0]))
            yield self._rows(key, [(None, chunk, number, "gap") for number, chunk in sorted(early.items())])
            expected = max(early) + 1
        self.held.clear()
        self.front.update((b"", None, expected, 0, None))

    def _rows(self, key, out: list[tuple]) -> pd.DataFrame:
        offsets, frames, numbers, reasons = zip(*out) if out else ((), (), (), ())
        return pd.DataFrame({
            self.device: pd.Series([key[0]] * len(out), dtype=object), "offset": pd.array(offsets, "Int64"), "frame": pd.Series(frames, dtype=object),
            "rejected": pd.array(numbers, "Int64"), "reason": pd.Series(reasons, dtype=object),
        })

    def close(self) -> None:
        pass


def frames(
    chunks: DataFrame, device: str, seq: str, data: str, first: int = 0, give_up_ms: int | None = None, most_waiting: int = MOST_WAITING,
) -> DataFrame:
    """(device, offset, frame, rejected, reason) as chunks arrive, from chunks numbered by ``seq`` without gaps from ``first`` on.

    Chunks may arrive in any order over any micro-batches: one that is early waits in the state until those
    before it have come; a repetition of one that has come is passed over. ``rejected`` is null for frames. Chunks
    that cannot be used come out with their ``seq`` as ``rejected``, their bytes as ``frame`` and a ``reason``:

    * ``differs``: a chunk of that number with other bytes has come before; that one counts;
    * ``no room``: more than ``most_waiting`` bytes of the device would wait; the chunk may be sent again;
    * ``gap``: with ``give_up_ms``, the next chunk has not come for that long and the gap is given up. Scanning goes on
      behind the waiting chunks, and as the length of the gap is unknown, later frames have no offset;
    * ``late``: the chunk belongs to a gap that was given up.

    The state of a device holds one unfinished frame, the waiting chunks and 16 bytes for each chunk used, in entries of
    256 numbers each. It needs
    the RocksDB state store, which is set for the session where another one is.
    """
    spark = chunks.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    kind = dict(chunks.dtypes)[device]
    slim = chunks.select(device, F.col(seq).cast("bigint").alias(seq), F.col(data).cast("binary").alias(data))
    return slim.groupBy(device).transformWithStateInPandas(
        Reassembly(device, seq, data, first, give_up_ms, most_waiting),
        f"`{device}` {kind}, offset bigint, frame binary, rejected bigint, reason string", "append",
        "None" if give_up_ms is None else "ProcessingTime",
    )
