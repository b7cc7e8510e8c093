"""Scanning against a single pass, and values against struct."""

import os
import random
import struct
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.functions import wire
from tallyframe.operators import codec
from tallyframe.streaming import frames as stream
from tallyframe.streaming.frames import frames as stream_frames

SYNC = b"\xb5\x62"


def fletcher(body):
    a = b = 0
    for byte in body:
        a = (a + byte) & 255
        b = (b + a) & 255
    return bytes([a, b])


def make(cls, msg, payload):
    body = bytes([cls, msg]) + struct.pack("<H", len(payload)) + payload
    return SYNC + body + fletcher(body)


def scan_in_one_pass(data):
    out, i = [], 0
    while i < len(data) - 7:
        if data[i : i + 2] == SYNC:
            size = 8 + struct.unpack_from("<H", data, i + 4)[0]
            if i + size <= len(data):
                out.append((i, data[i : i + size]))
                i += size
                continue
        i += 1
    return out


def capture(rng, count):
    data = b""
    for _ in range(count):
        kind = rng.random()
        if kind < 0.7:
            data += make(rng.randrange(256), rng.randrange(256), rng.randbytes(rng.choice([0, 3, 40, 900, 4000])))
        elif kind < 0.8:
            data += SYNC + rng.randbytes(2) + struct.pack("<H", rng.choice([5, 2000, 60000])) + rng.randbytes(9)
        elif kind < 0.9:
            data += SYNC * rng.randrange(1, 4)
        else:
            data += rng.randbytes(rng.randrange(30)) + b"\xb5"
    return data


@pytest.fixture(scope="module")
def captures():
    rng = random.Random(5)
    return {"long": capture(rng, 900), "short": capture(rng, 4), "tiny": b"\xb5\x62", "cut": make(1, 2, b"abc")[:-1] + make(1, 3, b"")}


def chunked(spark, captures, seed=1):
    rng, rows = random.Random(seed), []
    for name, data in captures.items():
        at = seq = 0
        while at < len(data):
            size = rng.choice([1, 7, 500, 70000])
            rows.append((name, seq, data[at : at + size]))
            at, seq = at + size, seq + 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "capture string, seq int, data binary")


@pytest.mark.parametrize("options", [{"block": 1 << 16 | 1 << 8, "fan": 3}, {}, {"block": 70000, "fan": 2, "floor": 20, "pieces": 5}])
def test_scan_in_blocks(spark, captures, options):
    found = codec.scan(chunked(spark, captures), "capture", "data", "seq", **options)
    rows = {(r.capture, r.offset, bytes(r.frame)) for r in found.collect()}
    assert rows == {(name, at, frame) for name, data in captures.items() for at, frame in scan_in_one_pass(data)}


def test_scan_whole_captures(spark, captures):
    frame = spark.createDataFrame(list(captures.items()), "capture string, data binary")
    assert codec.scan(frame, "capture", "data").count() == sum(len(scan_in_one_pass(d)) for d in captures.values())


def test_repeated_chunks_count_once(spark, captures):
    frame = chunked(spark, {"a": make(1, 2, b"ab" * 9)})
    again = frame.unionByName(frame).unionByName(chunked(spark, {"long": captures["long"]}))
    again = again.unionByName(again.where("capture = 'long' and seq % 3 = 0"))
    for options in ({}, {"block": 70000, "fan": 2}):
        found = codec.scan(again, "capture", "data", "seq", **options).collect()
        assert [(r.offset, bytes(r.frame)) for r in found if r.capture == "a"] == scan_in_one_pass(make(1, 2, b"ab" * 9))
        assert sorted((r.offset, bytes(r.frame)) for r in found if r.capture == "long") == scan_in_one_pass(captures["long"])


def test_differing_chunks_of_one_number_fail(spark):
    rows = spark.createDataFrame([("a", 0, b"abc"), ("a", 0, b"abd")], "capture string, seq int, data binary")
    with pytest.raises(Exception, match="differ"):
        codec.scan(rows, "capture", "data", "seq").collect()


def test_whole_captures_are_cut_without_a_shuffle(spark, captures):
    rows = spark.createDataFrame([(k, v) for k, v in captures.items()] + [("none", None), ("empty", b"")], "capture string, data binary")
    found = codec.scan(rows, "capture", "data", block=1 << 16 | 1 << 8)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    for name, data in captures.items():
        assert sorted((r.offset, bytes(r.frame)) for r in rows if r.capture == name) == scan_in_one_pass(data)


def late_stream(spark, tmp_path, batches, **options):
    """Frames of chunks that arrive in the given micro-batches."""
    folder = str(tmp_path / "in")
    schema = "device string, seq bigint, data binary"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/b*")
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/b{number}")
    found = stream_frames(stream, "device", "seq", "data", **options)
    found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    return spark.read.schema(found.schema).parquet(str(tmp_path / "out")).collect()


def test_late_and_repeated_chunks_over_micro_batches(spark, tmp_path):
    frames = [make(1, n, bytes([n] * 4)) for n in range(4)]
    rows = [("d", n, f) for n, f in enumerate(frames)]
    found = late_stream(spark, tmp_path, [[rows[0], rows[2]], [rows[1], rows[0]], [rows[3], rows[2]]])
    assert sorted((r.offset, bytes(r.frame)) for r in found) == scan_in_one_pass(b"".join(frames))
    assert all(r.rejected is None for r in found)


def test_frames_over_chunk_borders_in_any_order(spark, tmp_path):
    rng = random.Random(9)
    data = capture(rng, 40)
    cuts = sorted(rng.sample(range(1, len(data)), 30))
    pieces = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
    rows = [("d", n, p) for n, p in enumerate(pieces)]
    rng.shuffle(rows)
    found = late_stream(spark, tmp_path, [rows[:9], rows[9:20], rows[20:]])
    expected = scan_in_one_pass(data)
    seen = sorted((r.offset, bytes(r.frame)) for r in found)
    # Frames behind a sync that may still be waiting for its bytes at the end are not out yet.
    assert seen == expected[: len(seen)] and len(seen) > 0


def test_differing_and_too_many_chunks_are_rejected(spark, tmp_path):
    frames = [make(1, n, bytes([n] * 40)) for n in range(6)]
    rows = [("d", n, f) for n, f in enumerate(frames)]
    batches = [
        [rows[0], rows[2], ("e", 0, frames[0][:20])],
        [("d", 0, b"other"), ("d", 2, b"other"), rows[2]],  # differ from one used and from one waiting
        [rows[3], rows[4]],  # 4 has no room beside 2 and 3
        [rows[1], ("e", 1, frames[0][20:])],
        [rows[4], rows[3], rows[5]],
    ]
    found = late_stream(spark, tmp_path, batches, most_waiting=120)
    good = {(r.device, r.offset, bytes(r.frame)) for r in found if r.rejected is None}
    assert good == {("d", at, f) for at, f in scan_in_one_pass(b"".join(frames))} | {("e", 0, frames[0])}
    assert sorted((r.rejected, r.reason, bytes(r.frame)) for r in found if r.rejected is not None) == [
        (0, "differs", b"other"), (2, "differs", b"other"), (4, "no room", frames[4])]


def test_a_gap_is_given_up_after_a_time(spark, tmp_path):
    frames = [make(1, n, bytes([n] * 4)) for n in range(5)]
    rows = [("d", n, f) for n, f in enumerate(frames)]
    folder, schema = str(tmp_path / "in"), "device string, seq bigint, data binary"
    spark.createDataFrame([rows[0], rows[2]], schema).coalesce(1).write.parquet(f"{folder}/b0")
    found = stream_frames(spark.readStream.schema(schema).parquet(f"{folder}/b*"), "device", "seq", "data", give_up_ms=1)
    query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start(str(tmp_path / "out"))
    try:
        out = lambda: spark.read.schema(found.schema).parquet(str(tmp_path / "out")) if os.path.exists(tmp_path / "out") else None

        def wait(until):  # a query with timers never runs out of batches
            deadline = time.time() + 60
            while time.time() < deadline and not (out() is not None and until(out())):
                time.sleep(0.5)

        wait(lambda seen: seen.where("reason = 'gap'").count())
        spark.createDataFrame([rows[1], rows[3]], schema).coalesce(1).write.parquet(f"{folder}/b1")
        wait(lambda seen: seen.where("offset IS NULL AND rejected IS NULL OR reason = 'late'").count() == 2)
    finally:
        query.stop()
    out = out().collect()
    assert sorted((r.rejected, r.reason) for r in out if r.rejected is not None) == [(1, "late"), (2, "gap")]
    assert sorted((r.offset, bytes(r.frame)) for r in out if r.rejected is None and r.offset is not None) == [(0, frames[0])]
    assert [bytes(r.frame) for r in out if r.rejected is None and r.offset is None] == [frames[3]]


def test_chains_by_doubling():
    rng = random.Random(4)
    for n in (0, 1, 2, 50, 333):
        following = np.array([rng.choice([i, *range(i + 1, min(n, i + 4) + 1)]) for i in range(n)] + [n])
        for first in range(n + 1):
            chain, at = [], first
            while following[at] != at:
                chain.append(at)
                at = int(following[at])
            assert codec._chain(following, first).tolist() == chain and codec._last(following)[first] == at


def test_stream_advance_matches_one_pass():
    rng = random.Random(9)
    data = b"".join(make(1, 2, rng.randbytes(rng.randrange(60))) + rng.choice([b"", b"\x00\xb5", b"noise"]) for _ in range(200))
    found, carry, at = [], b"", 0
    for start in range(0, len(data), 37):
        buffer = carry + data[start : start + 37]
        cut, rest = stream._advance(buffer)
        found += [(at + a, buffer[a:b]) for a, b in cut]
        at, carry = at + rest, buffer[rest:]
    assert found == scan_in_one_pass(data)


def test_known_frame(spark):
    row = spark.createDataFrame([(b"\x06\x01",)], "p binary").select(wire.frame(F.lit(5), F.lit(1), F.col("p")).alias("f")).first()
    assert bytes(row.f) == bytes.fromhex("B562050102000601") + b"\x0f\x38"


def test_checksums_agree(spark):
    rng = random.Random(2)
    data = [rng.randbytes(n) for n in (0, 1, 2, 300, 5000)] + [None]
    rows = spark.createDataFrame([(d,) for d in data], "d binary").select("d", wire.checksum("d").alias("a"), wire.checksum_sql("d").alias("b")).collect()
    for r in rows:
        expected = None if r.d is None else struct.unpack("<H", fletcher(bytes(r.d)))[0]
        assert r.a == expected and (r.d is None or r.b == expected)


def test_floats_are_exact(spark):
    rng = random.Random(4)
    doubles = [0.0, -0.0, 1.5, -2.25, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1]
    doubles += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(200)]
    doubles = [d for d in doubles if d == d]
    raw = [struct.pack("<d", d) for d in doubles]
    singles = [s for s in (struct.unpack("<f", rng.randbytes(4))[0] for _ in range(200)) if s == s] + [2.0**-149, 3.5, -0.0]
    raw += [struct.pack("<f", s) for s in singles]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, r binary")
    found = [r.v for r in frame.select("i", wire.float_value("r").alias("v")).orderBy("i").collect()]
    assert [struct.pack("<d", v) for v in found] == [struct.pack("<d", v) for v in doubles + singles]
    assert frame.where("i = 0").select(wire.float_value(F.lit(struct.pack("<f", float("nan")))).alias("v")).first().v != 0


def test_integers(spark):
    cases = [(">", "U8", 2**64 - 1), (">", "I8", -(2**63)), (">", "U2", 65535), (">", "I1", -1), (">", "I4", -2), (">", "X4", 7)]
    rows = [(t, v.to_bytes(int(t[1]), "little", signed=t[0] == "I"), str(v)) for _, t, v in cases]
    found = spark.createDataFrame(rows, "t string, r binary, v string").select("v", wire.integer_value("r", "t").cast("string").alias("g")).collect()
    assert all(r.v == r.g for r in found)
    ranged = spark.createDataFrame([(bytes([0b01100011]),)], "r binary").select(wire.integer_value("r", F.lit("RU1_3")).cast("int").alias("g")).first()
    assert ranged.g == 0b00011 << 0b011


def test_text_is_cut_and_stripped(spark):
    got = spark.createDataFrame([(b"ab\x00c\x00\x00",), (b"\xff\x41",)], "r binary").select(wire.text_value("r").alias("t")).collect()
    assert [r.t for r in got] == ["ab\x00c", "�A"]


class Entries(dict):
    """A state variable that counts the calls."""

    calls = 0

    def getValue(self, key):
        Entries.calls += 1
        return (self[key],) if key in self else None

    def updateValue(self, key, value):
        Entries.calls += 1
        self[key] = value[0]

    def removeKey(self, key):
        Entries.calls += 1
        del self[key]

    def get(self, key=None):
        Entries.calls += 1
        return dict.get(self, key)

    def exists(self):
        return bool(dict.get(self, None))

    def update(self, value):
        Entries.calls += 1
        self[None] = value

    def getValueState(self, *names):
        return Entries()

    getMapState = getValueState


def test_early_chunks_cost_few_state_calls():
    rng = random.Random(3)
    data = [make(1, 2, rng.randbytes(rng.randrange(60))) + rng.choice([b"", b"noise"]) for _ in range(500)]
    rows = list(enumerate(data))
    rng.shuffle(rows)
    device = stream.Reassembly("device", "seq", "data", 0, None, stream.MOST_WAITING)
    device.init(Entries())
    found, Entries.calls = [], 0
    for part in (rows[:200], rows[200:400], rows[400:]):
        batch = pd.DataFrame(part, columns=["seq", "data"])
        found += [r for out in device.handleInputRows(("d",), iter([batch.iloc[:90], batch.iloc[90:]]), None) for r in out.itertuples(index=False)]
    assert sorted((int(r.offset), r.frame) for r in found) == scan_in_one_pass(b"".join(data))
    assert Entries.calls < 60 and not device.held


def test_registry_rows_are_sized_and_not_sorted_with_the_values(spark):
    """A few registry keys name all values: a sorted join would bring them into one task."""
    values = spark.range(9).selectExpr("id", "'M' AS message", "'f' AS field", "0 AS idx", "CAST(id AS DECIMAL(20,0)) AS int_value", "CAST(NULL AS DOUBLE) AS real_value")
    bits = spark.createDataFrame([("M", "f", "low", 0, 1)], "message string, field string, bit string, bit_start int, width int")
    meaning = spark.createDataFrame([("M", "f", 0.5, "m", False, None)], "message string, field string, multiplier double, unit string, reserved boolean, since_version int")
    labels = spark.createDataFrame([("M", "f", 1, "one")], "message string, field string, value bigint, label string")
    readings = spark.createDataFrame([("M", "f", "low", 1, "odd", "m", 2.0)], "message string, field string, bit string, bit_value bigint, reading string, unit string, multiplier double")
    unpacked = codec.unpack_bits(values, bits, ["id"])
    assert sorted((r.id, r.bit_value) for r in unpacked.collect()) == [(i, i % 2) for i in range(9)]
    meant = codec.interpret(values, meaning, labels)
    assert sorted((r.id, r.scaled_value, r.label) for r in meant.collect()) == [(i, i / 2, "one" if i == 1 else None) for i in range(9)]
    read = codec.conditional(values, unpacked.drop("field", "idx"), readings, ["id"])
    assert sorted((r.id, r.scaled_value) for r in read.collect()) == [(i, i * 2.0) for i in (1, 3, 5, 7)]
    for rows in (unpacked, meant):
        assert "SortMergeJoin" not in rows._jdf.queryExecution().executedPlan().toString()


def test_bytes_in_reverse(spark):
    rng = random.Random(6)
    data = [rng.randbytes(n) for n in range(14)] + [None]
    rows = spark.createDataFrame([(d,) for d in data], "d binary").select("d", wire.reversed_hex("d").alias("h")).collect()
    assert all(r.h == (None if r.d is None else bytes(r.d)[::-1].hex().upper()) for r in rows)


def test_events_of_views_are_dealt_over_tasks(spark):
    from tallyframe.plans import captures as plans

    rows = plans.grouped(spark, "/root/testdata/sf0.001")[0]
    assert "RoundRobinPartitioning" in rows._jdf.queryExecution().executedPlan().toString()


def test_windows_go_to_python_in_small_batches(spark, captures):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    try:
        spark.conf.set(name, "1g")
        codec.scan(chunked(spark, {"tiny": captures["tiny"]}), "capture", "data", "seq")
        assert int(spark.conf.get(name)) <= 4 << 20
    finally:
        spark.conf.set(name, held)
