"""Fingerprints of documents, by an independent rule in plain Python, and their corner cases."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import enums, layout, version

SIZES = {"U1": 1, "U4": 4, "R8": 8, "X2": 2, "CH": 1}


def by_hand(entries):
    if not entries:
        return "empty_" + hashlib.sha256(b"no_fields").hexdigest()[:12]
    return hashlib.sha256(json.dumps(entries).encode()).hexdigest()[:16]


DOCUMENTS = [
    ({"fields": [{"name": "svid", "byte_offset": 0, "data_type": "U4"}, {"name": "week", "byte_offset": 4, "data_type": "U4"},
                 {"name": "dwrd", "byte_offset": 8, "data_type": {"array_of": "U4", "count": 8}}]},
     [["svid", 0, "U4", 4], ["week", 4, "U4", 4], ["dwrd", 8, "U4[8]", 32]]),
    ({"payload": {"fields": [{"name": "reserved_0", "byte_offset": 2}, {"name": "Reserved1", "byte_offset": 1, "data_type": "Z9", "size_bytes": 6}]}},
     [["reserved", 1, "Z9", 6], ["reserved", 2, "U1", 1]]),
    ({"payload_fields": [{"name": "naïve \"q\" 😀", "byte_offset": "8 + n", "data_type": {"array_of": "CH", "count": "N"}}, {"byte_offset": None, "size_bytes": None}]},
     [["", -1, "U1", None], ["naïve \"q\" 😀", -1, "CH[N]", 0]]),
    ({"ubx_message": {"fields": [], "payload": {"fields": [{"name": "a", "data_type": "R8"}], "repeated_groups": [{"fields": [{"name": "b", "byte_offset": 0, "data_type": "X2"}]}]}}},
     [["a", 0, "R8", 8], ["b", 0, "X2", 2]]),
    ({"fields": [{"name": "x", "byte_offset": 3, "data_type": {"array_of": {"type": "U1"}, "count": 2}}]},
     [["x", 3, json.dumps({"array_of": {"type": "U1"}, "count": 2}, sort_keys=True), 1]]),
    ({"payload": [1, 2]}, []),
]


def test_document_fingerprints(spark):
    frame = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(DOCUMENTS)], "i int, structure string")
    found = {r.i: (r.fingerprint, r.field_count) for r in layout.add_fingerprint(layout.add_fields(frame)).collect()}
    for i, (_, entries) in enumerate(DOCUMENTS):
        assert found[i] == (by_hand(entries), len(entries)), i
    assert found[0][0] == "5614d4d3e4dc8a75"


def test_one_rule_for_layouts_of_any_width(spark):
    for count in (40, 70_000):
        rows = [("a", i, f"f{i}", "U1", 1) for i in range(count)]
        fields = spark.createDataFrame(rows, "e string, o int, n string, t string, s int")
        found = layout.fingerprint(fields, ["e"], "n", "o", "t", "s").first()
        text = "[" + ", ".join(f'["f{i}", {i}, "U1", 1]' for i in range(count)) + "]"
        assert (found.fingerprint, found.field_count) == (hashlib.sha256(text.encode()).hexdigest()[:16], count)


VERSIONS = [
    ([{"name": "msgVer", "byte_offset": 0, "data_type": "U1", "description": "Message version (0x01 for this)"}], True, 0, 1, "high"),
    ([{"name": "a", "byte_offset": 0}, {"name": "version", "byte_offset": 1, "data_type": "U1", "description": "no number"}], True, 1, 1, "high"),
    ([{"name": "a", "byte_offset": 0}, {"name": "ver", "byte_offset": 9, "data_type": "U2", "description": "version: 4"}], True, 9, 4, "low"),
    ([{"name": "a", "byte_offset": 0, "description": "Message version 3"}], True, 0, 3, "medium"),
    ([{"name": "swVersion", "byte_offset": 0, "data_type": "U1"}], False, None, 0, "none"),
    ([{"name": "version", "byte_offset": 0, "data_type": "U1", "description": "0x0A"}, {"name": "b", "byte_offset": 0, "data_type": "U1"}], True, 0, 10, "medium"),
    ([], False, None, 0, "none"),
]


def test_version_of_documents(spark):
    frame = spark.createDataFrame([(i, json.dumps({"fields": v[0]})) for i, v in enumerate(VERSIONS)], "i int, structure string")
    out = version.add_version(layout.add_fields(frame))
    found = {r.i: (r.version_info.detected, r.version_info.byte_offset, r.protocol_version, r.version_info.confidence) for r in out.collect()}
    assert found == {i: tuple(v[1:]) for i, v in enumerate(VERSIONS)}


def test_same_version_from_field_table(spark):
    rows = [(i, p, f.get("name"), f.get("byte_offset"), f.get("data_type"), f.get("description")) for i, v in enumerate(VERSIONS) for p, f in enumerate(v[0])]
    fields = spark.createDataFrame(rows, "i int, p int, n string, o int, t string, d string")
    out = version.detect_version(fields, ["i"], "n", "o", "t", "d", ["p"])
    found = {r.i: (r.version_info.detected, r.version_info.byte_offset, r.protocol_version, r.version_info.confidence) for r in out.collect()}
    assert found == {i: tuple(v[1:]) for i, v in enumerate(VERSIONS) if v[0]}


def test_summary_of_many_differences(spark):
    a = spark.createDataFrame([("m", i, "x", "U1", 1) for i in range(6)], "m string, o int, n string, t string, s int")
    b = spark.createDataFrame([("m", i, "y", "U1", 1) for i in range(1, 7)], "m string, o int, n string, t string, s int")
    diff = layout.differences(a, b, ["m"], "o", "n", "t", "s", ["n"])
    counts = spark.createDataFrame([("m", 0)], "m string, field_count_diff int")
    row = layout.summarize(diff, ["m"], "o", "n", "t", counts).first()
    assert row.mismatch_count == 7
    assert row.summary == "extra field at offset 0; field at offset 1: x(U1) vs y(U1); field at offset 2: x(U1) vs y(U1); ...and 4 more differences"


@pytest.mark.parametrize("structure,count", [({"payload": {"fields": [{}, {}]}}, 2), ({"payload_fields": [{}]}, 1), ({"fields": [{}, {}, {}], "payload": {}}, 3), ({}, 0)])
def test_field_count(spark, structure, count):
    assert spark.createDataFrame([(json.dumps(structure),)], "structure string").select(layout.count_fields().alias("c")).first().c == count


def test_enum_name_is_cut_at_words(spark):
    from tallyframe.functions import naming as n

    texts = ["a" * 40, "one two three four five six seven eight", "3D-fix", "", "Set main talker ID to GPS"]
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select(n.enum_name(F.col("t")).alias("n")).collect()]
    assert got == ["a" * 30, "one_two_three_four_five_six", "_3d_fix", "unknown", "gps"]


def test_enum_pairs_are_worked_out_once(spark):
    rows = spark.createDataFrame([("0 = off, 1 = on, 0x2 = far\n1 = again",), ("5 = alone",), (None,), ("",)], "t string")
    pairs = rows.select(enums.enum_pairs("t").alias("p"))
    # Each pattern is looked for once a text, for its numbers and for its labels.
    assert pairs._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 4
    found = [r.p if r.p is None else [(p.value, p.description) for p in r.p] for r in pairs.collect()]
    assert found == [[(0, "off"), (1, "on"), (2, "far")], [], None, []]
