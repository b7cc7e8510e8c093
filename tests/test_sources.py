"""Readers and writers over small files written here."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import naming
from tallyframe.operators import codec, keys, merge, rules, vote
from tallyframe.plans import files, flows
from tallyframe.sources import captures, ingest, readers, writers
from tallyframe.sources.store import Store


def put(path, name, content):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(content if isinstance(content, str) else json.dumps(content))


FIELDS = [{"name": "version", "byte_offset": 0, "data_type": "U1", "description": "Message version (0x00)"}, {"name": "val", "byte_offset": 1, "data_type": "U2"}]
OTHER = [{"name": "val", "byte_offset": 0, "data_type": "U4"}]


def test_bundles_are_read_in_order(spark, tmp_path):
    put(tmp_path, "u-blox-F9-HPG-1.51_x_gemini.json", {"messages": [{"name": "A", "fields": FIELDS}, {"fields": OTHER}]})
    put(tmp_path, "M9-ADR-5.10_x_anthropic.json", {"messages": [{"name": "A", "payload": {"fields": FIELDS}}, {"name": "B", "fields": []}]})
    put(tmp_path, "ignored.json", {"messages": [{"name": "C"}]})
    rows = readers.extractions(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.message_name, r.source.short_name, r.field_count, r.protocol_version) for r in rows] == [
        ("A", "M9-ADR-5.10", 2, 0), ("B", "M9-ADR-5.10", 0, 0), ("A", "F9-HPG-1.51", 2, 0),
    ]
    assert rows[0].fingerprint == rows[2].fingerprint and rows[1].fingerprint.startswith("empty_")


@pytest.fixture()
def store(tmp_path):
    base = tmp_path / "store"
    for i, fields in enumerate([FIELDS, FIELDS, OTHER]):
        put(base / f"m{i}", "A.json", {"message_name": "A", "extracted_structure": {"fields": fields}, "review": {"verdict": "extraction_error", "corrected_structure": [{"fields": FIELDS}]} if i == 2 else None})
    put(base / "m0", "bad.json", "{broken")
    put(base / "m0", "none.json", {"message_name": "B", "extracted_structure": {}})
    put(base / "m0", "error.json", {"message_name": "B", "extracted_structure": {"error": "x"}})
    put(base / "m0", "noname.json", {"extracted_structure": {"fields": FIELDS}})
    return str(base)


def test_conversations_and_rejects(spark, store):
    rows, rejects = readers.conversations(spark, store)
    assert sorted((r.manual, r.field_count) for r in rows.collect()) == [("m0", 2), ("m1", 2), ("m2", 1)]
    assert {(r.file, r.reason) for r in rejects.collect()} == {
        ("bad.json", "malformed JSON"), ("none.json", "no structure"), ("error.json", "error in structure"), ("noname.json", "no message name"),
    }
    assert readers.adjudication_input(rows).count() == 3


def test_flow_from_store_to_decisions(spark, store, tmp_path):
    rows, _ = readers.conversations(spark, store)
    votes = flows.preliminary_votes(rows)
    by_version = {r.protocol_version: r for r in votes.collect()}
    assert by_version[0].status == "majority" or by_version[0].total_count == 3
    assert writers.write_preliminary(votes, str(tmp_path / "prelim")).count() == 1
    reviewed, _ = readers.conversations(spark, store, reviewed=True)
    assert {r.manual: r.verdict for r in reviewed.collect()} == {"m0": "not_reviewed", "m1": "not_reviewed", "m2": "extraction_error"}
    decisions = flows.final_decisions(reviewed)
    row = decisions.first()
    assert (row.decision, row.confidence, row.agreement_count) == ("accepted_with_corrections", "high", 3)
    assert writers.write_final(decisions, str(tmp_path / "final")).first().messages == 1
    assert Store(spark, str(tmp_path / "final")).read("decisions").where("list = 'canonical'").count() == 1


def test_canonical_and_report(spark, tmp_path):
    rows = spark.createDataFrame([("A", 0, "x", i) for i in range(4)] + [("B", 0, "x", 1), ("B", 0, "y", 2)], "name string, version int, fp string, seq int")
    votes = vote.vote(rows, ["name", "version"], "fp", ["seq"])
    ballots = vote.ballots(rows, votes, ["name", "version"], "fp")
    counters = writers.write_canonical(votes, str(tmp_path / "c"), "name", "version", ballots=ballots, source="seq", value="fp").first()
    written = Store(spark, str(tmp_path / "c"))
    assert written.read("messages").where("confidence = 'high'").count() == 1
    assert written.read("sources").where("agrees").count() == 4
    assert (counters.written, counters.skipped_no_consensus, counters.skipped_low_confidence) == (1, 1, 0)
    manifest = written.read("manifest").first()
    assert (manifest.file_key, manifest.confidence, manifest.sources) == ("A-v0", "high", 4)
    writers.write_report(votes, str(tmp_path / "r"), ["name", "version"])
    assert Store(spark, str(tmp_path / "r")).read("issues").count() == 1


def test_keys_from_bundles_to_registry(spark, tmp_path):
    one = {"keys": [{"name": "CFG-A-X", "key_id": "0x30210001", "data_type": "U2", "description": "d", "scale": "2^-7", "unit": "s",
                     "inline_enum": {"values": {"ON": {"value": 1}, "OFF": {"value": 0}}}}, {"name": "no id"}]}
    two = {"keys": [{"name": "CFG-A-X", "key_id": "0x30210001", "data_type": "U2", "description": "longer", "unit": "s",
                     "inline_enum": {"values": [{"name": "AUTO", "value": 2}, {"name": "ENABLED", "value": 1}, {"name": "ON", "value": 1}]}},
                    {"name": "CFG-B", "key_id": "0x12", "bitfield": {"bits": [{"name": "b"}]}}]}
    put(tmp_path / "k", "u-blox-F9-HPG-1.51_a_gemini_config_keys.json", one)
    put(tmp_path / "k", "u-blox-M10-SPG-5.30_a_gemini_config_keys.json", two)
    loaded = readers.config_keys(spark, str(tmp_path / "k"))
    merged, enum, members = flows.merged_keys(loaded)
    rows = {r.key_id: r for r in merged.collect()}
    x = rows["0x30210001"]
    assert (x.name, x.group, x.group_id, x.item_id, x.description, x.source_count) == ("CFG-A-X", "CFG-A", "0x21", "0x0001", "longer", 2)
    assert (x.scale.multiplier, x.scale.kind, x.scale.exponent) == (2**-7, "power_of_2", -7)
    assert (rows["0x00000012"].group, rows["0x00000012"].group_id) == ("CFG", "0x00")
    assert {(r.name, r.value) for r in enum.collect()} == {("ON", 1), ("OFF", 0), ("AUTO", 2)}
    assert {(r.key_id, r.source) for r in members.collect()} == {("0x30210001", "F9-HPG-1.51"), ("0x30210001", "M10-SPG-5.30"), ("0x12", "M10-SPG-5.30")}
    assert keys.complete_bits(readers.key_bits(loaded)).select("data_type", "bit_start", "bit_end").collect() == [("U", 0, 0)]
    writers.write_keys(merged, keys.groups(merged, ["key_id"]), str(tmp_path / "out"))
    assert Store(spark, str(tmp_path / "out")).read("groups").count() == 2


def test_registry_metadata_and_reports(spark, tmp_path):
    variant = {"name": "EPH", "discriminator": {"field": "type", "byte_offset": 0, "value": 1}, "payload": {"fields": OTHER}}
    put(tmp_path / "reg", "r.json", {"messages": [{"name": "M", "class_id": "0x13", "message_id": "0x00", "variant_aliases": ["M-EPH"], "variants": [variant]}]})
    put(tmp_path / "reg", "one.json", {"name": "N", "class_id": "0x01", "message_id": "0x07"})
    messages = readers.registry(spark, str(tmp_path / "reg"))
    assert {r.name for r in messages.collect()} == {"M", "N"}
    found = readers.registry_variants(messages.where("name = 'M'")).first()
    assert (found.variant, found.byte_offset, found.value) == ("EPH", 0, 1)
    put(tmp_path / "meta", "m.json", {"manuals": {"u-blox8-M8": {"protocol_version": 1800, "firmware_version": "SPG 3.01"}}})
    meta = readers.manual_metadata(spark, str(tmp_path / "meta")).first()
    assert (meta.source, meta.protocol_version, meta.device_family) == ("u-blox8-M8", 1800, "M8")
    put(tmp_path / "inv", "i.json", {"messages": {"M": ["a", "b"]}, "config_groups": {}})
    assert readers.inventory(spark, str(tmp_path / "inv")).count() == 2
    put(tmp_path / "map", "m.json", {"field_aliases": {"_comment": "c", "a": "b"}})
    assert readers.name_mapping(spark, str(tmp_path / "map"), "field_aliases").collect() == [("a", "b")]
    put(tmp_path / "rep", "M_validation.json", {"message": "M", "results": [{"manual": "a", "matches": False, "discrepancies": [{"field": "f", "issue": "type"}]}, {"manual": "b", "matches": None}]})
    rows = {r.manual: r for r in readers.validation_results(spark, str(tmp_path / "rep")).collect()}
    assert rows["a"].matches is False and rows["a"].discrepancies[0].issue == "type" and rows["b"].matches is None


def test_append_skips_what_is_held(spark, tmp_path):
    path = str(tmp_path / "held")
    rows = spark.createDataFrame([("a", "M", 1), ("a", "N", 2)], "manual string, message string, v int")
    assert writers.append_new(rows.where("v = 1"), path, ["manual", "message"]).count() == 1
    assert writers.append_new(rows, path, ["manual", "message"]).collect() == [("a", "N", 2)]
    assert Store(spark, path).read("rows").count() == 2
    for _ in range(2):
        writers.record_variation(rows, str(tmp_path / "variations"), ("check", 1))
    assert Store(spark, str(tmp_path / "variations")).read("rows").where("recorded_at is not null").count() == 2


def test_rows_of_another_writer_are_not_appended_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "held")
    rows = spark.createDataFrame([("a", "M", 1), ("a", "N", 2)], "manual string, message string, v int")
    publish, raced = Store._publish, []

    def race(self, state):
        if not raced:  # another writer is first, with one of the rows
            raced.append(True)
            Store(spark, path).commit({"rows": rows.where("v = 1")}, append=True)
        return publish(self, state)

    monkeypatch.setattr(Store, "_publish", race)
    assert writers.append_new(rows, path, ["manual", "message"]).collect() == [("a", "N", 2)]
    assert Store(spark, path).read("rows").count() == 2


def test_capture_files(spark, tmp_path):
    (tmp_path / "caps").mkdir()
    (tmp_path / "caps" / "a.bin").write_bytes(bytes.fromhex("00B562050102000601") + b"\x0f\x38\xb5")
    found = codec.scan(readers.captures(spark, str(tmp_path / "caps")), "capture", "data")
    assert [(r.offset, len(r.frame)) for r in found.collect()] == [(1, 10)]


def test_captures_in_pieces(spark, tmp_path):
    (tmp_path / "caps").mkdir()
    data = bytes(range(256)) * 40 + bytes.fromhex("B5620501020006010F38") + b"tail"
    (tmp_path / "caps" / "a.bin").write_bytes(data)
    (tmp_path / "caps" / "empty.bin").write_bytes(b"")
    rows = readers.capture_pieces(spark, str(tmp_path / "caps"), piece=1000)
    assert b"".join(bytes(r.data) for r in rows.orderBy("seq").collect()) == data
    found = codec.scan(rows, "capture", "data", "seq").collect()
    assert [(r.offset, len(r.frame)) for r in found] == [(256 * 40, 10)]


def test_conflicts_are_written(spark, tmp_path):
    conflicts = spark.createDataFrame([("k", "name", 2)], "key string, field string, n int")
    writers.write_conflicts(conflicts, conflicts.where("n > 5"), str(tmp_path / "x"))
    assert Store(spark, str(tmp_path / "x")).read("conflicts").collect() == [("k", "name", 2)]
    assert Store(spark, str(tmp_path / "x")).read("queue").collect() == []


def test_second_registry_forms(spark):
    texts = ['"U004"', '["I004", 1e-07]', '["X001", {"a": "U001"}]', '["numSvs", {"b": "U002"}]', "broken"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(naming.registry_form("t").alias("f")).collect()
    assert [(r.f.kind, r.f.type, r.f.scale, r.f.bits, r.f.count_field, r.f.fields) for r in found] == [
        ("plain", "U004", None, None, None, None), ("scaled", "I004", 1e-07, None, None, None), ("bitfield", "X001", None, '{"a":"U001"}', None, None),
        ("group", "group", None, None, "numSvs", '{"b":"U002"}'), (None, None, None, None, None, None),
    ]


def test_message_rules_and_fixed_length(spark):
    rows = spark.createDataFrame([("0x01", "0x02", "input"), (None, "0x02", None)], "class_id string, message_id string, message_type string")
    found = {r.rule: (r.checked, r.violations) for r in rules.expect(rows, rules.message_rules()).collect()}
    assert found == {"has_class_id": (2, 1), "has_message_id": (2, 0), "has_message_type": (2, 1)}


def test_version_sets(spark):
    pairs = spark.createDataFrame([("M", "a"), ("M", "b"), ("N", "c")], "entity string, source string")
    meta = spark.createDataFrame([("a", 2700), ("b", 1800), ("c", 0)], "source string, version int")
    out = {r.entity: r for r in merge.supported_versions(pairs, meta, ["entity"], "source", "version").collect()}
    assert (out["M"].min_version, out["M"].version_count, out["N"].min_version, out["N"].source_count) == (1800, 2, None, 1)
    assert merge.supported_versions(pairs, meta, ["entity"], "source", "version", keep_empty=False).count() == 1


def test_variant_order_puts_unknown_last(spark):
    messages = spark.createDataFrame([("B-Y", "input", "none"), ("B-X", "input", "type 0x04"), ("C", "output", "")], "name string, message_type string, discriminator_text string")
    families = spark.createDataFrame([("B", "X", "-X", None, 0), ("B", "Y", "-Y", None, 1), ("B", "Z", "-Z", 3, 2)], "base_name string, variant string, suffix string, value int, position int")
    merged, variants, aliases = merge.consolidate(messages, families)
    assert {(r.name, r.variant_count) for r in merged.collect()} == {("C", 0), ("B", 2)}
    assert {(r.variant, r.discriminator, r.variant_index) for r in variants.collect()} == {("X", 4, 0), ("Y", None, 1)}
    assert aliases.where(F.col("alias") == "B-Z").count() == 1


def test_ingestion_reads_new_files_only(spark, tmp_path, monkeypatch):
    read = []
    parse = ingest.extractions

    def noted(files):
        read.append(sorted(r.file for r in files.select("file").collect()))
        return parse(files)

    run = lambda: ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"), noted).awaitTermination()
    put(tmp_path / "in", "u-blox-F9-HPG-1.51_a_gemini.json", {"messages": [{"name": "M", "fields": FIELDS}, {"fields": FIELDS}]})
    put(tmp_path / "in", "bad_gemini.json", "{broken")
    run()
    put(tmp_path / "in", "u-blox-M10-SPG-5.30_a_anthropic.json", {"messages": [{"name": "M", "fields": OTHER}]})
    put(tmp_path / "in", "unlisted_gemini.json", {"other": 1})
    run()
    run()
    assert read == [["bad_gemini.json", "u-blox-F9-HPG-1.51_a_gemini.json"], ["u-blox-M10-SPG-5.30_a_anthropic.json", "unlisted_gemini.json"]]
    store = Store(spark, str(tmp_path / "t"))
    assert sorted((r.batch, r.message_name, r.family) for r in store.read("extraction").collect()) == [(0, "M", "F9"), (1, "M", "M10")]
    assert sorted((r.file, r.reason) for r in store.read("reject").collect()) == [("bad_gemini.json", "malformed JSON"), ("unlisted_gemini.json", "no list")]
    fields = store.read("field")
    assert fields.where("batch = 0").count() == len(FIELDS) and fields.where("family = 'M10'").count() == len(OTHER)
    whole = readers.extractions(spark, str(tmp_path / "in")).select("message_name", "fingerprint").collect()
    assert sorted(whole) == sorted(store.read("extraction").select("message_name", "fingerprint").collect())


def test_a_batch_of_files_that_is_repeated_adds_nothing(spark, tmp_path):
    put(tmp_path / "in", "r.json", {"messages": [{"name": "N", "class_id": "0x01", "message_id": "0x07", "payload": {"fields": [
        {"name": "f", "data_type": "X1", "bitfield": [{"name": "b", "bit_offset": 0, "bit_width": 2}]}]}}]})
    run = lambda: ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"), ingest.registry).awaitTermination()
    run()
    for name in ("0", ".0.crc"):
        if (tmp_path / "c" / "commits" / name).exists():
            (tmp_path / "c" / "commits" / name).unlink()
    run()
    store = Store(spark, str(tmp_path / "t"))
    assert [store.read(part).count() for part in ("message", "field", "bit", "variant")] == [1, 1, 1, 0]
    assert store.read("bit").first()[:5] == ("N", "f", "b", 0, 2)


def test_second_registry_keeps_the_order_of_the_text(spark, tmp_path):
    text = '{"M": {"z": "U001", "a": ["X002", {"q": "U003", "b": "U001", "odd": 7}], "g": ["num", {"y": "U004", "x": ["n2", {"d": ["n3", {"e": "U001"}]}]}], "s": ["I004", 0.01], "c": "CH[4]"}, "E": {}}'
    put(tmp_path / "o", "o.json", text)
    put(tmp_path / "o", "bad.json", "{broken")
    fields, bits = readers.second_registry(spark, str(tmp_path / "o"), depth=2)
    rows = sorted((tuple(r.path), r.pos, r.field, r.kind, r.type, r.count_field, r.rest) for r in fields.collect())
    assert rows == [
        ((), 0, "z", "plain", "U001", None, None), ((), 1, "a", "bitfield", "X002", None, None), ((), 2, "g", "group", "group", "num", None),
        ((), 3, "s", "scaled", "I004", None, None), ((), 4, "c", "plain", "CH[4]", None, None),
        (("g",), 0, "y", "plain", "U004", None, None), (("g",), 1, "x", "group", "group", "n2", '{"d":["n3",{"e":"U001"}]}')]
    assert [(r.field, r.bit, r.width) for r in bits.orderBy("pos").collect()] == [("a", "q", 3), ("a", "b", 1), ("a", "odd", 1)]
    deep, _ = readers.second_registry(spark, str(tmp_path / "o"))
    assert {(tuple(r.path), r.field) for r in deep.collect()} >= {(("g", "x"), "d"), (("g", "x", "d"), "e")}


def test_rule_sets_count_keys_items_and_references(spark):
    rows = spark.createDataFrame(
        [("a", None, "U1", 1, "x", "d"), ("a", None, "U1", 1, "x", ""), ("a", None, "U1", 300, None, None), ("sigId", "gps", "U1", 1, "x", "d"), ("sigId", "galileo", "U1", 1, "x", "d"), ("sigId", "gps", "U1", None, "y", "d")],
        "enum string, context string, type string, value int, name string, description string")
    named = spark.createDataFrame([("M",), ("M",), ("N",), (None,)], "message string")
    known = spark.createDataFrame([("M",), ("O",)], "message string")
    found = {r.rule: (r.checked, r.violations, r.passed) for r in rules.check((rows, rules.enum_value_set()), (named, rules.enum_references()), (known, rules.known_messages())).collect()}
    assert found == {
        "value_present": (6, 2, False), "value_fits_type": (6, 1, False), "described": (6, 2, False), "duplicate_value": (4, 1, False), "duplicate_name": (1, 1, False),
        "contexts": (1, 0, True), "enumerations": (2, 18, False), "message_known": (3, 2, False)}


def test_a_growing_capture_is_followed(spark, tmp_path):
    captures.register(spark)
    (tmp_path / "in").mkdir()
    data = bytes(range(256)) * 9

    def run(settle):
        stream = spark.readStream.format("capture_pieces").option("piece", 100).option("pattern", "*.bin").option("settle", settle).load(str(tmp_path / "in"))
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        rows = spark.read.schema(captures.SCHEMA).parquet(str(tmp_path / "out")).orderBy("capture", "seq").collect()
        return [(r.seq, bytes(r.data)) for r in rows if r.capture.endswith("a.bin")]

    (tmp_path / "in" / "a.bin").write_bytes(data[:260])
    (tmp_path / "in" / "empty.bin").write_bytes(b"")
    (tmp_path / "in" / "other.txt").write_bytes(b"x")
    pieces = [(n, data[at : at + 100]) for n, at in enumerate(range(0, len(data), 100))]
    assert run(3600) == pieces[:2] == run(3600)
    (tmp_path / "in" / "a.bin").write_bytes(data)
    assert run(3600) == pieces[:-1]
    assert run(0) == pieces
    batch = spark.read.format("capture_pieces").option("piece", 100).option("split", 250).option("pattern", "*.bin").load(f"file://{tmp_path}/in")
    assert batch.rdd.getNumPartitions() == 12
    (tmp_path / "small").mkdir()
    for name in "abcdefg":
        (tmp_path / "small" / name).write_bytes(name.encode() * 30)
    small = spark.read.format("capture_pieces").option("piece", 20).option("split", 60).load(str(tmp_path / "small"))
    assert small.rdd.getNumPartitions() == 4 and sorted((r.capture[-1], r.seq, len(r.data)) for r in small.collect()) == [(n, k, 20 - 10 * k) for n in "abcdefg" for k in (0, 1)]
    assert sorted((r.seq, bytes(r.data)) for r in batch.collect()) == pieces
    (tmp_path / "in" / "a.bin").write_bytes(data + b"more")
    with pytest.raises(Exception, match="has grown"):
        run(0)


def test_results_of_a_report_do_not_carry_their_file(spark, tmp_path):
    put(tmp_path, f"x{readers.VALIDATION_SUFFIX}", {"message": "A", "results": [{"manual": "m1", "matches": True}, {"manual": "m2"}]})
    rows = readers.validation_results(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate " in line)
    assert "results" in generate and "document" not in generate
    assert sorted((r.message, r.manual, r.matches) for r in rows.collect()) == [("A", "m1", True), ("A", "m2", None)]


def test_reports_of_one_source_are_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PER_FILE", 5)
    spark.range(40).selectExpr("id AS doc_id", "'s' AS source", "id * 2 AS n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(20).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality").write.parquet(str(tmp_path / "labels.parquet"))
    sizes = []
    kept = readers.validation_results

    def counted(spark, path):
        sizes.append(len(os.listdir(path)))
        return kept(spark, path)

    monkeypatch.setattr(readers, "validation_results", counted)
    found = {r.manual: (r.message, r.matches, r.issue) for r in files.report_files(spark, str(tmp_path)).collect()}
    assert found == {str(i): ("s", None if i >= 20 else i % 2 == 1, f"size {2 * i}" if i < 20 and i % 2 == 0 else None) for i in range(40)}
    assert sizes[0] > 4


def test_many_capture_ranges_are_few_tasks_and_batches(tmp_path):
    held = captures._Files({"path": str(tmp_path), "piece": "10", "split": "10"})
    sizes = {f"c{i}": 95 for i in range(300)}
    parts = held.ranges({}, sizes)
    assert len(parts) <= captures.MOST_TASKS < 3000
    assert sorted(p for part in parts for p in part.parts) == sorted((c, at, min(95, at + 10)) for c in sizes for at in range(0, 95, 10))
    (tmp_path / "a#1").write_bytes(b"x" * 95)
    assert held.sizes() == {"a#1": 95}
    batches = list(held.rows(captures.Ranges([("a#1", 0, 50), ("a#1", 50, 95)])))
    assert [b.num_rows for b in batches] == [10] and batches[0].column(0)[0].as_py() == f"file://{tmp_path}/a#1"
    old = {f"file://{tmp_path}/c0": 10}
    assert [p for part in held.ranges(old, {"c0": 15}) for p in part.parts] == [("c0", 10, 15)]


def test_files_of_many_folders_are_listed_and_read_in_tasks(spark, tmp_path, monkeypatch):
    """Names and texts as Spark's own reader gives them, and few tasks for many files."""
    for folder in ("m#1", "m 2/deep", "_hidden", ".h"):
        for i in range(40):
            put(tmp_path / "s" / folder, f"a#{i} é%41.json", f"{{broken {i}")
    put(tmp_path / "s", "top.json", {"message_name": "A"})
    put(tmp_path / "s", "_no.json", {})
    put(tmp_path / "s", "no.txt", {})
    put(tmp_path / "s" / "m 3", "empty.json", "")
    found = readers.documents(spark, f"file://{tmp_path}/s", recursive=True)
    rows = sorted((r.folder, r.file, r.stem, r.text, r.document is None) for r in found.collect())
    assert found.rdd.getNumPartitions() <= readers.TASKS * spark.sparkContext.defaultParallelism
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(readers, "_listed", lambda *x: None)
    theirs = readers.documents(spark, f"file://{tmp_path}/s", recursive=True)
    assert rows == sorted((r.folder, r.file, r.stem, r.text, r.document is None) for r in theirs.collect()) and len(rows) == 81


def test_captures_are_listed_and_read_in_tasks(spark, tmp_path, monkeypatch):
    (tmp_path / "c").mkdir()
    for i in range(30):
        (tmp_path / "c" / f"c {i}.bin").write_bytes(bytes([i]) * 25 * (i % 3))
    both = lambda: (
        sorted((r.capture, bytes(r.data)) for r in readers.captures(spark, str(tmp_path / "c"), "*.bin").collect()),
        sorted((r.capture, r.seq, bytes(r.data)) for r in readers.capture_pieces(spark, str(tmp_path / "c"), "*.bin", piece=10).collect()),
    )
    ours = both()
    assert "FileScan" not in readers.captures(spark, str(tmp_path / "c"))._jdf.queryExecution().executedPlan().toString()
    whole = {f"file:{tmp_path}/c/c {i}.bin": bytes([i]) * 25 * (i % 3) for i in range(30) if i % 3}
    assert ours[0] == sorted(whole.items()) and len(ours[1]) == 10 * 3 + 10 * 5
    monkeypatch.setattr(readers, "_listed", lambda *x: None)
    assert ours[0] == sorted((r.capture, bytes(r.data)) for r in readers.captures(spark, str(tmp_path / "c"), "*.bin").collect())


def test_files_keep_their_names(spark, tmp_path):
    rows = spark.createDataFrame([("m/a#1.json", "x"), ("m/a#2.json", "y"), ("m/50%.json", "z")], "name string, data string")
    folder = files.put(rows, spark, "names", f"file://{tmp_path}/in")
    assert {r.file: r.text for r in readers.documents(spark, folder, recursive=True).collect()} == {"a#1.json": "x", "a#2.json": "y", "50%.json": "z"}


def test_second_registry_takes_its_files_apart_once(spark, tmp_path):
    put(tmp_path, "a.json", {"M": {"a": "U001", "g": ["n", {"b": ["X001", {"x": "U002"}]}]}})
    fields, bits = readers.second_registry(spark, str(tmp_path))
    for rows in (fields, bits):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "FileScan parquet" in plan
    assert sorted((r.path, r.pos, r.field) for r in fields.collect()) == [([], 0, "a"), ([], 1, "g"), (["g"], 0, "b")]
    assert [(r.path, r.field, r.bit, r.width) for r in bits.collect()] == [(["g"], "b", "x", 2)]
