"""Plans that matter at scale: what is read, where rows are reduced, what is not there."""

from pyspark.sql import functions as F

from tallyframe.operators import compare, layout, skew
from tallyframe.plans import auditing, voting
from tallyframe.session import cut_lineage

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vote_reads_four_columns_and_combines_first(spark):
    plan = plan_of(voting.vote_consensus(spark, FOLDER))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate"}
    assert "partial_count" in plan and "partial_min" in plan and "Window" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_filters_reach_the_scan(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").where("l_quantity > 49")
    assert "GreaterThan(l_quantity,49.0)" in plan_of(lines.groupBy("l_orderkey").count())


def test_top_rows_are_cut_before_the_shuffle(spark):
    rows = spark.createDataFrame([("m", i, "missing_in_first", "x", "y", "U1", "U1") for i in range(9)], "m string, o int, kind string, first_n string, second_n string, first_t string, second_t string")
    plan = plan_of(layout.summarize(rows, ["m"], "o", "n", "t"))
    assert plan.index("row_number(), 3, Final") < plan.index("row_number(), 3, Partial")


def test_no_hot_key_leaves_the_plain_plan(spark):
    rows = spark.createDataFrame([("m", i) for i in range(9)], "m string, o int")
    plan = plan_of(skew.ordered(rows, ["m"], ["o"], {"p": ("lag", F.col("o"))}))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_documents_are_read_without_a_shuffle(spark):
    rows = spark.createDataFrame([('{"fields":[{"name":"a"}]}',)], "structure string")
    assert "Exchange" not in plan_of(layout.add_fingerprint(layout.add_fields(rows)))


def test_rule_sets_read_each_table_once(spark):
    found = auditing.enum_value_rules(spark, FOLDER)
    plan = plan_of(found)
    assert plan.count("FileScan parquet") == 3 and plan.count("Exchange hashpartitioning") == 3
    # The two messages that no nation has are few here; every other rule is broken somewhere, too, but for one.
    assert {r.rule for r in found.collect() if not r.violations} <= {"enumerations", "message_known"}


def test_registries_do_not_pass_through_the_driver(spark):
    # Written, so that Spark takes them for as small as their files.
    kept = lambda rows, schema: cut_lineage(spark.createDataFrame(rows, schema))
    names = [f"m{i}" for i in range(200)]
    ours = kept([(m, f, "X1") for m in names for f in ("a", "b", "c")], "message string, field string, dtype string")
    theirs = kept([(m, f, "X001") for m in names for f in ("a", "B", "d")], "message string, field string, dtype string")
    our_bits = kept([(m, f, b, 0, 1) for m in names for f in "a" for b in ("p", "q")], "message string, field string, bit string, bit_offset int, width int")
    their_bits = kept([(m, f, b, 1, 1) for m in names for f in ("a", "B") for b in ("p", "Q")], "message string, field string, bit string, bit_offset int, width int")
    aliases, bit_aliases = (spark.createDataFrame([x], "our_name string, other_name string") for x in (("b", "B"), ("q", "Q")))
    fields = compare.cross(ours, theirs, "message", "field", "dtype", aliases)
    bits = compare.cross_bits(ours, theirs, our_bits, their_bits, "message", "field", "dtype", "bit", aliases, bit_aliases)
    for found in (fields, bits):
        assert "Broadcast" not in plan_of(found) and "SortMergeJoin" in plan_of(found)
    assert sorted((r.message, r.field, r.issue) for r in fields.collect()) == sorted((m, *x) for m in names for x in (("c", "our_only"), ("d", "library_only")))
    assert sorted((r.message, r.field, r.bit, r.issue) for r in bits.collect() if r.bit) == sorted((m, "a", b, "offset_mismatch") for m in names for b in ("p", "q"))
    assert sorted((r.message, r.field, r.issue) for r in bits.collect() if not r.bit) == sorted((m, "b", "missing_bitfield") for m in names)
