"""The paths for hot keys must give what the plain paths give."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.operators import sections, skew

HOT = {"floor": 50, "pieces": 7}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}", rng.randrange(60), i, rng.randrange(9)) for i in range(3000)]
    return spark.createDataFrame(data, "key string, at int, id int, v int").cache()


def test_hot_key_is_found(rows):
    assert [r.key for r in skew.hot_keys(rows, ["key"], floor=200).collect()] == ["hot"]
    assert skew.hot_keys(rows, ["key"]) is None


def test_chunks_split_the_hot_key(rows):
    chunked, hot, _ = skew.with_chunks(rows, ["key"], ["at", "id"], **HOT)
    assert chunked.where("key = 'hot'").select("_chunk").distinct().count() > 3
    ranges = chunked.where("key = 'hot'").groupBy("_chunk").agg(F.min(F.struct("at", "id")).alias("a"), F.max(F.struct("at", "id")).alias("b"))
    ordered = ranges.orderBy("_chunk").collect()
    assert all(x.b < y.a for x, y in zip(ordered, ordered[1:]))


def test_exact_copies_are_split_too(spark):
    copies = spark.range(2000).selectExpr("'hot' as key", "1 as at", "3 as v")
    chunked, _, order = skew.with_chunks(copies, ["key"], ["at"], **HOT)
    assert order == ["at", "_tie"] and chunked.select("_chunk").distinct().count() > 3
    found = skew.ordered(copies, ["key"], ["at"], {"s": ("sum_before", F.col("v"))}, **HOT)
    assert sorted(r.s or 0 for r in found.collect()) == [3 * i for i in range(2000)]


@pytest.mark.parametrize("chunking", [{}, HOT])
def test_ordered_equals_windows(rows, chunking):
    value = F.when(F.col("v") > 2, F.col("v"))
    found = skew.ordered(rows, ["key"], ["at", "id"], {
        "p": ("lag", value), "n": ("lead", F.col("v")), "s": ("sum_before", F.col("v")), "m": ("max_before", value),
    }, **chunking)
    w = W.partitionBy("key").orderBy("at", "id")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    expected = rows.select("*", F.lag(value).over(w).alias("p"), F.lead("v").over(w).alias("n"), F.sum("v").over(before).alias("s"), F.max(value).over(before).alias("m"))
    columns = ["key", "at", "id", "v", "p", "n", "s", "m"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_null_keys_match(spark, how):
    left = spark.createDataFrame([(None, i) for i in range(100)] + [("a", 1), ("b", 2)], "key string, v int")
    right = spark.createDataFrame([(None, 5), ("a", 6)], "key string, w int")
    found = skew.null_safe_join(left, right, ["key"], how)
    assert found.count() == {"inner": 101, "left": 102, "left_semi": 101, "left_anti": 1}[how]


@pytest.mark.parametrize("chunking", [{}, HOT])
def test_lists_hold_every_row(rows, chunking):
    out = {}
    for r in skew.listed(rows, ["key"], ["id"], F.col("v"), "vs", 100, **chunking).collect():
        assert r.vs_count == len(r.vs) <= 100
        out.setdefault(r.key, []).append((r.part, r.vs))
    for key in ("hot", "k3"):
        expected = [r.v for r in rows.where(F.col("key") == key).orderBy("id").collect()]
        assert [v for _, part in sorted(out[key]) for v in part] == expected
    assert len(out["hot"]) > 15


def pack_in_one_pass(ranges, limit):
    out, state = {}, None
    for start, end, order in sorted(ranges, key=lambda r: (r[0], r[2])):
        if state and max(state[2], end) - state[1] + 1 <= limit:
            state = (state[0], state[1], max(state[2], end))
        else:
            state = (order, start, end)
        out[order] = state[0]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_packing_hot_sources(spark, seed):
    rng = random.Random(seed)
    data = [("hot", s, s + rng.choice([0, 0, 1, 2, 5, 30]), i) for i, s in enumerate(rng.randrange(900) for _ in range(1500))]
    data += [("cold", s, s + 1, 10_000 + s) for s in range(0, 40, 3)]
    frame = spark.createDataFrame(data, "source string, s int, e int, id int")
    found = sections.pack(frame, "source", "s", "e", "id", 15, **HOT)
    for source in ("hot", "cold"):
        expected = pack_in_one_pass([(s, e, i) for k, s, e, i in data if k == source], 15)
        assert {r.id: r.batch for r in found.where(F.col("source") == source).collect()} == expected


@pytest.mark.parametrize("chunking", [{}, HOT])
def test_packing_tied_and_textual_orders(spark, chunking):
    data = [("s", 1, 2, "a"), ("s", 1, 2, "a"), ("s", 30, 31, "b"), ("t", 5, 5, None)]
    found = sections.pack(spark.createDataFrame(data, "source string, s int, e int, id string"), "source", "s", "e", "id", 15, **chunking)
    assert sorted((r.source, r.s, r.batch) for r in found.collect() if r.source == "s") == [("s", 1, "a"), ("s", 1, "a"), ("s", 30, "b")]
    assert found.count() == 4
