"""Order-dependent merges against plain loops."""

import random

import pytest

from tallyframe.operators import conflict, merge, vote


def union_in_order(items):
    """Accepted values and sources of one key, source by source."""
    accepted, sources = {}, {}
    for source in sorted({s for s, _, _ in items}):
        taken = set(accepted.values())
        for s, name, value in items:
            if s != source:
                continue
            if name in accepted:
                sources[name].add(source)
            elif value not in taken:
                accepted[name] = value
                sources[name] = {source}
    return accepted, sources


@pytest.mark.parametrize("seed", range(2))
def test_enum_union(spark, seed):
    rng = random.Random(seed)
    rows = []
    for key in ("a", "b", "c"):
        for source in range(6):
            for name in rng.sample(range(12), 6):
                rows.append((key, f"s{source}", f"n{name}", rng.randrange(10)))
    items = spark.createDataFrame(rows, "k string, source string, name string, value int")
    union = merge.enum_union(items, ["k"], "name", "value", ["source"]).cache()
    listed = merge.enum_sources(items, union, ["k"], "name", "source", ["source"])
    for key in ("a", "b", "c"):
        accepted, sources = union_in_order([r[1:] for r in rows if r[0] == key])
        assert {r.name: r.value for r in union.where(f"k = '{key}'").collect()} == accepted
        found = {}
        for r in listed.where(f"k = '{key}'").collect():
            found.setdefault(r.name, set()).add(r.source)
        assert found == sources


def test_longer_text_wins_and_first_on_a_tie(spark):
    rows = [(1, "a", "xx", 0), (2, "a", "yyy", 1), (3, "a", "zzz", 2), (4, "reservedB", "long text", 3), (5, "b", None, 4)]
    items = spark.createDataFrame(rows, "seq int, name string, description string, bit int").selectExpr("'m' as m", "*")
    out = merge.superset(items, ["m"], ["name"], "description", ["seq"], ["bit"], drop_reserved="name")
    assert {(r.name, r.bit) for r in out.collect()} == {("a", 1), ("b", 4)}


def test_vote_ties_go_to_the_first_seen(spark):
    rows = [("m", "x", 3), ("m", "y", 1), ("m", "y", 4), ("m", "x", 2), ("one", "z", 9)]
    out = {r.m: r for r in vote.vote(spark.createDataFrame(rows, "m string, fp string, seq int"), ["m"], "fp", ["seq"]).collect()}
    assert out["m"].winning_value == "y" and out["m"].confidence == "no_consensus" and out["m"].confidence_score == 0.25
    assert out["one"].confidence == "single_source" and out["one"].has_consensus


def test_vote_does_not_depend_on_row_order(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), rng.randrange(3), i) for i in range(400)]
    first = vote.vote(spark.createDataFrame(rows, "m int, fp int, seq int"), ["m"], "fp", ["seq"]).drop("winning_order")
    rng.shuffle(rows)
    second = vote.vote(spark.createDataFrame(rows, "m int, fp int, seq int").repartition(5), ["m"], "fp", ["seq"]).drop("winning_order")
    assert sorted(first.collect()) == sorted(second.collect())


def test_bad_settings_are_refused(spark):
    rows = spark.createDataFrame([("m", "x", 1)], "m string, fp string, seq int")
    with pytest.raises(ValueError):
        vote.vote(rows, ["m"], "fp", ["seq"], threshold=0)
    with pytest.raises(ValueError):
        vote.vote(rows, ["m"], "fp", [])
    with pytest.raises(ValueError):
        vote.filter_consensus(rows, True, "sure")


def fold_in_order(state, rows):
    """One arrival after another, by the compatible rules."""
    for entity, source, fp in rows:
        if entity not in state:
            state[entity] = {"fp": fp, "a": 1, "t": 1, "label": "single_source", "score": 0.5, "in": {source}, "out": set()}
            continue
        s = state[entity]
        if fp == s["fp"]:
            if source in s["in"]:
                continue
            s["in"].add(source)
            s["a"] += 1
        else:
            if source in s["out"]:
                continue
            s["out"].add(source)
        s["t"] += 1
        ratio = s["a"] / s["t"]
        s["score"] = round(ratio, 3)
        if fp == s["fp"] and ratio >= 0.75:
            s["label"] = "low" if s["t"] < 3 else ("high" if ratio >= 0.9 else "medium")
    return state


def test_incremental_equals_one_by_one(spark):
    rng = random.Random(3)
    rows = [(f"m{rng.randrange(8)}", f"s{rng.randrange(12)}", rng.choice("xxxy"), i) for i in range(240)]
    canonical = spark.createDataFrame([], "m string, fingerprint string, agreement_count bigint, total_count bigint, confidence string, confidence_score double")
    members = spark.createDataFrame([], "m string, source string, agrees boolean, fingerprint string")
    for start in (0, 70, 150):
        part = spark.createDataFrame(rows[start : {0: 70, 70: 150, 150: 240}[start]], "m string, src string, fp string, seq int")
        canonical, members = vote.incremental(canonical, members, part, ["m"], "src", "fp", ["seq"])
        canonical, members = canonical.cache(), members.cache()
    expected = fold_in_order({}, [r[:3] for r in rows])
    found = {r.m: r for r in canonical.collect()}
    assert set(found) == set(expected)
    for key, e in expected.items():
        r = found[key]
        assert (r.fingerprint, r.agreement_count, r.total_count, r.confidence, r.confidence_score) == (e["fp"], e["a"], e["t"], e["label"], e["score"])


def test_dash_gives_way_to_a_value(spark):
    rows = [("k", "-", 1), ("k", "-", 2), ("k", "1e-7", 3), ("k", "", 4)]
    out = conflict.detect(spark.createDataFrame(rows, "k string, scale string, seq int"), ["k"], [conflict.KEY_ATTRIBUTES[2]], ["seq"]).first()
    assert (out.suggested, out.confidence, out.needs_review) == ("1e-7", 0.9, False)
    assert out.reason == "Scale value differs - prefer actual value over '-'" and out.instance_count == 3
