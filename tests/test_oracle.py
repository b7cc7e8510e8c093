"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tallyframe.operators import skew
from tallyframe.plans import all_oracles, all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return f"{type(value).__name__}:{value}"


def check(spark, duck, name):
    result = all_queries()[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    columns = sorted(result.columns)
    found = sorted(tuple(plain(r[c]) for c in columns) for r in result.collect())
    cursor = duck.execute(all_oracles()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert found == sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_matches_sql(spark, duck, name):
    check(spark, duck, name)


ORDERED_OR_JOINED = [
    "structure_rules", "bit_layout", "vote_outliers", "section_ranges", "level_ranges", "config_sections", "config_sections_batched",
    "extraction_rules", "page_batches", "frame_scan", "incremental_consensus", "decision_changes", "patch_registry", "best_reviewable",
]


@pytest.mark.parametrize("name", ORDERED_OR_JOINED)
def test_query_matches_sql_when_keys_are_hot(spark, duck, name, monkeypatch):
    """The same results when every key with a few rows is treated as hot."""
    monkeypatch.setattr(skew, "HOT_FLOOR", 5)
    check(spark, duck, name)
