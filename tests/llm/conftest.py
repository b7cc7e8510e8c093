import glob
import os

import duckdb
import pytest

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

LONG = "The quick brown fox jumps over the lazy dog near the old river bank. " * 4000
TEXTS = [
    None, "", " ", "\n\n", "word", "one two three", "x" * 50_000, LONG, LONG + "tail", "Ünï çödé straße 日本語 ﬁ ▁ \u0000 end",
    "same text here\nsame text here\nother", "repeat me now please repeat me now please " * 12, "repeat me now please repeat me now please " * 12,
]


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def tricky(spark):
    """Null and repeated keys, null, empty and long texts, repeated rows, and columns with names the operators use."""
    rows = [(i, t, f"own {i}", i % 3) for i, t in enumerate(TEXTS)]
    rows += [(None, "one two three", "own", None), (None, None, None, None), (7, LONG, "own 7", 1), rows[5], rows[5]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, `_now` string, quality int").selectExpr(
        "*", "'a' AS hits", "'b' AS secrets", "'c' AS toxicity", "'d' AS language", "'e' AS pieces", "'f' AS spans", "'g' AS licenses", "'h' AS `_row`", "'i' AS `_print`",
        "'j' AS `_text`", "'k' AS `_key`", "'l' AS `_state`", "'m' AS n_chars", "'n' AS `dot.name`",
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.limit(0)
