"""Filter interaction audit: what each filter removes in every order of the filters, by packed counters."""

from __future__ import annotations

from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
_SPACES, _SYMBOLS = r"[ \t\n\x0B\f\r]+", "[#$%&*|]"

#: What is counted of each step of each order; a field of the packed integers each.
COUNTERS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
#: Bits of a field. A row adds at most one to a field and 120 to ``shapley``, so nothing runs over below 2 ** 56 rows a part.
WIDTH = 64


def failures(text: Column) -> Column:
    """The mask of filters A to D (bit 0 to 3) that a text fails: words, distinct words, capitals, symbols. Null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, _SPACES), "")
    failed = [
        F.size(words) < LEAST_WORDS,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT,
        F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") * 100 > F.char_length(text).cast("bigint") * MOST_CAPITALS,
        text.rlike(_SYMBOLS),
    ]
    return sum((f.cast("int") * (1 << bit) for bit, f in enumerate(failed)), F.lit(0))


def masks(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): rows of ``df`` by part, failed filters and labels.

    Bit 4, filter E, is set where a smaller key has the same text. A null part counts as the empty string, a null
    text as the empty text. Null keys have no label, are smaller than none and none is smaller than they, so such
    rows do not fail E; nor do repeated rows of the least key. A key with several labels is good (quality 1) or toxic
    if one of them says so. Other columns are not read; an empty table gives no rows.

    Equal texts fail the same of A to D, so that a text needs one row of each part and label after the first
    aggregation, however many copies there are.
    """
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.col("quality").eqNullSafe(1)).alias("_good"), F.max(F.col("toxic").eqNullSafe(1)).alias("_toxic")
    )
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = df.select(
        F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("_part"),
        failures(content).alias("_mask"), F.unhex(F.sha2(content.cast("binary"), 256)).alias("_text"),
    )
    cell = ["_text", "_part", "_mask", "_good", "_toxic"]
    told = rows.join(marks, F.col("_key") == F.col("_id"), "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(False)) for c in ("_good", "_toxic")}
    )
    copies = told.groupBy("_key", *cell).agg(F.count(F.lit(1)).alias("_n"))
    cells = copies.groupBy(*cell).agg(
        F.sum("_n").alias("_n"), F.min("_key").alias("_least"), F.min_by("_n", "_key").alias("_of_least"),
        F.sum(F.when(F.col("_key").isNull(), F.col("_n"))).alias("_of_null"),
    )
    first = F.col("_least").eqNullSafe(F.min("_least").over(W.partitionBy("_text")))
    zero = F.lit(0).cast("bigint")
    fresh = F.coalesce("_of_null", zero) + F.when(first, F.coalesce("_of_least", zero)).otherwise(zero)
    split = cells.withColumn("_fresh", fresh).select(
        "_part", "_good", "_toxic",
        F.inline(F.array(
            F.struct(F.col("_mask").alias("mask"), F.col("_fresh").alias("_some")),
            F.struct((F.col("_mask") + (1 << 4)).alias("mask"), (F.col("_n") - F.col("_fresh")).alias("_some")),
        )),
    )
    sums = split.where("_some > 0").groupBy("_part", "mask", "_good", "_toxic").agg(F.sum("_some").alias("n"))
    return sums.select(F.col("_part").alias("part"), "mask", F.col("_good").alias("good"), F.col("_toxic").alias("toxic"), "n")


def orders(filters: str = FILTERS) -> list[str]:
    return ["".join(p) for p in permutations(filters)]


@cache
def packed(mask: int, good: bool, toxic: bool, filters: str = FILTERS) -> int:
    """What one row with these failed filters adds to each counter of each step of each order, as one integer.

    Field COUNTERS.index(c) of step s of order o is number (o * steps + s) * counters + c, from the lowest bits on.
    """
    total, field = 0, 0
    for order in orders(filters):
        kept = True
        for name in order:
            fails = bool(mask >> filters.index(name) & 1)
            removed = kept and fails
            redundant = fails and not kept
            kept = kept and not fails
            outcomes = (kept, removed, redundant, mask == 1 << filters.index(name), removed and good, removed and toxic)
            for outcome in outcomes:
                total |= outcome << field
                field += WIDTH
    return total


def unpack(total: int, filters: str = FILTERS) -> np.ndarray:
    """[order, step, counter] of a sum of packed integers."""
    n = len(filters)
    fields = len(orders(filters)) * n * len(COUNTERS)
    return np.frombuffer(total.to_bytes(fields * WIDTH // 8, "little"), "<i8").reshape(-1, n, len(COUNTERS))


def audit(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, the COUNTERS, shapley) of (part, mask, good, toxic, n) rows.

    One row for every part, order of the filters and step (from 1), zeros included. ``shapley`` is what the filter
    of the step removes, summed over all orders and any step. Every mask becomes a packed integer, once for each of
    its ``n`` rows, and these are summed up per part; a part has at most four rows a mask, so a part of any size is
    one small group. No rows give no rows.
    """
    names = orders(filters)
    steps = len(filters)
    schema = f"part string, filter_order string, step int, {', '.join(f'{c} bigint' for c in COUNTERS)}, shapley bigint"

    def counted(table: pa.Table) -> pa.Table:
        total = sum(r["n"] * packed(r["mask"], r["good"], r["toxic"], filters) for r in table.to_pylist())
        counts = unpack(total, filters)
        removed = {name: 0 for name in filters}
        for o, order in enumerate(names):
            for s, name in enumerate(order):
                removed[name] += int(counts[o, s, COUNTERS.index("removed")])
        columns = {
            "part": [table.column("part")[0].as_py()] * (len(names) * steps),
            "filter_order": [o for o in names for _ in o],
            "step": pa.array([s + 1 for _ in names for s in range(steps)], pa.int32()),
        }
        columns |= {c: counts[:, :, i].reshape(-1) for i, c in enumerate(COUNTERS)}
        columns["shapley"] = pa.array([removed[name] for o in names for name in o], pa.int64())
        return pa.table(columns)

    return cells.groupBy("part").applyInArrow(counted, schema)
