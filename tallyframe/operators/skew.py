"""Ordered columns and lists that keep a hot key from landing in one task.

A key is hot when it has more than ``floor`` rows, whatever the size of the table. Joins need no such care:
adaptive execution splits the hot keys of an equi-join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

HOT_FLOOR = 1 << 20
PIECES = 64


def hot_keys(df: DataFrame, keys, counts: DataFrame | None = None, floor=None) -> DataFrame | None:
    """Keys with more than ``floor`` rows, with their count ``_n``.

    Runs one aggregation to find out, unless the caller knows the counts; None when there is no such key, so
    that the usual case keeps the plain plan. The keys are written out, so Spark knows their size and chooses
    how to join them.
    """
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    limit = HOT_FLOOR if floor is None else floor
    if (counts.agg(F.max("_n")).first()[0] or 0) <= limit:
        return None
    return cut_lineage(counts.where(F.col("_n") > limit).select(*keys, "_n"))


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Equi-join in which null keys match; keeps the left key columns."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for the side of an equi-join that grows with the input: its rows meet in tasks and never pass through the driver.

    Spark takes the size of a table that was written from its files, and rows that are much alike take far less room there than
    in a broadcast (33 MB and 2 GB of two registries of 900,000 messages).
    """
    return df.hint("merge")


def with_chunks(df: DataFrame, keys, order, pieces=PIECES, floor=None) -> tuple[DataFrame, DataFrame | None, list]:
    """Add ``_chunk``: rows of a hot key are cut, in ``order``, into about ``pieces`` runs.

    Returns the rows, the hot keys (None: no hot key, every chunk is 0) and the order to use. With a
    hot key the rows are written once with a number each, ``_tie``, which ends the order, so that
    even exact copies are told apart and every later reader sees the same runs. The cut points are
    order tuples drawn by hash.
    """
    hot = hot_keys(df, keys, None, floor)
    if hot is None:
        return df.withColumn("_chunk", F.lit(0)), None, list(order)
    rows = cut_lineage(df.withColumn("_tie", F.monotonically_increasing_id()))
    order = [*order, "_tie"]
    step = F.greatest(F.lit(1).cast("bigint"), (F.col("_n") / pieces).cast("bigint"))
    cuts = (
        null_safe_join(rows.select(*dict.fromkeys([*keys, *order])), hot, keys, "inner")
        .where(F.pmod(F.xxhash64(*order), step) == 0)
        .groupBy(*keys)
        .agg(F.collect_set(F.struct(*order)).alias("_cuts"))
    )
    here = F.struct(*order)
    chunk = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= here)), F.lit(0))
    chunked = null_safe_join(rows, cut_lineage(cuts), keys, "left").withColumn(
        "_chunk", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(chunk)
    )
    return chunked.drop("_cuts"), hot, order


def ordered(df: DataFrame, keys, order, columns: dict[str, tuple[str, Column]], **chunking) -> DataFrame:
    """Add columns that depend on neighbouring rows of the same key, in ``order``.

    ``columns`` maps a name to (kind, expression); kind is ``lag``, ``lead``, ``sum_before`` or
    ``max_before`` (over the earlier rows; null when there are none). Each run of a hot key is
    worked on by itself, and one summary row per run carries the state across runs.
    """
    inputs = {name: f"_in_{name}" for name in columns}
    source = df.withColumns({inputs[name]: expression for name, (_, expression) in columns.items()})
    source, hot, order = with_chunks(source, keys, order, **chunking)
    if hot is None:
        out = _near(source, keys, order, columns, inputs)
        return out.drop("_chunk", *inputs.values())
    rank = F.struct(*order)
    summaries = []
    for name, (kind, _) in columns.items():
        value = F.col(inputs[name])
        summary = {
            "lag": F.max_by(F.struct(value.alias("v")), rank),
            "lead": F.min_by(F.struct(value.alias("v")), rank),
            "sum_before": F.struct(F.sum(value).alias("v")),
            "max_before": F.struct(F.max(value).alias("v")),
        }[kind]
        summaries.append(summary.alias(f"_s_{name}"))
    cut = W.partitionBy(*keys).orderBy("_chunk")
    earlier = cut.rowsBetween(W.unboundedPreceding, -1)
    chunk_keys = [*keys, "_chunk"]
    # Only the runs of hot keys are summed up.
    hot_rows = null_safe_join(source, hot, keys, "left_semi")
    runs = hot_rows.groupBy(*chunk_keys).agg(*summaries)
    carries = []
    for name, (kind, _) in columns.items():
        held = F.col(f"_s_{name}")
        carry = {
            "lag": F.lag(held).over(cut)["v"],
            "lead": F.lead(held).over(cut)["v"],
            "sum_before": F.sum(held["v"]).over(earlier),
            "max_before": F.max(held["v"]).over(earlier),
        }[kind]
        carries.append(carry.alias(f"_c_{name}"))
    runs = runs.select(*chunk_keys, *carries)
    out = null_safe_join(source, cut_lineage(runs), chunk_keys, "left")
    out = _near(out, chunk_keys, order, columns, inputs, carried=True)
    return out.drop("_chunk", "_tie", *inputs.values(), *[f"_c_{name}" for name in columns])


def _near(df: DataFrame, keys, order, columns, inputs, carried=False) -> DataFrame:
    """The columns of :func:`ordered` within each group of ``keys``, continued from the carried state."""
    inside = W.partitionBy(*keys).orderBy(*order)
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    results = {}
    for name, (kind, _) in columns.items():
        value = F.col(inputs[name])
        carry = F.col(f"_c_{name}") if carried else F.lit(None)
        if kind in ("lag", "lead"):
            near = (F.lag if kind == "lag" else F.lead)(F.struct(value.alias("v"))).over(inside)
            results[name] = F.when(near.isNull(), carry).otherwise(near["v"])
        elif kind == "sum_before":
            near = F.sum(value).over(before)
            results[name] = F.when(near.isNull(), carry).otherwise(near + F.coalesce(carry, F.lit(0)))
        else:
            near = F.max(value).over(before)
            results[name] = F.greatest(near, carry) if carried else near
    return df.withColumns(results)


def listed(df: DataFrame, keys, order, value: Column, name: str, size: int = 1000, **chunking) -> DataFrame:
    """Per key, parts of up to ``size`` rows in order: ``part`` (from 0), ``name`` (the values), ``<name>_count``.

    Every row is in some list, however many a key has; no row holds more than ``size`` values.
    """
    one = F.lit(1).cast("bigint")
    placed = ordered(df.withColumn("_v", F.struct(value.alias("v"))), keys, order, {"_at": ("sum_before", one)}, **chunking)
    at = F.coalesce("_at", F.lit(0).cast("bigint"))
    parts = placed.select(*keys, F.floor(at / size).alias("part"), at.alias("_at"), "_v")
    lists = parts.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("_at", "_v"))).alias("_l"))
    return lists.select(*keys, "part", F.transform("_l", lambda x: x["_v"]["v"]).alias(name), F.size("_l").cast("bigint").alias(f"{name}_count"))
