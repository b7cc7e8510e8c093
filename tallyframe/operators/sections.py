"""Page ranges from outlines, packing of ranges, and metadata read from front matter."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n
from ..session import cut_lineage
from . import skew


# -- outline entries -------------------------------------------------------------------------


def located_entries(outline: DataFrame, title: str, need_ids=True) -> DataFrame:
    """Outline rows that name a message, with its ids; ``need_ids`` keeps only rows with both ids."""
    pattern = fixed.LOCATED_TITLE
    out = outline.withColumns({
        "entity": n.extract(title, pattern, 1),
        "class_id": n.extract(title, pattern, 2),
        "message_id": n.extract(title, pattern, 3),
    }).where("entity is not null")
    return out.where("class_id is not null and message_id is not null") if need_ids else out


def next_entry_ranges(entries: DataFrame, source: str, page: str, seq: str, cap=5) -> DataFrame:
    """Ranges that end at the next entry's page, and at most ``cap`` pages on."""
    out = skew.ordered(entries, [source], [page, seq], {"_next": ("lead", F.col(page))})
    last = F.least(F.col(page) + cap, F.coalesce(F.col("_next"), F.col(page) + cap))
    return out.withColumn("page_start", F.col(page)).withColumn("page_end", last).drop("_next")


def level_ranges(outline: DataFrame, source: str, seq: str, level: str, page: str, default=2, minimum=2, cap: int | None = 4) -> DataFrame:
    """Ranges that end before the next entry on the same or a higher level.

    An entry on level l closes every open entry on a level >= l, so it is repeated once per such
    level and the next closing entry is the next row of that level's own sequence. ``default`` pages
    follow when there is none; ``minimum`` is the least number of pages; ``cap`` limits the pages
    after the first (None: no limit).
    """
    deepest = outline.agg(F.max(level)).scalar()
    closing = outline.withColumn("_level", F.explode(F.sequence(F.col(level), deepest)))
    closing = skew.ordered(closing, [source, "_level"], [seq], {"_next": ("lead", F.col(page))})
    own = closing.where(F.col("_level") == F.col(level))
    start = F.col(page)
    end = F.coalesce(F.col("_next") - 1, start + default)
    if minimum > 1:
        end = F.greatest(end, start + (minimum - 1))
    if cap is not None:
        end = F.least(end, start + cap)
    return own.withColumn("page_start", start).withColumn("page_end", end).drop("_level", "_next")


def first_match(ranges: DataFrame, source: str, entity: str, seq: str) -> DataFrame:
    """The first outline entry per (source, entity)."""
    picked = ranges.groupBy(source, entity).agg(F.min_by(F.struct("page_start", "page_end"), seq).alias("_r"))
    return picked.select(source, entity, "_r.*")


# -- configuration section -------------------------------------------------------------------


def config_section(outline: DataFrame, source: str, seq: str, level: str, title: str, page: str, batched=False, section=fixed.CONFIG_SECTION):
    """The configuration section of each source: (bounds, group ranges).

    The section starts at the first title with ``section`` and ends at the next entry on its level
    (``batched``: on exactly that level and a later page; otherwise on that level or a higher one).
    Its introduction ends before the first reference entry; groups are the key groups after that.
    ``batched`` keeps groups in outline order and only on the level below the reference's.
    """
    here = F.struct(F.col(seq).alias("seq"), F.col(page).alias("page"), F.col(level).alias("level"))
    starts = outline.where(F.col(title).contains(section)).groupBy(source).agg(F.min_by(here, seq).alias("_s"))
    # One row a source, written, so that Spark knows the size of what the outline is joined with.
    inside = skew.null_safe_join(outline, cut_lineage(starts), [source], "inner").where(F.col(seq) > F.col("_s.seq"))
    same = F.col(level) == F.col("_s.level")
    closes = (same & (F.col(page) > F.col("_s.page"))) if batched else (F.col(level) <= F.col("_s.level"))
    refers = F.lower(title).contains("reference")
    if batched:
        refers = refers & F.col(title).contains("Configuration")
    # The first reference counts if it stands before the end, so both are found at once.
    marks = inside.groupBy(source).agg(F.min_by(here, F.when(closes, F.col(seq))).alias("_end"), F.min_by(here, F.when(refers, F.col(seq))).alias("_first"))
    before = F.col("_end").isNull() | (F.col("_first.seq") < F.col("_end.seq"))
    marks = cut_lineage(marks.withColumn("_ref", F.when(before, F.col("_first"))).drop("_first"))
    bounds = skew.null_safe_join(starts, marks, [source], "left").select(
        source,
        F.col("_s.page").alias("section_start"),
        (F.col("_end.page") - 1).alias("section_end"),
        F.when(F.col("_ref").isNotNull(), F.col("_s.page")).alias("intro_start"),
        (F.col("_ref.page") - 1).alias("intro_end"),
    )
    open_rows = F.col("_end").isNull() | (F.col(seq) < F.col("_end.seq"))
    named = skew.null_safe_join(inside, marks.where("_ref is not null"), [source], "inner").where(open_rows & (F.col(seq) > F.col("_ref.seq")))
    if batched:
        named = named.where(F.col(level) == F.col("_ref.level") + 1)
    named = named.withColumn("group", n.extract(title, fixed.GROUP_TITLE)).where("`group` is not null")
    order = [seq] if batched else [page, seq]
    listed = skew.ordered(named, [source], order, {"_next": ("lead", F.col(page))})
    start, after = F.col(page), (F.col("_end.page") - 1)
    last = F.coalesce(after, start + (5 if batched else 10))
    between = F.greatest(start, F.col("_next") - 1)
    end = F.when(F.col("_next").isNotNull(), between).otherwise(last if batched else F.greatest(last, start))
    ranges = listed.groupBy(source, "group").agg(
        F.max_by(F.struct(start.alias("page_start"), end.alias("page_end")), F.struct(*order)).alias("_r")
    )
    return bounds, ranges.select(source, "group", "_r.*")


# -- packing ---------------------------------------------------------------------------------


def _pack(rows: pd.DataFrame, max_pages: int, state):
    """Greedy packing of sorted ranges from ``state`` = (batch key, first page, last page) or None."""
    ids = []
    for start, end, order in zip(rows["_start"], rows["_end"], rows["_order"]):
        if state is not None and max(state[2], end) - state[1] + 1 <= max_pages:
            state = (state[0], state[1], max(state[2], end))
        else:
            state = (order, start, end)
        ids.append(state[0])
    return ids, state


def pack(ranges: DataFrame, source: str, start: str, end: str, order: str, max_pages: int = 15, **chunking) -> DataFrame:
    """Batches of consecutive ranges of a source, each spanning at most ``max_pages`` pages.

    Adds ``batch`` (the ``order`` value of its first range). Packing is sequential, but what a run
    of rows does depends on earlier rows only through the first page of the open batch, and only
    if that page is within ``max_pages`` of the run. So for a hot source each run is packed once
    for every such page, the runs' outcomes are chained, and each run is packed again from its
    true start.
    """
    # Rows are told apart by a number of their own, so equal orders, of any type, stay apart.
    numbered = cut_lineage(ranges.withColumn("_order", F.monotonically_increasing_id()))
    rows = numbered.withColumns({"_start": F.col(start).cast("bigint"), "_end": F.col(end).cast("bigint"), "_by": F.col(order)})
    rows, hot, _ = skew.with_chunks(rows, [source], ["_start", "_by", "_order"], **chunking)
    slim = rows.select(source, "_chunk", "_start", "_end", "_by", "_order")
    source_type = dict(ranges.dtypes)[source]
    sequence = ["_start", "_by", "_order"]

    def outcomes(key, group):
        group = group.sort_values(sequence)
        first = int(group["_start"].iloc[0])
        out = []
        for back in range(-1, max_pages):
            entry = None if back < 0 else (None, first - back, first - back)
            _, (batch, page, last) = _pack(group, max_pages, entry)
            out.append((key[0], key[1], first, back, batch is None, batch or 0, page, last))
        return pd.DataFrame(out, columns=[source, "_chunk", "first", "back", "through", "batch", "page", "last"])

    def chain(key, group):
        out, state = [], None
        for chunk, table in group.groupby("_chunk", sort=True):
            out.append((key[0], int(chunk), state is not None, *(state or (0, 0, 0))))
            back = -1
            if state is not None and state[2] - state[1] + 1 <= max_pages:
                back = int(table["first"].iloc[0]) - state[1]
            if not 0 <= back < max_pages:
                back = -1
            row = table[table["back"] == back].iloc[0]
            if row["through"]:  # the open batch went on through the whole run
                state = (state[0], state[1], max(state[2], int(row["last"])))
            else:
                state = (int(row["batch"]), int(row["page"]), int(row["last"]))
        return pd.DataFrame(out, columns=[source, "_chunk", "_open", "_b", "_p", "_l"])

    def entries(hot):
        schema = f"`{source}` {source_type}, _chunk int, first bigint, back int, through boolean, batch bigint, page bigint, last bigint"
        hot_rows = skew.null_safe_join(slim, hot, [source], "left_semi")
        # One row per (run, possible page): at most pieces * (max_pages + 1) rows per hot source.
        tables = hot_rows.groupBy(source, "_chunk").applyInPandas(outcomes, schema)
        return tables.groupBy(source).applyInPandas(
            chain, f"`{source}` {source_type}, _chunk int, _open boolean, _b bigint, _p bigint, _l bigint"
        )

    def assign(key, group):
        group = group.sort_values(sequence)
        row = group.iloc[0]
        state = (int(row["_b"]), int(row["_p"]), int(row["_l"])) if row["_open"] else None
        ids, _ = _pack(group, max_pages, state)
        return group[["_order"]].assign(_batch=ids)

    closed = {"_open": False, "_b": 0, "_p": 0, "_l": 0}
    if hot is None:
        placed = slim.withColumns({c: F.lit(v) for c, v in closed.items()})
    else:
        placed = skew.null_safe_join(slim, cut_lineage(entries(hot)), [source, "_chunk"], "left").fillna(closed)
    batches = placed.groupBy(source, "_chunk").applyInPandas(assign, "_order bigint, _batch bigint")
    firsts = numbered.select(F.col("_order").alias("_batch"), F.col(order).alias("batch"))
    return numbered.join(batches, "_order").join(firsts, "_batch").drop("_order", "_batch")


def batch_summary(packed: DataFrame, source: str, start: str, end: str) -> DataFrame:
    return packed.groupBy(source, "batch").agg(
        F.min(start).alias("page_start"), F.max(end).alias("page_end"),
        F.count(F.lit(1)).alias("ranges"), (F.max(end) - F.min(start) + 1).alias("page_count"),
    )


# -- front matter ----------------------------------------------------------------------------


def metadata(text):
    """Struct (firmware_version, version_identifier, protocol_version, method) of a front-matter text."""
    c = n._col(text)
    cases = []
    for method, pattern in fixed.FRONT_MATTER:
        values = [F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]
        names = ("firmware_version", "version_identifier", "protocol_version")
        cases.append((c.rlike(pattern), F.struct(*[v.alias(a) for v, a in zip(values, names)], F.lit(method).alias("method"))))
    return n._first_case(cases, F.lit(None))


def front_matter(pages: DataFrame, source: str, page: str, text: str, pages_searched: int = 30) -> DataFrame:
    """Metadata per source from its first ``pages_searched`` pages, whose distinct texts meet in one row."""
    front = pages.where((F.col(page) >= 1) & (F.col(page) <= pages_searched)).select(source, page, F.col(text).alias("_t"))
    joined = front.groupBy(source).agg(
        F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(page, "_t"))), lambda p: p["_t"]), "\n").alias("_text")
    )
    found = joined.withColumn("_m", metadata("_text")).where("_m is not null")
    return found.select(source, "_m.*").withColumn("protocol_version_int", n.protocol_version("protocol_version"))
