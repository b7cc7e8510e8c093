"""Page ranges and packing over outlines derived from documents and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import sections
from .base import query, table

P = fixed.MESSAGE_PREFIX

ENTRIES = f"""
WITH outline AS (SELECT source, doc_id AS seq, CAST(n_chars % 400 AS INT) AS page, CAST(1 + n_chars % 4 AS INT) AS level,
    CASE WHEN n_chars % 3 = 0 THEN '{P}' || upper(lang) || '-' || upper(source) || ' (0x01 0x' || lpad(lower(hex(doc_id % 256)), 2, '0') || ')'
         ELSE '{P}' || upper(lang) || '-' || upper(source) END AS title, n_chars % 3 = 0 AS located,
    '{P}' || upper(lang) || '-' || upper(source) AS entity FROM documents)
"""


def outline(spark, folder):
    chars = F.col("n_chars")
    name = F.concat(F.lit(P), F.upper("lang"), F.lit("-"), F.upper("source"))
    ids = F.format_string(" (0x01 0x%02x)", F.col("doc_id") % 256)
    return table(spark, folder, "documents").select(
        "source", F.col("doc_id").alias("seq"), (chars % 400).cast("int").alias("page"), (1 + chars % 4).cast("int").alias("level"),
        F.when(chars % 3 == 0, F.concat(name, ids)).otherwise(name).alias("title"),
    )


@query(ENTRIES + """
SELECT source, seq, entity, '0x01' AS class_id, '0x' || lpad(lower(hex(seq % 256)), 2, '0') AS message_id, page AS page_start,
    least(page + 5, coalesce(lead(page) OVER (PARTITION BY source ORDER BY page, seq), page + 5)) AS page_end FROM outline WHERE located""")
def section_ranges(spark, folder):
    entries = sections.located_entries(outline(spark, folder), "title")
    out = sections.next_entry_ranges(entries, "source", "page", "seq")
    return out.select("source", "seq", "entity", "class_id", "message_id", "page_start", "page_end")


LEVELS = ENTRIES + """
, closed AS (SELECT o.*, (SELECT arg_min(n.page, n.seq) FROM outline n WHERE n.source = o.source AND n.seq > o.seq AND n.level <= o.level) AS nxt FROM outline o)
"""


@query(LEVELS + """
SELECT source, seq, page AS page_start, least(greatest(coalesce(nxt - 1, page + 2), page + 1), page + 4) AS page_end FROM closed""")
def level_ranges(spark, folder):
    out = sections.level_ranges(outline(spark, folder), "source", "seq", "level", "page")
    return out.select("source", "seq", "page_start", "page_end")


@query(LEVELS + """
, ranges AS (SELECT *, coalesce(nxt - 1, page + 5) AS page_end FROM closed)
SELECT source, entity, arg_min(page, seq) AS page_start, arg_min(page_end, seq) AS page_end FROM ranges GROUP BY ALL""")
def first_match_ranges(spark, folder):
    """Uncapped ranges of the first entry per name: no minimum, no cap."""
    ranges = sections.level_ranges(outline(spark, folder), "source", "seq", "level", "page", default=5, minimum=1, cap=None)
    named = sections.located_entries(ranges, "title", need_ids=False)
    return sections.first_match(named, "source", "entity", "seq")


CONFIG = """
WITH o AS (SELECT user_id AS source, event_id AS seq, CAST(event_id % 977 AS INT) AS page,
    CAST(CASE WHEN k < 3 THEN 1 WHEN k < 6 THEN 1 WHEN k < 12 THEN 2 ELSE 3 END AS INT) AS level,
    CASE WHEN k < 3 THEN '6 Configuration interface' WHEN k < 6 THEN '7 Annex' WHEN k < 12 THEN '6.9 Configuration reference' ELSE '6.9.1 CFG-' || upper(event_type) || (k % 4) END AS title,
    CASE WHEN k >= 12 THEN 'CFG-' || upper(event_type) || (k % 4) END AS grp
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)),
s AS (SELECT source, min(seq) AS s_seq, arg_min(page, seq) AS s_page, arg_min(level, seq) AS s_level FROM o WHERE title LIKE '%Configuration interface%' GROUP BY source),
inside AS (SELECT o.*, s_page, s_level, s_seq FROM o JOIN s USING (source) WHERE seq > s_seq),
e AS (SELECT source, min(seq) FILTER ({closes}) AS end_seq, arg_min(page, seq) FILTER ({closes}) AS end_page FROM inside GROUP BY source),
open AS (SELECT inside.*, end_seq, end_page FROM inside JOIN e USING (source) WHERE end_seq IS NULL OR seq < end_seq),
r AS (SELECT source, min(seq) AS r_seq, arg_min(page, seq) AS r_page, arg_min(level, seq) AS r_level FROM open WHERE lower(title) LIKE '%reference%' GROUP BY source)
"""
LOOSE = CONFIG.replace("{closes}", "level <= s_level")
STRICT = CONFIG.replace("{closes}", "level = s_level AND page > s_page")


def config_outline(spark, folder):
    k = F.get_json_object("props", "$.k").cast("bigint")
    group = F.concat(F.lit("6.9.1 CFG-"), F.upper("event_type"), (k % 4).cast("string"))
    return table(spark, folder, "events").select(
        F.col("user_id").alias("source"), F.col("event_id").alias("seq"), (F.col("event_id") % 977).cast("int").alias("page"),
        F.when(k < 6, 1).when(k < 12, 2).otherwise(3).alias("level"),
        F.when(k < 3, F.lit("6 Configuration interface")).when(k < 6, F.lit("7 Annex")).when(k < 12, F.lit("6.9 Configuration reference")).otherwise(group).alias("title"),
    )


def _config(spark, folder, batched):
    return sections.config_section(config_outline(spark, folder), "source", "seq", "level", "title", "page", batched)


@query(LOOSE + """
SELECT source, s_page AS section_start, end_page - 1 AS section_end, CASE WHEN r_page IS NOT NULL THEN s_page END AS intro_start, r_page - 1 AS intro_end
FROM s LEFT JOIN e USING (source) LEFT JOIN r USING (source)""")
def config_bounds(spark, folder):
    return _config(spark, folder, False)[0]


@query(LOOSE + """
, g AS (SELECT open.*, lead(page) OVER (PARTITION BY source ORDER BY page, seq) AS nxt FROM open JOIN r USING (source) WHERE seq > r_seq AND grp IS NOT NULL)
SELECT source, grp AS "group", page AS page_start, greatest(page, CASE WHEN nxt IS NOT NULL THEN nxt - 1 ELSE coalesce(end_page - 1, page + 10) END) AS page_end FROM g
QUALIFY row_number() OVER (PARTITION BY source, grp ORDER BY page DESC, seq DESC) = 1""")
def config_sections(spark, folder):
    return _config(spark, folder, False)[1]


@query(STRICT + """
, g AS (SELECT open.*, lead(page) OVER (PARTITION BY source ORDER BY seq) AS nxt FROM open JOIN r USING (source) WHERE seq > r_seq AND level = r_level + 1 AND grp IS NOT NULL)
SELECT source, grp AS "group", page AS page_start, CASE WHEN nxt IS NOT NULL THEN greatest(page, nxt - 1) ELSE coalesce(end_page - 1, page + 5) END AS page_end FROM g
QUALIFY row_number() OVER (PARTITION BY source, grp ORDER BY seq DESC) = 1""")
def config_sections_batched(spark, folder):
    return _config(spark, folder, True)[1]


@query("""
WITH RECURSIVE r AS (SELECT source, doc_id, (doc_id // 8) AS s, (doc_id // 8) + n_chars % 6 AS e,
    row_number() OVER (PARTITION BY source ORDER BY (doc_id // 8), doc_id) AS k FROM documents),
p AS (SELECT source, doc_id, k, doc_id AS batch, s AS f, e AS l FROM r WHERE k = 1
    UNION ALL SELECT r.source, r.doc_id, r.k, CASE WHEN greatest(l, e) - f + 1 <= 15 THEN batch ELSE r.doc_id END,
        CASE WHEN greatest(l, e) - f + 1 <= 15 THEN f ELSE s END, CASE WHEN greatest(l, e) - f + 1 <= 15 THEN greatest(l, e) ELSE e END
        FROM p JOIN r ON r.source = p.source AND r.k = p.k + 1)
SELECT p.source, batch, min(s) AS page_start, max(e) AS page_end, count(*) AS ranges, max(e) - min(s) + 1 AS page_count
FROM p JOIN r ON r.source = p.source AND r.k = p.k GROUP BY p.source, batch""")
def page_batches(spark, folder):
    start = F.floor(F.col("doc_id") / 8)
    ranges = table(spark, folder, "documents").select("source", "doc_id", start.alias("s"), (start + F.col("n_chars") % 6).alias("e"))
    return sections.batch_summary(sections.pack(ranges, "source", "s", "e", "doc_id"), "source", "s", "e")


@query("""
WITH p AS (SELECT source, doc_id % 40 AS page, CASE doc_id % 5 WHEN 0 THEN 'HPG 1.' || (n_chars % 90 + 10) || ' EXT CORE 1.00 (ab' || doc_id || ') 27.' || (n_chars % 90 + 10)
    WHEN 1 THEN 'SPG 5.10 ROM SPG 5.10 (7b202e) 34.' || (n_chars % 90 + 10) ELSE 'nothing here' END AS t, n_chars, doc_id FROM documents),
one AS (SELECT source, t, row_number() OVER (PARTITION BY source, t[1] ORDER BY page, t) AS k FROM p WHERE page BETWEEN 1 AND 30),
ext AS (SELECT source, t FROM one WHERE t LIKE 'HPG%' AND k = 1),
f AS (SELECT source, t, 'ext_core_table' AS method FROM ext
    UNION ALL SELECT source, t, 'rom_prefix_table' FROM one WHERE t LIKE 'SPG%' AND k = 1 AND source NOT IN (SELECT source FROM ext))
SELECT source, split_part(t, ' ', 1) || ' ' || split_part(t, ' ', 2) AS firmware_version,
    CASE method WHEN 'ext_core_table' THEN regexp_extract(t, '(EXT CORE 1.00 \\([^)]*\\))', 1) ELSE 'ROM SPG 5.10 (7b202e)' END AS version_identifier,
    regexp_extract(t, '([0-9.]+)$', 1) AS protocol_version, method,
    CAST(trunc(CAST(regexp_extract(t, '([0-9.]+)$', 1) AS DOUBLE) * 100) AS BIGINT) AS protocol_version_int FROM f""")
def front_matter(spark, folder):
    doc, more = F.col("doc_id"), (F.col("n_chars") % 90 + 10).cast("string")
    text = (
        F.when(doc % 5 == 0, F.concat(F.lit("HPG 1."), more, F.lit(" EXT CORE 1.00 (ab"), doc.cast("string"), F.lit(") 27."), more))
        .when(doc % 5 == 1, F.concat(F.lit("SPG 5.10 ROM SPG 5.10 (7b202e) 34."), more)).otherwise(F.lit("nothing here"))
    )
    pages = table(spark, folder, "documents").select("source", (doc % 40).alias("page"), text.alias("text"))
    return sections.front_matter(pages, "source", "page", "text")
