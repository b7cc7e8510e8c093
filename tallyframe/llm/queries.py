"""The operators bound to the given tables, as named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.base import table
from . import decontaminate, interactions, language, license, pieces, quality, repair, secrets, simhash, substring, suffixes, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = license.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.array_join("licenses.sentences", ",").alias("sentences"), F.array_join("licenses.licenses", ",").alias("licenses"),
        F.size("licenses.licenses").cast("bigint").alias("n_licenses"), "licenses.n_unmatched",
    )


ORACLES["op1_license_scans"] = license.sql()


@query
def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(table(spark, folder, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("component", "component_id")


@query
def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontaminate.find(documents.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", "hits.n_words", decontaminate.n_hit().alias("n_hit"), F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits.spans") > 0).alias("contaminated"),
    )


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.rules(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "quality.*").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "n_chunks", "n_low_chunks", "n_high_chunks",
    )


@query
def op7_sentencepiece(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """``path``: the model file, by default the public model beside the installed libraries."""
    model = pieces.load(path or pieces.public_model())
    found = pieces.encoded(table(spark, folder, "documents").select("doc_id", "text"), model)
    return found.select(
        "doc_id", F.size("pieces.ids").cast("bigint").alias("n_pieces"), "pieces.ids", "pieces.nbest",
        "pieces.round_trip",
    )


@query
def op8_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.KINDS[: secrets.BASE]))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS[: secrets.BASE]],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed("secrets").alias("spans"),
    )


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "spans.n_sentences", "spans.n_removed", (F.col("spans.n_removed") > 0).alias("repeated"), "text")


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(documents, labels, "doc_id", "text", ~held)
    found = toxicity.score(documents, model)
    return found.select("doc_id", held.alias("held_out"), "toxicity.score", "toxicity.predicted", "toxicity.largest", "toxicity.n_windows")


ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT page_id, html, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM m"""


@query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.roundtrip(table(spark, folder, "pages").select("page_id", "url", "html"))


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held = language.held_out(F.col("doc_id"))
    model = language.fit(documents, "doc_id", "text", "lang", ~held)
    found = language.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), F.col("language.nearest").alias("lang_pred"), "language.score", "language.rejected")


ORACLES["op11_filter_interactions"] = """
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS words FROM t),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
f AS (
    SELECT doc_id, part, if(len(words) < 50, 'A', '') || if(100 * len(list_distinct(words)) < 65 * len(words), 'B', '')
        || if(100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), 'C', '') || if(regexp_matches(text, '[#$%&*|]'), 'D', '')
        || if(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false), 'E', '') AS failed
    FROM w),
cells AS (
    SELECT part, failed, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
    FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
    SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM x a, x b, x d, x e, x g
    WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
steps AS (
    SELECT filter_order, step, filter_order[step] AS name, string_split(filter_order[1:step - 1], '') AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS step)),
told AS (
    SELECT part, filter_order, step, name, failed, good, toxic, n, contains(failed, name) AS fails,
        len(list_filter(earlier, lambda e: e <> '' AND contains(failed, e))) > 0 AS gone
    FROM cells, steps),
sums AS (
    SELECT part, filter_order, step, name,
        coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
        coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant, coalesce(sum(n) FILTER (failed = name), 0) AS unique_fails,
        coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0) AS toxic_lost
    FROM told GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, name) AS BIGINT) AS shapley
FROM sums"""


@query
def op11_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.audit(interactions.masks(table(spark, folder, "documents"), table(spark, folder, "labels")))


ORACLES["op12_conversation_repair"] = """
WITH RECURSIVE k AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations),
crc AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1), lambda i: ascii(key[i])::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, n: xor(v >> 1, 3988292384 * (v & 1))))) % 20 AS kind
    FROM k),
d AS (
    SELECT conv_id, turn, if(kind = 4, 'user', role) AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(if(kind = 3, 2, 1)))
    FROM crc WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
m AS (
    SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut, role[1:1] AS initial,
        lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] NOT IN ('su', 'ua', 'au') AS illegal
    FROM o),
run AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS state, {cost: 0::BIGINT, audit: '', body: ''} AS best FROM conversations
    UNION ALL
    SELECT conv_id, i, option.state, min(option.best) FROM (
        SELECT conv_id, i, unnest([
            {state: spot, best: {cost: cost + 4, audit: audit || 'D', body: body}},
            if(NOT goes AND (initial = nxt OR initial = 's' AND spot = ''),
                {state: initial, best: {cost: cost + extra, audit: audit || 'K', body: body || sep || role || ':' || text}}, NULL),
            if(NOT goes, {state: nxt, best: {cost: cost + 3 + extra, audit: audit || 'R',
                body: body || sep || if(nxt = 'u', 'user', 'assistant') || ':' || text}}, NULL)]) AS option
        FROM (
            SELECT *, if(spot = 'u', 'a', 'u') AS nxt, if(body = '', '', chr(10)) AS sep FROM (
                SELECT r.conv_id, m.i, m.role, m.text, m.initial, m.blank OR m.again AS goes, if(m.cut, 3, 0) AS extra,
                    CASE n WHEN 0 THEN r.state WHEN 1 THEN if(r.state = 'u', 'a', 'u') ELSE if(r.state = 'u', 'u', 'a') END AS spot,
                    r.best.cost + 3 * n AS cost, r.best.audit || repeat('I', n) AS audit,
                    r.best.body || if(n > 0, if(r.best.body = '', '', chr(10)) || if(r.state = 'u', 'assistant:', 'user:'), '')
                        || if(n > 1, chr(10) || if(r.state = 'u', 'user:', 'assistant:'), '') AS body
                FROM run r JOIN m ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND m.i = r.i + 1, (SELECT unnest([0, 1, 2]) AS n))))
    WHERE option IS NOT NULL GROUP BY ALL),
sums AS (
    SELECT c.conv_id, count(m.i) AS n, coalesce(max(m.turn) - min(m.turn) + 1 - count(DISTINCT m.turn), 0) AS gaps, count(*) FILTER (m.blank) AS blank,
        count(*) FILTER (NOT m.blank AND m.again) AS duplicate, count(*) FILTER (NOT m.blank AND NOT m.again AND m.cut) AS truncated,
        count(*) FILTER (m.illegal) AS illegal
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY ALL),
done AS (
    SELECT r.conv_id, min(CASE r.state
        WHEN 'u' THEN {cost: r.best.cost + 3, audit: r.best.audit || 'I', body: r.best.body || chr(10) || 'assistant:'}
        WHEN 's' THEN {cost: r.best.cost + 6, audit: r.best.audit || 'II', body: r.best.body || chr(10) || 'user:' || chr(10) || 'assistant:'}
        ELSE r.best END) AS best
    FROM run r JOIN sums s ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.n = r.i GROUP BY ALL)
SELECT s.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit, sha256(best.body) AS repaired_sha256
FROM sums s JOIN done d ON d.conv_id IS NOT DISTINCT FROM s.conv_id"""


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = repair.damaged(table(spark, folder, "conversations"))
    return repair.audited(rows, "conv", present="present").withColumnRenamed("conv", "conv_id")


ORACLES["op13_suffix_array_dedup"] = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS m FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM t WHERE n >= 100)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k FROM s) WHERE k > 1),
b AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 100 THEN 0 ELSE 1 END AS opens FROM d WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b) GROUP BY doc_id, run),
p AS (
    SELECT t.doc_id, coalesce(lag(z) OVER w, 0) AS a, r.a AS z, h FROM t JOIN r USING (doc_id) WINDOW w AS (PARTITION BY t.doc_id ORDER BY r.a)
    UNION ALL SELECT t.doc_id, coalesce(max(z), 0), any_value(n), any_value(h) FROM t LEFT JOIN r USING (doc_id) GROUP BY t.doc_id),
kept AS (SELECT doc_id, sha256(unhex(string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a))) AS kept_sha256 FROM p GROUP BY doc_id)
SELECT t.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, kept_sha256
FROM t JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM r GROUP BY doc_id) USING (doc_id)"""


@query
def op13_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "repeats.n_bytes", "repeats.n_removed", F.size("repeats.spans").cast("bigint").alias("n_spans"),
        F.sha2("repeats.kept", 256).alias("kept_sha256"),
    )
