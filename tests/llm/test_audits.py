"""Operators 11 and 12: filter interactions and conversation repair."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from tallyframe.llm import interactions, queries, repair

COUNTS = [*interactions.COUNTERS, "shapley"]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_interactions(docs, labels):
    """{(part, order, step): counts} of (doc_id, text, source) rows, document by document."""
    quality = {k for k, q, _ in labels if k is not None and q == 1}
    toxic = {k for k, _, t in labels if k is not None and t == 1}
    least = {}
    for key, text, _ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    out = {}
    for part in {d[2] or "" for d in docs}:
        for order in itertools.permutations("ABCDE"):
            for step in range(1, 6):
                out[part, "".join(order), step] = dict.fromkeys(COUNTS, 0)
    for key, text, part in docs:
        text, part = text or "", part or ""
        words = WORDS.findall(text)
        failed = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": any(c in text for c in "#$%&*|"), "E": key is not None and least[text] < key,
        }
        for order in itertools.permutations("ABCDE"):
            gone = False
            for step, name in enumerate(order, 1):
                row = out[part, "".join(order), step]
                here = failed[name] and not gone
                row["redundant"] += failed[name] and gone
                row["unique_fails"] += failed[name] and sum(failed.values()) == 1
                gone = gone or here
                row["removed"] += here
                row["kept"] += not gone
                row["good_lost"] += here and key in quality
                row["toxic_lost"] += here and key in toxic
    for (part, order, step), row in out.items():
        row["shapley"] = sum(r["removed"] for (p, o, s), r in out.items() if p == part and o[s - 1] == order[step - 1])
    return out


def told(rows):
    return {(r.part, r.filter_order, r.step): {c: r[c] for c in COUNTS} for r in rows}


def test_interactions_of_tricky_rows(spark, tricky, nothing):
    labels = [(0, 1, 0), (0, None, 1), (5, 0, 1), (5, 1, None), (7, None, None), (None, 1, 1), (10, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = tricky.selectExpr("*", "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE 'web' END AS source", "1 AS part", "2 AS mask", "3 AS `_n`")
    found = interactions.audit(interactions.masks(docs, marks))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    small = [(k, t if t is None or len(t) < 60_000 else t, p) for k, t, p in rows]
    plain = plain_interactions(small, labels)
    assert told(found.collect()) == plain and len(plain) == 2 * 600
    assert interactions.audit(interactions.masks(nothing.selectExpr("*", "'' AS source"), marks)).count() == 0
    assert sum(r["good_lost"] for r in plain.values()) and sum(r["toxic_lost"] for r in plain.values())


def test_no_counter_runs_over_into_the_next(spark):
    greatest = (1 << 55)
    rows = [("a", mask, good, toxic, greatest // 32) for mask in range(32) for good in (False, True) for toxic in (False, True)]
    found = interactions.audit(spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean, n bigint")).collect()
    n = greatest // 32
    for row in found:
        left = 1 << 5 - row.step  # masks that fail none of the first ``step`` filters
        assert (row.kept, row.removed, row.redundant) == (4 * n * left, 4 * n * left, 4 * n * (16 - left))
        assert (row.unique_fails, row.good_lost, row.toxic_lost) == (4 * n, 2 * n * left, 2 * n * left)


def test_interactions_query_like_plain_loops(spark, folder, duck):
    docs = duck.execute("SELECT doc_id, text, source FROM documents").fetchall()
    labels = duck.execute("SELECT doc_id, quality, toxic FROM labels").fetchall()
    assert told(queries.QUERIES["op11_filter_interactions"](spark, folder).collect()) == plain_interactions(docs, labels)


# --- conversations

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, edits, repaired rows) by trying every edit at every place, from the end on."""

    @cache
    def rest(i, state):
        """(cost, edits, rows) from row ``i`` on where the repaired rows so far end in ``state``."""
        def inserted(state, most=2):
            options = []
            if i == len(rows) and state in ("", "a"):
                options.append((0, "", ()))
            if i < len(rows):
                options += edits(state)
            if most:
                tail = inserted(NEXT[state], most - 1)
                if tail:
                    row = (NAMES[NEXT[state]], "")
                    options.append((3 + tail[0], "I" + tail[1], (row, *tail[2])))
            return min(options, default=None)

        def edits(state):
            (role, text), must, cut = rows[i][:2], rows[i][2], rows[i][3]
            options = []

            def one(cost, edit, after, row):
                tail = rest(i + 1, after)
                if tail:
                    options.append((cost + tail[0], edit + tail[1], (row, *tail[2]) if row else tail[2]))

            one(4, "D", state, None)
            if not must:
                if role[:1] == "s" and state == "" or role[:1] == NEXT[state]:
                    one(3 * cut, "K", role[:1], (role, text))
                one(3 + 3 * cut, "R", NEXT[state], (NAMES[NEXT[state]], text))
            return options

        return inserted(state)

    return rest(0, "")


def plain_repair(rows):
    """What audited() gives of one conversation's (turn, role, text) rows."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, blank, duplicate, truncated, marked = set(), 0, 0, 0, []
    for _, role, text in rows:
        is_blank = not WORDS.search(text)
        is_double = not is_blank and (role, text) in seen
        is_cut = not is_blank and not is_double and WORDS.findall(text)[-1][-1] not in ".!?"
        seen.add((role, text))
        blank, duplicate, truncated = blank + is_blank, duplicate + is_double, truncated + is_cut
        marked.append((role, text, is_blank or is_double, is_cut))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, kept = cheapest(tuple(marked)) if rows else (0, "", ())
    body = "\n".join(f"{r}:{t}" for r, t in kept)
    return (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest()), kept


def damage(rows):
    """{conv: rows after damage} of (conv, turn, role, text) rows."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = out.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def as_rows(found):
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in found}


@pytest.mark.parametrize("batch", [10_000, 3])
def test_random_conversations_like_trying_every_edit(spark, batch):
    rng = random.Random(batch)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "uncle", "System"])
            text = rng.choice(["One.", "Two!", "three", "four? ", " ", "", None, "five.\n\t", "six ü", "One.", "A" * 40 + "b.", "A" * 40 + "c."])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None, 2]), role, text, "x", True))
    rows += [(None, 0, "user", "Null?", "x", True), (None, 1, "assistant", "Yes.", "x", True), (500, 1, "user", "gone", "x", False), (None, 9, "user", "gone", "x", None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, conv string, ok boolean").repartition(3)
        found = as_rows(repair.audited(df, present="ok").collect())
        fixed = repair.repaired(df, present="ok").orderBy("conv", "place").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = {}
    for conv, turn, role, text, _, ok in rows:
        by.setdefault(conv, []).extend([(turn, role, text)] if ok else [])
    plain = {conv: plain_repair(mine) for conv, mine in by.items()}
    assert found == {conv: result for conv, (result, _) in plain.items()}
    kept = {}
    for r in fixed:
        assert r.place == len(kept.setdefault(r.conv, []))
        kept[r.conv].append((r.role, r.text))
    assert kept == {conv: list(k) for conv, (_, k) in plain.items() if k}
    assert found[500] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_of_no_rows_and_of_great_turns(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert repair.audited(empty).collect() == [] and repair.repaired(empty).collect() == []
    least, greatest = -(1 << 63), (1 << 63) - 1
    rows = [("a", least, "user", "x."), ("a", greatest, "assistant", "y."), ("b", greatest - 1, "user", "x."), ("b", greatest, "assistant", "x.")]
    found = as_rows(repair.audited(spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")).collect())
    assert found["a"][0] == greatest and found["b"][0] == 0 and found["b"][6] == "KK"


def test_giant_conversation_spills_its_back_pointers(spark, monkeypatch):
    monkeypatch.setattr(repair, "SPILL_BYTES", 1000)
    rows = [(1, i, ["user", "assistant", "user", "tool"][i % 4], f"Row {i}.") for i in range(70_000)]
    found = repair.audited(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()[0]
    assert found.audit == "KKKR" * 17_500 and found.cost == 3 * 17_500 and found.illegal == 17_500 + 17_499
    body = "\n".join(f"{['user', 'assistant'][i % 2]}:Row {i}." for i in range(70_000))
    assert found.repaired_sha256 == hashlib.sha256(body.encode()).hexdigest()


def test_few_steps_are_possible():
    paths, reached = repair.Paths(), [repair.Paths.first]
    for costs in reached:
        for initial, goes, cut in itertools.product("sua?", (False, True), (False, True)):
            after = paths.step(costs, initial, goes, cut)[3]
            if after not in reached:
                reached.append(after)
    assert len(paths.steps) < 1 << 16  # the numbers of steps fit two bytes


def test_repair_query_like_trying_every_edit(spark, folder, duck):
    rows = duck.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    found = queries.QUERIES["op12_conversation_repair"](spark, folder).withColumnRenamed("conv_id", "conv").collect()
    assert as_rows(found) == {conv: plain_repair(mine)[0] for conv, mine in damage(rows).items()}


@pytest.mark.parametrize("name", ["op11_filter_interactions", "op12_conversation_repair"])
def test_audits_like_their_sql(spark, folder, duck, name):
    found = queries.QUERIES[name](spark, folder)
    cursor = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(cursor.fetchall())
