"""Operator 13: repeated strings by refined buckets, against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pytest

from tallyframe.llm import queries, suffixes


def plain_repeats(docs, window=100):
    """{(key, text): (n_bytes, spans, kept)} of (key, text) rows; equal rows count once."""
    order = sorted({(k is not None, k or 0, t or "") for k, t in docs})
    first, out = {}, {}
    for some, key, text in order:
        data = text.encode()
        covered = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - window + 1):
            string = data[at : at + window]
            if string in first:
                covered[at : at + window] = True
            else:
                first[string] = at
        edges = np.flatnonzero(np.diff(np.concatenate(([False], covered)).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out[key if some else None, text] = (len(data), spans, bytes(data[i] for i in range(len(data)) if not covered[i]))
    return out


def told(rows):
    return {(r.doc_id, r.text or ""): (r.repeats.n_bytes, [tuple(s) for s in r.repeats.spans], bytes(r.repeats.kept)) for r in rows}


def made(seed, n=120):
    """Unique keys; passages of 60 to 300 bytes that many texts share, whole copies, loops, and texts near the least size."""
    rng = random.Random(seed)
    letters = "abcdeé\n "
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [some(rng.randrange(60, 300)) for _ in range(12)] + ["ab" * 90, "x" * 150]
    texts = []
    for _ in range(n):
        text = some(rng.randrange(0, 200))
        for _ in range(rng.randrange(0, 5)):
            shared = rng.choice(passages)
            start = rng.randrange(0, len(shared) // 3)
            text += shared[start : len(shared) - rng.randrange(0, len(shared) // 3)] + some(rng.choice([0, 0, 1, 3, 150]))
        texts.append(rng.choice(texts) if texts and rng.random() < 0.15 else text)
    texts += ["z" * 99, "z" * 100, "z" * 101, "", None, "z" * 500]
    keys = rng.sample(range(1000), len(texts))
    return list(zip(keys, texts, strict=True))


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 1 << 20), (3, 150), (4, 150)])
def test_repeats_like_a_dictionary_of_all_strings(spark, monkeypatch, seed, block):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    docs = made(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = suffixes.deduplicated(df).collect()
    assert len(found) == len(docs)
    plain = plain_repeats(docs)
    assert told(found) == plain
    assert any(s and s[0][0] > 0 for _, s, _ in plain.values()) and len(plain) == len(docs)


def test_null_and_repeated_keys(spark, tricky, nothing):
    rng = random.Random(5)
    some = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(None, some[:300]), (None, some[100:]), (None, None), (3, some), (3, some), (4, some[:250] + "!"), (4, some[:250] + "?"), (4, ""), (None, some[100:])]
    df = spark.createDataFrame([(k, t, "a", "b", 1) for k, t in rows], "doc_id bigint, text string, repeats string, doc string, `_mark` int").repartition(3)
    found = suffixes.deduplicated(df)
    assert sorted(found.columns) == sorted(df.columns)
    rows_found = found.collect()
    assert sorted((str(r.doc_id), str(r.text), r.doc, r._mark) for r in rows_found) == sorted((str(k), str(t), "b", 1) for k, t in rows)
    mine = told(rows_found)
    threes = [r.repeats for r in rows_found if r.doc_id == 3]
    assert len(threes) == 2 and threes[0] == threes[1] and mine[3, some][1] == [(0, 400)]
    # Texts of one key are in order of their hash, so one of each two keeps what both have.
    assert sorted(len(mine[None, t][1]) for t in (some[:300], some[100:])) == [0, 1]
    assert {mine[4, some[:250] + c][1][0] for c in "!?"} == {(0, 250)}
    assert suffixes.deduplicated(nothing).collect() == [] and suffixes.deduplicated(nothing).columns[: len(nothing.columns)] == nothing.columns
    long = suffixes.deduplicated(tricky).collect()
    assert len(long) == tricky.count()
    assert all(r.repeats.n_bytes == len((r.text or "").encode()) for r in long)


def test_string_keys(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(200))
    df = spark.createDataFrame([("b", text), ("a", text[50:]), ("c", "own")], "doc_id string, text string")
    assert {r.doc_id: [tuple(s) for s in r.repeats.spans] for r in suffixes.deduplicated(df).collect()} == {"a": [], "b": [(50, 200)], "c": []}


def test_suffix_query_like_a_dictionary_of_all_strings(spark, folder, duck):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    found = queries.QUERIES["op13_suffix_array_dedup"](spark, folder).collect()
    mine = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}
    plain = {k: (n, sum(b - a for a, b in s), len(s), hashlib.sha256(kept).hexdigest()) for (k, _), (n, s, kept) in plain_repeats(docs).items()}
    assert len(found) == len(docs) and mine == plain


def test_suffix_query_like_its_sql(spark, folder, duck):
    found = queries.QUERIES["op13_suffix_array_dedup"](spark, folder)
    cursor = duck.execute(queries.ORACLES["op13_suffix_array_dedup"])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(cursor.fetchall())
