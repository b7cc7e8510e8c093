"""Operators that look across rows: SimHash, substrings, classifiers, and the pipeline."""

import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tallyframe.llm import components, decontaminate, language, pieces, queries, secrets, simhash, substring, toxicity
from test_rows import OWN, lowered, own, plain_hits, plain_quality  # noqa: F401  (the folder is on the path)

# --- SimHash


def plain_print(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """{key: least key reachable} of [(key, print)], for unique keys."""
    distinct = sorted({p for _, p in prints})
    parent = {p: p for p in distinct}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for key, p in prints:
        least[root(p)] = min(key, least.get(root(p), key))
    return [(key, f"{p:016x}", least[root(p)]) for key, p in prints]


def plain_sketch(text):
    """512 bits as a number, by plain counting over five-word shingles."""
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))
    if not words:
        return 0
    mask = (1 << 64) - 1
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 5]).encode(), 42) for i in range(max(1, len(words) - 4))]
    out = 0
    for number in range(8):
        if number:
            mixed = []
            for h in hashes:
                h = (h + 0x9E3779B97F4A7C15) & mask
                h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & mask
                h = (h ^ h >> 27) * 0x94D049BB133111EB & mask
                mixed.append(h ^ h >> 31)
            hashes = mixed
        bits = np.array(hashes, np.uint64)[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)
        out = out << 64 | sum(1 << b for b, n in enumerate(bits.sum(0).tolist()) if 2 * n > len(hashes))
    return out


def similar_groups(docs):
    """[(key, least key of its group)] of (key, text) rows: the sets of distinct five-word shingles of every pair are compared."""
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    groups = []
    for key, mine in [(k, shingles(t)) for k, t in docs]:
        near = [g for g in groups if any(mine == other or len(mine & other) >= 0.8 * len(mine | other) for _, other in g)]
        groups = [g for g in groups if g not in near] + [[(key, mine)] + [x for g in near for x in g]]
    return [(key, min(k for k, _ in g)) for g in groups for key, _ in g]


def test_sketches_like_plain_counting(documents):
    for _, text in documents[:40]:
        assert int.from_bytes(simhash.sketch(text.encode(), 5, 8), "big") == plain_sketch(text)


@pytest.mark.parametrize("block", [4096, 5])
def test_similar_texts_are_one_group(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    rows, truth = [], {}
    for group in range(25):
        base = [word() for _ in range(400)]
        for copy in range(rng.randrange(1, 9)):
            mine = list(base)
            for _ in range(4 if copy else 0):  # similarity above 0.9 to the base
                mine[rng.randrange(400)] = word()
            rows.append((len(rows), " ".join(mine)))
            truth.setdefault(group, []).append(len(rows) - 1)
        half = base[:200] + [word() for _ in range(200)]  # similarity of about a third: a group of its own
        rows.append((len(rows), " ".join(half)))
        truth[f"half {group}"] = [len(rows) - 1]
    kept = simhash.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(min(v) for v in truth.values())


def plain_similarity(a, b):
    sets = []
    for text in (a, b):
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


@pytest.mark.parametrize("block", [4096, 5])
def test_repeated_lines_do_not_make_texts_similar(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    footer = " ".join(word() for _ in range(7))
    pages = [" ".join(" ".join(word() for _ in range(26)) + " " + footer for _ in range(150)) for _ in range(4)]
    near = []
    for changed in range(1, 40, 2):  # similarities from 0.96 down to 0.3 around the bound, a chain among them
        words = pages[0].split()[:230]
        for place in range(2, 5 * changed, 5):
            words[place] = word()
        near.append(" ".join(words))
    texts = pages + near
    most = simhash.most_differing(0.8)
    weighed = [int.from_bytes(simhash.sketch(t.encode(), 5, 8), "big") for t in pages]
    assert all((a ^ b).bit_count() <= most for a in weighed for b in weighed)  # what used to drop all pages but one
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if plain_similarity(texts[i], texts[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    kept = simhash.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted({min(i for i, g in enumerate(group) if g == h) for h in group})


def test_no_near_sketch_is_left_out(spark):
    rng = random.Random(9)
    most = simhash.most_differing(0.8)
    rows = []
    for pair in range(20):  # all differing bits in the first number, the last band alike
        value = rng.getrandbits(512)
        other = value ^ sum(1 << b for b in rng.sample(range(448, 512), rng.randrange(25, 64)))
        rows += [(2 * pair, value.to_bytes(64, "big")), (2 * pair + 1, other.to_bytes(64, "big"))]
    assert all((int.from_bytes(a[1], "big") ^ int.from_bytes(b[1], "big")).bit_count() <= most for a, b in zip(rows[::2], rows[1::2], strict=True))
    found = {(r.u, r.v) for r in simhash.similar_links(spark.createDataFrame(rows, "node bigint, sketch binary")).collect()}
    assert found == {(2 * pair + 1, 2 * pair) for pair in range(20)}


def test_similar_sketches_meet_at_an_anchor_of_bands_that_differ(spark):
    # A bit differs in each 13 bits in a row; of the first band of 17 only one, which the covering code takes to one anchor.
    places = [12, *range(20, 512, 13)]
    differing = np.isin(simhash.PLACES, places).sum(1)
    assert differing[0] == 1 and differing.min() > 0 and len(places) <= simhash.most_differing(0.8)
    other = np.zeros(512, np.uint8)
    other[places] = 1
    rows = [(0, bytes(64)), (1, np.packbits(other).tobytes())]
    assert [tuple(r) for r in simhash.similar_links(spark.createDataFrame(rows, "node bigint, sketch binary")).collect()][:1] == [(1, 0)]


def test_simhash_query(spark, folder, documents):
    rows = [(r.doc_id, r.fingerprint, r.component_id) for r in queries.op2_simhash_near_dedup(spark, folder).collect()]
    assert sorted(rows) == plain_groups([(i, plain_print(t)) for i, t in documents])


def near_prints(rng, groups=40, size=12):
    """Clusters of numbers a few bits apart, chains among them, and strangers."""
    out = set()
    for _ in range(groups):
        value = rng.getrandbits(64)
        for _ in range(rng.randrange(1, size)):
            for bit in rng.sample(range(64), rng.randrange(0, 6)):
                value ^= 1 << bit
            out.add(value)
    return sorted(out | {0, (1 << 64) - 1, 0b1111, 0b11111 << 20})


@pytest.mark.parametrize("block", [4096, 3])
def test_links_connect_all_near_prints(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    prints = near_prints(random.Random(block))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "print bigint")
    found = simhash.links(frame).collect()
    assert all(r.u != r.v for r in found)
    linked = {r.u: r.v for r in components.components(simhash.links(frame)).collect()}
    expected = plain_groups(list(zip(range(len(prints)), prints)))
    groups = {}
    for (_, _, group), p in zip(expected, signed):
        groups.setdefault(group, []).append(p)
    for members in groups.values():
        assert {linked.get(m, m) for m in members} == {min(members)}


def test_every_near_pair_meets_at_a_home():
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(1, 5)):
            b ^= 1 << bit
        anchor, prints, home = simhash.anchors(np.array([a, b], np.uint64).view(np.int64))
        homes = set(anchor[home & (prints == prints[np.flatnonzero(prints == np.array([a], np.uint64).view(np.int64)[0])[0]])].tolist())
        visits = set(anchor[prints == np.array([b], np.uint64).view(np.int64)[0]].tolist())
        assert homes & visits


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i + 1, i) for i in range(300)]
    star = [(1000 + i, 999) for i in range(200)]
    found = {r.u: r.v for r in components.components(spark.createDataFrame(chain + star, "u bigint, v bigint")).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {1000 + i: 999 for i in range(200)}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_simhash_on_tricky_rows(spark, tricky, nothing):
    rows = simhash.groups(tricky).collect()
    assert len(rows) == tricky.count()
    empty = {r.component for r in rows if r.fingerprint == "0" * 16}
    assert empty == {0}
    kept = simhash.deduplicated(tricky)
    assert kept.columns == tricky.columns
    found = [r.doc_id for r in kept.collect()]
    assert len(found) == len(set(found)) and found.count(0) == 1 and {4, 5, 6, 9} <= set(found) and not {1, 2, 3} & set(found)
    assert simhash.groups(nothing).collect() == [] == simhash.deduplicated(nothing).collect()
    nulls = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "quite another text altogether here")], "doc_id bigint, text string")
    assert {r.component for r in simhash.groups(nulls).collect()} == {None} and simhash.deduplicated(nulls).count() == 2


# --- substrings


def plain_substrings(rows):
    """{(key, text): number of removed sentences}; rows sorted by key and the place of their text."""
    seen, out = {}, {}
    for key, text in rows:
        found = substring.Sentences(text.encode())
        words = lowered(text).split()
        covered = set()
        for a, b in zip(*(x.tolist() for x in found.spans()), strict=True):
            span = tuple(words[found.firsts[a] : found.lasts[b] + 1])
            if seen.setdefault(span, (key, text, a)) != (key, text, a):
                covered |= set(range(a, b + 1))
        out[key, text] = len(covered)
    return out


def test_substring_query(spark, folder, documents):
    rows = queries.op4_substring_dedup(spark, folder).collect()
    expected = plain_substrings(documents)
    texts = dict(documents)
    assert {(r.doc_id, texts[r.doc_id]): r.n_removed for r in rows} == expected
    assert all((r.text == texts[r.doc_id]) == (not r.n_removed) for r in rows)


def test_passages_are_cut_alike_wherever_they_stand():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    for _ in range(60):
        passage = " ".join(word() + rng.choice([""] * 12 + ["."]) for _ in range(60))
        spans = []
        for _ in range(2):
            before, after = (" ".join(word() for _ in range(rng.randrange(0, 40))) for _ in range(2))
            found = substring.Sentences(f"{before} {passage} {after}".encode())
            spans.append({tuple(h) for h in found.hashes()[1].tolist()})
        assert spans[0] & spans[1]


@pytest.mark.parametrize("every", [0, 10, 25])
@pytest.mark.parametrize("single", [False, True])
def test_passages_of_51_words_hold_a_span(every, single):
    rng = random.Random(every + single)
    word = lambda: chr(rng.randrange(0x4E00, 0x9F00)) if single else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    end, space = ("。", "") if single else (".", " ")
    words = lambda n: space.join(word() + (end if every and rng.randrange(every) == 0 else "") for _ in range(n))
    for _ in range(300):
        passage, spans = words(51), []
        for _ in range(2):
            found = substring.Sentences(space.join([words(rng.randrange(1, 40)), passage, words(rng.randrange(1, 40))]).encode())
            spans.append({tuple(h) for h in found.hashes()[1].tolist()})
        assert spans[0] & spans[1]


def test_text_without_spaces_is_cut_where_it_repeats():
    rng = random.Random(2)
    some = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(n))
    text = (some(30) + "。" + some(40)).encode()
    found = substring.Sentences(text)
    assert text.decode()[30] == "。" and 30 in found.lasts.tolist()
    first, last = (x.tolist() for x in found.spans())
    kept, n, gone = substring.removed(text, first[:1])
    a, b = found.firsts[first[0]], found.lasts[last[0]] + 1
    assert kept.decode() == text.decode()[:a] + text.decode()[b:] and n == len(found.firsts) and gone == last[0] - first[0] + 1


def test_substring_on_tricky_rows(spark, tricky, nothing):
    rows = substring.deduplicated(tricky).collect()
    names = [c for c in OWN if c != "text"]
    key = lambda found: sorted(tuple(str(r[c]) for c in names) for r in found)
    assert key(rows) == key(tricky.collect())
    assert all(r.text is None for r in rows if r["_now"] in ("own 0", None))
    assert substring.deduplicated(nothing).collect() == []
    passage = "This very sentence has quite a few words in it. So does the second one that follows the first one here. And a third."
    some = [(2, "Own words first. " + passage), (1, passage + " Own end of the other."), (3, "Nothing shared."), (1, passage + " Own end of the other.")]
    found = {r.doc_id: r.text for r in substring.deduplicated(spark.createDataFrame(some, "doc_id int, text string")).collect()}
    assert found[1] == some[1][1] and found[3] == "Nothing shared." and "second one" not in found[2] and found[2].startswith("Own words first.")


# --- classifiers


def labelled(n=240):
    rng = random.Random(11)
    syllables = ["ta", "mo", "ri", "ne", "su", "lo", "pa", "ki", "ve", "do"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(30, 120))]
        if toxic := i % 4 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["grubwitz", "flarchhead", "snudge"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark, tricky, nothing):
    rows, labels = labelled()
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    held = toxicity.held_out(docs.doc_id)
    model = toxicity.fit(docs, marks, "doc_id", "text", ~held)
    found = toxicity.score(docs, model).withColumn("held", held).collect()
    right = [r.toxicity.predicted == (r.doc_id % 4 == 0) for r in found if r.held]
    assert len(right) > 50 and sum(right) / len(right) > 0.95
    scored = toxicity.score(tricky, model).collect()
    assert own(scored) == own(tricky.collect()) and all(0 <= r.toxicity.score <= 1 for r in scored)
    assert toxicity.score(nothing, model).collect() == []
    for some in (marks.limit(0), marks.where("toxic = 0")):
        plain = toxicity.fit(docs, some, "doc_id", "text", ~held)
        assert {r.toxicity.predicted for r in toxicity.score(docs, plain).collect()} == {0}


def test_toxicity_query(spark, folder, duck):
    rows = queries.op5_toxicity(spark, folder).collect()
    held = dict(duck.execute("SELECT doc_id, 0 FROM documents").fetchall())
    assert {r.doc_id for r in rows} == set(held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_language_query(spark, folder, duck):
    import zlib

    rows = queries.op10_language_id(spark, folder).collect()
    own_lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r.lang_pred == own_lang[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.9 and all(0 <= r.score <= 1 for r in rows)


def plain_counts(text):
    """{bucket: number} of the two- and three-byte n-grams of a text, gram by gram."""
    folded = "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in text)
    data, out = f" {' '.join(folded.split(' '))} ".encode(), {}
    data = b" " + b" ".join(w for w in data.split(b" ") if w) + b" "
    for size in (2, 3):
        for at in range(len(data) - size + 1):
            code = int.from_bytes(data[at : at + size], "big")
            bucket = (code * 2654435761 + size * 40503) % (1 << 32) >> 19
            out[bucket] = out.get(bucket, 0) + 1
    return out


def plain_vector(found, idf):
    weights = np.zeros(1 << 13)
    for bucket, n in found.items():
        weights[bucket] = (1 + np.log(n)) * idf[bucket]
    return weights / (np.linalg.norm(weights) or 1)


def plain_centroids(vectors, k=4, rounds=12):
    chosen = [0]
    while len(chosen) < k:
        nearest = [max(float(v @ vectors[c]) for c in chosen) for v in vectors]
        far = min(range(len(vectors)), key=nearest.__getitem__)
        if nearest[far] > 0.999:
            break
        chosen.append(far)
    centroids = [vectors[c] for c in chosen]
    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for v in vectors:
            groups[max(range(len(centroids)), key=lambda c: float(v @ centroids[c]))].append(v)
        sums = [sum(g) if g else c for g, c in zip(groups, centroids, strict=True)]
        centroids = [s / np.linalg.norm(s) for s in sums]
    return centroids


def test_language_query_like_plain_loops(spark, folder, duck):
    import zlib

    docs = duck.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    found = {r.doc_id: r for r in queries.op10_language_id(spark, folder).collect()}
    order = {r[0]: r[1] for r in spark.createDataFrame([(d[0],) for d in docs], "k bigint").selectExpr("k", "xxhash64(k)").collect()}
    letters = lambda t: any(c.isalpha() for c in t or "")
    learn = [d for d in docs if d[2] is not None and letters(d[1]) and zlib.crc32(str(d[0]).encode()) % 4 != 2]
    grams = {d[0]: plain_counts(d[1] or "") for d in docs}
    seen = {}
    for d in learn:
        for bucket in grams[d[0]]:
            seen[bucket] = seen.get(bucket, 0) + 1
    idf = np.array([np.log((len(learn) + 1) / (seen.get(b, 0) + 1)) + 1 for b in range(1 << 13)])
    centroids = []
    for lang in sorted({d[2] for d in learn}):
        mine = sorted((d for d in learn if d[2] == lang), key=lambda d: order[d[0]])
        vectors = [plain_vector(grams[d[0]], idf).astype(np.float16).astype(np.float64) for d in mine]
        centroids += [(lang, c) for c in plain_centroids(vectors)]
    for key, text, _ in docs:
        if not letters(text):
            assert (found[key].lang_pred, found[key].score) == ("und", 0.0)
            continue
        v = plain_vector(grams[key], idf)
        scores = [(float(v @ c), lang) for lang, c in centroids]
        best = max(s for s, _ in scores)
        assert abs(found[key].score - best) < 1e-3
        assert max(s for s, lang in scores if lang == found[key].lang_pred) > best - 1e-3


def plain_toxicity(model, text):
    """(score, windows): every word is compressed anew with both dictionaries."""
    import zstandard

    def length(content, data):
        dictionary = zstandard.ZstdCompressionDict(content)
        settings = zstandard.ZstdCompressionParameters.from_level(
            19, source_size=256, dict_size=len(content), min_match=4, write_checksum=0, write_content_size=0, write_dict_id=0)
        dictionary.precompute_compress(compression_params=settings)
        return len(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings).compress(data))

    words = "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in text or "").split(" ")
    total, largest, n = 0.0, 0, 0
    for word in filter(None, words):
        data = toxicity.coded(f" {word} ".encode())
        difference = max(-toxicity.LARGEST, min(toxicity.LARGEST, length(model.ordinary, data) - length(model.toxic, data)))
        total, largest, n = total + model.weights[difference + toxicity.LARGEST], max(largest, difference), n + 1
    z = model.curve[0] + model.curve[1] * max(-20.0, min(20.0, total)) / 4 + model.curve[2] * largest / 4
    return 1 / (1 + np.exp(-z)), n


def test_toxicity_scores_like_plain_loops(spark):
    rows, labels = labelled(160)
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, marks, "doc_id", "text", ~toxicity.held_out(docs.doc_id))
    some = [*rows[:12], (900, None), (901, ""), (902, "GRUBWITZ, Flarchhead! ünd 12 snudge")]
    found = toxicity.score(spark.createDataFrame(some, "doc_id bigint, text string"), model).collect()
    for r in found:
        score, n = plain_toxicity(model, r.text)
        assert abs(r.toxicity.score - score) < 1e-9 and r.toxicity.n_windows == n and r.toxicity.predicted == (score >= 0.7)


def test_language_on_tricky_rows(spark, tricky, nothing):
    docs = spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr")] * 8)] + [(99, "x", None), (98, None, "en"), (None, "y", "xx")],
        "doc_id bigint, text string, lang string",
    )
    model = language.fit(docs, "doc_id", "text", "lang", ~language.held_out(docs.doc_id))
    assert set(model.languages) == {"en", "de", "fr"}
    found = language.predict(tricky, model).collect()
    assert own(found) == own(tricky.collect())
    for r in found:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.language.nearest == "und") == (not letters) and 0 <= r.language.score <= 1
    assert language.predict(nothing, model).collect() == []
    none = language.fit(docs.limit(0), "doc_id", "text", "lang", ~language.held_out(docs.doc_id))
    assert {r.language.lang for r in language.predict(docs, none).collect()} == {"und"}
    strange = spark.createDataFrame([("日本語の文章",)], "text string")
    assert language.predict(strange, model).first().language.rejected


def test_every_language_is_learnt(spark, monkeypatch):
    names = [f"l{chr(97 + i)}" for i in range(7)]
    stems = [["bakor", "tilun"], ["wexiq", "yozph"], ["chugra", "smeld"], ["pfaud", "jinkv"], ["ruolei", "nnaee"], ["thrys", "glynm"], ["ziqqa", "hobwu"]]
    rows = [(10 * i + k, " ".join(stems[i] * (2 + k)), n) for i, n in enumerate(names) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    whole = language.fit(docs, "doc_id", "text", "lang", language.F.lit(True))
    expected = sorted((r.doc_id, r.language.lang, round(r.language.score, 5)) for r in language.predict(docs, whole).collect())
    monkeypatch.setattr(language, "LANGUAGES", 3)
    model = language.fit(docs, "doc_id", "text", "lang", language.F.lit(True))
    assert [set(b.languages) for b in model.blocks()] == [set(names[:3]), set(names[3:6]), set(names[6:])]
    found = language.predict(docs, model).collect()
    assert all(r.language.nearest == r.lang for r in found)
    assert [(a, b) for a, b, _ in expected] == sorted((r.doc_id, r.language.lang) for r in found)
    assert [s for _, _, s in expected] == pytest.approx([r.language.score for r in sorted(found)], abs=1e-4)


def test_a_repeated_id_is_learnt_once(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_ROWS", 5)
    texts = ["bakor tilun", "wexiq yozph", "chugra smeld", "pfaud jinkv", "ruolei nnaee"]
    rows = [(i, texts[i], f"l{hot}") for hot in range(5) for i in range(5) for _ in range(40 if i == hot else 1)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), "doc_id", "text", "lang", language.F.lit(True))
    assert model.languages == [f"l{hot}" for hot in range(5) for _ in range(language.CENTROIDS)]


def test_language_counts_in_stretches(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog ".encode() * 50
    whole = language.counts(text)
    monkeypatch.setattr(language, "STRETCH", 64)
    assert (language.counts(text) == whole).all()


# --- pipeline


def test_pipeline_like_plain_loops(spark, folder, duck):
    docs = duck.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()
    items = duck.execute("SELECT CAST(item_id AS VARCHAR), text FROM benchmark").fetchall()
    docs = [d for d in docs if plain_quality(d[1])[6]]
    keep = {group for _, group in similar_groups([d[:2] for d in docs])}
    docs = [d for d in docs if d[0] in keep]
    long_items = [(n, t) for n, t in items if len(decontaminate.normal_words(t.encode())) >= corpus_pipeline.LEAST_ITEM]
    automaton = decontaminate.Automaton([(n, decontaminate.normal_words(t.encode())) for n, t in long_items])
    out = {}
    for key, text, lang, source in docs:
        n, hit, _ = plain_hits(text, long_items)
        if len(hit) > 0.5 * n:
            continue
        data = text.encode()
        while spans := automaton.hits(decontaminate.normal_words(data))[0]:
            data = decontaminate.cut_words(data, spans)
        assert not plain_hits(data.decode(), long_items)[1]
        out[key] = (secrets.redact(data, secrets.scan(data), b"[secret]").decode(), lang, source)
    rows = corpus_pipeline.run(spark, folder).collect()
    segmenter = pieces.Segmenter(pieces.load(pieces.public_model()))
    assert {r.doc_id: (segmenter.decode(r.ids), r.lang, r.source) for r in rows} == out
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in rows) and len(rows) == len(out)


def test_stages_on_tricky_rows(spark, folder, tricky):
    docs = tricky.selectExpr("*", "'en' AS lang", "'s' AS source").drop("n_chars").withColumnRenamed("_now", "_verdict")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for some in (docs, docs.limit(0)):
            found = stage(spark, some, folder)
            found.collect()
            assert number == len(corpus_pipeline.STAGES) - 1 or found.columns == some.columns


def test_encoding_stage_ranks_segmentations(spark, folder):
    texts = ["The quick brown fox jumps over the lazy dog near the old river bank.", "word", "x1 ééé\n日本語", "", None, "word"]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string")
    rows = {r.doc_id: r for r in corpus_pipeline.sentencepiece_encoding(spark, docs, folder).collect()}
    segmenter = pieces.Segmenter(pieces.load(pieces.public_model()))
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        if text is None:
            assert rows[i].ids is None and rows[i].n_pieces is None and rows[i].nbest is None
            continue
        ids, ranked = segmenter.encode(text)
        assert rows[i].ids == ids.tolist() and [(n.score, n.ids) for n in rows[i].nbest] == [(s, p.tolist()) for s, p in ranked]
        assert len(ranked) == (pieces.BEST if text else 0) and all(segmenter.decode(n.ids) == text for n in rows[i].nbest)
