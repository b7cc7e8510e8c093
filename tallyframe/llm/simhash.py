"""Near duplicates by SimHash: fingerprints that differ in few bits are found at anchors of a covering code.

The 64 bits are cut into three bands. Two fingerprints that differ in up to four bits differ in at most one
bit of some band. Anchors of a band are the words of the code that is a Hamming code on 15 of its bits and
free on the others: every band value is at most one bit (the covering radius) from an anchor. Each fingerprint
is at home at its nearest anchor and visits every anchor within the radius and the band's threshold, two bits,
so the pair meets at the home of either.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import by_arrow, free_name, own, raw, small_batches
from .components import components

WORDS = 4
SEED = 42
MOST_BITS = 4
#: (first bit, number of bits) of each band, from the lowest bit. One band more than MOST_BITS // 2, so that
#: some band holds at most one of the differing bits.
BANDS = ((0, 22), (22, 21), (43, 21))
HAMMING = 15
RADIUS, BAND_BITS = 1, 1
#: Fingerprints of one anchor are compared in blocks of at most about this many, each in its own task's turn.
BLOCK = 4096
#: Pairs that a task compares at once.
PAIRS = 1 << 20
_AT_ONCE = 1 << 16


def _shingles(text: bytes | None, words: int):
    """The hashes of all shingles in order, some at a time; none for a text without words."""
    parts = (text or b"").lower().split()
    if not parts:
        return
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(parts) - words + 1)
    ends = ends[min(words, len(parts)) - 1 :]
    digest = xxhash.xxh64_digest
    for at in range(0, n, _AT_ONCE):
        some = zip(starts[at : min(n, at + _AT_ONCE)].tolist(), ends[at : at + _AT_ONCE].tolist(), strict=True)
        yield np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in some]), ">u8")


def _majority(parts, numbers: int) -> bytes:
    ones, n = np.zeros((numbers, 64), np.int64), 0
    for hashes in parts:
        n += len(hashes)
        for number in range(numbers):
            if number:
                hashes = _mixed(hashes.astype(np.uint64)).astype(">u8")
            ones[number] += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def sketch(text: bytes | None, words: int = WORDS, numbers: int = 1) -> bytes:
    """The SimHash of all shingles in ``numbers`` times 64 bits, highest bit first; all zero for a text without words.

    The first 64 bits are of the shingles' hashes, each further number of the hashes mixed once more.
    """
    return _majority(_shingles(text, words), numbers)


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """The hashes of the distinct shingles, in order."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *(h.astype(np.uint64) for h in _shingles(text, words))]))


def set_sketch(text: bytes | None, words: int, numbers: int) -> bytes:
    """As :func:`sketch`, but each distinct shingle counts once, and 128 bits more that tell the set of shingles."""
    found = shingle_set(text, words)
    parts = (found[at : at + _AT_ONCE].astype(">u8") for at in range(0, len(found), _AT_ONCE))
    return _majority(parts, numbers) + xxhash.xxh3_128_digest(found.tobytes())


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Other hashes, as good as independent, of the same shingles."""
    hashes = hashes + np.uint64(0x9E3779B97F4A7C15)
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The SimHash of all shingles, as a signed 64-bit number; 0 for a text without words."""
    return int.from_bytes(sketch(text, words), "big", signed=True)


def fingerprints(df: DataFrame, text: str = "text", into: str = "fingerprint", words: int = WORDS) -> DataFrame:
    """All columns of ``df`` and the bigint ``into``."""

    @by_arrow(pa.int64())
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, words) for t in raw(texts)], pa.int64())

    return small_batches(df).withColumn(into, found(F.col(f"`{text}`").cast("string")))


def _syndromes() -> np.ndarray:
    """Of each 15-bit value: 0 for a code word, else the number of the bit that makes it one."""
    values = np.arange(1 << HAMMING)
    out = np.zeros(1 << HAMMING, np.int64)
    for bit in range(HAMMING):
        out ^= np.where(values >> bit & 1, bit + 1, 0)
    return out


def _masks(free: int, reach: int) -> list[np.ndarray]:
    """By syndrome: what leads from a band value to its anchors within reach, the home first."""
    out = []
    for syndrome in range(HAMMING + 1):
        near = [0] if not syndrome else [1 << (syndrome - 1)]
        pairs = [1 << i - 1 | 1 << j - 1 for i, j in combinations(range(1, HAMMING + 1), 2) if i ^ j == syndrome and syndrome not in (i, j)]
        masks = []
        for mask in near + pairs:
            for n in range(reach - mask.bit_count() + 1):
                masks += [mask | sum(1 << HAMMING + b for b in bits) for bits in combinations(range(free), n)]
        out.append(np.array(masks, np.int64))
    return out


_SYNDROMES = _syndromes()
_REACH = [_masks(width - HAMMING, RADIUS + BAND_BITS) for _, width in BANDS]


def _visited(values: np.ndarray, masks: list[np.ndarray]):
    """(anchors, numbers of values, home) of the visits of a band's values, by syndrome."""
    syndromes = _SYNDROMES[values & (1 << HAMMING) - 1]
    for syndrome in range(HAMMING + 1):
        mine = np.flatnonzero(syndromes == syndrome)
        visited = values[mine, None] ^ masks[syndrome][None, :]
        home = np.zeros(visited.shape, bool)
        home[:, 0] = True
        yield visited.ravel(), np.repeat(mine, visited.shape[1]), home.ravel()


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, fingerprint, home) of all visits; an anchor's number holds its band."""
    out = []
    unsigned = prints.view(np.uint64)
    for band, (first, width) in enumerate(BANDS):
        values = (unsigned >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
        out += [(visited | band << 32, prints[of], home) for visited, of, home in _visited(values, _REACH[band])]
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def _visits(prints: DataFrame) -> DataFrame:
    def visit(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                some = batch.column(0).slice(at, 20_000).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in anchors(some)], ["anchor", "fingerprint", "home"])

    return prints.mapInArrow(visit, "anchor bigint, fingerprint bigint, home boolean")


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as stars: (node, least node of what it is linked with), for all nodes but the least."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        grown = label.copy()
        np.minimum.at(grown, label[a], least)
        np.minimum.at(grown, label[b], least)
        grown = grown[grown]
        if (grown == label).all():
            break
        label = grown
    some = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[some], nodes[label[some]]


def _pairs(groups: np.ndarray, home: np.ndarray):
    """Rows, sorted by group, to compare: (homes, rows of their groups), some PAIRS at a time."""
    starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(groups)])))
    homes = np.flatnonzero(home)
    group_of = np.searchsorted(starts, homes, "right") - 1
    pairs = np.cumsum(sizes[group_of])
    at = 0
    while at < len(homes):
        end = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + PAIRS, "right")))
        some, of = homes[at:end], group_of[at:end]
        n = sizes[of]
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(some, n), np.repeat(starts[of], n) + offset
        at = end


def _compared(cells: DataFrame, near) -> DataFrame:
    """(u, v), u > v: links within each cell, as stars; rows arrive sorted by cell.

    ``near(table)`` gives the numbers of a table's rows and a function that tells which of some pairs are linked.
    """

    def compare(batches):
        rest = None
        names = ["anchor", "row", "col"]

        def found(table):
            keys = [table.column(n).to_numpy() for n in names]
            changes = np.zeros(table.num_rows, bool)
            for k in keys:
                changes[1:] |= k[1:] != k[:-1]
            numbers, linked = near(table)
            for a, b in _pairs(np.cumsum(changes), table.column("home").to_numpy(zero_copy_only=False)):
                hit = linked(a, b)
                if hit.any():
                    u, v = _stars(numbers[a[hit]], numbers[b[hit]])
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            # The last cell may go on in the next batch.
            last = np.ones(table.num_rows, bool)
            for n in names:
                column = table.column(n).to_numpy()
                last &= column == column[-1] if len(column) else last
            cut = table.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
            rest = table.slice(cut)
            if cut:
                yield from found(table.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield from found(rest)

    return cells.mapInArrow(compare, "u bigint, v bigint")


def _cells(visits: DataFrame, spread: str, block: int) -> DataFrame:
    """Visits (anchor, home, others) with row and col: those of anchors with more than ``block`` dealt over a grid of blocks.

    ``spread`` is the column by whose hash rows are dealt over blocks. Rows come sorted by cell.
    """
    others = [c for c in visits.columns if c not in ("anchor", "home")]
    counts = visits.groupBy("anchor").agg(F.sum(F.col("home").cast("int")).alias("homes"), F.count(F.lit(1)).alias("visitors"))
    crowded = cut_lineage(counts.where((F.col("visitors") > block) & (F.col("homes") > 0)))
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    mine = lambda n: F.pmod(F.xxhash64(spread), blocks(n)).cast("int")
    cell = lambda row, col, home: F.struct(row.alias("row"), col.alias("col"), home.alias("home"))
    # In a crowded anchor a home is compared in every block of its row and is a visitor to the other homes.
    as_visitor = F.transform(F.sequence(F.lit(0), blocks("homes") - 1), lambda r: cell(r, mine("visitors"), F.lit(False)))
    as_home = F.transform(F.sequence(F.lit(0), blocks("visitors") - 1), lambda c: cell(mine("homes"), c, F.lit(True)))
    alone = F.array(cell(F.lit(0), F.lit(0), F.col("home")))
    cells = F.when(F.col("homes").isNull(), alone).when(F.col("home"), F.concat(as_home, as_visitor)).otherwise(as_visitor)
    dealt = visits.join(crowded, "anchor", "left").select("anchor", *others, F.explode(cells).alias("cell"))
    dealt = dealt.select("anchor", "cell.row", "cell.col", *others, "cell.home")
    return dealt.repartition("anchor", "row", "col").sortWithinPartitions("anchor", "row", "col")


def links(prints: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """(u, v), u > v: enough links between distinct fingerprints that differ in ``most`` bits or fewer to connect
    all that are linked. ``prints`` has one column of distinct values.

    Rows of an anchor with more than BLOCK visitors are dealt over a grid of blocks of homes and visitors. Each
    task gives its links as stars, never all pairs of a group.
    """
    if most // len(BANDS) > BAND_BITS:
        raise ValueError(f"the bands find pairs of up to {len(BANDS) * (BAND_BITS + 1) - 1} bits")

    def near(table):
        values = table.column("fingerprint").to_numpy()
        return values, lambda a, b: (np.bitwise_count((values[a] ^ values[b]).view(np.uint64)) <= most) & (values[a] != values[b])

    return _compared(_cells(_visits(prints), "fingerprint", BLOCK), near)


#: For similarities, sketches of NUMBERS * 64 bits meet at anchors of the same code in bands of BAND bits: a sketch is
#: at home at the nearest anchor of each band and visits all within the radius, so bands that are equal meet and many that
#: differ in a bit or two. Bits differ at a rate of acos(2s / (1 + s)) / pi for shingle sets of similarity s, 0.15 at 0.8:
#: of 20,000 simulated pairs at 0.8, some 0.6 % meet in none of 45 bands. Two orders of the bits give the bands.
#: Wider bands meet fewer strangers and need more of them: a larger corpus takes more NUMBERS and a greater BAND.
SIMILAR_WORDS, SIMILARITY = 5, 0.8
NUMBERS, BAND = 8, 17
_ROWS = 64 * NUMBERS // BAND
#: The bits of each band: all bits in order, then half of them again, a band's far from each other.
PLACES = np.concatenate((np.arange(_ROWS * BAND).reshape(_ROWS, BAND), np.arange(_ROWS * BAND).reshape(BAND, _ROWS).T[: _ROWS // 2]))
_NEAR = _masks(BAND - HAMMING, RADIUS)
#: How many deviations beyond the expected number of differing bits still count as similar, and how many make a
#: candidate whose sets of shingles are compared.
LEEWAY, CANDIDATE_LEEWAY = 1.5, 4
#: Texts of one group of candidates that are compared by their shingles at once.
SET_BLOCK = 512


def most_differing(similarity: float, bits: int = 64 * NUMBERS, leeway: float = LEEWAY) -> int:
    """Differing bits up to which sketches count as similar."""
    rate = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * rate + leeway * math.sqrt(bits * rate * (1 - rate)))


def similar_links(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v), u > v: as :func:`links`, for the nodes of (node, sketch) rows that may be similar by their sketches."""
    most = most_differing(similarity, leeway=CANDIDATE_LEEWAY)

    def visit(batches):
        weights = 1 << np.arange(BAND, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 5_000):
                some = batch.slice(at, 5_000)
                data = np.frombuffer(b"".join(some.column("sketch").to_pylist()), np.uint8).reshape(-1, 8 * NUMBERS)
                bits = np.unpackbits(data, axis=1)
                found = [  # band by band: copies of a sketch stand apart
                    (visited | band << 32, of, home) for band, places in enumerate(PLACES) for visited, of, home in _visited(bits[:, places] @ weights, _NEAR)
                ]
                anchor, of, home = (np.concatenate(part) for part in zip(*found, strict=True))
                of = pa.array(of)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), some.column("node").take(of), some.column("sketch").take(of), pa.array(home)], ["anchor", "node", "sketch", "home"])

    def near(table):
        data = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(-1, NUMBERS)
        numbers, columns = table.column("node").to_numpy(), np.ascontiguousarray(data.T)

        def linked(a, b):
            hit = numbers[a] != numbers[b]
            some = np.flatnonzero(hit)
            total = np.zeros(len(some), np.int64)
            for column in columns:  # a pair goes as soon as its bits so far are too many
                total = total + np.bitwise_count(column[a[some]] ^ column[b[some]])
                near = total <= most
                some, total = some[near], total[near]
            hit[:] = False
            hit[some] = True
            return hit

        return numbers, linked

    visits = nodes.mapInArrow(visit, "anchor bigint, node bigint, sketch binary, home boolean")
    return _compared(_cells(visits, "node", BLOCK), near)


def _enough(common, one, other, similarity: float):
    """Whether sets of these sizes are similar with so many common members."""
    return common >= similarity * (one + other - common) - 1e-9


def confirmed_links(sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v), u > v: enough links between nodes of similar sets to connect all that are linked within a root.

    ``sets`` are (node, root, shingles) rows, written, ``root`` the least of a group of candidates. Most members are
    similar to the root itself; only the others are compared with all members, in blocks of SET_BLOCK.
    """

    @by_arrow(pa.bool_())
    def like_root(ours: pa.Array, roots: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(raw(ours), raw(roots), strict=True):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            out.append(bool(_enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), similarity)))
        return pa.array(out, pa.bool_())

    bases = sets.where("node = root").select("root", F.col("shingles").alias("base"))
    judged = cut_lineage(sets.join(bases, "root").select("node", "root", like_root("shingles", "base").alias("direct")))

    def near(table):
        numbers, held = table.column("node").to_numpy(), table.column("shingles").to_pylist()
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 8
        edges = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.unique(np.frombuffer(b"".join(held), np.uint64), return_inverse=True)[1]

        def linked(a, b):
            hit, mark = np.zeros(len(a), bool), np.zeros(len(ids), bool)
            starts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))).tolist()
            for start, end in zip(starts, [*starts[1:], len(a)], strict=True):
                # The rows of a home's group stand side by side.
                home, first, last = a[start], b[start], b[end - 1] + 1
                mine = ids[edges[home] : edges[home + 1]]
                mark[mine] = True
                found = np.concatenate(([0], np.cumsum(mark[ids[edges[first] : edges[last]]])))
                mark[mine] = False
                common = np.diff(found[edges[first : last + 1] - edges[first]])
                hit[start:end] = _enough(common, sizes[home], sizes[first:last], similarity)
            return hit & (numbers[a] != numbers[b])

        return numbers, linked

    open_roots = judged.where("not direct").select("root").distinct()
    visits = sets.join(judged.select("node", "direct"), "node").join(open_roots, "root", "left_semi")
    visits = visits.select(F.col("root").alias("anchor"), "node", "shingles", (~F.col("direct")).alias("home"))
    direct = judged.where("direct and node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    return direct.union(_compared(_cells(visits, "node", min(BLOCK, SET_BLOCK)), near))


def _named(marked: DataFrame, most: int) -> DataFrame:
    """(print, root, component) of each distinct ``print`` in (key, print) rows."""
    distinct = cut_lineage(marked.groupBy("print").agg(F.min("key").alias("least")))
    roots = components(links(distinct.select("print"), most)).select(F.col("u").alias("print"), F.col("v").alias("root"))
    rooted = distinct.join(roots, "print", "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component")), "root").select("print", "root", "component")


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, most: int = MOST_BITS) -> DataFrame:
    """A row (key, fingerprint, component) for each row of ``df``.

    ``fingerprint`` has 16 hex digits; ``component`` is the least key among all rows reachable over links of
    fingerprints that differ in ``most`` bits or fewer. Null and empty texts have fingerprint zero and are
    linked like any other. Rows with equal fingerprints are linked, so repeated rows are; null keys are never
    the least, and a group with null keys only has a null component.
    """
    marked = fingerprints(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), "text", "print", words)
    marked = cut_lineage(marked.select("key", "print"))
    found = marked.join(_named(marked, most), "print")
    return found.select(F.col("key").alias(key), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component")


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``df`` with one row of each group of similar texts: that of the least key, null keys last, the first of equal keys.

    Texts are similar if their sets of distinct shingles of ``words`` words have a similarity of ``similarity`` or
    more; groups are connected by such links, and texts with equal sets, empty and null texts among them, are one
    group. Sketches of the sets only find the candidates: each link is confirmed by the sets themselves. The rows are
    written once with their sketches, so that every later reader sees the same rows.
    """
    row, mark = free_name(df, "_row"), free_name(df, "_sketch")

    @by_arrow(pa.binary())
    def sketched(texts: pa.Array) -> pa.Array:
        return pa.array([set_sketch(t, words, NUMBERS) for t in raw(texts)], pa.binary())

    @by_arrow(pa.binary())
    def shingled(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t, words).tobytes() for t in raw(texts)], pa.binary())

    marked = small_batches(df).withColumn(mark, sketched(F.col(f"`{text}`").cast("string")))
    rows = cut_lineage(marked.withColumn(row, F.monotonically_increasing_id()))
    light = rows.select(F.col(f"`{key}`").alias("key"), F.col(mark).alias("sketch"), F.col(row).alias("row"))
    nodes = cut_lineage(light.groupBy("sketch").agg(F.min("row").alias("node")))
    bits = nodes.select("node", F.substring("sketch", 1, 8 * NUMBERS).alias("sketch"))
    candidates = components(similar_links(bits, similarity)).select(F.col("u").alias("node"), F.col("v").alias("root"))
    candidates = candidates.union(candidates.select(F.col("root").alias("node"), "root").distinct())
    texts = rows.select(F.col(row).alias("node"), F.col(f"`{text}`").cast("string").alias("text"))
    # Written, as only the texts of candidates are taken apart and several readers need their sets.
    sets = cut_lineage(texts.join(candidates, "node").select("node", "root", shingled("text").alias("shingles")))
    roots = components(confirmed_links(sets, similarity)).select(F.col("u").alias("node"), F.col("v").alias("root"))
    rooted = nodes.join(roots, "node", "left").select("sketch", F.coalesce("root", "node").alias("root"))
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row"))["row"]
    keepers = light.join(rooted, "sketch").groupBy("root").agg(first.alias("row")).select("row")
    # The rows to drop are few as a rule; their written size lets Spark choose how to join.
    drops = cut_lineage(light.select("row").join(keepers, "row", "left_anti"))
    return rows.join(drops.withColumnRenamed("row", row), row, "left_anti").select(*own(df))
