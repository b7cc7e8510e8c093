"""SentencePiece encoding and decoding over the lattice of a public model's pieces.

Every piece that matches somewhere in a text is an edge of the lattice, with the model's score of the piece.
A forward pass finds the best score up to each place; these are exact estimates for a best-first search from
the end, which therefore meets segmentations in order of their score.
"""

from __future__ import annotations

import heapq
import re
import struct
import uuid
from array import array
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_arrow, raw, small_batches

#: Segmentations of a text that are ranked.
BEST = 3
#: Words and chunks whose segmentation a task remembers, and the length of the longest.
REMEMBERED, LONGEST = 300_000, 64
#: Longer chunks are segmented one by one.
MOST_LETTERS = 24
#: A character that no piece covers costs this much more than the worst piece.
UNKNOWN_COST = 10.0
#: Pieces without a use of their own, such as runs of spaces that the model sets apart, have scores below this.
USABLE = -1e8

#: Letters with the spaces before them; other characters, digits and fractions among them, likewise; line ends; spaces.
_FINE = re.compile(r" *[^\W\d_²³¹¼-¾]+| *(?:[^\w \n]|[\d_²³¹¼-¾])+|\n| +")
_COARSE = re.compile(r" *[^ ]+| +")
#: What goes before the ids of a remembered chunk.
_HEAD, _HEAD_BYTES = "<dd", 16


@dataclass
class Model:
    """Pieces in order of their ids: text with plain spaces, score, and a byte's number or None."""

    texts: list[str]
    scores: list[float]
    bytes_: list[int | None]
    control: set[int]
    unknown: int
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def load(path: str, most: int = 1 << 20) -> Model:
    """The pieces of a SentencePiece model file that the driver can read; at most ``most`` of them."""
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    n = file.get_piece_size()
    if n > most:
        raise ValueError(f"{path} has {n} pieces, more than {most}")
    names = [file.id_to_piece(i) for i in range(n)]
    return Model(
        [name.replace("▁", " ") for name in names], [file.get_score(i) for i in range(n)],
        [int(names[i][1:-1], 16) if file.is_byte(i) else None for i in range(n)],
        {i for i in range(n) if file.is_control(i) or file.is_unknown(i)}, file.unk_id(),
    )


class PieceTable:
    """Pieces by the hash of their text, in two tables of which one holds any piece, for look-ups of whole arrays."""

    BITS = 17
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        names = [t for t in pieces if len(t) <= MOST_LETTERS]
        self.longest = max(map(len, names), default=0)
        keys = []
        for name in names:
            key = 0
            for c in name:
                key = self.step(key, ord(c))
            keys.append(key)
        self.ids = np.array([-1, *(pieces[t][0] for t in names)], np.int32)
        self.scores = np.array([-np.inf, *(pieces[t][1] for t in names)])
        self.keys = np.array([0, *keys], np.uint64)
        size = 1 << self.BITS
        while size < 4 * len(names):
            size, self.BITS = 2 * size, self.BITS + 1
        self.slots = [np.zeros(size, np.int32), np.zeros(size, np.int32)]
        places = [self._place(self.keys, table).tolist() for table in (0, 1)]
        tables = [dict(), dict()]
        for row in range(1, len(keys) + 1):  # a row that finds its place taken moves the other one to the other table
            table = 0
            while row is not None:
                place = places[table][row]
                row, tables[table][place] = tables[table].get(place), row
                table = 1 - table
        for table in (0, 1):
            self.slots[table][list(tables[table])] = list(tables[table].values())

    @staticmethod
    def step(key: int, code: int) -> int:
        return (key * 0x100000001B3 + code + 1) & 0xFFFFFFFFFFFFFFFF

    def _place(self, keys: np.ndarray, table: int) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(29))) * self.FACTOR
        return (mixed >> np.uint64(64 - self.BITS) if not table else mixed >> np.uint64(20) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key in ids and scores, 0 where there is no such piece."""
        first, second = (self.slots[t][self._place(keys, t)] for t in (0, 1))
        return np.where(self.keys[first] == keys, first, np.where(self.keys[second] == keys, second, 0))


class Segmenter:
    def __init__(self, model: Model):
        plain = [i for i, b in enumerate(model.bytes_) if b is None and i not in model.control]
        self.pieces = {model.texts[i]: (i, model.scores[i]) for i in plain}
        #: Every beginning of a piece, with its id and score if it is one.
        self.starts = {t[:n]: () for t in self.pieces for n in range(1, len(t))} | self.pieces
        self.lookup = PieceTable(self.pieces)
        self.bytes_ = {b: i for i, b in enumerate(model.bytes_) if b is not None}
        self.unknown = model.unknown
        usable = [model.scores[i] for i in plain if model.scores[i] > USABLE]
        self.worst = min(usable, default=0.0) - UNKNOWN_COST
        # A text may be cut where no piece reaches across; the chunks are then segmented one by one.
        whole = lambda p, t: [t] == p.findall(t)
        self.chunk = next((p for p in (_FINE, _COARSE) if all(whole(p, t) for t in self.pieces)), re.compile(r"(?s).+"))
        self.texts = model.texts
        self.known: dict[str, bytes] = {}
        self.lists: dict[tuple[str, int], list] = {}
        self.table = [
            b"" if i in model.control else bytes([model.bytes_[i]]) if model.bytes_[i] is not None else t.encode() for i, t in enumerate(model.texts)
        ]

    def _lattice(self, text: str):
        """Edges (start, ids, score) by where they end, and the best score up to each place."""
        starts, n = self.starts, len(text)
        edges: list[list[tuple]] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, n + 1):
                found = starts.get(text[i:j])
                if found is None:
                    break
                if found:
                    edges[j].append((i, (found[0],), found[1]))
            if text[i] not in self.pieces:
                edges[i + 1].append((i, self._bytes(text[i]), self.worst))
        best = [0.0] * (n + 1)
        for j in range(1, n + 1):
            best[j] = max([best[i] + score for i, _, score in edges[j]])
        return edges, best

    def _bytes(self, character: str) -> tuple[int, ...]:
        return tuple(self.bytes_.get(b, self.unknown) for b in character.encode())

    def best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Up to ``n`` segmentations (score, ids) of a chunk, best first.

        Of equal estimates the latest is followed first, so that one path is ended before its equals are begun:
        a long run of one character has very many of them.
        """
        edges, best = self._lattice(text)
        serial, out = count(), []
        # (minus the score of the whole path, serial, place, score from there to the end, what comes after)
        heap = [(round(-best[-1], 6), 0, len(text), 0.0, None)]
        while heap and len(out) < n:
            _, _, place, after, path = heapq.heappop(heap)
            if not place:
                ids = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                out.append((after, tuple(ids)))
                continue
            for start, ids, score in edges[place]:
                heapq.heappush(heap, (round(-(best[start] + score + after), 6), -next(serial), start, score + after, (ids, path)))
        return out

    def _ranked(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        found = self.lists.get((text, n))
        if found is None:
            if len(self.lists) >= REMEMBERED // 10:
                self.lists.clear()
            found = self.best(text, n)
            if len(text) <= LONGEST:
                self.lists[text, n] = found
        return found

    def _kept(self, text: str, found: bytes) -> bytes:
        if len(text) <= LONGEST:
            self.known[text] = found
        return found

    def _chunk(self, text: str) -> bytes:
        """The score of the best segmentation, by how much the second is worse, and the ids of the best, as bytes."""
        # One forward pass for the best and the second best score up to each place.
        starts, pieces, n, none = self.starts, self.pieces, len(text), -np.inf
        best, second, came, by = [none] * (n + 1), [none] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            first, other = best[i], second[i]
            for j in range(i + 1, n + 1):
                found = starts.get(text[i:j])
                if found is None:
                    break
                if found:
                    number, score = found
                    whole = first + score
                    if whole > best[j]:
                        second[j] = best[j] if best[j] > second[j] else second[j]
                        best[j], came[j], by[j] = whole, i, number
                    elif whole > second[j]:
                        second[j] = whole
                    if other + score > second[j]:
                        second[j] = other + score
            if text[i] not in pieces:
                j, whole = i + 1, first + self.worst
                if whole > best[j]:
                    second[j] = best[j] if best[j] > second[j] else second[j]
                    best[j], came[j], by[j] = whole, i, -1
                elif whole > second[j]:
                    second[j] = whole
                if other + self.worst > second[j]:
                    second[j] = other + self.worst
        ids, place = [], n
        while place:
            if by[place] < 0:
                ids += reversed(self._bytes(text[place - 1]))
            else:
                ids.append(by[place])
            place = came[place]
        return self._kept(text, struct.pack(_HEAD, best[-1], best[-1] - second[-1]) + np.array(ids[::-1], np.int32).tobytes())

    def learn(self, chunks: set[str]) -> None:
        """Remember the best segmentations of chunks, all of one length at once."""
        by_size: dict[int, list[str]] = {}
        for chunk in chunks:
            if len(chunk) <= MOST_LETTERS:
                by_size.setdefault(len(chunk), []).append(chunk)
        for size, some in by_size.items():
            for at in range(0, len(some), 1 << 15):
                self._chunks(some[at : at + (1 << 15)], size)

    def _chunks(self, chunks: list[str], size: int) -> None:
        """As :meth:`_chunk`, for many chunks of one length whose characters all are pieces."""
        letters = np.array(chunks, f"<U{size}").view(np.uint32).reshape(-1, size).astype(np.uint64)
        table, n = self.lookup, len(chunks)
        best, second = np.full((size + 1, n), -np.inf), np.full((size + 1, n), -np.inf)
        came, by = np.zeros((size + 1, n), np.int32), np.zeros((size + 1, n), np.int32)
        best[0] = 0.0
        sound = np.ones(n, bool)
        for i in range(size):
            key = np.zeros(n, np.uint64)
            for j in range(i + 1, min(size, i + table.longest) + 1):
                key = key * np.uint64(0x100000001B3) + letters[:, j - 1] + np.uint64(1)
                rows = table.rows(key)
                if j == i + 1:
                    sound &= rows > 0
                hit = np.flatnonzero(rows)
                if not len(hit):
                    continue
                found = rows[hit]
                score = table.scores[found]
                whole, held = best[i, hit] + score, best[j, hit]
                better = whole > held
                second[j, hit] = np.maximum(np.maximum(second[j, hit], second[i, hit] + score), np.where(better, held, whole))
                best[j, hit] = np.where(better, whole, held)
                turned = hit[better]
                came[j, turned], by[j, turned] = i, found[better]
        scores, costs = best[size], np.where(sound, best[size], 0) - second[size]
        came, by, ids = came.T.tolist(), table.ids[by].T.tolist(), table.ids
        texts = self.texts
        for chunk, fine, score, cost, back, numbers in zip(chunks, sound.tolist(), scores.tolist(), costs.tolist(), came, by, strict=True):
            if not fine:
                continue
            mine, place = [], size
            while place:
                mine.append(numbers[place])
                place = back[place]
            mine.reverse()
            # A hash that two texts share would show here; such a chunk is then left to the exact search.
            if "".join([texts[i] for i in mine]) == chunk:
                self._kept(chunk, struct.pack(_HEAD, score, cost) + array("i", mine).tobytes())

    def encode(self, text: str, n: int = BEST) -> tuple[np.ndarray, list[tuple[float, np.ndarray]]]:
        """The ids of the best segmentation of a text, and (score, ids) of the ``n`` best, of which it is the first."""
        return next(self.encode_all([text], n))

    def encode_all(self, texts: list[str], n: int = BEST):
        """As :meth:`encode`, for some texts; what is new in them is segmented together."""
        lists = [self.chunk.findall(" " + t) if t else [] for t in texts]
        new = set().union(*lists).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set().union(*lists)
        self.learn(new)
        for chunks in lists:
            yield self._joined(chunks, n) if chunks else (np.zeros(0, np.int32), [])

    def _joined(self, chunks: list[str], n: int) -> tuple[np.ndarray, list[tuple[float, np.ndarray]]]:
        known, make = self.known.get, self._chunk
        found = [known(c) or make(c) for c in chunks]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.int32)
        heads = (np.cumsum(sizes) - sizes)[:, None] + np.arange(_HEAD_BYTES // 4)
        scores, costs = flat[heads].view(np.float64).T
        rest = np.ones(len(flat), bool)
        rest[heads.ravel()] = False
        ids, score = flat[rest], float(scores.sum())
        if n < 2:
            return ids, [(score, ids)][:n]
        # The n best of all differ from the best in those chunks only whose second segmentation costs least.
        limit = np.partition(costs, min(n - 1, len(costs)) - 1)[min(n - 1, len(costs)) - 1]
        places = [p for p in np.flatnonzero(costs <= limit).tolist() if costs[p] < np.inf]
        places = sorted(sorted(places, key=lambda p: (costs[p], p))[: n - 1])
        ends = np.cumsum(sizes - _HEAD_BYTES // 4)
        spans = [(int(ends[p] - sizes[p] + _HEAD_BYTES // 4), int(ends[p])) for p in places]
        ranked = []
        for p, (a, b) in zip(places, spans, strict=True):
            listed, mine = self._ranked(chunks[p], n), tuple(ids[a:b].tolist())
            # Of equal segmentations the one in ``ids`` is the first.
            ranked.append([(listed[0][0], mine), *(x for x in listed if x[1] != mine)][:n])
        return ids, [(total, _spliced(ids, spans, ranked, choice)) for total, choice in _merged(ranked, score, n)]

    def decode(self, ids) -> str:
        """The text of ids; the space that encoding puts first is taken off."""
        found = b"".join(map(self.table.__getitem__, ids))
        return (found[1:] if found[:1] == b" " else found).decode(errors="replace")


def _merged(ranked: list[list[tuple[float, tuple]]], score: float, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """(score, choice) of the ``n`` best choices of one segmentation for each chunk."""
    out, heap = [], [(0.0, (0,) * len(ranked), 0)]
    while heap and len(out) < n:
        cost, choice, last = heapq.heappop(heap)
        out.append((score - cost, choice))
        for k in range(last, len(ranked)):
            i = choice[k] + 1
            if i < len(ranked[k]):
                heapq.heappush(heap, (cost + ranked[k][i - 1][0] - ranked[k][i][0], (*choice[:k], i, *choice[k + 1 :]), k))
    return out


def _spliced(ids: np.ndarray, spans: list[tuple[int, int]], ranked: list[list[tuple[float, tuple]]], choice: tuple[int, ...]) -> np.ndarray:
    """``ids`` with the chosen segmentations in the places of some chunks."""
    parts, at = [], 0
    for (a, b), others, i in zip(spans, ranked, choice, strict=True):
        if i:
            parts += [ids[at:a], np.array(others[i][1], np.int32)]
            at = b
    return np.concatenate([*parts, ids[at:]]) if parts else ids


_held: dict[str, Segmenter] = {}


def _segmenter(model: Model) -> Segmenter:
    if model.key not in _held:
        _held.clear()
        _held[model.key] = Segmenter(model)
    return _held[model.key]


_BEST = pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))])
_RANKED = pa.list_(_BEST)
_ENCODED = pa.struct([("ids", pa.list_(pa.int32())), ("nbest", _RANKED), ("round_trip", pa.bool_())])


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int32)


def _lists(sizes, values: pa.Array, null: list[bool] | None = None) -> pa.ListArray:
    """Values as lists of these sizes; those marked as null are."""
    ends = [0, *np.cumsum(np.fromiter(sizes, np.int64)).tolist()]
    offsets = [None if n else e for e, n in zip(ends, [*(null or [False] * (len(ends) - 1)), False], strict=True)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encoded(df: DataFrame, model: Model, text: str = "text", into: str = "pieces", best: int = BEST) -> DataFrame:
    """All columns of ``df`` and the struct ``into``: ids of the best segmentation, nbest (score, ids), round_trip.

    ``nbest`` lists the ``best`` best segmentations of the whole text, best first, ``ids`` being the first; none with 0. An empty text has no ids
    and no segmentations, a null text null in both. Characters outside the vocabulary become their bytes. The ids
    are decoded again in the same task, and ``round_trip`` tells whether they give the text. Rows are encoded one
    by one. A column of that name is replaced.
    """
    held = df.sparkSession.sparkContext.broadcast(vars(model))

    @by_arrow(_ENCODED)
    def found(texts: pa.Array) -> pa.Array:
        segmenter = _segmenter(Model(**held.value))
        ids, scores, paths, counts, whole = [], [], [], [], []
        rows = [None if t is None else t.decode() for t in raw(texts)]
        for t, (mine, ranked) in zip(rows, segmenter.encode_all(rows, best), strict=True):
            ids.append(mine)
            counts.append(len(ranked))
            scores += [s for s, _ in ranked]
            paths += [p for _, p in ranked]
            whole.append(segmenter.decode(mine.tolist()) == (t or ""))
        null = texts.is_null().to_pylist()
        listed = pa.StructArray.from_arrays([pa.array(scores, pa.float64()), _lists(map(len, paths), pa.array(_flat(paths), pa.int32()))], fields=list(_BEST))
        columns = [_lists(map(len, ids), pa.array(_flat(ids), pa.int32()), null), _lists(counts, listed, null), pa.array(whole, pa.bool_())]
        return pa.StructArray.from_arrays(columns, fields=list(_ENCODED))

    return small_batches(df).withColumn(into, found(F.col(f"`{text}`").cast("string")))


def decoded(df: DataFrame, model: Model, ids: str = "pieces.ids", into: str = "decoded") -> DataFrame:
    """All columns of ``df`` and ``into``, the text of the ids; null for null, the empty text for no ids.

    Rows are decoded one by one, so repeated rows get equal results. A column named ``into`` is replaced; an empty table
    gives no rows.
    """
    held = df.sparkSession.sparkContext.broadcast(vars(model))

    @by_arrow(pa.string())
    def found(lists: pa.Array) -> pa.Array:
        segmenter = _segmenter(Model(**held.value))
        # One row's ids at a time: as Python numbers those of a whole batch take hundreds of MB.
        ids, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        rows = zip(ends[:-1].tolist(), ends[1:].tolist(), lists.is_null().to_pylist(), strict=True)
        return pa.array([None if null else segmenter.decode(ids[a:b].tolist()) for a, b, null in rows], pa.string())

    return small_batches(df).withColumn(into, found(F.col(ids)))


def public_model() -> str:
    """The path of the public model that the queries use unless told another."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
