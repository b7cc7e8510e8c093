"""Conversation structure repair: the cheapest edits that make roles alternate, by one ordered pass over each conversation."""

from __future__ import annotations

import hashlib
import tempfile
from array import array

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_SPACE = " \t\n\v\f\r"
#: Characters of a text by which rows of one turn and role are ordered before the marks of first occurrences are laid in.
HEAD = 16
#: Bytes of back pointers (two a row) that a conversation holds in memory; what is beyond that is spilled.
SPILL_BYTES = 4 << 20

# Where a repaired conversation stands: at its start, after a system row, a user row or an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLE = {_USER: b"user", _ASSISTANT: b"assistant"}
_ENDS = (_START, _ASSISTANT)
_FAR = 1 << 60


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, present): rows damaged by crc32("conv:turn") modulo 20.

    0 drops a row (it comes out with ``present`` false), 1 empties its text, 2 takes . ! and ? from it, 3 repeats it,
    4 makes its role user. Nulls of ``role`` and ``text``, and in the text that is checked, count as one space.
    """
    blank = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")), F.lit(20))
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), kind.alias("kind")
    )
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"), F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _closed(costs: tuple) -> list:
    """(cost, rank, inserts, from) of every state, rows inserted after the last one included."""
    best = [(cost, rank, "", state) for state, (cost, rank) in enumerate(costs)]
    for _ in range(3):
        for state, (cost, rank, inserts, origin) in enumerate(list(best)):
            best[_NEXT[state]] = min(best[_NEXT[state]], (cost + INSERT, rank, inserts + "I", origin))
    return best


class Paths:
    """The cheapest edits so far that end in each state, as an automaton over kinds of rows.

    A configuration gives, for each state, the cost above the least one and the rank of its edits in ASCII order.
    Edits of equal cost for the same rows are never a beginning of one another, so ranks of earlier rows decide
    ties of later ones. From any state two inserted rows and one deletion do what any other state can do, so a state
    that costs more than that above the least one is on no cheapest path and leaves. So few configurations exist,
    and what a kind of row does to one is worked out once. A step is (number, added cost, [(state, state before,
    inserts, edit)], next configuration).
    """

    first = ((0, 0),) + ((_FAR, 0),) * 3

    def __init__(self):
        self.known: dict[tuple, tuple] = {}
        self.steps: list[tuple] = []

    def step(self, costs: tuple, initial: str, goes: bool, cut: bool) -> tuple:
        case = (costs, initial if initial in "sua" else "", goes, cut)
        found = self.known.get(case)
        if found is None:
            found = self.known[case] = self._step(*case)
        return found

    def _step(self, costs: tuple, initial: str, goes: bool, cut: bool) -> tuple:
        options: dict[int, list] = {}
        extra = TRUNCATED if cut else 0
        for state, (cost, rank, inserts, origin) in enumerate(_closed(costs)):
            if cost >= _FAR:
                continue
            options.setdefault(state, []).append((cost + DELETE, rank, inserts + "D", origin))
            if goes:
                continue
            after = _NEXT[state]
            if initial == "s" and state == _START:
                options.setdefault(_SYSTEM, []).append((cost + KEEP + extra, rank, inserts + "K", origin))
            if initial == ("a" if after == _ASSISTANT else "u"):
                options.setdefault(after, []).append((cost + KEEP + extra, rank, inserts + "K", origin))
            options.setdefault(after, []).append((cost + REROLE + extra, rank, inserts + "R", origin))
        best = {state: min(found) for state, found in options.items()}
        least = min(cost for cost, *_ in best.values())
        best = {state: found for state, found in best.items() if found[0] <= least + 2 * INSERT + DELETE}
        ranked = sorted(best, key=lambda s: best[s][1:3])
        costs = tuple((best[s][0] - least, ranked.index(s)) if s in best else (_FAR, 0) for s in range(4))
        moves = [(s, origin, edits[:-1], edits[-1]) for s, (_, _, edits, origin) in best.items()]
        found = (len(self.steps), least, moves, costs)
        self.steps.append(found)
        return found

    @staticmethod
    def end(costs: tuple) -> tuple:
        """(added cost, last state with a row, inserts) of the cheapest end."""
        cost, _, inserts, origin = min(best for state, best in enumerate(_closed(costs)) if state in _ENDS)
        return cost, origin, inserts


def _inserted(state: int, inserts: str) -> tuple[bytes, int]:
    """What the inserted rows add to a repaired conversation that stands at ``state``, and where it stands then."""
    out = b""
    for _ in inserts:
        out += (b"\n" if state else b"") + _ROLE[_NEXT[state]] + b":"
        state = _NEXT[state]
    return out, state


class Conversation:
    """One conversation while its rows come in, in order.

    A running hash of the cheapest repaired rows is held for each state, so no text is held; back pointers, the
    number of the step of each row, are spilled to a file of the task beyond SPILL_BYTES.
    """

    def __init__(self, name, paths: Paths):
        self.name, self.paths, self.costs = name, paths, Paths.first
        self.hashes = {_START: hashlib.sha256()}
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial = self.least = self.greatest = None
        self.turns = 0
        self.fresh: set[str] = set()
        self.held, self.back = array("H"), tempfile.SpooledTemporaryFile(max_size=SPILL_BYTES)  # noqa: SIM115

    def add(self, turn: int | None, role: str, text: str, content: str) -> None:
        self.rows += 1
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.greatest
            self.greatest = turn
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        seen = content not in self.fresh
        self.fresh.discard(content)
        shown = text.rstrip(_SPACE)
        blank = not shown
        duplicate = not blank and seen
        cut = not blank and not duplicate and shown[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        number, cost, moves, self.costs = self.paths.step(self.costs, initial, blank or duplicate, cut)
        self.cost += cost
        self.held.append(number)
        if len(self.held) == 1 << 15:
            self._flush()
        body = b":" + text.encode("utf-8", "surrogatepass")
        hashes = {}
        for state, origin, inserts, edit in moves:
            lead, at = _inserted(origin, inserts)
            if edit != "D":
                lead += (b"\n" if at else b"") + (role.encode("utf-8", "surrogatepass") if edit == "K" else _ROLE[state]) + body
            hashes[state] = self.hashes[origin]
            if lead:
                hashes[state] = hashes[state].copy()
                hashes[state].update(lead)
        self.hashes = hashes

    def _flush(self) -> None:
        self.back.write(self.held.tobytes())
        self.held = array("H")

    def _audit(self, state: int, inserts: str) -> str:
        """The edits in order, read from the back pointers from the last row to the first."""
        edits = bytearray(inserts.encode()[::-1])
        self._flush()
        at = self.back.tell()
        while at:
            size = min(at, 1 << 16)
            at -= size
            self.back.seek(at)
            block = array("H", self.back.read(size))
            for number in reversed(block):
                _, origin, before, edit = next(m for m in self.paths.steps[number][2] if m[0] == state)
                edits += edit.encode() + before.encode()[::-1]
                state = origin
        edits.reverse()
        return edits.decode()

    def result(self) -> tuple:
        added, state, inserts = Paths.end(self.costs)
        done = self.hashes[state].copy()
        done.update(_inserted(state, inserts)[0])
        gaps = 0 if self.least is None else self.greatest - self.least + 1 - self.turns
        audit = self._audit(state, inserts)
        self.back.close()
        return (
            self.name, min(gaps, (1 << 63) - 1), self.blank, self.duplicate, self.truncated, self.illegal, self.cost + added, audit, done.hexdigest(),
        )


_COLUMNS = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TYPES = "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _summed(batches):
    paths, now = Paths(), None
    for batch in batches:
        out = []
        for conv, kind, turn, role, text, content in zip(*(batch[c] for c in ("conv", "kind", "turn", "role", "text", "content")), strict=True):
            if now is None or now.name != conv:
                if now is not None:
                    out.append(now.result())
                now = Conversation(conv, paths)
            if kind == 1:
                now.fresh.add(content)
            elif kind == 2:
                now.add(None if turn is None else int(turn), role, text, content)
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS)
    if now is not None:
        yield pd.DataFrame([now.result()], columns=_COLUMNS)


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation in one task each, in order of turn (nulls first), role and text."""
    return rows.repartition("conv").sortWithinPartitions(
        "conv", F.col("at").asc_nulls_first(), "role", "head", "kind", "text"
    )


def _rows(df: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    rows = df.select(conv.cast("string").alias("conv"), turn.cast("decimal(38, 0)").alias("at"), blank(role).alias("role"), blank(text).alias("text"))
    return rows.withColumn("head", F.substring("text", 1, HEAD))


def audited(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """One row a conversation: its faults, the cheapest edits that repair it, and the hash of the repaired rows.

    Columns: ``conv``, ``gaps`` (turns missing between the least and the greatest; beyond a long: the greatest long),
    ``blank``, ``duplicate``, ``truncated`` (rows by their first fault), ``illegal`` (neighbours whose roles do not
    follow one another), ``cost``, ``audit`` (K keep, R change role, D delete, I insert) and ``repaired_sha256`` of
    the rows ``role:text`` with line feeds between them.

    Rows are taken by turn, null turns first; rows of one turn by role and text, so the result does not hang on how
    the table is stored. Null roles and texts count as one space, empty texts are blank. A null conversation is one.
    Rows where the column ``present`` is false only name their conversation, which without other rows has zeros and an
    empty audit. Repeated rows are duplicates. Other columns are not read; an empty table gives no rows.

    All rows of a conversation pass through one task in order, as their hash must. The task holds some numbers and four
    running hashes, no texts; marks of the first occurrence of each content are worked out before, where a content
    of very many rows is counted in every task, and sorted in.
    """
    here = F.coalesce(F.col(f"`{present}`"), F.lit(False)) if present else F.lit(True)
    columns = [F.col(f"`{c}`") for c in (conv, turn, role, text)]
    content = F.substring(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256), 1, 32)
    rows = _rows(df.where(here), *columns).withColumns({"content": content, "kind": F.lit(2)})
    none = F.lit(None).cast("string")
    first = rows.groupBy("conv", "content").agg(F.min(F.struct("at", "role", "head")).alias("first"))
    first = first.select("conv", "first.at", "first.role", none.alias("text"), "first.head", "content", F.lit(1).alias("kind"))
    # A conversation without any row left is named once by each task.
    names = df.select(columns[0].cast("string").alias("conv")).distinct() if present else None
    events = rows.unionByName(first)
    if names is not None:
        events = events.unionByName(
            names.select("conv", F.lit(None).cast("decimal(38, 0)").alias("at"), none.alias("role"), none.alias("text"), none.alias("head"), none.alias("content"), F.lit(0).alias("kind"))
        )
    found = _ordered(events).select("conv", "kind", F.col("at").cast("string").alias("turn"), "role", "text", "content").mapInPandas(_summed, _TYPES)
    return found.withColumn("conv", F.col("conv").cast(dict(df.dtypes)[conv]))


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """(conv, place, edit, role, text) of the repaired conversations: place counts from 0, inserted rows have empty texts.

    Faults, ties, nulls and empty tables as in :func:`audited`, whose edits are laid before the rows of each
    conversation in a second ordered pass.
    """
    here = F.coalesce(F.col(f"`{present}`"), F.lit(False)) if present else F.lit(True)
    edits = audited(df, conv, turn, role, text, present)
    rows = _rows(df.where(here), *[F.col(f"`{c}`") for c in (conv, turn, role, text)]).withColumn("kind", F.lit(2))
    none = F.lit(None).cast("string")
    plans = edits.select(
        F.col("conv").cast("string").alias("conv"), F.lit(None).cast("decimal(38, 0)").alias("at"), none.alias("role"), F.col("audit").alias("text"),
        none.alias("head"), F.lit(1).alias("kind"),
    )
    names = ["conv", "place", "edit", "role", "text"]

    def applied(batches):
        plan, at, place, state = "", 0, 0, _START
        for batch in batches:
            out = []
            for name, kind, role, text in zip(*(batch[c] for c in ("conv", "kind", "role", "text")), strict=True):
                if kind == 1:
                    plan, at, place, state = text, 0, 0, _START
                else:
                    edit = plan[at]
                    at += 1
                    if edit == "K":
                        state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
                    elif edit == "R":
                        state = _NEXT[state]
                        role = _ROLE[state].decode()
                    if edit != "D":
                        out.append((name, place, edit, role, text))
                        place += 1
                while plan[at : at + 1] == "I":
                    at += 1
                    state = _NEXT[state]
                    out.append((name, place, "I", _ROLE[state].decode(), ""))
                    place += 1
            if out:
                yield pd.DataFrame(out, columns=names)

    found = _ordered(rows.unionByName(plans)).select("conv", "kind", "role", "text").mapInPandas(applied, "conv string, place bigint, edit string, role string, text string")
    return found.withColumn("conv", F.col("conv").cast(dict(df.dtypes)[conv]))
