"""Secret scans: keyword automaton, anchored patterns where a keyword stands, checksums where a secret holds one."""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_arrow, raw, small_batches

#: Kinds in the order in which spans of one start are listed. The first three are the base kinds.
KINDS = ("assign", "access", "hex", "forge", "wallet")
BASE = 3
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: Patterns are matched at a place where one of their keywords stands, on UTF-8 bytes: (?i) is ASCII only there.
ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
FORGE = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
WALLET = re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "forge": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    "wallet": ("xprv",),
}

BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

#: Digits and a-f become 0, all else a space, so that a run of hex digits is found by a plain search.
_HEX = bytes(48 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = re.compile(rb"0+")


def forge_checksum(match: re.Match) -> bool:
    """The last six base-62 digits are the CRC-32 of the 30 before them."""
    value = 0
    for digit in match[2]:
        value = value * 62 + BASE62.index(digit)
    return value == zlib.crc32(match[1])


def wallet_checksum(match: re.Match) -> bool:
    """Base-58 text of 78 bytes and the first four of their double SHA-256."""
    value = 0
    for digit in match[0]:
        value = value * 58 + BASE58.index(digit)
    if value >> (82 * 8):
        return False
    data = value.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(data[:78]).digest()).digest()[:4] == data[78:]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


#: By kind: the pattern, and whether a match is kept. A match that is not kept still uses up its characters.
CHECKS = {
    "assign": (ASSIGN, lambda m: len(m[1]) >= MIN_VALUE),
    "access": (ACCESS, lambda m: len(m[0]) >= MIN_ACCESS),
    "forge": (FORGE, forge_checksum),
    "wallet": (WALLET, wallet_checksum),
}


def scan(text: bytes, keywords: ahocorasick.Automaton | None = None) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) in bytes, by start and kind; leftmost and not overlapping within a kind."""
    found, free = [], dict.fromkeys(CHECKS, 0)
    # Lower case of ASCII only, and a character for each byte: places are those of the bytes.
    lowered = text.lower().decode("latin-1")
    # Keywords are reported by their end; their starts are in order within a kind only after sorting.
    hits = sorted((end - size + 1, kind) for end, (kind, size) in (keywords or automaton()).iter(lowered))
    for start, kind in hits:
        if start < free[kind]:
            continue
        pattern, holds = CHECKS[kind]
        if match := pattern.match(text, start):
            free[kind] = match.end()
            if holds(match):
                found.append((start, KINDS.index(kind), match.end()))
    digits = text.translate(_HEX)
    at, least = 0, b"0" * MIN_HEX
    while (at := digits.find(least, at)) >= 0:
        end = _HEX_RUN.match(digits, at).end()
        found.append((at, KINDS.index("hex"), end))
        at = end
    return sorted(found)


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans with places counted in code points."""
    if text.isascii():
        return spans
    places, before, at = {}, 0, 0
    for place in sorted({p for s, _, e in spans for p in (s, e)}):
        before, at = before + len(text[at:place].decode()), place
        places[place] = before
    return [(places[s], kind, places[e]) for s, kind, e in spans]


def redact(text: bytes, spans: list[tuple[int, int, int]], mark: bytes) -> bytes:
    """The text with every stretch covered by spans replaced by ``mark``."""
    out, done, last = [], 0, -1
    for start, _, end in spans:
        if start > last:  # else it goes on from the stretch before
            out += [text[done:start], mark]
        last = max(last, end)
        done = last
    return b"".join([*out, text[done:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


@by_arrow(pa.list_(_SPAN))
def _spans(texts: pa.Array) -> pa.Array:
    rows, keywords = [], automaton()
    for text in raw(texts):
        found = scan(text or b"", keywords)
        if found:
            found = in_code_points(text, found)
        rows.append([{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in found])
    return pa.array(rows, pa.list_(_SPAN))


def find(df: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """All columns of ``df`` and ``into``: the spans in each whole text, in code points, end exclusive.

    Kinds: assign, access and hex as patterns say; forge (tokens of code forges and package registries) and
    wallet (extended private keys) only where the checksum inside them is right. Spans of one kind do not
    overlap; those of several kinds may. A null or empty text has an empty list. Rows are scanned one by one,
    so repeated rows get equal results. A column of that name is replaced.
    """
    return small_batches(df).withColumn(into, _spans(F.col(f"`{text}`").cast("string")))


def redacted(df: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``mark``.

    Null texts stay null, empty ones empty; each row is treated by itself, so repeated rows stay equal. Columns keep their
    names and order; an empty table gives no rows.
    """
    replacement = mark.encode()

    @by_arrow(pa.string())
    def clean(texts: pa.Array) -> pa.Array:
        keywords = automaton()
        rows = [t if t is None or not (found := scan(t, keywords)) else redact(t, found, replacement) for t in raw(texts)]
        return pa.array(rows, pa.binary()).cast(pa.string())

    return small_batches(df).withColumn(text, clean(F.col(f"`{text}`").cast("string")))
