"""Quality rules: counts of words, lines and repeats, and bands of the compression ratio."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, by_arrow, free_name, raw, small_batches, structs

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
LEVEL = 3
CHUNK = 4096
SYMBOLS = b"#*$%&|<>"

#: Limits of compressed bytes / bytes by length: from this many bytes on, a text below ``low`` is taken for
#: repetition and one above ``high`` for noise. Read off prose in several languages that passes the base rules: ``high``
#: is 5 to 11 % above its greatest ratio of that length, which was 0.97, 0.71, 0.60, 0.55, 0.49, 0.46, 0.44 and 0.43 from 128
#: bytes on, and below that of random letters, base64 (from 512 bytes on) and hexadecimal digits (from 8 KiB on); ``low`` is
#: three fifths of the least, 0.41 to 0.34 from 1 KiB on, as lists and tables repeat more than prose. Short texts have
#: little to compress, so their band is wide.
BANDS = (
    # bytes, low, high
    (0, 0.00, 9.00),
    (128, 0.12, 1.05),
    (512, 0.15, 0.76),
    (1024, 0.25, 0.65),
    (2048, 0.24, 0.58),
    (4096, 0.23, 0.54),
    (8192, 0.22, 0.50),
    (16384, 0.21, 0.48),
    (32768, 0.20, 0.47),
)
#: A text is rejected when more than this share of its chunks of ``CHUNK`` bytes lies outside the band of their length. The
#: rest at its end counts as one from LEAST_CHUNK bytes on; a text of one chunk is judged as a whole only.
MAX_BAD_CHUNKS, LEAST_CHUNK = 0.5, 512

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "ratio", "n_chunks", "n_low_chunks", "n_high_chunks")
_MEASURE = pa.struct([(name, pa.float64() if name == "ratio" else pa.int64()) for name in FIELDS])


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside any run of ``window`` words that occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    # The number of a word is where it first stands.
    ids = np.fromiter(map(seen.setdefault, words, range(len(words))), np.int64, len(words))
    again = np.bincount(ids, minlength=len(ids))[ids] > 1
    run = np.cumsum(np.concatenate(([0], again)))
    starts = np.flatnonzero(run[window:] - run[:-window] == window)
    if len(starts) < 2:
        return 0
    # Equal windows get equal numbers: number the first words, then pair that with each next word's number.
    code = ids[starts]
    for step in range(1, window):
        code = np.unique(code * len(ids) + ids[starts + step], return_inverse=True)[1]
    twice = starts[np.bincount(code)[code] > 1]
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def band(size: int, bands=BANDS) -> tuple[float, float]:
    return bands[bisect_right([b[0] for b in bands], size) - 1][1:]


def compressor(level: int = LEVEL):
    return zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False).compress


def measure(text: bytes | None, squeeze=None, chunk: int = CHUNK) -> tuple:
    """The values of ``FIELDS`` for one text."""
    squeeze = squeeze or compressor()
    text = text or b""
    words = text.split()
    letters = text.translate(None, SPACE)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    ratio = len(squeeze(text)) / len(text) if text else None
    pieces = [text[i : i + chunk] for i in range(0, len(text), chunk)] if len(text) > chunk else []
    pieces = [p for p in pieces if len(p) >= min(LEAST_CHUNK, chunk)]
    bands, ratios = [band(len(p)) for p in pieces], [len(squeeze(p)) / len(p) for p in pieces]
    return (
        len(words), len(letters.decode()), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
        repeat_words(words), len(text), ratio, len(pieces), sum(r < low for r, (low, _) in zip(ratios, bands, strict=True)),
        sum(r > high for r, (_, high) in zip(ratios, bands, strict=True)),
    )


@by_arrow(_MEASURE)
def _measured(texts: pa.Array) -> pa.Array:
    squeeze = compressor()
    return structs(_MEASURE, [measure(t, squeeze) for t in raw(texts)])


def _inside(size: Column, ratio: Column, bands=BANDS) -> Column:
    """Whether a ratio lies in the band of its length."""
    out = F.lit(True)
    for least, low, high in bands:
        out = F.when(size >= least, ratio.between(low, high)).otherwise(out)
    return out


def rules(df: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """All columns of ``df`` and the struct ``into`` of ``FIELDS`` and base_failed, in_band, kept.

    A text fails the base rules with fewer than 20 words or with over 30 % of its words in repeated 8-word
    windows. It is kept if it passes them, its compression ratio lies in the band of its length, and no more
    than half of its 4 KiB chunks, the rest at its end among them, lie outside theirs. A null text counts as an empty one: no words, not
    kept. Rows are judged one by one, so repeated rows get equal results. A column of that name is replaced.
    """
    row = free_name(df, "_measured")
    measured = small_batches(df).withColumn(row, _measured(F.col(f"`{text}`").cast("string")))
    of = lambda name: F.col(f"{row}.{name}")
    failed = (of("n_words") < MIN_WORDS) | (100 * of("n_repeat_words") > MAX_REPEAT_PERCENT * of("n_words"))
    chunks_fit = of("n_low_chunks") + of("n_high_chunks") <= MAX_BAD_CHUNKS * of("n_chunks")
    fits = F.coalesce(_inside(of("n_bytes"), of("ratio")), F.lit(False)) & chunks_fit
    verdict = F.struct(*[of(n).alias(n) for n in FIELDS], failed.alias("base_failed"), fits.alias("in_band"), (~failed & fits).alias("kept"))
    return measured.withColumn(into, verdict).drop(row)
