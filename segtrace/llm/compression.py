"""Quality rules by compression bands.

A text that compresses far better than prose repeats itself, one that hardly compresses is noise.
Each text is compressed whole and in fixed chunks with zstandard; the ratio (compressed bytes over
bytes) must lie within a band that depends on the length, because short inputs compress worse.

Everything is computed for one row at a time, so rows need no shuffle, skew can't arise and a lost
task is simply run again. Memory is bounded by one Arrow batch.

Defined cases: a null or empty text has zero counts and is rejected by the base rule (fewer than 20
words); null ids are kept; repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, own

SYMBOLS = b"#*$%&|<>"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

SCHEMA = (
    "id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_bytes long, ratio double, n_chunks long, n_chunks_low long, n_chunks_high long, in_band boolean"
)


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio by length: `whole` has (bytes from, lowest, highest) in rising order.

    chunk: bytes of a chunk; a last piece under half a chunk joins the one before. A document goes when
    more than max_bad_chunks of its chunks lie outside chunk_band.
    """

    level: int = 3
    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.0),
        (128, 0.30, 1.00),
        (256, 0.25, 0.90),
        (512, 0.20, 0.82),
        (2048, 0.16, 0.75),
        (8192, 0.13, 0.72),
        (65536, 0.10, 0.70),
    )
    chunk: int = 4096
    chunk_band: tuple[float, float] = (0.16, 0.78)
    max_bad_chunks: float = 0.3


def repeated_words(words: list[bytes], width: int) -> int:
    """Words that lie in some window of `width` words which occurs at least twice, all occurrences included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    ids = (ids + np.uint64(1)) * _ODD
    ids = (ids ^ (ids >> np.uint64(29))) * _MIX
    ids ^= ids >> np.uint64(32)
    window = np.zeros(n, np.uint64)
    for k in range(width):
        window = window * _ODD + ids[k : k + n]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    edge[starts] += 1
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(raw: bytes, width: int = 8) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text in UTF-8."""
    words = raw.split()
    solid = raw.translate(None, WHITE)
    chars = len(solid.decode("utf-8", "replace")) if not solid.isascii() else len(solid)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words, width)


def ratios(raw: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, int, int, int]:
    """Ratio of the whole text, number of chunks, and chunks below and above the chunk band."""
    if not raw:
        return 0.0, 0, 0, 0
    whole = len(packer.compress(raw)) / len(raw)
    if len(raw) < bands.chunk:
        return whole, 0, 0, 0
    n = max(1, (len(raw) + bands.chunk // 2) // bands.chunk)
    low = high = 0
    for k in range(n):
        piece = raw[k * bands.chunk : (k + 1) * bands.chunk if k < n - 1 else None]
        r = len(packer.compress(piece)) / len(piece)
        low += r < bands.chunk_band[0]
        high += r > bands.chunk_band[1]
    return whole, n, low, high


def in_band(n_bytes: int, ratio: float, n_chunks: int, low: int, high: int, bands: Bands) -> bool:
    """The method's verdict: the whole text within the band of its length, and few chunks outside theirs."""
    _, least, most = next(b for b in reversed(bands.whole) if n_bytes >= b[0])
    return least <= ratio <= most and low + high <= n_chunks * bands.max_bad_chunks


def measure(raw: bytes, packer: zstandard.ZstdCompressor, bands: Bands, width: int) -> tuple:
    """All of SCHEMA after the id, for one text."""
    packed = ratios(raw, packer, bands)
    return (*text_counts(raw, width), len(raw), *packed, in_band(len(raw), *packed, bands))


def compression_stats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands(), width: int = 8) -> DataFrame:
    """Counts, compression ratios and in_band of every text: one row for each row of df."""
    rows = own(df, id=id_col, text=text_col)
    schema = SCHEMA.format(id=rows.schema["id"].dataType.simpleString())
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [{"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[x.split()[1]] for x in SCHEMA.split(", ")[1:]]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            out = [measure(raw or b"", packer, bands, width) for raw in batch.column(1).cast(pa.binary()).to_pylist()]
            cols = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], names=names)

    return rows.mapInArrow(scan, schema)


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands(), min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """compression_stats plus base_failed and kept, under the id column's own name."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    stats = compression_stats(df, id_col, text_col, bands)
    return stats.select(F.col("id").alias(id_col), *stats.columns[1:], failed.alias("base_failed"), (~failed & F.col("in_band")).alias("kept"))


def keep_quality(df: DataFrame, text_col: str = "text", bands: Bands = Bands(), min_words: int = 20, max_repeat_percent: int = 30, width: int = 8) -> DataFrame:
    """The rows of df that quality_rules keeps, in one pass without a shuffle."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            good = []
            for raw in batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist():
                n, *_, repeats, size, ratio, chunks, low, high, inside = measure(raw or b"", packer, bands, width)
                good.append(inside and n >= min_words and 100 * repeats <= max_repeat_percent * n)
            yield batch.filter(pa.array(good, pa.bool_()))

    return df.mapInArrow(keep, df.schema)
