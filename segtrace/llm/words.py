"""Words of Arrow batches as numbers, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs stay equal, others differ all over."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))  # a random-looking number for each byte
_BASE = 0xD6E8FEB86659FD93
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _upto(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse (modulo 2^64), at least n of each."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, _U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def string_hashes(strings: pa.StringArray) -> np.ndarray:
    """64-bit hashes of all strings at once: sums of byte numbers times powers, taken from one running sum."""
    if not len(strings):
        return np.zeros(0, _U)
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at -= at[0]
    # A quarter of a megabyte at a time (or one longer string): the running sums and powers stay small.
    group = at[:-1] >> 18
    cuts = [*np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist(), len(strings)]
    return np.concatenate([_hashes(text[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in zip(cuts, cuts[1:], strict=False)])


def _hashes(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    power, inverse = _upto(len(text) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(text) + 1, _U)
        np.cumsum(_BYTES[text] * power[: len(text)], out=sums[1:])
        return mix((sums[at[1:]] - sums[at[:-1]]) * inverse[at[:-1]] + np.diff(at).astype(_U) * _U(0x94D049BB133111EB))


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased (A-Z) texts: words per text, a code for each word, and a 64-bit hash for each code."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    flat = words.flatten()
    filled = pc.not_equal(flat, "")  # white space at the edges of a text leaves empty pieces
    lengths = np.asarray(words.value_lengths()).astype(np.int64)
    seen = np.append(0, np.cumsum(np.asarray(filled).astype(np.int64)))
    ends = np.cumsum(lengths)
    counts = seen[ends] - seen[ends - lengths] if len(lengths) else np.zeros(0, np.int64)
    coded = flat.filter(filled).dictionary_encode()
    return counts, np.asarray(coded.indices).astype(np.int64), string_hashes(coded.dictionary)


def slices(batches: Iterator[pa.RecordBatch], text: int, size: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that column `text` has about `size` bytes in each (at least one row)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths) // size
        cuts = [*np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist(), len(batch)] if len(batch) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
