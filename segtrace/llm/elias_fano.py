"""Elias-Fano coding of monotone sequences in numpy, and the files that hold the arrays.

A sequence of n values below a universe u keeps the low l = log2(u / n) bits of each value packed, and the
high parts as a unary bit vector of about 2n bits; a rank sample per word finds the k-th one or zero.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from .common import file_system

_U = np.uint64
_ONES = _U(0x0101010101010101)
#: Queries are answered so many at a time, which keeps them in the processor's cache.
_CHUNK = 1 << 14
#: Position of the r-th set bit of each byte, made by rule.
_SELECT = np.array([([k for k in range(8) if b >> k & 1] + [0] * 8)[:8] for b in range(256)], np.uint8)


def _select_in_word(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Position of the r-th (from 0) set bit of each word."""
    b = x - ((x >> _U(1)) & _U(0x5555555555555555))
    b = (b & _U(0x3333333333333333)) + ((b >> _U(2)) & _U(0x3333333333333333))
    upto = (((b + (b >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _ONES).astype(_U)  # set bits up to each byte
    r, byte = r.astype(_U), np.zeros(len(x), _U)
    for k in range(7):
        byte += ((upto >> _U(8 * k)) & _U(255)) <= r
    before = np.where(byte > 0, (upto >> (_U(8) * (np.maximum(byte, _U(1)) - _U(1)))) & _U(255), _U(0))
    return (_U(8) * byte).astype(np.int64) + _SELECT[(x >> (_U(8) * byte)) & _U(255), (r - before)]


class EliasFano:
    """words: unary high parts; low: packed low bits; zeros: zeros before each word."""

    def __init__(self, n: int, bits: int, words: np.ndarray, low: np.ndarray, zeros: np.ndarray):
        self.n, self.bits, self.words, self.low, self.zeros = n, bits, words, low, zeros
        self._ones: np.ndarray | None = None

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        """values: rising, not above universe."""
        values, n = np.asarray(values, _U), len(values)
        bits = max(0, (int(universe) // max(n, 1)).bit_length() - 1)
        high = (values >> _U(bits)).astype(np.int64)
        size = n + (int(universe) >> bits) + 2
        flags = np.zeros(-(-size // 64) * 64, np.uint8)
        flags[high + np.arange(n)] = 1
        words = np.packbits(flags, bitorder="little").view(_U)
        low = np.zeros(-(-n * bits // 64) + 2, _U)
        if bits and n:
            part, at = values & _U((1 << bits) - 1), np.arange(n, dtype=np.int64) * bits
            word, shift = at >> 6, (at & 63).astype(_U)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low[word[first]] = np.bitwise_or.reduceat(part << shift, first)
            over = np.flatnonzero(shift + _U(bits) > _U(64))
            low[word[over] + 1] |= part[over] >> (_U(64) - shift[over])
        zeros = np.append(0, np.cumsum(64 - np.bitwise_count(words).astype(np.int64)))[:-1]
        return cls(n, bits, words, low, zeros.astype(np.int64 if size >> 31 else np.uint32))

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.head": np.array([self.n, self.bits], np.int64), f"{name}.words": self.words, f"{name}.low": self.low, f"{name}.zeros": self.zeros}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, bits = arrays[f"{name}.head"].tolist()
        return cls(n, bits, arrays[f"{name}.words"], arrays[f"{name}.low"], arrays[f"{name}.zeros"])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), _U)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(_U)
        two = (self.low[word] >> shift) | ((self.low[word + 1] << _U(1)) << (_U(63) - shift))
        return two & _U((1 << self.bits) - 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero."""
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), side="right") - 1
        return (word << 6) + _select_in_word(~self.words[word], k - self.zeros[word].astype(np.int64))

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        if self._ones is None:
            self._ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(self._ones, i, side="right") - 1
        at = (word << 6) + _select_in_word(self.words[word], i - self._ones[word])
        return ((at - i).astype(_U) << _U(self.bits)) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each x in the (strictly rising) sequence or -1: its successor is looked for among equal high parts."""
        if len(x) > _CHUNK:
            return np.concatenate([self.find(x[k : k + _CHUNK]) for k in range(0, len(x), _CHUNK)])
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        high = (x >> _U(self.bits)).astype(np.int64)
        inside = np.flatnonzero(high < len(self.words) * 64 - self.n)
        high, want = high[inside], x[inside] & _U((1 << self.bits) - 1)
        lo = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) + 1 - high, 0)
        end = np.minimum(self._zero(high) - high, self.n)
        hi, open_ = end.copy(), np.flatnonzero(lo < end)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        some = np.flatnonzero(lo < end)
        good = some[self._low(lo[some]) == want[some]]
        out[inside[good]] = lo[good]
        return out


def write_arrays(uri: str, arrays: dict[str, np.ndarray], attempt: int = 0) -> None:
    """One file with a header and aligned arrays; written aside and renamed, so a task may run again."""
    head, at = {}, 0
    for name, x in arrays.items():
        head[name] = [x.dtype.str, len(x), at]
        at += -(-x.nbytes // 64) * 64
    text = json.dumps(head).encode()
    text = len(text).to_bytes(8, "little") + text
    text += b" " * (-len(text) % 64)
    store, path = file_system(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(f"{path}.{attempt}.tmp", compression=None) as out:
        out.write(text)
        for x in arrays.values():
            out.write(memoryview(np.ascontiguousarray(x)).cast("B") if x.nbytes else b"")
            out.write(b"\0" * (-x.nbytes % 64))
    store.move(f"{path}.{attempt}.tmp", path)


class Arrays:
    """The arrays of one file by name: slices of a memory map where the folder is mounted, else each read by its range
    when it is first asked for. size: the bytes of the file."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self._store, self._path = file_system(uri)
        self._data = pa.memory_map(self._path).read_buffer() if isinstance(self._store, fs.LocalFileSystem) else None
        n = int.from_bytes(self._bytes(0, 8), "little")
        self._head, self._start = json.loads(bytes(self._bytes(8, n))), -(-(8 + n) // 64) * 64
        self.size = self._start + sum(-(-np.dtype(kind).itemsize * size // 64) * 64 for kind, size, _ in self._head.values())
        self._known: dict[str, np.ndarray] = {}
        self._coded: dict[str, EliasFano] = {}

    def _bytes(self, at: int, n: int):
        if self._data is not None:
            return memoryview(self._data)[at : at + n]
        with self._store.open_input_file(self._path) as source:
            return source.read_at(n, at)

    def __iter__(self):
        return iter(self._head)

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._known:
            kind, size, at = self._head[name]
            self._known[name] = np.frombuffer(self._bytes(self._start + at, np.dtype(kind).itemsize * size), np.dtype(kind), size)
        return self._known[name]

    def coded(self, name: str) -> EliasFano:
        if name not in self._coded:
            self._coded[name] = EliasFano.of(self, name)
        return self._coded[name]


def read_arrays(uri: str) -> Arrays:
    return Arrays(uri)
