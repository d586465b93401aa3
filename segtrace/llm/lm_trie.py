"""LM scoring with an n-gram trie in Elias-Fano form.

Building. Words (64-bit hashes) are counted by Spark and get numbers by hash order. Each task turns its
texts into triples (word, next, next but one), sorted, counted and packed, one block for each shard; shards are
ranges of the first two words of equal expected mass, so frequent words spread over many. A shard holds all
successors of its word pairs. Levels are files in the shared folder, one per shard:

* level 1, by word: hash, count, and pointers to its successors (monotone, Elias-Fano);
* level 2, pairs: Elias-Fano keys, quantised probability, quantised back-off mass, pointers into level 3;
* level 3, triples: a last word is stored as its rank among the successors of the middle word (the context-
  relative number), made monotone by the context's pointer, in Elias-Fano; quantised probability.

Probabilities are interpolated Witten-Bell: with c of a context's C followers, T of them distinct,
P(w | context) = c / (C + T) + T / (C + T) * P(w | shorter context), down to (c(w) + 1) / (N + V + 1).
Levels 2 and 3 are quantised to 8 bits of log10, so the sum over words is 1 but for that rounding.

Memory. A task holds about `tokens_per_block` tokens while it gathers triples, one shard (about `tokens_per_shard`
tokens) while it builds a level, and at most `open_bytes` of opened files, the least recently used of which go first.
Where each level is cut is itself a file (`index`), so what is sent to a task doesn't grow with the corpus.

A look-up in a shard has a price of its own, however few keys it is for, so it is made for more at a time the more shards there are: for
the texts of up to 8 slices of some megabytes, and for the last words of up to 8 shards. Else texts x shards (and shards x shards) grow with the square of the corpus.

Scoring. Tasks map the files into memory and look up the distinct pairs and triples of a block of
texts at a time, in order; the tokens themselves are worked on a few megabytes at a time. Only pages that are touched are read, and all tasks of a machine share them; where the
shared folder isn't mounted, only the arrays that a lookup needs are read, each by its range.

Defined cases: a null or empty text has one token, the end; null ids are scored but not learnt from; repeated
rows count each; an empty training set gives every token 1 / (0 + 0 + 1); other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, own, saved, shared_dir
from .elias_fano import EliasFano, read_arrays, write_arrays
from .words import slices, word_codes

_U = np.uint64
END, BEGIN = 0x656E64, 0x626567696E  # in place of a word's hash


def _attempt() -> int:
    from pyspark import TaskContext

    return TaskContext.get().taskAttemptId()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pieces(owner: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, slice) for each run of a rising array."""
    if len(owner):
        cuts = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(owner))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            yield int(owner[a]), slice(a, b)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per text (words and one end), a code for each token, and the hash of each code (0 is the end)."""
    counts, codes, hashes = word_codes(column)
    size = counts + 1
    out = np.zeros(int(size.sum()), np.int64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(size) - 1] = False
    out[inner] = codes + 1
    return size, out, np.append(_U(END), hashes)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers, byte planes apart (the high ones are mostly 0), compressed."""
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(blob: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    raw, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), 0, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).reshape(-1).view(kind))
        at += n * width
    return out


@dataclass
class Trie:
    """Where the levels are and how they are cut; the arrays are mapped when first used, in each process.

    The index file holds the first number of each part of level 1 (word_base), of each shard in level 2 (pair_base) and
    in level 3 (space_base), and the pairs before each part of level 1 (follow_base), each with an end.
    """

    folder: str
    total: int  # N: training tokens
    texts: int  # training texts: tokens that begin one
    word_bits: int  # level 1 is cut by the first bits of the hash
    size: int  # numbers given to words, the end and the begin mark included
    shards: int
    index: str = ""
    step: float = 1 / 32  # of log10, between quantised values
    open_bytes: int = 128 << 20

    def __post_init__(self):
        self._open: OrderedDict[str, dict] = OrderedDict()
        self._held = 0

    def __getstate__(self):
        return self.__dict__ | {"_open": OrderedDict(), "_held": 0}

    def indexed(self, **bases: np.ndarray) -> Trie:
        """The same trie with an index file of these arrays beside those it has."""
        name = f"index{len(self.index)}"
        known = {k: self.part(self.index)[k] for k in self.part(self.index)} if self.index else {}
        write_arrays(f"{self.folder}/{name}.bin", known | {k: np.asarray(v, np.int64) for k, v in bases.items()})
        return replace(self, index=name)

    def base(self, name: str) -> np.ndarray:
        return self.part(self.index)[name]

    @property
    def together(self) -> int:
        """Slices of texts whose keys are looked up at once."""
        return min(8, max(1, self.shards // 40))

    @property
    def vocabulary(self) -> int:
        return max(0, self.size - 1)

    def part(self, level: str, k: int | None = None) -> dict:
        key = level if k is None else f"{level}-{k:06d}"
        if key in self._open:
            self._open.move_to_end(key)
            return self._open[key]
        arrays = self._open[key] = read_arrays(f"{self.folder}/{key}.bin")
        self._held += arrays.size
        while self._held > self.open_bytes and len(self._open) > 1:
            self._held -= self._open.popitem(last=False)[1].size
        return arrays

    def coded(self, level: str, k: int, name: str) -> EliasFano:
        return self.part(level, k).coded(name)

    def part_of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> _U(64 - self.word_bits)).astype(np.int64) if self.word_bits else np.zeros(len(hashes), np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of (any) hashes, -1 where unknown."""
        order = np.argsort(hashes)
        ranked, out = hashes[order], np.full(len(hashes), -1, np.int64)
        base = self.base("word_base")
        for k, cut in _pieces(self.part_of(ranked)):
            if base[k + 1] > base[k]:
                found = self.coded("words", k, "hash").find(ranked[cut] & _U((1 << (64 - self.word_bits)) - 1))
                out[order[cut]] = np.where(found < 0, -1, found + base[k])
        return out

    def _words(self, ids: np.ndarray, look: Callable[[int, np.ndarray], np.ndarray], kind: type) -> np.ndarray:
        order = np.argsort(ids)
        ranked, out = ids[order], np.zeros(len(ids), kind)
        base = self.base("word_base")
        for k, cut in _pieces(np.searchsorted(base, ranked, side="right") - 1):
            out[order[cut]] = look(k, ranked[cut] - base[k])
        return out

    def counts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of words, and those of all words before them."""
        return tuple(self._words(ids, lambda k, i, name=name: self.part("words", k)[name][i], np.int64) for name in ("count", "before"))

    def followers(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First pair of words in level 2, and one past their last."""
        base = self.base("follow_base")
        return tuple(self._words(ids, lambda k, i, step=step: self.coded("follow", k, "first").get(i + step).astype(np.int64) + base[k], np.int64) for step in (0, 1))

    def keys(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first.astype(_U) * _U(self.size) + second.astype(_U)

    def shard_of(self, c1: np.ndarray, b1: np.ndarray, c2: np.ndarray, b2: np.ndarray) -> np.ndarray:
        """Shard of pairs by counts c and counts before b of their words: rises with the key."""
        whole = float(self.total + self.texts)
        return np.minimum((b1 + c1 * (b2 / whole)) / whole * self.shards, self.shards - 1).astype(np.int64)

    def pairs(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Index in level 2 of rising keys, -1 where absent."""
        out, first = np.full(len(keys), -1, np.int64), self.base("pair_base")
        for k, cut in _pieces(shard):
            if first[k + 1] > first[k]:
                base = _U(self.part("pairs", k)["base"][0])
                near = keys[cut] >= base
                found = self.coded("pairs", k, "key").find(np.where(near, keys[cut] - base, 0))
                out[cut] = np.where(near & (found >= 0), found + first[k], -1)
        return out

    def quantise(self, p: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.clip(np.rint(-np.log10(p) / self.step), 0, 255).astype(np.uint8)

    def value(self, code: np.ndarray) -> np.ndarray:
        return (10.0 ** (-self.step * np.arange(256)))[code]


def _blocks(trie: Trie, flush: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts to (shard, n, block): their triples, counted, about `flush` tokens at a time."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = trie.numbers(np.array([BEGIN], _U))
        begin_count, begin_before = trie.counts(begin)
        kept: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            key, third, shard = (np.concatenate(x) for x in zip(*kept, strict=True))
            kept.clear()
            order = np.lexsort((third, key))
            key, third, shard = key[order], third[order], shard[order]
            del order
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (third[1:] != third[:-1])))
            many = np.diff(np.append(first, len(key))).astype(np.uint32)
            key, third, shard = key[first], third[first], shard[first]
            rows = [(k, c.stop - c.start, int(key[c][0]), _pack(np.diff(key[c], prepend=key[c][:1]), third[c], many[c])) for k, c in _pieces(shard)]
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array([_signed(x) for x in cols[2]], pa.int64()), pa.array(cols[3], pa.binary())], names=["shard", "n", "base", "block"])

        for batch in slices(batches, 0):
            size, codes, hashes = tokens(batch.column(0))
            ids = trie.numbers(hashes)
            count, before = trie.counts(ids)
            word, c, b = ids[codes], count[codes].astype(float), before[codes].astype(float)
            starts = np.cumsum(size) - size
            prev, pc_, pb = (np.roll(x, 1) for x in (word, c, b))
            prev[starts], pc_[starts], pb[starts] = begin[0], begin_count[0], begin_before[0]
            third = np.roll(word, -1)
            third[np.cumsum(size) - 1] = trie.size  # nothing follows the end
            kept.append((trie.keys(prev, word), third.astype(np.uint32), trie.shard_of(pc_, pb, c, b).astype(np.int32)))
            held += len(word)
            del word, c, b, prev, pc_, pb, third
            if held >= flush:
                yield out()
                held = 0
        if kept:
            yield out()

    return gather


def _pair_level(trie: Trie) -> Callable:
    """Blocks of one shard to its pairs (Elias-Fano) and its triples (packed for the next step), in a file.

    Rows out: (shard, n, part, word, follow): the number of pairs of the shard (word null), and pairs by first word.
    """

    def build(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        parts = [[np.cumsum(np.append(_U(r["base"] & (1 << 64) - 1), d[1:]), dtype=_U), t, c] for r in table.to_pylist() for d, t, c in [_unpack(r["block"], r["n"], _U, np.uint32, np.uint32)]]
        pair, third, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.lexsort((third, pair))
        pair, third, count = pair[order], third[order], count[order]
        first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (third[1:] != third[:-1])))
        count = np.add.reduceat(count.astype(np.int64), first)
        pair, third = pair[first], third[first]
        head = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        many = np.diff(np.append(head, len(pair))).astype(np.uint32)
        pair = pair[head]
        base = pair[0]
        coded = EliasFano.encode(pair - base, int(pair[-1] - base))
        triples = np.frombuffer(_pack(third, count.astype(np.uint32)), np.uint8)
        follow = np.frombuffer(_pack(many), np.uint8)
        arrays = coded.arrays("key") | {"base": np.array([base], _U), "n": np.array([len(third)], np.int64)}
        write_arrays(f"{trie.folder}/pairs-{shard:06d}.bin", arrays, _attempt())
        write_arrays(f"{trie.folder}/triples-{shard:06d}.bin", {"n": arrays["n"], "triples": triples, "follow": follow}, _attempt())
        word = (pair // _U(trie.size)).astype(np.int64)
        at = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        part = np.searchsorted(trie.base("word_base"), word[at], side="right") - 1
        rows = [(shard, len(pair), None, None, None), *((shard, None, p, w, k) for p, w, k in zip(part.tolist(), word[at].tolist(), np.diff(np.append(at, len(word))).tolist(), strict=True))]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["shard", "n", "part", "word", "follow"])

    return build


def _follow_level(trie: Trie) -> Callable:
    """(part, word, follow) of one part of level 1 to its pointers; returns (part, pairs)."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        part, base = key[0].as_py(), trie.base("word_base")
        many = np.zeros(base[part + 1] - base[part], np.int64)
        many[table["word"].to_numpy() - base[part]] = table["follow"].to_numpy()
        first = np.append(0, np.cumsum(many)).astype(_U)
        write_arrays(f"{trie.folder}/follow-{part:06d}.bin", EliasFano.encode(first, int(first[-1])).arrays("first"), _attempt())
        return pa.table({"part": pa.array([part], pa.int64()), "pairs": pa.array([int(first[-1])], pa.int64())})

    return build


def _shards_together(trie: Trie) -> int:
    """Shards whose last words are looked up at once; they are then read twice."""
    return min(8, max(1, trie.shards // 128))


def _triple_level(trie: Trie) -> Callable:
    """Shard numbers to the final level 2 and 3 of each; returns (shard, space): the values level 3 reaches over."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, together = trie.base("pair_base"), _shards_together(trie)
        for batch in batches:
            shards = batch.column(0).to_pylist()
            for some in (shards[k : k + together] for k in range(0, len(shards), together)):
                full = [(x, int(base[x + 1] - base[x])) for x in some if base[x + 1] > base[x]]
                known = looked_up(_union([last_pairs(x, n) for x, n in full])) if len(full) > 1 else None
                space = {x: solve(x, n, known) for x, n in full}
                yield pa.RecordBatch.from_pydict({"shard": some, "space": [space.get(x, 0) for x in some]})

    def last_pairs(shard: int, n: int) -> np.ndarray:
        """Keys of the middle and last words of a shard's triples."""
        pair = trie.coded("pairs", shard, "key").get(np.arange(n)) + _U(trie.part("pairs", shard)["base"][0])
        kept = trie.part("triples", shard)
        third, _ = _unpack(kept["triples"].tobytes(), int(kept["n"][0]), np.uint32, np.uint32)
        (many,) = _unpack(kept["follow"].tobytes(), n, np.uint32)
        second, real = np.repeat(pair % _U(trie.size), many), third != trie.size
        return _union([trie.keys(second[real], third[real])])

    def looked_up(distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rising keys of pairs, and their indices in level 2."""
        a, b = (distinct // _U(trie.size)).astype(np.int64), (distinct % _U(trie.size)).astype(np.int64)
        ends, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        c, before = (x.astype(float) for x in trie.counts(ends))
        i, j = where[: len(a)], where[len(a) :]
        return distinct, trie.pairs(distinct, trie.shard_of(c[i], before[i], c[j], before[j]))

    def solve(shard: int, n: int, known: tuple[np.ndarray, np.ndarray] | None) -> int:
        base = _U(trie.part("pairs", shard)["base"][0])
        pair = trie.coded("pairs", shard, "key").get(np.arange(n)) + base
        first, second = (pair // _U(trie.size)).astype(np.int64), (pair % _U(trie.size)).astype(np.int64)
        kept = trie.part("triples", shard)
        third, count = _unpack(kept["triples"].tobytes(), int(kept["n"][0]), np.uint32, np.uint32)
        (many,) = _unpack(kept["follow"].tobytes(), n, np.uint32)
        count, many = count.astype(np.int64), many.astype(np.int64)
        head = np.cumsum(many) - many
        followed = np.add.reduceat(count, head)  # occurrences of the pair
        last = third[head] == trie.size  # pairs that end a text have no successor
        firsts, at1 = np.unique(first, return_inverse=True)
        c1, _ = trie.counts(firsts)
        lo1, hi1 = trie.followers(firsts)
        seconds, at2 = np.unique(second, return_inverse=True)
        lo2, hi2 = trie.followers(seconds)
        room = np.where(last, 0, (hi2 - lo2)[at2])
        start = np.append(0, np.cumsum(room))
        owner = np.repeat(np.arange(n), many)
        real = ~last[owner]
        owner, word, count = owner[real], third[real].astype(np.int64), count[real]
        # Rank of each last word among the successors of the middle word: where that pair is in level 2.
        keys = trie.keys(second[owner], word)
        distinct, back = np.unique(keys, return_inverse=True)
        index = known[1][np.searchsorted(known[0], distinct)] if known else looked_up(distinct)[1]
        rank = index[back] - lo2[at2[owner]]
        value = start[owner] + rank
        order = np.argsort(value)
        p2 = followed / (c1 + hi1 - lo1)[at1]
        p3 = count / (followed + many)[owner]
        mass = np.where(last, 1.0, many / (followed + many))
        arrays = EliasFano.encode(start.astype(_U), int(start[-1])).arrays("first") | EliasFano.encode(value[order].astype(_U), int(start[-1])).arrays("rank")
        arrays |= {"p2": trie.quantise(p2), "mass": trie.quantise(mass), "p3": trie.quantise(p3[order])}
        write_arrays(f"{trie.folder}/probs-{shard:06d}.bin", arrays, _attempt())
        return int(start[-1])

    return build


def _ends(sizes: DataFrame, key: str, value: str, n: int) -> np.ndarray:
    """0 and the running sums of sizes(key 0 .. n - 1, value), two numbers for each part or shard."""
    got, out = sizes.select(key, value).toArrow(), np.zeros(n + 1, np.int64)
    out[got[key].to_numpy() + 1] = got[value].to_numpy()
    return np.cumsum(out)


def build_trie(docs: DataFrame, text_col: str = "text", words_per_part: int = 1_000_000, tokens_per_shard: int = 1_000_000, tokens_per_block: int = 400_000) -> Trie:
    """Count the texts of docs and write the levels of their trie to a new folder in the shared one."""
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "trie")
    texts = own(docs, text=text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            size, codes, hashes = tokens(batch.column(0))
            many = np.append(np.bincount(codes, minlength=len(hashes)), len(size))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(hashes, _U(BEGIN)).view(np.int64)), pa.array(many)], names=["hash", "count"])

    words = saved(texts.mapInArrow(count, "hash long, count long").groupBy("hash").agg(F.sum("count").alias("count")), "words")
    n, total = words.agg(F.count("*"), F.sum("count")).first()
    if not n:
        return Trie(folder, 0, 0, 0, 0, 1)
    n_texts = words.filter(F.col("hash") == BEGIN).first()["count"]
    total -= n_texts
    bits = max(0, (-(-n // words_per_part) - 1).bit_length())
    part = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long")
    by_part = words.withColumn("part", part)
    sums = saved(by_part.groupBy("part").agg(F.count("*").alias("n"), F.sum("count").alias("c")), "parts")
    base, before = _ends(sums, "part", "n", 1 << bits), _ends(sums, "part", "c", 1 << bits)
    trie = Trie(folder, total, n_texts, bits, int(n), max(1, -(-total // tokens_per_shard)), step=max(1 / 32, np.log10(total + 2) / 255)).indexed(word_base=base, before=before)

    def write_words(key: tuple, table: pa.Table) -> pa.Table:
        k = key[0].as_py()
        hashes, many = table["hash"].to_numpy().view(_U), table["count"].to_numpy()
        order = np.argsort(hashes)
        many = many[order]
        low = hashes[order] & _U((1 << (64 - bits)) - 1)
        arrays = EliasFano.encode(low, (1 << (64 - bits)) - 1).arrays("hash") | {"count": many, "before": trie.base("before")[k] + np.cumsum(many) - many}
        write_arrays(f"{folder}/words-{k:06d}.bin", arrays, _attempt())
        return pa.table({"part": pa.array([k], pa.int64())})

    saved(by_part.groupBy("part").applyInArrow(write_words, "part long"), "manifest")
    # Blocks have a piece for each shard: with many shards they are larger, so that pieces don't become ever smaller.
    blocks = texts.mapInArrow(_blocks(trie, max(tokens_per_block, min(1000 * trie.shards, 1_600_000))), "shard long, n long, base long, block binary")
    found = saved(blocks.groupBy("shard").applyInArrow(_pair_level(trie), "shard long, n long, part long, word long, follow long"), "manifest")
    trie = trie.indexed(pair_base=_ends(found.filter(F.col("word").isNull()), "shard", "n", trie.shards))
    # Every part gets its pointers, also one whose words nothing follows: its first word is listed with none.
    firsts = [(k, int(base[k]), 0) for k in range(1 << bits) if base[k + 1] > base[k]]
    follow = found.filter(F.col("word").isNotNull()).select("part", "word", "follow").unionByName(spark.createDataFrame(firsts, "part long, word long, follow long"))
    follow = follow.groupBy("part", "word").agg(F.sum("follow").alias("follow"))
    trie = trie.indexed(follow_base=_ends(saved(follow.groupBy("part").applyInArrow(_follow_level(trie), "part long, pairs long"), "manifest"), "part", "pairs", 1 << bits))
    tasks = spark.range(0, trie.shards, 1, min(-(-trie.shards // _shards_together(trie)), 100_000)).select(F.col("id").alias("shard"))
    return trie.indexed(space_base=_ends(saved(tasks.mapInArrow(_triple_level(trie), "shard long, space long"), "manifest"), "shard", "space", trie.shards))


def score_batch(trie: Trie, column: pa.Array) -> dict[str, np.ndarray]:
    """Tokens, known tokens, base score and score of each text."""
    return next(score_block(trie, [tokens(column)]))


def score_block(trie: Trie, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[dict[str, np.ndarray]]:
    """score_batch of the texts of several parts, given by their tokens, whose words, pairs and triples are looked up together."""
    hashes = _union([own_hashes for *_, own_hashes in parts])
    ids = trie.numbers(hashes) if trie.size else np.full(len(hashes), -1, np.int64)
    known = ids >= 0
    count, before = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    if known.any():
        count[known], before[known] = trie.counts(ids[known])
    single = (count + 1) / (trie.total + trie.vocabulary + 1)
    parts = [(size, np.searchsorted(hashes, own_hashes).astype(np.int32)[codes]) for size, codes, own_hashes in parts]
    scored = _probabilities(trie, parts, ids, count, before, single) if trie.total else (single[codes] for _, codes in parts)
    for (size, codes), p in zip(parts, scored, strict=True):
        starts = np.cumsum(size) - size
        yield {"n_tokens": size, "n_known": np.add.reduceat(known[codes].astype(np.int64), starts), "base_score": np.add.reduceat(np.log10(single)[codes], starts), "score": np.add.reduceat(np.log10(p), starts)}


def _interpolated(trie: Trie, codes: np.ndarray, ids: np.ndarray, count: np.ndarray, before: np.ndarray, starts: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Probabilities of the tokens of one part; p: those of single words."""
    single = np.zeros(len(ids))
    single[codes] = p
    return next(_probabilities(trie, [(np.diff(np.append(starts, len(codes))), codes)], ids, count, before, single))


def _probabilities(trie: Trie, parts: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, count: np.ndarray, before: np.ndarray, single: np.ndarray) -> Iterator[np.ndarray]:
    """Probabilities of the tokens of each of the parts (size, codes); ids, count, before and single are by code."""
    begin = trie.numbers(np.array([BEGIN], _U))
    ids, count, before = np.append(ids, begin), np.append(count, trie.texts), np.append(before, trie.counts(begin)[1])
    lo, hi = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    known = np.flatnonzero(ids >= 0)
    lo[known], hi[known] = trie.followers(ids[known])
    mass1 = np.where(count > 0, (hi - lo) / np.maximum(1, count + (hi - lo)), 1.0)
    mass1[ids < 0] = 1.0

    def placed(size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of texts, codes of the words before, and places of tokens with both words known."""
        starts = np.cumsum(size) - size
        prev = np.roll(codes, 1)
        prev[starts] = len(ids) - 1
        return starts, prev, np.flatnonzero((ids[prev] >= 0) & (ids[codes] >= 0))

    def met(size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, prev, at = placed(size, codes)
        return _distinct(trie.keys(ids[prev[at]], ids[codes[at]]))

    # Pairs: the distinct ones in rising order, and for each token where its own is.
    keys, pairs = _merged([met(*part) for part in parts])
    order = known[np.argsort(ids[known])]
    u, v = (order[np.searchsorted(ids[order], x.astype(np.int64))] for x in (keys // _U(trie.size), keys % _U(trie.size)))
    shard = trie.shard_of(count[u].astype(float), before[u].astype(float), count[v].astype(float), before[v].astype(float))
    index, pair_base, space_base = trie.pairs(keys, shard), trie.base("pair_base"), trie.base("space_base")
    there, rank = index >= 0, index - lo[u]
    del u, v
    p2, mass2, space = np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.uint8), np.full(len(keys), -1, np.int64)
    for k, cut in _pieces(shard):
        hit = np.flatnonzero(there[cut]) + cut.start
        if len(hit):
            arrays, local = trie.part("probs", k), index[hit] - pair_base[k]
            p2[hit], mass2[hit] = arrays["p2"][local], arrays["mass"][local]
            space[hit] = trie.coded("probs", k, "first").get(local).astype(np.int64) + space_base[k]
    del index, shard

    def triples_of(part: tuple[np.ndarray, np.ndarray], found: np.ndarray) -> tuple[np.ndarray, ...]:
        """(places, pairs) of contexts that are there, and (places, values) of triples whose both pairs are: the pair before is the context, the present pair's rank the word."""
        starts, _, at = placed(*part)
        pair = np.full(len(part[1]), -1, np.int32)
        pair[at] = found
        context = np.roll(pair, 1)
        context[starts] = -1
        after = np.flatnonzero(context >= 0)
        after = after[there[context[after]]]
        ahead = after[pair[after] >= 0]
        ahead = ahead[there[pair[ahead]]]
        return after, context[after], ahead, space[context[ahead]] + rank[pair[ahead]]

    alone = triples_of(parts[0], pairs[0]) if len(parts) == 1 else None  # of several parts they are found twice, to hold less
    values, triples = _merged([_distinct((alone or triples_of(*x))[-1]) for x in zip(parts, pairs, strict=True)])
    p3, found = np.zeros(len(values), np.uint8), np.zeros(len(values), bool)
    for k, cut in _pieces(np.searchsorted(space_base, values, side="right") - 1):
        local = trie.coded("probs", k, "rank").find((values[cut] - space_base[k]).astype(_U))
        hit = np.flatnonzero(local >= 0)
        p3[cut.start + hit], found[cut.start + hit] = trie.part("probs", k)["p3"][local[hit]], True
    for part, pair, triple in zip(parts, pairs, triples, strict=True):
        _, prev, at = placed(*part)
        after, context, ahead, _ = alone or triples_of(part, pair)
        p = mass1[prev] * single[part[1]]
        p[at] += np.where(there[pair], trie.value(p2[pair]), 0.0)
        p[after] *= trie.value(mass2[context])
        p[ahead] += np.where(found[triple], trie.value(p3[triple]), 0.0)
        yield p


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising distinct values, and where each value is among them."""
    distinct, back = np.unique(values, return_inverse=True)
    return distinct, back.astype(np.int32)


def _union(arrays: list[np.ndarray]) -> np.ndarray:
    """Rising distinct values. (np.unique without places hashes, which takes several times as long as a sort of such numbers.)"""
    values = np.sort(np.concatenate(arrays), kind="stable")
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """_distinct of several arrays as one of all."""
    if len(parts) == 1:
        return parts[0][0], [parts[0][1]]
    every = _union([distinct for distinct, _ in parts])
    return every, [np.searchsorted(every, distinct).astype(np.int32)[back] for distinct, back in parts]


def score_texts(df: DataFrame, trie: Trie, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of df: id, n_tokens, n_known (seen in training), train_tokens, base_score (unigrams) and score (the trie)."""
    rows = own(df, id=id_col, text=text_col)
    names = [id_col, "n_tokens", "n_known", "base_score", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scored() -> Iterator[pa.RecordBatch]:
            for these, got in zip(keys, score_block(trie, parts), strict=True):
                yield pa.RecordBatch.from_arrays([these, *[pa.array(got[c]) for c in names[1:]]], names=names)

        keys, parts = [], []
        for batch in slices(batches, 1):
            size, codes, hashes = tokens(batch.column(1))
            keys.append(batch.column(0))
            parts.append((size, codes.astype(np.int32), hashes))
            if len(parts) >= trie.together:
                yield from scored()
                keys, parts = [], []
        if parts:
            yield from scored()

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(score, f"`{id_col}` {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.select(f"`{id_col}`", "n_tokens", "n_known", F.lit(trie.total).cast("long").alias("train_tokens"), "base_score", "score")


def learn_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 7, held: int = 2) -> DataFrame:
    """Learn from the rows whose crc32(id as text) mod fold isn't held, and score all rows; held_out tells the rest."""
    in_fold: Column = F.coalesce(crc_mod(id_col, fold) != held, F.lit(False))
    trie = build_trie(docs.filter(in_fold), text_col)
    scored = score_texts(docs, trie, id_col, text_col)
    return scored.withColumn("held_out", ~F.coalesce(crc_mod(id_col, fold) != held, F.lit(False)))
