"""Token ids in files of length-delimited records, with an offset index beside each, for reads in any order.

Writing. Documents are dealt by ranges of (id, hash of the text) and sorted within each, so no id is one task's alone; each
task encodes its texts and writes one file of records (records.py) and one index: for each record its offset and the tokens of the
file before it, 8 bytes each, and the totals at the end. Both are renamed when whole, so a task that runs again replaces its own files.
The manifest (Parquet) has a row for each file with the tokens of all files before it, from running sums in two levels.

Reading. The index gives rows (shard, n, offset, size, start, n_tokens); whoever wants other rows, or an order of their own, filters
or shuffles these and hands them to read_records, which seeks, checks both checksums of each record and decodes. shuffled() is the
order of a training epoch: blocks of neighbouring records by a hash of (seed, shard, block).

Encoding. The tokenizers library encodes; a worker keeps what each distinct piece gave (up to `_KEPT` pieces). Texts are cut
into pieces only where a byte-level tokenizer cuts anyway: before a blank that stands before a word, and around white space. Other tokenizers get
whole texts.

Defined cases: a null text is empty and has only the end id; null ids come first; repeated ids follow one another in the order of
their texts' hashes; an empty table writes an empty manifest; other columns are ignored. Ids are integers.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batches_of, file_system, own, refuse_full, saved, shared_dir
from .records import frame, messages, parse_message, unframe
from .words import slices, string_hashes

_KEPT = 700_000
_READ, _TEXT = 1 << 20, 3 << 20
INDEX = "shard int, n long, offset long, size long, start long, n_tokens long"
#: Unicode's white space.
_UTF8_WHITE = "\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

#: White space other than a single blank or line end between two other letters; a blank at an end of the text.
_ODD = f"[{_UTF8_WHITE}][{_UTF8_WHITE}]|^[{_UTF8_WHITE}]|[{_UTF8_WHITE}]$|^$"
_PIECES = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]").findall


class Encoder:
    """Token ids of texts by a tokenizer file of the tokenizers library.

    A piece's key: what stands behind a blank is its own key (the blank belongs to the piece); any other piece has a blank before it.
    """

    def __init__(self, path: str, end_id: int, most: int = _KEPT):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        self.tokenizer, self.end_id, self.most = Tokenizer.from_file(path), end_id, most
        rules = json.loads(self.tokenizer.to_str())
        cut, added = rules["pre_tokenizer"] or {}, rules["added_tokens"]
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4  # bytes of an id in a file
        self.bytes = None
        if rules["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space"):
            if not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(f"[{_WHITE}]", t["content"]) for t in added):
                self.bytes = _byte_sizes(self.tokenizer, added)
                self.by_line = Tokenizer.from_file(path)
                self.by_line.pre_tokenizer = CharDelimiterSplit("\n")
        self.forget_all()

    def forget_all(self) -> None:
        """Know the end id only: code 0, a key that no piece has."""
        self.names = pa.array([], pa.string())  # by code, as are the next four
        self.hash, self.size, self.first, self.seen = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)
        self.sorted, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and their codes
        self._add(pa.array([""]), np.array([1]), np.array([self.end_id]))

    def _forget(self) -> None:
        """Keep the pieces that most batches had, at most half of the room."""
        least = 2
        while (self.seen >= least).sum() > self.most // 2:
            least *= 2
        keep = np.flatnonzero(self.seen >= least)
        names, size, ids, seen = self.names.take(pa.array(keep)), self.size[keep], _ragged(self.ids, self.first[keep], self.size[keep]), self.seen[keep]
        self.forget_all()
        self._add(names, size, ids)
        self.seen[1:] = seen // 2

    def _find(self, names: pa.Array) -> np.ndarray:
        """The code of each name, -1 for unknown ones. Equal hashes are not enough: the names are compared."""
        hashes = string_hashes(names)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        code = np.where(self.sorted[at] == hashes, self.order[at], -1)
        hit = np.flatnonzero(code >= 0)
        same = pc.equal(self.names.take(pa.array(code[hit])), names.take(pa.array(hit))).to_numpy(zero_copy_only=False)
        code[hit[~same]] = -1
        return code

    def _keys(self, column: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(number of keys of each text, keys of all texts). A text's first key is that of a piece without a blank in front."""
        if self.bytes is None:
            return pc.greater(pc.binary_length(column), 0).cast(pa.int64()).to_numpy(), column.filter(pc.greater(pc.binary_length(column), 0))
        odd = pc.match_substring_regex(column, _ODD)
        lists = pc.split_pattern(column, " ")
        if pc.any(odd).as_py():  # texts with more white space than single blanks, cut one by one
            places = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            cut = [[p[1:] if len(p) > 1 and p[0] == " " and k else (p if not k else " " + p) for k, p in enumerate(_PIECES(t))] for t in column.take(pa.array(places)).to_pylist()]
            order = np.arange(len(column))
            order[places] = len(column) + np.arange(len(places))
            lists = pa.concat_arrays([lists, pa.array(cut, lists.type)]).take(pa.array(order))
        return pc.list_value_length(lists).cast(pa.int64()).to_numpy(), lists.flatten()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has), each closed by the end id; null is an empty text."""
        if len(self.names) > self.most:
            self._forget()
        many, keys = self._keys(pc.fill_null(column, ""))
        last = np.cumsum(many)
        firsts = (last - many)[many > 0]
        inner, heads = keys.dictionary_encode(), pc.binary_join_element_wise(pa.scalar(" "), keys.take(pa.array(firsts)), "").dictionary_encode()
        names = pa.concat_arrays([inner.dictionary, heads.dictionary])
        known = self._find(names)
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = self._learn(names.take(pa.array(new)))
        self.seen[known] += 1
        codes = known[inner.indices.to_numpy()]
        codes[firsts] = known[heads.indices.to_numpy() + len(inner.dictionary)]
        codes = np.insert(codes, last, 0)
        size = self.size[codes]
        ends = np.append(0, np.cumsum(size, dtype=np.int64))
        return _ragged(self.ids, self.first[codes], size), np.diff(ends[np.append(0, last + 1 + np.arange(len(last)))])

    def _learn(self, names: pa.Array) -> np.ndarray:
        """Encode the pieces of new keys; their codes. Many at once in one text, a line each, its ids cut by the bytes they stand for. Line ends are
        tokens of their own between pieces that neither begin nor end with white space but for one blank in front. A piece of plain letters
        (and stops behind them) needs no cutting, so such pieces go to a tokenizer that cuts at line ends alone. Other pieces are encoded one by one."""
        pieces = pc.if_else(pc.starts_with(names, " "), pc.utf8_slice_codeunits(names, 1), pc.binary_join_element_wise(pa.scalar(" "), names, ""))
        length = pc.binary_length(pieces).to_numpy()
        plain = pc.match_substring_regex(pieces, _SIMPLE).to_numpy(zero_copy_only=False) & (self.bytes is not None)
        words, lines, rest = np.flatnonzero(plain), [], []
        other = np.flatnonzero(~plain)
        for k, piece in zip(other.tolist(), pieces.take(pa.array(other)).to_pylist(), strict=True):
            inner = piece[1:] if piece[:1] == " " else piece
            (lines if self.bytes is not None and inner and not inner[0].isspace() and not inner[-1].isspace() else rest).append((k, piece))
        sizes, found = [], []
        for a in range(0, len(rest), 1000):
            got = [e.ids for e in self.tokenizer.encode_batch_fast([piece for _, piece in rest[a : a + 1000]], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            found.append(np.array([i for ids in got for i in ids], np.int64))
        for a in range(0, len(words), 4000):
            text = "\n".join(pieces.take(pa.array(words[a : a + 4000])).to_pylist())
            size = length[words[a : a + 4000]]
            (got,) = self.by_line.encode_batch_fast([_STOPS(r"\n\1", text).encode().decode("latin-1").translate(_LETTERS)], add_special_tokens=False)
            ids = np.array(got.ids, np.int64)
            at = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(size))  # of each piece's last token
            sizes.append(np.diff(np.append(-1, at)))
            found.append(ids)
        for a in range(0, len(lines), 4000):
            text = "\n".join([piece for _, piece in lines[a : a + 4000]])
            size = length[[k for k, _ in lines[a : a + 4000]]]
            (got,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(got.ids, np.int64)
            at = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(size + 1)[:-1])  # of each piece's line end
            sizes.append(np.diff([-1, *at.tolist(), len(ids)]) - 1)
            found.append(np.delete(ids, at))
        places = np.array([*(k for k, _ in rest), *words.tolist(), *(k for k, _ in lines)], np.int64)
        first = self._add(names.take(pa.array(places)), np.concatenate(sizes), np.concatenate(found))
        out = np.empty(len(places), np.int64)
        out[places] = first + np.arange(len(places))
        return out

    def _add(self, names: pa.Array, size: np.ndarray, ids: np.ndarray) -> int:
        """Know these names: how many ids each has, and the ids of all. The code of the first."""
        first, hashes = len(self.names), string_hashes(names)
        self.names = pa.concat_arrays([self.names, names])
        self.hash = np.append(self.hash, hashes)
        self.first = np.append(self.first, len(self.ids) + np.cumsum(size, dtype=np.int64) - size)
        self.size, self.ids = np.append(self.size, size.astype(np.int32)), np.append(self.ids, ids.astype(np.int32))
        self.seen = np.append(self.seen, np.zeros(len(names), np.int32))
        order = np.argsort(hashes)
        at = np.searchsorted(self.sorted, hashes[order])
        self.sorted, self.order = np.insert(self.sorted, at, hashes[order]), np.insert(self.order, at, first + order)
        return first


def _ragged(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[first : first + size] of all pieces, one after another."""
    ends = np.cumsum(size, dtype=np.int64)
    at = np.repeat(first - ends + size, size)
    at += np.arange(len(at))
    return values[at]


def _letters() -> dict[int, str]:
    """The letter that a byte-level tokenizer has for each byte: itself where it can be seen, else the next from 256 on. Line ends stay."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)} | {10: "\n"}


_LETTERS = _letters()
#: Latin letters, then stops: two tokens' worth for a byte-level tokenizer's cutting.
_SIMPLE = "^ ?[A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{24f}]+[.,;:!?]*$"
_STOPS = re.compile("([.,;:!?]+)(?=\n|$)").sub


def _byte_sizes(tokenizer, added: list[dict]) -> np.ndarray:
    """How many bytes of a text each id of a byte-level tokenizer stands for: one for each letter of its entry."""
    words = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(words.values()) + 1, np.int64)
    for word, i in words.items():
        out[i] = len(word)
    for token in added:
        out[token["id"]] = len(token["content"].encode())
    return out


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches (id, text) put together, or cut, to about `size` bytes of text."""
    held, many = [], 0
    for batch in slices(batches, 1, size):
        held.append(batch)
        many += batch.column(1).nbytes
        if many >= size // 2:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, many = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _give_back() -> None:
    """Return freed memory to the system: idle workers live on beside the next stage's tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every system has it
        ctypes.CDLL(None).malloc_trim(0)


def _names(folder: str, shard: int) -> tuple[str, str]:
    return f"{folder}/part-{shard:06d}.tfrecord", f"{folder}/part-{shard:06d}.index"


def _writer(folder: str, path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        shard, coder = context.partitionId(), encoder(path, end_id)
        names = _names(base, shard)
        parts = [f"{name}.{context.taskAttemptId()}.tmp" for name in names]
        records = tokens = size = 0
        with store.open_output_stream(parts[0], compression=None) as data, store.open_output_stream(parts[1], compression=None) as index:
            for batch in _gathered(batches, _TEXT):
                ids, many = coder.encode(batch.column(1))
                raw, ends = memoryview(ids.astype(f"<u{coder.width}").tobytes()), (np.cumsum(many) * coder.width).tolist()
                out = messages(batch.column(0).to_pylist(), [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], coder.width)
                lengths = np.fromiter(map(len, out), np.int64, len(out))
                framed, offset = frame(np.frombuffer(b"".join(out), np.uint8), np.cumsum(lengths) - lengths, lengths)
                data.write(framed.tobytes())
                _give_back()
                index.write(np.stack([size + offset[:-1], tokens + np.cumsum(many) - many], axis=1).astype("<i8").tobytes())
                records, tokens, size = records + len(out), tokens + len(ids), size + int(offset[-1])
            index.write(np.array([size, tokens], "<i8").tobytes())
        del coder
        encoder.cache_clear()  # a waiting worker would keep some 90 MB of tokenizers, which take about a second to load again
        gc.collect()
        _give_back()
        for part, name in zip(parts, names, strict=True):
            if records:
                store.move(part, name)
            else:
                store.delete_file(part)
        if records:
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "records": [records], "tokens": [tokens], "bytes": [size]})

    return write


def running_start(rows: DataFrame, place: str, value: str, out: str, span: int = 1000) -> DataFrame:
    """rows with `out`: the sum of value over all rows of a smaller place (distinct integers from 0), in two levels, so that no
    task sees more than `span` rows or one row for each `span`."""
    group = F.floor(F.col(place) / span)
    sums = rows.groupBy(group.alias("__g")).agg(F.sum(value).alias("__s"))
    before = F.coalesce(F.sum("__s").over(Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("__g").alias("__h"), before.alias("__before"))
    within = F.coalesce(F.sum(value).over(Window.partitionBy("__g").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = rows.withColumn("__g", group).withColumn("__within", within).join(sums, F.col("__g") == F.col("__h"))
    return found.withColumn(out, F.col("__within") + F.col("__before")).drop("__g", "__h", "__before", "__within")


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, shard_bytes: int = 96 << 20) -> str:
    """Write the ids of all texts, in rising order of the id, below a folder that must be new or empty; its name. A file has the ids
    of about shard_bytes of text; a task's tokenizer and what it has learnt of its pieces are forgotten at its end, so a worker that waits holds little.

    Files: part-NNNNNN.tfrecord and .index, in the order of their numbers, and manifest (shard, records, tokens, bytes, start).
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "tokens")
    refuse_full(folder)
    size = docs.agg(F.sum(F.octet_length(f"`{text_col}`"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes), min(spark.sparkContext.defaultParallelism, -(-size // (8 << 20))))
    rows = own(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text", F.xxhash64("text").alias("hash"))
    dealt = rows.repartitionByRange(shards, F.asc_nulls_first("id"), "hash").sortWithinPartitions(F.asc_nulls_first("id"), "hash", "text")
    with batches_of(spark, 256):  # more rows of long texts take much memory outside of the heap
        written = saved(dealt.select("id", "text").mapInArrow(_writer(folder, tokenizer, end_id), "shard int, records long, tokens long, bytes long"), "shards")
    running_start(written, "shard", "tokens", "start").write.parquet(f"{folder}/manifest")
    return folder


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("shard int, records long, tokens long, bytes long, start long").parquet(f"{folder}/manifest")


def _entries(folder: str):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(_names(base, shard)[1]) as source:
                    at = np.frombuffer(source.read(), "<i8").reshape(-1, 2)
                step = np.diff(at, axis=0)
                for a in range(0, len(step), 50_000):
                    b = min(a + 50_000, len(step))
                    columns = [np.full(b - a, shard, np.int32), np.arange(a, b), at[a:b, 0], step[a:b, 0], start + at[a:b, 1], step[a:b, 1]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in INDEX.split(", ")])

    return entries


def _dealt(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, start), the files dealt over tasks."""
    shards = read_manifest(spark, folder)
    return shards.repartition(max(1, min(shards.count(), 100_000)), "shard").select("shard", "start")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record (INDEX): where it is, and its first token's place among all tokens."""
    return _dealt(spark, folder).mapInArrow(_entries(folder), INDEX)


def shuffled(entries: DataFrame, seed: int, block: int = 1) -> DataFrame:
    """entries in an order that depends on the seed alone: blocks of `block` neighbouring records by a hash, and those of a block
    likewise. Larger blocks read more at a time and mix less."""
    order = [F.xxhash64(F.lit(seed), "shard", F.floor(F.col("n") / block)), F.xxhash64(F.lit(seed), "shard", "n"), F.col("shard"), F.col("n")]
    return entries.repartitionByRange(*order).sortWithinPartitions(*order)


def _runs(shard: np.ndarray, offset: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring entries that one read of at most _READ bytes gets (a longer record by itself)."""
    a = 0
    for b in range(1, len(shard) + 1):
        if b == len(shard) or shard[b] != shard[a] or offset[b] != offset[b - 1] + size[b - 1] or offset[b] + size[b] - offset[a] > _READ:
            yield a, b
            a = b


def read_records(spark: SparkSession, folder: str, entries: DataFrame | None = None) -> DataFrame:
    """(doc_id, shard, n, start, ids) of the records of entries (default: all, each file in its order); ids: little-endian unsigned
    32-bit integers. ValueError in the task if a length, a checksum or a number of ids is wrong."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        name, source = "", None
        for batch in batches:
            shard, n, offset, size, start, many = (batch.column(k).to_numpy() for k in range(6))
            for a, b in _runs(shard.tolist(), offset.tolist(), size.tolist()):
                wanted = _names(base, int(shard[a]))[0]
                if wanted != name:
                    if source is not None:
                        source.close()
                    name, source = wanted, store.open_input_file(wanted)
                data = np.frombuffer(source.read_at(int(offset[b - 1] + size[b - 1] - offset[a]), int(offset[a])), np.uint8)
                at, length = unframe(data, offset[a:b] - offset[a], size[a:b])
                view = memoryview(data)
                got = [parse_message(view[i : i + m]) for i, m in zip(at.tolist(), length.tolist(), strict=True)]
                ids = np.frombuffer(b"".join(t for _, t, _ in got), f"<u{max(w for *_, w in got)}").astype("<u4")
                ends = np.append(0, np.cumsum(many[a:b]))
                if ends[-1] != len(ids):
                    raise ValueError(f"{name}: the index says {ends[-1]} ids, the records have {len(ids)}")
                # not from a list of memoryviews: pyarrow (23.0.1) never lets go of what is behind them
                cuts = pa.array(4 * ends).cast(pa.int32())
                raw = pa.Array.from_buffers(pa.binary(), b - a, [None, cuts.buffers()[1], pa.py_buffer(ids)])
                columns = [pa.array([i for i, *_ in got], pa.int64()), pa.array(shard[a:b]), pa.array(n[a:b]), pa.array(start[a:b]), raw]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shard", "n", "start", "ids"])
        if source is not None:
            source.close()
        _give_back()

    schema = "doc_id long, shard int, n long, start long, ids binary"
    if entries is None:  # index and records in one step: another step of Python would need workers of its own
        return _dealt(spark, folder).mapInArrow(lambda batches: read(_entries(folder)(batches)), schema)
    return entries.select(*[f.split()[0] for f in INDEX.split(", ")]).mapInArrow(read, schema)


def token_digests(records: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and CRC-32 of the ids of each record."""
    return records.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
