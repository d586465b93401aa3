"""Records and token files: checksums bit by bit, the library's encoding of whole texts, round trips, damage, odd rows."""

import gc
import os
import random
import struct
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from conftest_data import DOCS, SF, docs_frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from segtrace.llm import records
from segtrace.llm.queries import QUERIES
from segtrace.llm.token_files import Encoder, read_index, read_manifest, read_records, running_start, shuffled, token_digests, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


def plain_crc(data):
    value = 0xFFFFFFFF
    for byte in data:
        value ^= byte
        for _ in range(8):
            value = (value >> 1) ^ (0x82F63B78 * (value & 1))
    return value ^ 0xFFFFFFFF


def whole(text, end=2):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, end]


def test_checksums():
    assert plain_crc(b"123456789") == 0xE3069283
    rng = random.Random(0)
    pieces = [b"", b"1", b"123456789", bytes(32), *(rng.randbytes(rng.choice([0, 1, 3, 4, 5, 251, 252, 253, 256, 300, 2000])) for _ in range(60))]
    size = np.array([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    assert records.crc32c(data, np.cumsum(size) - size, size).tolist() == [plain_crc(p) for p in pieces]
    assert records.crc32c(data[:0], size[:0], size[:0]).tolist() == []


def test_frame_by_hand():
    """One record, byte by byte."""
    mask = lambda c: ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF
    head = struct.pack("<Q", 5)
    want = head + struct.pack("<I", mask(plain_crc(head))) + b"hello" + struct.pack("<I", mask(plain_crc(b"hello")))
    out, offset = records.frame(np.frombuffer(b"hello", np.uint8), np.array([0]), np.array([5]))
    assert out.tobytes() == want and offset.tolist() == [0, len(want)]
    start, size = records.unframe(out, np.array([0]), np.array([len(want)]))
    assert (start.tolist(), size.tolist()) == ([12], [5])
    for k in range(len(want)):
        bad = out.copy()
        bad[k] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bad, np.array([0]), np.array([len(want)]))


@given(st.lists(st.integers(0, 2**16 - 1), max_size=40), st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.sampled_from([2, 4]))
@settings(max_examples=100, deadline=None)
def test_message(ids, doc, width):
    (data,) = records.messages([doc], [memoryview(np.array(ids, f"<u{width}").tobytes())], width)
    got, tokens, size = records.parse_message(memoryview(data))
    assert (got, size) == (doc, width) and np.frombuffer(tokens, f"<u{width}").tolist() == ids


@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　a1.'s<|endoftext|>")), max_size=30), max_size=6))
@settings(max_examples=300, deadline=None)
def test_pieces_give_what_whole_texts_give(texts):
    ids, many = ENCODER.encode(pa.array(texts, pa.string()))
    cut = np.split(ids, np.cumsum(many)[:-1]) if len(many) else []
    assert [c.tolist() for c in cut] == [whole(t) for t in texts]


ENCODER = Encoder(PATH, 2, most=200)  # forgets often


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    other, texts = Tokenizer.from_file(path), ["Some Words here", "", "x"]
    ids, many = Encoder(path, 7).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in (*other.encode(t, add_special_tokens=False).ids, 7)] and many.sum() == len(ids)


def test_query_is_the_library(spark):
    """The whole table: ids of whole texts, in rising order."""
    got = {r.doc_id: r for r in QUERIES["op13_token_records"](spark, SF).collect()}
    start = 0
    for i, text in sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()):
        ids = whole(text)
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_files_in_any_order(spark):
    """The files read record by record without the library's reader, the index, and shuffled reads."""
    docs = spark.createDataFrame([(k, f"text number {k} " * (k % 7)) for k in range(300)], "doc_id long, text string")
    folder = write_tokens(docs, PATH)
    base, rows = folder.removeprefix("file:").replace("//", "/"), []
    for name in sorted(x for x in os.listdir(base) if x.endswith(".tfrecord")):
        with open(f"{base}/{name}", "rb") as file:
            data = file.read()
        at = 0
        while at < len(data):
            (n,) = struct.unpack_from("<Q", data, at)
            doc, tokens, width = records.parse_message(memoryview(data)[at + 12 : at + 12 + n])
            rows.append((doc, np.frombuffer(tokens, f"<u{width}").tolist()))
            at += n + 16
    assert rows == [(k, whole(f"text number {k} " * (k % 7))) for k in range(300)]
    index = read_index(spark, folder)
    assert index.count() == 300 and read_manifest(spark, folder).agg({"tokens": "sum"}).first()[0] == sum(len(ids) for _, ids in rows)
    orders = []
    for seed, block in ((1, 1), (1, 1), (2, 1), (1, 20)):
        got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in read_records(spark, folder, shuffled(index, seed, block)).collect()]
        assert sorted(got) == rows and got != rows
        orders.append(got)
    assert orders[0] == orders[1] != orders[2]
    some = read_records(spark, folder, index.filter("n % 3 = 1")).collect()
    assert 0 < len(some) < 300 and all(np.frombuffer(r.ids, "<u4").tolist() == rows[r.doc_id][1] for r in some)
    with pytest.raises(ValueError, match="holds files"):
        write_tokens(docs, PATH, folder)


class Taken:
    """Stands in for the entries of read_records: keeps the function that Spark's workers would run."""

    def select(self, *_):
        return self

    def mapInArrow(self, read, _):
        return read


def test_readers_keep_nothing_of_what_they_have_read(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat(concat('some text ', id, ' '), 5000) AS text")
    folder = write_tokens(docs, PATH)
    index, read = read_index(spark, folder).toArrow().to_batches(), read_records(spark, folder, Taken())
    tracemalloc.start()
    try:
        many = [sum(int(pc.sum(pc.binary_length(batch.column(4))).as_py()) for batch in read(iter(index))) for _ in range(3)]
        gc.collect()
        kept, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert many[0] > 2_000_000 and len(set(many)) == 1 and kept < many[0] // 4


def test_damage_is_seen(spark):
    folder = write_tokens(spark.createDataFrame([(1, "some text"), (2, "more")], "doc_id long, text string"), PATH)
    base = folder.removeprefix("file:").replace("//", "/")
    name = next(f"{base}/{x}" for x in os.listdir(base) if x.endswith(".tfrecord"))
    with open(name, "r+b") as file:
        file.seek(30)
        byte = file.read(1)[0]
        file.seek(30)
        file.write(bytes([byte ^ 4]))
    os.path.exists(crc := f"{base}/.{os.path.basename(name)}.crc") and os.remove(crc)
    with pytest.raises(Exception, match="checksum"):
        read_records(spark, folder).collect()


def test_running_start(spark):
    rows = spark.range(0, 257).selectExpr("CAST(id AS INT) AS shard", "id % 5 AS tokens")
    got = {r.shard: r.start for r in running_start(rows, "shard", "tokens", "start", span=10).collect()}
    assert got == {k: sum(i % 5 for i in range(k)) for k in range(257)}


def test_odd_rows(spark):
    got = token_digests(read_records(spark, write_tokens(docs_frame(spark, DOCS), PATH))).collect()
    assert len(got) == len(DOCS)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([i for i, _ in DOCS], key=lambda i: (i is not None, i or 0))
    ends = np.append(0, np.cumsum([r.n_tokens for r in got]))
    assert [r.start for r in got] == ends[:-1].tolist()
    want = sorted((i is None, i or 0, zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))) for i, t in DOCS for ids in [whole(t)])
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids_crc32) for r in got) == want
    empty = write_tokens(docs_frame(spark, []), PATH)
    assert read_records(spark, empty).count() == 0 and read_manifest(spark, empty).count() == 0
