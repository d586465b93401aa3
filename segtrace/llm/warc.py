"""WARC as a Spark source and sink.

Source: `spark.read.format("warc").load(folder)`, a Python data source. Files are the partitions (each
record is a gzip member of its own). Filters on record type and on the headers are pushed into the scan;
a record's header is parsed first, and its payload is inflated only if the record passes and its payload is
wanted. Else inflating stops after the header: the member's gzip header names its compressed length (an extra field
`sl`, as the WARC format's annex proposes), so the reader seeks to the next record. Only in archives of others
without that field the end has to be found by inflating.

Sink: write_warc() writes one file per task, under a temporary name that is then renamed, so a task that
runs again writes the same file; any store that pyarrow knows works.

archive_pages() keeps one copy of each payload: among records with the same SHA-1 the one with the
largest id is the response, the others are revisit records that name it. Digests are counted with partial
aggregation, and only those that repeat matter. Up to `broadcast_rows` of them are broadcast, so no payload is
shuffled. Beyond, a Bloom filter passes pages whose digest may repeat to a shuffled join, and a second one lets only those
keep their payload there that may be the response of their digest: of a digest that a third of all rows share, one.

Defined cases: a null payload is empty; null ids and urls become empty header values and are read back as
null; repeated ids with equal payloads are all the response; an empty table writes no record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from .common import file_system, own, refuse_full, saved, shared_dir
from .urls import build_filter, probed

SCHEMA = (
    "record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long,"
    " refers_to string, page_id string, payload binary"
)
#: Column of the source to header of the record.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
    "refers_to": "WARC-Refers-To",
    "page_id": "X-Page-Id",
}
_READ = 1 << 18
#: gzip: magic, method, flags, time, extra flags, system, extra length; field id and length, compressed and plain length.
_HEAD = struct.Struct("<2sBBIBBH2sHII")
_TAIL = struct.Struct("<II")


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base 32, upper case: five hex digits are four base-32 digits."""
    text = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(text, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def encode_record(headers: dict[str, str], payload: bytes | None, level: int = 1) -> bytes:
    """One record as a gzip member that tells its own length, compressed and not, in an extra field."""
    lines = [f"{k}: {v}".replace("\r", " ").replace("\n", " ") for k, v in headers.items() if v]
    body = payload or b""
    data = b"".join(["\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(body)}", "", ""]).encode(), body, b"\r\n\r\n"])
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    size = _HEAD.size + len(packed) + _TAIL.size
    sizes = (size, len(data)) if max(size, len(data)) < 1 << 32 else (0, 0)
    return b"".join([_HEAD.pack(b"\x1f\x8b", 8, 4, 0, 0, 255, 12, b"sl", 8, *sizes), packed, _TAIL.pack(zlib.crc32(data), len(data) & 0xFFFFFFFF)])


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write records (the columns of SCHEMA) as WARC files in folder; (file, records, bytes) per task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        name, n, size = f"{base}/part-{context.partitionId():06d}.warc.gz", 0, 0
        part = f"{name}.{context.taskAttemptId()}.tmp"
        with store.open_output_stream(part, compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    headers = {h: "" if row[c] is None else str(row[c]) for c, h in HEADERS.items()}
                    data = encode_record(headers, row["payload"])
                    out.write(data)
                    n, size = n + 1, size + len(data)
        if n:
            store.move(part, name)
        else:
            store.delete_file(part)
        yield pa.RecordBatch.from_pydict({"file": [name], "records": [n], "bytes": [size]})

    return records.select([x.strip().split()[0] for x in SCHEMA.split(",")]).mapInArrow(write, "file string, records long, bytes long")


class _Members:
    """The gzip members of a file, one after another: inflate() gives bytes of the present one, skip() passes it.

    inflated counts the bytes that were inflated, read those that were read.
    """

    def __init__(self, source):
        self.source, self.rest, self.engine, self.inflated, self.read = source, b"", None, 0, 0

    def _more(self) -> bytes:
        data = self.source.read(_READ)
        self.read += len(data)
        return data

    def begin(self) -> bool:
        """Start the next member; False at the end of the file."""
        while len(self.rest) < _HEAD.size and (more := self._more()):
            self.rest += more
        if not self.rest:
            return False
        self.engine, self.end = zlib.decompressobj(31), None
        if len(self.rest) >= _HEAD.size:
            _, _, flags, _, _, _, extra, name, size, packed, _ = _HEAD.unpack_from(self.rest)
            if flags & 4 and extra == 12 and name == b"sl" and size == 8 and packed:
                self.end = self.source.tell() - len(self.rest) + packed
        return True

    def inflate(self, most: int) -> bytes:
        """Up to `most` more bytes of this member; b"" at its end."""
        while not self.engine.eof:
            if not self.rest and not (more := self._more()):
                raise EOFError("a WARC file ends inside a record")
            elif not self.rest:
                self.rest = more
            out = self.engine.decompress(self.rest, most)
            self.rest = self.engine.unused_data if self.engine.eof else self.engine.unconsumed_tail
            if out:
                self.inflated += len(out)
                return out
        return b""

    def skip(self) -> None:
        """Go past this member: by its length where it tells that, else by inflating what is left of it."""
        if self.engine.eof:
            return
        if self.end is None:
            while self.inflate(_READ):
                pass
        elif (ahead := self.end - (self.source.tell() - len(self.rest))) <= len(self.rest):
            self.rest = self.rest[ahead:]
        else:
            self.source.seek(self.end)
            self.rest = b""


def parse_head(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if colon:
            fields[key.strip().lower()] = value.strip()
    return fields


class WarcSource(DataSource):
    """format("warc"): options path (a folder or one file) and payload: true, false (there is no such column), or
    record types, joined by commas, whose payloads are decoded; those of others are null."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA if self._payload() else SCHEMA.rpartition(",")[0]

    def _payload(self) -> str:
        """"" for no payload, "true" for all, else the record types."""
        return str(self.options.get("payload", "true")).lower().replace("false", "")

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], self._payload())


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str = ""):
        self.path, self.payload, self.wanted, self.inflated = path, payload, {}, 0

    def pushFilters(self, filters):
        """Equality and IN on header columns are taken; whatever else stays with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if column in HEADERS and column != "payload_bytes":
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """One partition per file, largest first so that the long tasks start early."""
        from pyarrow import fs

        store, base = file_system(self.path)
        info = store.get_file_info(base)
        if info.type == fs.FileType.NotFound:
            return []
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(base, recursive=True))
        files = [x for x in found if x.type == fs.FileType.File and x.base_name.endswith((".warc.gz", ".warc"))]
        return [InputPartition(x.path) for x in sorted(files, key=lambda x: (-x.size, x.path))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.value is None:
            return
        store, _ = file_system(self.path)
        names = [*HEADERS, *(["payload"] if self.payload else [])]
        kinds = [pa.int64() if c == "payload_bytes" else pa.binary() if c == "payload" else pa.string() for c in names]
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        types = None if self.payload in ("", "true") else set(self.payload.split(","))
        with store.open_input_file(partition.value) as source:
            members = _Members(source)
            while members.begin():
                start = b""
                while b"\r\n\r\n" not in start and (more := members.inflate(2048)):
                    start += more
                head, _, body = start.partition(b"\r\n\r\n")
                fields = parse_head(head)
                row = [fields.get(h.lower()) for h in HEADERS.values()]
                if any(dict(zip(HEADERS, row, strict=True))[c] not in v for c, v in self.wanted.items()):
                    members.skip()
                    continue
                row[list(HEADERS).index("payload_bytes")] = int(fields.get("x-payload-length") or fields.get("content-length", 0))
                if self.payload and (types is None or (row[0] or "").lower() in types):
                    pieces = [body]
                    while more := members.inflate(_READ):
                        pieces.append(more)
                    row.append(b"".join(pieces)[: int(fields.get("content-length", 0))])
                    size += len(row[-1])
                else:
                    members.skip()
                    row += [None] * bool(self.payload)
                rows.append(tuple(row))
                size += 500
                self.inflated = members.inflated
                if size > 4 << 20:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()


def read_warc(spark: SparkSession, folder: str, payload: bool | str = True) -> DataFrame:
    """The records below folder; payload: see WarcSource."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def with_roles(pages: DataFrame, min_bytes: int = 0, broadcast_rows: int = 200_000) -> DataFrame:
    """pages(id, url, payload) as records: payloads of at least min_bytes are stored once."""
    rows = pages.withColumn("payload", F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary")))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("size", F.length("payload").cast("long"))
    brief = rows.filter(F.col("size") >= min_bytes).groupBy(F.col("digest").alias("of")).agg(F.max("id").alias("keeper"), F.count("*").alias("n"))
    again = saved(brief.filter("n > 1").select("of", "keeper"), "repeated")
    if (n := again.limit(broadcast_rows + 1).count()) <= broadcast_rows:
        rows = _with_keepers(rows, F.broadcast(again), min_bytes)
    else:
        rows = _with_filters(rows, again, again.count() if n else 0, min_bytes)
    again = F.col("keeper").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("keeper")))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"), F.concat(F.lit("sha1:"), "digest").alias("payload_digest"), F.col("size").alias("payload_bytes"),
        F.when(again, F.concat(F.lit("<urn:page:"), F.col("keeper").cast("string"), F.lit(">"))).alias("refers_to"),
        F.col("id").cast("string").alias("page_id"), F.when(~again, F.col("payload")).alias("payload"),
    )


def _with_keepers(rows: DataFrame, keepers: DataFrame, min_bytes: int) -> DataFrame:
    return rows.join(keepers, (F.col("digest") == F.col("of")) & (F.col("size") >= min_bytes), "left").drop("of")


def _with_filters(rows: DataFrame, again: DataFrame, n: int, min_bytes: int) -> DataFrame:
    """What _with_keepers gives, for repeated digests too many to broadcast: pages whose digest can't repeat stay where
    they are; of the others, those that can't be their digest's response go to the join without their payload."""
    bloom, blocks = build_filter(again.select(F.col("of").alias("key")), n)
    seen = probed(rows, F.col("digest"), saved(bloom, "bloom"), blocks, "maybe").withColumn("maybe", F.col("maybe") & (F.col("size") >= min_bytes))
    keepers = seen.filter("maybe").groupBy(F.col("digest").alias("of")).agg(F.max("id").alias("keeper"))
    keepers = saved(keepers, "keepers")
    record = lambda digest, key: F.concat_ws(":", digest, F.col(key).cast("string"))
    bloom, blocks = build_filter(keepers.select(record("of", "keeper").alias("key")), keepers.count())
    some = probed(seen.filter("maybe").drop("maybe"), record("digest", "id"), saved(bloom, "bloom"), blocks, "first")
    # A digest without any id has no keeper: all its pages are responses.
    some = some.withColumn("payload", F.when(F.col("first") | F.col("id").isNull(), F.col("payload"))).drop("first")
    joined = _with_keepers(some, keepers, min_bytes)
    return seen.filter("not maybe").drop("maybe").withColumn("keeper", F.lit(None).cast(joined.schema["keeper"].dataType)).unionByName(joined)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, folder: str | None = None) -> str:
    """Write pages as WARC files below folder, which must be new or empty (one in the shared folder if None); returns the folder."""
    folder = folder or shared_dir(pages.sparkSession, "warc")
    refuse_full(folder)
    records = with_roles(own(pages, id=id_col, url=url_col, payload=payload_col), min_bytes)
    saved(write_warc(records, folder), "manifest")
    return folder


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """What the archives hold per page, in one pass. Responses are measured on the payload that was read back, revisits
    by their headers, whose payloads are never decoded."""
    rows = read_warc(spark, folder, payload="response")
    full = F.col("record_type") == "response"
    number = F.regexp_extract("refers_to", r"([^:>]+)>$", 1)
    return rows.select(
        "page_id", F.when(full, F.length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(full, base32_sha1(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", F.when(F.col("refers_to").isNotNull(), number).alias("refers_to"),
    )


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()
