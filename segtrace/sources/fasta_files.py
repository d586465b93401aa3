"""FASTA files that carry a key's name: a Python data source for writing, with a commit step.

    df.write.format("keyed_fasta").mode("overwrite").save(folder)      # df(key, header, seq), all strings

A task writes each key of its rows to a file of its own under a temporary name. When all tasks are done the driver gives the files their
names: `<key>.fasta`, and `<key>.2.fasta` ... where several tasks had rows of a key, so a key with very many rows needs no task for itself. A failed job leaves none of its files.
Letters that a file name can't hold become `_`; keys that are the same after that, also but for case, share a number. The names fit read_fasta's default pattern.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

_OPEN = 64  # files that a task holds open at once


def safe_name(key: str | None) -> str:
    """A key as a file name: at most 150 letters, digits, `-`, `_` and `.`, not hidden; `unnamed` for an empty or null one."""
    return re.sub(r"[^\w.-]", "_", (key or "").strip())[:150].lstrip("._") or "unnamed"


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # name of the key, file


def _store(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool, wrap: int, run: str):
        self.path, self.overwrite, self.wrap, self.run = path, overwrite, wrap, run

    def write(self, rows: Iterator) -> _Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, base = _store(self.path)
        folder = f"{base}/_temporary-{self.run}"
        store.create_dir(folder, recursive=True)
        open_: dict[str, object] = {}
        files: list[tuple[str, str]] = []
        for key, header, seq in rows:
            name = safe_name(key)
            if name not in open_:
                if len(open_) >= _OPEN:  # rows come sorted by key, so one that is closed rarely comes back; if so it gets another file
                    open_.pop(next(iter(open_))).close()  # type: ignore[attr-defined]
                files.append((name, f"{folder}/{context.partitionId()}-{context.taskAttemptId()}-{len(files)}"))
                open_[name] = store.open_output_stream(files[-1][1], compression=None)
            seq = seq or ""
            lines = [seq[k : k + self.wrap] for k in range(0, len(seq), self.wrap)] if self.wrap else [seq]
            open_[name].write("\n".join([f">{(header or '').removeprefix('>')}", *lines, ""]).encode())  # type: ignore[attr-defined]
        for file in open_.values():
            file.close()  # type: ignore[attr-defined]
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        store, base = _store(self.path)
        if self.overwrite:
            for info in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if info.type == fs.FileType.File:
                    store.delete_file(info.path)
        seen: Counter[str] = Counter()
        for name, file in sorted(f for m in messages if isinstance(m, _Written) for f in m.files):
            seen[name.lower()] += 1
            nth = seen[name.lower()]
            store.move(file, f"{base}/{name}.fasta" if nth == 1 else f"{base}/{name}.{nth}.fasta")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        store, base = _store(self.path)
        folder = f"{base}/_temporary-{self.run}"
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class KeyedFasta(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_fasta"

    def schema(self) -> str:
        return "key string, header string, seq string"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite, int(self.options.get("wrap", "0")), self.options["run"])


def write_named(df: DataFrame, path: str, key: str, wrap: int | None = 80, replace: bool = False) -> None:
    """The records of each value of key in `<path>/<key>.fasta`; files that are there are an error unless they are to be replaced.

    Rows go to tasks by key; AQE cuts a key with very many rows over several.
    """
    import uuid

    from pyarrow import fs

    spark: SparkSession = df.sparkSession
    spark.dataSource.register(KeyedFasta)
    store, base = _store(path)
    if not replace and store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        raise FileExistsError(f"{path} already exists")
    rows = df.select(F.col(f"`{key}`").cast("string").alias("key"), F.col("header").cast("string").alias("header"), F.col("seq").cast("string").alias("seq"))
    dealt = rows.hint("rebalance", "key").sortWithinPartitions("key", "header")
    dealt.write.format("keyed_fasta").option("wrap", str(wrap or 0)).option("run", uuid.uuid4().hex).mode("overwrite" if replace else "append").save(path)
