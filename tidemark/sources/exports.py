"""A Parquet writer whose files carry their content's hash as name: bytes are hashed while they are written, nothing is read again."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: A file ends once it has so many rows, or so many bytes in memory.
FILE_ROWS = 2_000_000
FILE_BYTES = 512 << 20
#: Folder values as Spark reads them.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = frozenset("\"#%'*/:=?\\\x7f{[]^")
PART = "__part"
FILES = "table_name string, file string, rows long, bytes long, sha256 string"


def store_at(path: str):
    """pyarrow's file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


def folder_of(names: Sequence[str], values: Sequence[str | None]) -> str:
    """The folder of partition values, with a slash after each level."""
    said = ["".join(f"%{ord(c):02X}" if c in ESCAPED or c < " " else c for c in v) if v else NO_VALUE for v in values]
    return "".join(f"{n}={v}/" for n, v in zip(names, said, strict=True))


class Hashed:
    """A file that is written once from start to end, and hashed as it is."""

    def __init__(self, out):
        self.out, self.sha, self.size, self.closed = out, hashlib.sha256(), 0, False

    def write(self, data) -> int:
        self.sha.update(data)
        self.out.write(data)
        self.size += len(data)
        return len(data)

    def tell(self) -> int:
        return self.size

    def flush(self) -> None:
        self.out.flush()

    def close(self) -> None:
        if not self.closed:
            self.out.close()
        self.closed = True


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: (file, rows, bytes, sha256), files by their paths under the table's folder."""

    files: list[tuple[str, int, int, str]] = field(default_factory=list)


class ContentWriter(DataSourceArrowWriter):
    """Tasks get rows sorted by their folders and keep one file open.

    A file is moved to its name, of task, number and content, when it is whole. The commit names the files of the attempts that count,
    deletes all others, and leaves the list as one small file; until then no reader looks. An abort leaves nothing.
    """

    def __init__(self, path: str, name: str, parts: list[str]):
        self.path, self.name, self.parts = path, name, parts

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        store, root = store_at(f"{self.path}/{self.name}")
        done, now, task = Written(), None, TaskContext.get().partitionId()
        folder, sink, writer, temp, rows, size = "", None, None, "", 0, 0

        def end() -> None:
            nonlocal writer
            if writer is None:
                return
            writer.close()
            sink.close()
            sha = sink.sha.hexdigest()
            file = f"{folder}part-{task:05d}-{len(done.files):05d}-{sha}.parquet"
            store.move(temp, f"{root}/{file}")
            done.files.append((file, rows, sink.size, sha))
            writer = None

        for batch in iterator:
            data = batch.select([c for c in batch.schema.names if not c.startswith(PART)])
            values = list(zip(*[batch.column(f"{PART}{k}").to_pylist() for k in range(len(self.parts))], strict=True)) or [()] * batch.num_rows
            starts = [k for k in range(batch.num_rows) if k == 0 or values[k] != values[k - 1]]
            for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if values[a] != now or rows >= FILE_ROWS or size >= FILE_BYTES:
                    end()
                piece = data.slice(a, b - a)
                if writer is None:
                    now, folder, rows, size = values[a], folder_of(self.parts, values[a]), 0, 0
                    store.create_dir(f"{root}/{folder}".rstrip("/"), recursive=True)
                    temp = f"{root}/{folder}_{uuid.uuid4().hex}"
                    sink = Hashed(store.open_output_stream(temp))
                    writer = pq.ParquetWriter(pa.PythonFile(sink, mode="w"), piece.schema, compression="zstd")
                writer.write_batch(piece)
                rows, size = rows + piece.num_rows, size + piece.nbytes
        end()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = store_at(self.path)
        files = sorted(f for m in messages if m for f in m.files)
        kept = {f"{root}/{self.name}/{f[0]}" for f in files}
        for info in store.get_file_info(fs.FileSelector(f"{root}/{self.name}", recursive=True, allow_not_found=True)):
            if info.is_file and info.path not in kept:
                store.delete_file(info.path)
        store.create_dir(f"{root}/_files", recursive=True)
        with store.open_output_stream(f"{root}/_files/{self.name}.json") as out:
            for f in files:
                out.write((json.dumps(dict(zip(("table_name", "file", "rows", "bytes", "sha256"), (self.name, *f), strict=True))) + "\n").encode())

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = store_at(f"{self.path}/{self.name}")
        if store.get_file_info(root).type == fs.FileType.Directory:
            store.delete_dir(root)


class ContentFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_content_files"

    def writer(self, schema, overwrite: bool) -> ContentWriter:
        return ContentWriter(self.options["path"], self.options["table"], json.loads(self.options["parts"]))


def write_table(df: DataFrame, path: str, name: str, parts: Sequence[str] = (), sort: Sequence[str] = ()) -> None:
    """df as path/name, by partition columns, sorted within; path/_files/name.json lists its files.

    A partition of many rows is split over tasks by the adaptive rebalance. A table without rows has no file and no folder.
    """
    df.sparkSession.dataSource.register(ContentFiles)
    rows = df.hint("rebalance", *parts) if parts else df
    rows = rows.sortWithinPartitions(*parts, *sort) if [*parts, *sort] else rows
    named = [F.col(p).cast("string").alias(f"{PART}{k}") for k, p in enumerate(parts)]
    rows.select(*[c for c in df.columns if c not in parts], *named).write.format(ContentFiles.name()).options(path=path, table=name, parts=json.dumps(list(parts))).mode("append").save()


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(table_name, file, rows, bytes, sha256) of every file of an export."""
    return spark.read.schema(FILES).json(f"{path}/_files")
