"""The document sink as a data source: ``format("documents")`` in batch and stream.

Tasks write JSON lines into a staging folder below ``path`` that readers do
not see (its name starts with an underscore). The commit puts the files of the
tasks that counted into one folder and renames that to ``batch=<id>``, one step on a
file system with atomic renames (HDFS, local disks). A job that fails, or is
killed half-way, leaves no document; a batch that was committed before
its query failed is not written twice.

A frame with the one string column ``value`` is taken as finished JSON documents
(``sinks.documents`` makes them in the JVM); other rows become objects with null fields left out.
Options: ``path``, a folder that all executors share; ``batch``, the id of a batch write (default: the time);
``folder``, the name before the id (default ``batch``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "documents"


@dataclass
class Written(WriterCommitMessage):
    file: str | None    # job and file name below the staging folder; a stream's tasks and commit may be different copies of the writer


def storage(path: str) -> tuple[fs.FileSystem, str]:
    if ":" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def exists(where: fs.FileSystem, path: str) -> bool:
    return where.get_file_info(path).type != fs.FileType.NotFound


class Documents:
    """Staging and commit of one write; the same for batch and stream."""

    def __init__(self, options, overwrite: bool = False):
        if not options.get("path"):
            raise ValueError("documents need a path")
        self.path, self.overwrite, self.job = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex
        self.batch, self.folder = options.get("batch"), options.get("folder", "batch")

    def staging(self, root: str) -> str:
        return f"{root}/_staging/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, root = storage(self.path)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.json"
        out = None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                where.create_dir(self.staging(root), recursive=True)
                out = where.open_output_stream(f"{self.staging(root)}/{name}")
            if batch.schema.names == ["value"] and pa.types.is_string(batch.schema.types[0]):
                lines = [x for x in batch.column(0).to_pylist() if x is not None]
            else:
                lines = [json.dumps({k: v for k, v in row.items() if v is not None}, ensure_ascii=False, default=str) for row in batch.to_pylist()]
            out.write("".join(f"{x}\n" for x in lines).encode())
        if out is not None:
            out.close()
        return Written(f"{self.job}/{name}" if out is not None else None)

    def finish(self, messages: list[Written | None], batch: str) -> None:
        where, root = storage(self.path)
        final = f"{root}/{self.folder}={batch}"
        files = [m.file for m in messages if m is not None and m.file]
        if files and not exists(where, final):
            ready = f"{self.staging(root)}/ready"
            where.create_dir(ready, recursive=True)
            for file in files:
                where.move(f"{root}/_staging/{file}", f"{ready}/{file.split('/')[1]}")
            where.move(ready, final)
        if self.overwrite:
            for old in where.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if old.base_name.startswith(f"{self.folder}=") and old.base_name != f"{self.folder}={batch}":
                    where.delete_dir(old.path)
        self.discard(messages)

    def discard(self, messages: list[Written | None]) -> None:
        where, root = storage(self.path)
        for job in {self.job, *(m.file.split("/")[0] for m in messages if m is not None and m.file)}:
            if exists(where, f"{root}/_staging/{job}"):
                where.delete_dir(f"{root}/_staging/{job}")


class BatchWriter(Documents, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self.finish(messages, self.batch or str(time.time_ns()))

    def abort(self, messages) -> None:
        self.discard(messages)


class StreamWriter(Documents, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.finish(messages, str(batchId))

    def abort(self, messages, batchId: int) -> None:
        self.discard(messages)


class DocumentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options, overwrite)

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("documents")`` known to the session; saying it again does no harm."""
    spark.dataSource.register(DocumentSource)
