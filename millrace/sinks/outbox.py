"""Payloads of a stream into an outbox, each once: prepare, commit, abort, and a ledger of epochs.

Tasks write their payloads to staging files. When all have, the driver notes the epoch with its staged files in the ledger
(prepared), moves the files into the epoch's folder, and notes that it is done. An epoch that comes again, because the query
was killed before Spark knew that it was written, finds its note: a done epoch drops what was staged anew, a prepared one
finishes with the files it was prepared with. Only names pass through the driver. A sender takes whole epochs from the
outbox, in order; their numbers tell it what it has sent.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.envelope import require_columns
from millrace.session import ship_package
from millrace.streaming.sinks import checkpointed

NAME = "payload_outbox"


@dataclass
class Staged(WriterCommitMessage):
    file: str | None


class PayloadOutbox(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return OutboxWriter(self.options["path"], schema.names.index("body"))


class OutboxWriter(DataSourceStreamWriter):
    """``path/staging`` holds files that are not committed, ``path/ledger`` the notes, ``path/sent/epoch=n`` the payloads, one
    a line."""

    def __init__(self, path: str, body: int) -> None:
        self.path, self.body = path, body

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        path = self.path.removeprefix("file:") if not self.path.startswith("file://") else self.path
        fs, root = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        return fs, root.rstrip("/")

    def write(self, iterator: Iterator[Row]) -> Staged:
        fs, root = self._fs()
        first = next(iterator, None)
        if first is None:
            return Staged(None)
        fs.create_dir(f"{root}/staging", recursive=True)
        name = f"staging/{uuid.uuid4().hex}.jsonl"
        with fs.open_output_stream(f"{root}/{name}") as out:
            out.write(first[self.body].encode() + b"\n")
            for row in iterator:
                out.write(row[self.body].encode() + b"\n")
        return Staged(name)

    @staticmethod
    def _there(fs: pafs.FileSystem, path: str) -> bool:
        return fs.get_file_info(path).type != pafs.FileType.NotFound

    def _note(self, fs: pafs.FileSystem, path: str, content: object) -> None:
        """A note is there whole or not at all."""
        beside = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(beside) as out:
            out.write(json.dumps(content).encode())
        fs.move(beside, path)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        fs, root = self._fs()
        fs.create_dir(f"{root}/ledger", recursive=True)
        prepared, done = f"{root}/ledger/{batchId}.prepared", f"{root}/ledger/{batchId}.done"
        staged = [m.file for m in messages if m is not None and m.file]
        if self._there(fs, done):
            return self._drop(fs, root, staged)
        if self._there(fs, prepared):
            with fs.open_input_stream(prepared) as note:
                files = json.loads(note.read())
            self._drop(fs, root, [name for name in staged if name not in files])
        else:
            files = staged
            self._note(fs, prepared, files)
        folder = f"{root}/sent/epoch={batchId}"
        if files:
            fs.create_dir(folder, recursive=True)
        for i, name in enumerate(files):
            if self._there(fs, f"{root}/{name}"):  # else it was moved before the query was killed
                fs.move(f"{root}/{name}", f"{folder}/part-{i:05d}.jsonl")
        self._note(fs, done, len(files))

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        fs, root = self._fs()
        self._drop(fs, root, [m.file for m in messages if m is not None and m.file])

    def _drop(self, fs: pafs.FileSystem, root: str, names: list[str]) -> None:
        for name in names:
            if self._there(fs, f"{root}/{name}"):
                fs.delete_file(f"{root}/{name}")


def stream_to_outbox(payloads: DataFrame, path: str, checkpoint: str, *, interval_ms: int | None = None) -> StreamingQuery:
    """Put the ``body`` of each row of a stream (see ``pack_json_batches``) into the outbox at ``path``, once. A body is one
    line: JSON made by Spark has no line breaks."""
    require_columns(payloads, ["body"], "stream_to_outbox")
    ship_package(payloads.sparkSession)
    payloads.sparkSession.dataSource.register(PayloadOutbox)
    writer = payloads.select("body").writeStream.format(NAME).option("path", path)
    return checkpointed(writer, checkpoint, interval_ms).start()


def sent_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``body`` and ``epoch`` of the payloads in an outbox."""
    return spark.read.schema("value string, epoch bigint").text(f"{path}/sent").withColumnRenamed("value", "body")
