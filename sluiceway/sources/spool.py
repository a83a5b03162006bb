"""A message spool: a shared folder as a source and a sink of keyed messages, for streams and bounded sets.

Writers put messages into segment files; a commit names the segments of one batch in a log whose entries are numbered, so a
batch appears wholly or not at all, and in order. An entry carries the name of its writer and the number of its batch: a batch
that is written again adds nothing. Readers take the entries after their offset. With a ``subscription`` each micro-batch that
is done acknowledges its entries; ``trim`` deletes what all subscriptions have acknowledged.

The folder must be mounted at the same path on the driver and all executors.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

# Ships this small module with the readers and writers, so the executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "spool"
SCHEMA = "key string, value binary"
_ARROW = pa.schema([("key", pa.string()), ("value", pa.binary())])


def register_spool(spark: SparkSession) -> None:
    """Make ``format("spool")`` known to a session."""
    spark.dataSource.register(MessageSpool)


class _Log:
    """The numbered entries of a spool. An entry is a file that is created once, under the first free number."""

    def __init__(self, path: str):
        self.path = _mounted(path).rstrip("/")
        self.segments, self.entries, self.marks = (f"{self.path}/{name}" for name in ("segments", "log", "subscriptions"))
        for folder in (self.segments, self.entries, self.marks):
            os.makedirs(folder, exist_ok=True)

    def numbers(self) -> dict[int, str]:
        """Entries by number, with the names of their files."""
        names = sorted(n for n in os.listdir(self.entries) if n.endswith(".json"))
        return {int(n.split(".")[0]): n for n in names}

    def end(self) -> int:
        return max(self.numbers(), default=-1) + 1

    def files(self, start: int, end: int) -> list[str]:
        found = []
        for number, name in self.numbers().items():
            if start <= number < end:
                with open(f"{self.entries}/{name}") as file:
                    found += json.load(file)["files"]
        return found

    def add(self, files: list[str], writer: str, batch: str) -> bool:
        """Publish the files of a batch; False if an entry of that writer and batch exists."""
        mark = f"{writer}.{batch}.json"
        draft = f"{self.path}/{uuid.uuid4().hex}"
        with open(draft, "w") as file:
            json.dump({"files": files, "writer": writer, "batch": batch}, file)
        try:
            while True:
                there = self.numbers()
                if any(name.split(".", 1)[1] == mark for name in there.values()):
                    return False
                number = max(there, default=-1) + 1
                # A writer holds the number by a file of that name, then the entry appears under it in one step.
                try:
                    os.link(draft, f"{self.entries}/{number:012d}")
                except FileExistsError:
                    self._show(number)
                    continue
                self._show(number)
                return True
        finally:
            os.remove(draft)

    def _show(self, number: int) -> None:
        """Show the entry that has taken a number; whoever meets it may do so, should its writer have died before."""
        taken = f"{self.entries}/{number:012d}"
        try:
            with open(taken) as file:
                entry = json.load(file)
            os.rename(taken, f"{taken}.{entry['writer']}.{entry['batch']}.json")
        except FileNotFoundError:
            pass

    def acknowledge(self, subscription: str, end: int) -> None:
        draft = f"{self.path}/{uuid.uuid4().hex}"
        with open(draft, "w") as file:
            json.dump(end, file)
        os.replace(draft, f"{self.marks}/{subscription}")

    def acknowledged(self) -> int:
        """The offset up to which all subscriptions are done; 0 without any."""
        ends = []
        for name in os.listdir(self.marks):
            with open(f"{self.marks}/{name}") as file:
                ends.append(json.load(file))
        return min(ends, default=0)


def trim(path: str) -> int:
    """Delete the segments of entries that all subscriptions have acknowledged, and return their number.

    The entries stay, as small files: they tell batches that are written again.
    """
    log = _Log(path)
    done = 0
    for file in log.files(0, log.acknowledged()):
        if os.path.exists(f"{log.segments}/{file}"):
            os.remove(f"{log.segments}/{file}")
            done += 1
    return done


@dataclass
class _Segment(InputPartition):
    file: str


@dataclass
class _Written(WriterCommitMessage):
    file: str | None


def _read(path: str, segment: _Segment) -> Iterator[pa.RecordBatch]:
    with pa.OSFile(f"{path}/segments/{segment.file}") as file, pa.ipc.open_stream(file) as stream:
        yield from stream


def _mounted(path: str) -> str:
    """A path of the file system; ``file:`` in front of it is left out."""
    return urlsplit(path).path if path.startswith("file:") else path


class MessageSpool(DataSource):
    """Options: ``path``; to read, ``subscription``; to write, ``writer`` and, for bounded sets, ``batch``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_mounted(self.options["path"]))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_mounted(self.options["path"]), self.options.get("subscription"))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(_mounted(self.options["path"]), self.options.get("writer", "bounded"), self.options.get("batch") or uuid.uuid4().hex)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(_mounted(self.options["path"]), self.options.get("writer", "stream"), "")


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        log = _Log(self.path)
        return [_Segment(f) for f in log.files(0, log.end())] or [_Segment("")]

    def read(self, partition):
        return _read(self.path, partition) if partition.file else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, subscription: str | None):
        self.path, self.subscription = path, subscription

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        return {"entry": _Log(self.path).end()}

    def partitions(self, start: dict, end: dict):
        return [_Segment(f) for f in _Log(self.path).files(start["entry"], end["entry"])]

    def read(self, partition):
        return _read(self.path, partition)

    def commit(self, end: dict) -> None:
        if self.subscription:
            _Log(self.path).acknowledge(self.subscription, end["entry"])


class _Segments:
    """What both writers share: a task writes one segment, and a failed job leaves none."""

    def __init__(self, path: str, writer: str, batch: str):
        if "." in writer or "/" in writer:
            raise ValueError("the name of a writer has no dot and no slash")
        self.path, self.name, self.batch = path, writer, batch
        _Log(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        file, sink = f"{uuid.uuid4().hex}.arrow", None
        place = f"{self.path}/segments/{file}"
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if sink is None:
                    sink = pa.ipc.new_stream(f"{place}.open", _ARROW)
                rows = pa.Table.from_batches([batch]).select(_ARROW.names).cast(_ARROW)
                sink.write_table(rows)
        finally:
            if sink is not None:
                sink.close()
        if sink is None:
            return _Written(None)
        os.rename(f"{place}.open", place)
        return _Written(file)

    def publish(self, messages, batch: str) -> None:
        files = [m.file for m in messages if m is not None and m.file]
        if not _Log(self.path).add(files, self.name, batch):
            self.remove(messages)

    def remove(self, messages) -> None:
        for m in messages:
            if m is not None and m.file and os.path.exists(f"{self.path}/segments/{m.file}"):
                os.remove(f"{self.path}/segments/{m.file}")


class _Writer(_Segments, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self.publish(messages, self.batch)

    def abort(self, messages) -> None:
        self.remove(messages)


class _StreamWriter(_Segments, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, str(batchId))

    def abort(self, messages, batchId: int) -> None:
        self.remove(messages)
