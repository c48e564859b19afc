"""A replayable log of text records: topics without a broker, as a Spark data source.

A log is a folder.  Tasks write segment files (one JSON string a line); the driver then
adds one manifest, which gives every segment its partition and first offset.  Only what a
manifest names exists: files of failed tasks and of aborted writes are never read.  A
stream's writer is known by its ``writer`` name and the manifest keeps its last batch, so a
repeated batch adds nothing.  A log has one writing query at a time.

A stream's position is the number of the last manifest read, with the next offset of every
partition; a batch reads the manifests after its start up to its end, so a restarted query reads the same
records again and what a micro-batch reads does not depend on the length of the log.

Register with ``spark.dataSource.register(LineLog)``; format name ``linelog``.  ``path`` must be
reachable from every executor (any file system that pyarrow can open).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceStreamWriter,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

SCHEMA = "value STRING, partition INT, offset BIGINT"
SEGMENT_LINES = 1_000_000    # records a segment, so that a reading task has no more


class Store:
    """Files of a log: segments, and manifests numbered from 1."""

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def _fs(self):
        from pyarrow import fs

        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def manifests(self) -> list[int]:
        from pyarrow import fs

        system, root = self._fs()
        found = system.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
        return sorted(int(f.base_name) for f in found if f.base_name.isdigit())

    def manifest(self, number: int) -> dict:
        """What the manifest says; 0 is the empty log."""
        if number == 0:
            return {"segments": [], "next": {}, "writers": {}}
        system, root = self._fs()
        with system.open_input_stream(f"{root}/manifests/{number}") as f:
            return json.loads(f.read())

    def add_manifest(self, number: int, content: dict) -> None:
        system, root = self._fs()
        system.create_dir(f"{root}/manifests", recursive=True)
        draft = f"{root}/manifests/.{number}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as f:
            f.write(json.dumps(content).encode())
        system.move(draft, f"{root}/manifests/{number}")

    def segment(self, values: list[str | None]) -> str:
        system, root = self._fs()
        system.create_dir(f"{root}/segments", recursive=True)
        name = uuid.uuid4().hex
        with system.open_output_stream(f"{root}/segments/{name}") as f:
            for v in values:
                f.write(json.dumps(v).encode() + b"\n")
        return name

    def read(self, name: str) -> Iterator[str | None]:
        import io

        system, root = self._fs()
        with system.open_input_file(f"{root}/segments/{name}") as f:
            for line in io.TextIOWrapper(f, "utf-8", newline="\n"):
                yield json.loads(line)

    def delete(self, names: list[str]) -> None:
        system, root = self._fs()
        for name in names:
            system.delete_file(f"{root}/segments/{name}")


@dataclass
class Segment(InputPartition):
    name: str
    partition: int
    base: int


@dataclass
class Written(WriterCommitMessage):
    segments: list[tuple[str, int, int]]    # name, partition, lines


class _Writing:
    """What the batch and the stream writer share."""

    def __init__(self, options: dict[str, str]) -> None:
        self.store = Store(options["path"])
        self.partitions = int(options.get("partitions", 8))
        self.lines = int(options.get("segmentlines", SEGMENT_LINES))
        self.writer = options.get("writer", "")

    def write(self, iterator) -> Written:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId() % self.partitions
        done, held = [], []
        for row in iterator:
            held.append(row["value"])
            if len(held) == self.lines:
                done.append((self.store.segment(held), partition, len(held)))
                held = []
        if held:
            done.append((self.store.segment(held), partition, len(held)))
        return Written(done)

    def publish(self, messages: list[Written | None], batch: int | None) -> None:
        """One manifest more; nothing but the files' removal for a batch that the log has."""
        numbers = self.store.manifests()
        last = self.store.manifest(numbers[-1] if numbers else 0)
        segments = [s for m in messages if m is not None for s in m.segments]
        writers = dict(last["writers"])
        if batch is not None:
            if batch <= writers.get(self.writer, -1):
                self.store.delete([name for name, _, _ in segments])
                return
            writers[self.writer] = batch
        ends, placed = dict(last["next"]), []
        for name, partition, lines in segments:
            base = ends.get(str(partition), 0)
            placed.append({"name": name, "partition": partition, "base": base})
            ends[str(partition)] = base + lines
        self.store.add_manifest((numbers[-1] if numbers else 0) + 1, {"segments": placed, "next": ends, "writers": writers})

    def discard(self, messages: list[Written | None]) -> None:
        self.store.delete([name for m in messages if m is not None for name, _, _ in m.segments])


class LineLogWriter(_Writing, DataSourceWriter):
    def commit(self, messages) -> None:
        self.publish(messages, None)

    def abort(self, messages) -> None:
        self.discard(messages)


class LineLogStreamWriter(_Writing, DataSourceStreamWriter):
    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options)
        if not self.writer:
            raise ValueError("a stream needs the option 'writer', a name of its own for every checkpoint")

    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self.discard(messages)


def _records(store: Store, segment: Segment) -> Iterator[tuple]:
    for i, value in enumerate(store.read(segment.name)):
        yield value, segment.partition, segment.base + i


class LineLogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.store = Store(options["path"])

    def partitions(self) -> list[Segment]:
        return [Segment(**s) for n in self.store.manifests() for s in self.store.manifest(n)["segments"]]

    def read(self, partition: Segment) -> Iterator[tuple]:
        # (an empty log has no partition, and Spark then asks for None)
        return _records(self.store, partition) if partition is not None else iter([])


class LineLogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.store = Store(options["path"])
        self.start = options.get("startingoffsets", "earliest")
        if self.start not in ("earliest", "latest"):
            raise ValueError("startingOffsets is earliest or latest")

    def _at(self, number: int) -> dict:
        return {"manifest": number, "next": self.store.manifest(number)["next"]}

    def initialOffset(self) -> dict:
        return self._at(0) if self.start == "earliest" else self.latestOffset()

    def latestOffset(self) -> dict:
        numbers = self.store.manifests()
        return self._at(numbers[-1] if numbers else 0)

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return [Segment(**s) for n in range(start["manifest"] + 1, end["manifest"] + 1)
                for s in self.store.manifest(n)["segments"]]

    def read(self, partition: Segment) -> Iterator[tuple]:
        return _records(self.store, partition) if partition is not None else iter([])


class LineLog(DataSource):
    """``spark.read`` / ``readStream`` / ``write`` / ``writeStream`` with format ``linelog``."""

    @classmethod
    def name(cls) -> str:
        return "linelog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineLogReader:
        return LineLogReader(self.options)

    def streamReader(self, schema) -> LineLogStreamReader:
        return LineLogStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> LineLogWriter:
        if overwrite:
            raise ValueError("a log is only appended to")
        return LineLogWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> LineLogStreamWriter:
        return LineLogStreamWriter(self.options)
