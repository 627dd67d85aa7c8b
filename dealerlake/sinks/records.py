"""Which files make up a table: a small JSON record for each version of it, written once and never changed.

A version appears by renaming a finished file to its number, which fails where that number is taken.
So a record is there whole or not at all, and of two loads that started from one version the second is
refused. This needs a file system whose rename is atomic and refuses an existing target, as HDFS and
local disks do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from dealerlake.operators import LoadRejected


@dataclass(frozen=True)
class Record:
    """``places`` maps partition folder to the run folder that holds it; ``location`` is a whole table's folder.

    A table that is kept beside another one has a location, and the other one's places that it covers.
    """

    version: int
    location: str | None = None
    places: dict[str, str] | None = None
    buckets: int | None = None


class Records:
    """Records of the tables under ``root``, as ``<table>/versions/<number>.json``."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        self._jvm = jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils.toString
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        at = self._path(root)
        self._fs = at.getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.makeQualified(at).toUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def current(self, table: str) -> Record | None:
        numbers = self._numbers(table)
        return self.version(table, numbers[-1]) if numbers else None

    def version(self, table: str, number: int) -> Record | None:
        """The record with that number, None where it is gone."""
        held = self._read(self._file(table, number))
        return None if held is None else Record(number, **held)

    def write(self, table: str, record: Record) -> None:
        """Make ``record`` the table's newest version; refused where its number is taken."""
        held = {name: value for name, value in vars(record).items() if name != "version" and value is not None}
        if not self._write_once(self._file(table, record.version), held):
            raise LoadRejected(f"{table}: another load finished meanwhile; run this one again")

    def batch(self, table: str, batch: str) -> dict[str, int] | None:
        """What was counted when the batch was staged, None where it was not, or not to its end."""
        return self._read(self._batch_file(table, batch))

    def begin_batch(self, table: str, batch: str) -> bool:
        """Whether nobody has begun to stage the batch before."""
        return self._write_once(f"{self._batch_file(table, batch)}.begun", {})

    def finish_batch(self, table: str, batch: str, counted: dict[str, int]) -> None:
        """Mark the batch as staged. Where another session has done so for the same batch, its mark stays."""
        self._write_once(self._batch_file(table, batch), counted)

    def _write_once(self, file: str, held: dict) -> bool:
        """Whether ``file`` was made, whole; False where it is there already."""
        draft = self._path(f"{file.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(held).encode()))
        out.close()
        try:
            target = self._fs.makeQualified(self._path(file))
            self._context.rename(self._fs.makeQualified(draft), target, self._no_options)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def _read(self, file: str) -> dict | None:
        path = self._path(file)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(self._text(stream, "UTF-8"))
        finally:
            stream.close()

    def holds_data(self, table: str) -> bool:
        """Whether files of an earlier run or of the table's first folder are there."""
        return any(self._names(f"{self.root}/{table}/{folder}") for folder in ("runs", "base"))

    def has_folder(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def sweep(self, table: str, keep_for: timedelta) -> list[str]:
        """Delete records and run folders that only versions replaced before ``keep_for`` refer to; their names.

        A version counts from when its successor appeared. Folders younger than that stay too, since a
        load under way may be writing them.
        """
        oldest = (datetime.now() - keep_for).timestamp() * 1000
        numbers = self._numbers(table)
        written = {n: self._fs.getFileStatus(self._path(self._file(table, n))).getModificationTime() for n in numbers}
        dead = [n for n, successor in zip(numbers, numbers[1:], strict=False) if written[successor] < oldest]
        held = set()
        for number in numbers:
            record = self.version(table, number)
            if number not in dead and record:
                held |= set((record.places or {}).values()) | {(record.location or "").rsplit("/", 1)[-1]}
        gone = []
        for name, modified in self._names(f"{self.root}/{table}/runs").items():
            if name not in held and modified < oldest:
                self._fs.delete(self._path(f"{self.root}/{table}/runs/{name}"), True)
                gone.append(name)
        for number in dead:
            self._fs.delete(self._path(self._file(table, number)), False)
        return gone

    def _file(self, table: str, number: int) -> str:
        return f"{self.root}/{table}/versions/{number:09d}.json"

    def delete(self, files: list[str]) -> None:
        for file in files:
            self._fs.delete(self._path(self._jvm.java.net.URI(file)), False)

    def _batch_file(self, table: str, batch: str) -> str:
        return f"{self.root}/{table}/batches/{batch}.json"

    def _numbers(self, table: str) -> list[int]:
        names = self._names(f"{self.root}/{table}/versions")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def _names(self, folder: str) -> dict[str, int]:
        """Name -> time of change of what the folder holds."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(path)}
