"""Commit log of a stored table: numbered files, each put only if its number is free.

A writer first writes data under a name of its own, which nobody reads, and then
commits one small JSON file ``<path>/_commits/<number>.json`` that names it. A
writer that fails before the commit leaves nothing visible. Of two writers that
want the same number one gets it; the other one reads the log again and takes the
next. Readers open what the log names and list nothing else.

A commit file appears whole or not at all: it is written beside the log and put
in place by a rename that does not overwrite (a hard link in a local folder). The
file system has to do that in one step, as HDFS does; an object store without such
a rename is no place for the log.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_commits"


class CommitLog:
    """The commits below one path, numbered from 1 without gaps."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self._path(path)
        self.fs = self.root.getFileSystem(self.conf)
        self.folder = self._path(f"{path}/{FOLDER}")

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, folder) -> list[str]:
        if not self.fs.exists(folder):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(folder)]

    def _file(self, number: int):
        return self._path(f"{self.folder}/{number:012d}.json")

    def last(self) -> int:
        """The newest commit's number; 0 without one."""
        numbers = [int(n[:-5]) for n in self._names(self.folder) if n.endswith(".json") and not n.startswith(".")]
        return max(numbers, default=0)

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._file(number))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> dict | None:
        number = self.last()
        return self.read(number) if number else None

    def put(self, number: int, entry: dict) -> bool:
        """Commit ``entry`` under ``number``; False if another writer has it already."""
        self.fs.mkdirs(self.folder)
        draft, target = self._path(f"{self.folder}/.draft-{uuid.uuid4().hex}"), self._file(number)
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        finally:
            stream.close()
        try:
            return self._put_in_place(draft, target)
        finally:
            self.fs.delete(draft, False)

    def _put_in_place(self, draft, target) -> bool:
        if self.fs.getUri().getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        hadoop = self.jvm.org.apache.hadoop.fs
        none = self.jvm.java.lang.reflect.Array.newInstance(hadoop.Options.Rename.NONE.getClass(), 1)
        none[0] = hadoop.Options.Rename.NONE
        try:
            hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(draft, target, none)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def commit(self, entry: Callable[[dict | None], dict]) -> tuple[int, dict]:
        """Put ``entry(newest commit)`` under the next number, again after each lost race."""
        while True:
            number = self.last()
            made = entry(self.read(number) if number else None)
            if self.put(number + 1, made):
                return number + 1, made

    def partitions(self, column: str) -> list[str]:
        """Values of the folders ``column=value`` directly below the path."""
        start = f"{column}="
        return [n[len(start) :] for n in self._names(self.root) if n.startswith(start)]

    def delete(self, below: str) -> None:
        self.fs.delete(self._path(f"{self.root}/{below}"), True)
