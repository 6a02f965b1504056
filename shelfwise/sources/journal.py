"""A journal: small numbered entries, each written once, on the shared file system.

An entry is created only if its number is still free, so of two writers one gets the
number and the other sees the winner's entry and decides anew.  Entries are numbered,
not timed: clocks play no part in which one is newest.  Version pointers, manifests,
ranges of line ids and claims of landed files are journals.

Create-if-absent is a hard link of a finished file on a local file system, and
elsewhere a rename that refuses to replace (atomic on HDFS; an object store needs a
committer that offers the same).  Either way an entry appears with all its text.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession


class Folder:
    """A folder of small files: list, read, create if absent, delete."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(self.conf)
        uri = self.fs.makeQualified(self.path).toUri()
        self.local = uri.getPath() if uri.getScheme() == "file" else None

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def names(self) -> list[str]:
        if self.local is not None:
            return os.listdir(self.local) if os.path.isdir(self.local) else []
        if not self.fs.exists(self.path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path)]

    def read(self, name: str) -> str:
        if self.local is not None:
            with open(f"{self.local}/{name}", encoding="utf-8") as f:
                return f.read()
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """False if there is a file of that name already."""
        draft = f".{uuid.uuid4().hex}"
        if self.local is not None:
            os.makedirs(self.local, exist_ok=True)
            with open(f"{self.local}/{draft}", "w", encoding="utf-8") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(f"{self.local}/{draft}", f"{self.local}/{name}")
            except FileExistsError:
                return False
            finally:
                os.unlink(f"{self.local}/{draft}")
            return True
        out = self.fs.create(self._at(draft))
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        none = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        none[0] = rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path.toUri(), self.conf).rename(
                self._at(draft), self._at(name), none)
        except Exception:
            self.fs.delete(self._at(draft), False)
            if self.fs.exists(self._at(name)):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), False)


class Journal:
    """Entries 1, 2, 3, ... (JSON objects) in a folder of their own."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self._folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        """Numbers of the entries still there, ascending."""
        return sorted(int(n[:-5]) for n in self._folder.names() if n.endswith(".json") and n[0] != ".")

    def read(self, number: int) -> dict:
        return json.loads(self._folder.read(f"{number:020d}.json"))

    def last(self) -> dict | None:
        """The newest entry, if there is one."""
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def newest_first(self) -> Iterator[dict]:
        for number in reversed(self.numbers()):
            yield self.read(number)

    def append(self, decide: Callable[[dict | None], dict | None]) -> dict | None:
        """Write ``decide(last entry)`` as the next entry and return it.

        If another writer takes the number first, ``decide`` is asked again with that
        writer's entry; if it returns None nothing is written."""
        while True:
            numbers = self.numbers()
            number = numbers[-1] if numbers else 0
            entry = decide(self.read(number) if numbers else None)
            if entry is None or self._folder.create(f"{number + 1:020d}.json", json.dumps(entry, sort_keys=True)):
                return entry

    def prune(self, keep: int) -> int:
        """Delete all but the newest ``keep`` entries (one at least); numbers go on rising."""
        old = self.numbers()[:-max(1, keep)]
        for number in old:
            self._folder.delete(f"{number:020d}.json")
        return len(old)
