"""Small files in a table's folder that must appear whole and only once: logs of numbered entries.

Spark writes rows; what ties several writes together (which files make up a table, which numbers are taken) is an
entry of such a log. An entry is written beside and put into place by a step that fails if the place is
taken, so of two writers one wins and the other sees it.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

DIGITS = 12


class Folder:
    """A folder of the file system that Spark finds behind a path; one on this machine's disk is used as it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        here = self._path(self.path)
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = here.getFileSystem(self._conf)
        self._jvm = jvm
        uri = urlparse(self._fs.makeQualified(here).toString())
        self.local = unquote(uri.path) if uri.scheme == "file" else None

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def names(self, inside: str = "") -> list[str]:
        """Files directly below, without hidden ones."""
        at = self._at(inside)
        if not self._fs.exists(at):
            return []
        found = [(s.getPath().getName(), s.isFile()) for s in self._fs.listStatus(at)]
        return sorted(n for n, is_file in found if is_file and not n.startswith(("_", ".")))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def claim(self, name: str, text: str) -> bool:
        """Write a whole new file; False, and nothing written, if there is one of that name.

        Needs a file system whose rename does not replace, as HDFS and disks have.
        """
        beside = f".{name}.{uuid.uuid4().hex}"
        if self.local:
            os.makedirs(self.local, exist_ok=True)
            with open(f"{self.local}/{beside}", "w", encoding="utf-8") as f:
                f.write(text)
            try:
                os.link(f"{self.local}/{beside}", f"{self.local}/{name}")
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(f"{self.local}/{beside}")
        stream = self._fs.create(self._at(beside), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        done = not self._fs.exists(self._at(name)) and self._fs.rename(self._at(beside), self._at(name))
        if not done:
            self._fs.delete(self._at(beside), False)
        return done

    def move(self, name: str, to: str) -> None:
        self._fs.rename(self._at(name), self._at(to))

    def delete(self, name: str = "") -> None:
        """Remove a file or folder below, or the folder itself; it may be gone already."""
        self._fs.delete(self._at(name), True)


class Log:
    """Entries 1, 2, ... of a folder, each written once and never changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def entries(self) -> list[dict]:
        return [json.loads(self.folder.read(n)) for n in self.folder.names()]

    def last(self) -> tuple[int, dict | None]:
        """Number and content of the last entry; 0 and None of an empty log."""
        names = self.folder.names()
        return (int(names[-1]), json.loads(self.folder.read(names[-1]))) if names else (0, None)

    def add(self, number: int, entry: dict) -> bool:
        """Write entry ``number``; False if another writer did so first."""
        return self.folder.claim(f"{number:0{DIGITS}d}", json.dumps(entry))
