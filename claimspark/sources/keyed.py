"""Keyed update by file: only the files that hold a changed key are written again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimspark.sources.files import Folder, Log
from claimspark.sources.tables import update_by_key

FILE = "_arquivo"
#: Rows that a file holds at most, as far as its keys allow: a task reads and writes one file, however large the table.
FILE_ROWS = 1 << 20


class Conflict(RuntimeError):
    """Another job changed the table each time this one was about to."""


class KeyedTable:
    """A table in files that each hold a range of ``key`` (a whole-number or text column).

    A manifest names the table's files with the smallest and largest key of each. An update finds the files whose range
    holds a changed key, writes these anew beside the old ones and adds a manifest in which they take their place;
    a reader sees the table before or after it, never between. Old files stay for readers of earlier manifests until
    ``tidy``. The manifest has an entry per file, as Spark's own listing of a folder does.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.log = Log(spark, f"{path}/_manifests")

    def _write(self, rows: DataFrame, files: int) -> list[dict]:
        """Write rows as files that hold a range of the key; returns their manifest entries."""
        name = uuid.uuid4().hex
        target = f"{self.path}/data/{name}"
        rows.select(self.schema.fieldNames()).repartitionByRange(max(files, 1), self.key).write.parquet(target)
        stored = self.spark.read.schema(self.schema).parquet(target)
        # by file: one row each, with the extremes that the range and the files' own statistics already bound
        whole = F.element_at(F.split(F.input_file_name(), "/"), -1)
        ends = stored.select(whole.alias(FILE), self.key).groupBy(FILE)
        found = ends.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count("*").alias("rows")).collect()
        return [{"file": f"data/{name}/{r[FILE]}", "low": r["low"], "high": r["high"], "rows": r["rows"]} for r in found]

    def create(self, rows: DataFrame, files: int = 1) -> None:
        """Write the table's first version, in ``files`` files or more: one holds ``FILE_ROWS`` rows at most."""
        files = max(files, -(-rows.count() // FILE_ROWS))
        if not self.log.add(1, {"files": self._write(rows, files)}):
            raise Conflict(f"{self.path} exists")

    def version(self) -> int:
        return self.log.last()[0]

    def manifest(self) -> list[dict]:
        return (self.log.last()[1] or {"files": []})["files"]

    def read(self, files: list[dict] | None = None) -> DataFrame:
        """The table, or some of its files."""
        wanted = self.manifest() if files is None else files
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f['file']}" for f in wanted))

    def holding(self, keys: DataFrame, files: list[dict]) -> list[dict]:
        """The files whose range holds a key of ``keys``."""
        # ranges that overlap are one stretch, so that a key lies in one stretch at most
        stretches: list[list] = []
        for f in sorted((f for f in files if f["low"] is not None), key=lambda f: f["low"]):
            if stretches and f["low"] <= stretches[-1][1]:
                stretches[-1][1] = max(stretches[-1][1], f["high"])
                stretches[-1][2].append(f)
            else:
                stretches.append([f["low"], f["high"], [f]])
        if not stretches:
            return []
        low, high = (np.array([s[i] for s in stretches]) for i in (0, 1))

        @F.pandas_udf("int")
        def stretch(value: pd.Series) -> pd.Series:
            at = np.searchsorted(low, value.to_numpy(), side="right") - 1
            return pd.Series(np.where((at >= 0) & (value.to_numpy() <= high[np.maximum(at, 0)]), at, -1))

        hit = keys.select(F.col(self.key).alias("k")).where("k is not null").distinct()
        # the numbers of stretches, as many as there are files at most
        numbers = [r[0] for r in hit.select(stretch("k").alias("s")).where("s >= 0").distinct().collect()]
        return [f for n in sorted(numbers) for f in stretches[n][2]]

    def rewrite(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], attempts: int = 5) -> int:
        """Write the files that hold one of ``keys`` anew with ``change`` of their rows; returns their number.

        ``change`` gives every row it gets, with the same key. If another job was faster, the files are
        looked up and written again.
        """
        for _ in range(attempts):
            version, entry = self.log.last()
            files = (entry or {"files": []})["files"]
            old = self.holding(keys, files)
            if not old:
                return 0
            files_now = max(len(old), -(-sum(f["rows"] for f in old) // FILE_ROWS))
            new = self._write(change(self.read(old)), files_now)
            if sum(f["rows"] for f in new) != sum(f["rows"] for f in old):
                raise ValueError("a change must keep all rows")
            gone = {f["file"] for f in old}
            if self.log.add(version + 1, {"files": [f for f in files if f["file"] not in gone] + new}):
                return len(old)
            Folder(self.spark, f"{self.path}/{new[0]['file'].rpartition('/')[0]}").delete()
        raise Conflict(self.path)

    def update(self, changes: DataFrame, keys: list[str], cols: list[str]) -> int:
        """Set ``cols`` where ``changes`` (one row per key; with the table's key) has the ``keys``."""
        if self.key not in keys:
            raise ValueError(f"{self.key} must be among the keys")
        return self.rewrite(changes, lambda rows: update_by_key(rows, changes, keys, cols))

    def tidy(self) -> None:
        """Remove files that the last manifest does not name. Only while no other job reads or writes the table."""
        named = {f["file"] for f in self.manifest()}
        for entry in self.log.entries():
            for f in entry["files"]:
                if f["file"] not in named:
                    Folder(self.spark, self.path).delete(f["file"])
