"""A durable number sequence shared by concurrent jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from claimspark.sources.files import Log


class Sequence:
    """Numbers given out in blocks; a block once given is never given again, whatever becomes of its job.

    Blocks are entries of a log below ``base``. Two jobs that ask at the same time write the same entry;
    one succeeds, the other asks again behind it. A block with a ``key`` belongs to that key: a job that is run again
    with the same key and count gets the same numbers, so its rows replace those of its first run.
    """

    def __init__(self, spark: SparkSession, base: str, name: str, start: int = 1):
        self.log = Log(spark, f"{base}/_sequences/{name}")
        self.start = start

    def lease(self, count: int, key: str | None = None) -> int:
        """First of ``count`` numbers in a row."""
        if count < 0:
            raise ValueError("a block has no negative length")
        if key is not None:
            for entry in self.log.entries():
                if entry["key"] == key and entry["count"] == count:
                    return entry["first"]
        while True:
            number, last = self.log.last()
            first = last["first"] + last["count"] if last else self.start
            if self.log.add(number + 1, {"first": first, "count": count, "key": key}):
                return first
