"""Packing of documents into token windows, planned by non-negative least squares on the length histogram.

Documents are cut at whole windows; what is left is a piece shorter than the window. The
number of pieces per length is a histogram of fixed size. Combinations of two and three lengths
that fill a window exactly are its columns; non-negative least squares finds how often
each is to be used, the counts are rounded, and pieces take places by their rank within
their length. Pieces without a place are packed greedily one behind another and
cut where a window is full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import by_batches, keep, partitions
from claimspark.llm.tokenstore import _rows

WINDOW = 2048
#: Lengths from which combinations of three are formed: the most frequent ones.
BASIS, STEPS = 192, 200
PIECES = "doc_id long, start long, length long, doc_tokens long, crc long, part int, at long, rank long, ids binary"


def combinations(histogram: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: unused) that fill the window, of lengths that occur."""
    window = len(histogram) - 1
    have = np.flatnonzero(histogram[:window])
    pairs = np.array([(a, window - a, 0) for a in have if a <= window - a and histogram[window - a]], np.int64).reshape(-1, 3)
    often = np.sort(have[np.argsort(-histogram[have], kind="stable")[:BASIS]])
    a, b = (x.ravel() for x in np.meshgrid(often, often))
    c = window - a - b
    fits = (a <= b) & (b <= c) & (c > 0)
    triples = np.stack((a, b, c), 1)[fits]
    return np.concatenate((pairs, triples[histogram[triples[:, 2]] > 0])) if len(triples) else pairs


def repeats(histogram: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Non-negative least squares: repeat counts whose piece counts come closest to the histogram.

    Multiplicative steps from a positive start, which keep every count at 0 or above.
    """
    h = histogram.astype(float).copy()
    h[0] = 0
    x = np.full(len(columns), max(h.sum(), 1.0) / max(len(columns), 1) / 3)
    used = columns > 0
    pull = (h[columns] * used).sum(1)
    for _ in range(STEPS):
        fit = np.bincount(columns.ravel(), (x[:, None] * used).ravel(), len(h))
        x *= pull / np.maximum((fit[columns] * used).sum(1), 1e-12)
    return x


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, times) whose pieces never exceed the histogram: rounded counts, then what still fits."""
    columns = combinations(histogram)
    if not len(columns):
        return []
    x = repeats(histogram, columns)
    left = histogram.copy()
    out = []
    order = np.argsort(-x, kind="stable")
    for wanted in (np.rint(x), np.full(len(x), np.inf)):
        for i in order:
            lengths, need = np.unique(columns[i][columns[i] > 0], return_counts=True)
            times = int(min(wanted[i], (left[lengths] // need).min()))
            if times > 0:
                left[lengths] -= need * times
                out.append((tuple(int(v) for v in columns[i] if v), times))
    return out


def places(histogram: np.ndarray, first: int = 0) -> tuple[dict[int, np.ndarray], int]:
    """Per length: rows (rank from, sequence of that rank, offset), by rank; and the next free sequence.

    Ranks at and over the last row's end have no place; a closing row of -1 marks it.
    """
    found: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    window = len(histogram) - 1
    chosen = [((window,), int(histogram[window]))] if histogram[window] else []
    for lengths, times in chosen + plan(histogram):
        offset = 0
        for v in lengths:
            found.setdefault(v, []).append((taken.get(v, 0), first, offset))
            taken[v] = taken.get(v, 0) + times
            offset += v
        first += times
    return {v: np.array([*rows, (taken[v], -1, -1)], np.int64) for v, rows in found.items()}, first


def _pieces(path: str, end: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        seen = np.zeros(window + 1, np.int64)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = [x.split()[0] for x in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for doc_id, raw in _rows(batches, path, end):
            total = len(raw) // 4
            for start in range(0, total, window):
                piece = raw[4 * start : 4 * (start + window)]
                length = len(piece) // 4
                # only pieces that may be cut again carry their ids
                ids = piece if length < window else None
                rows.append((doc_id, start, length, total, zlib.crc32(piece), part, at, int(seen[length]), ids))
                seen[length] += 1
                at += 1
                held += len(ids or b"")
            if held > 1 << 22 or len(rows) > 20_000:
                yield flush()
                rows, held = [], 0
        if rows:
            yield flush()

    return run


def _placed(table: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.full(len(length), -1, np.int64), np.full(len(length), -1, np.int64)
            for v in np.unique(length):
                if (rows := table.get(int(v))) is None:
                    continue
                own = np.flatnonzero(length == v)
                row = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                sequence[own] = np.where(row[:, 1] < 0, -1, row[:, 1] + rank[own] - row[:, 0])
                offset[own] = row[:, 2]
            ids = pa.array([None if s >= 0 else x for s, x in zip(sequence, batch.column("ids").to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in OWN), pa.array(sequence), pa.array(offset), ids], [*OWN, "sequence_id", "offset", "ids"]
            )

    return run


OWN = ["doc_id", "start", "length", "doc_tokens", "crc", "part", "at"]
RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _cut(first: int, window: int):
    """Pieces at a position of the running stream, cut where a window ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                done = 0
                while done < r["length"]:
                    at = r["position"] + done
                    n = min(r["length"] - done, window - at % window)
                    crc = zlib.crc32(r["ids"][4 * done : 4 * (done + n)])
                    rows.append((r["doc_id"], r["start"] + done, n, crc, r["doc_tokens"], first + at // window, at % window))
                    done += n
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in range(7)], RESULT)

    return run


def pack(docs: DataFrame, path: str, end: int = 1, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    Every id of every document, the end id included, lies in exactly one piece; a sequence holds
    at most ``window`` ids without gaps. All sequences but the last are full, so padding is less
    than one window in all. Null text: one piece, the end id. Null or repeated ids: rows are
    documents of their own. No rows: no pieces.

    Only the histogram (one number per length) comes to the driver.
    """
    spark = docs.sparkSession
    ranged = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(partitions(spark), "doc_id")
    pieces = keep(by_batches(ranged.sortWithinPartitions("doc_id", "text"), _pieces(path, end, window), PIECES))

    counts = pieces.groupBy("part", "length").agg((F.max("rank") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = keep(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = np.zeros(window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    table, first = places(histogram)

    ranked = pieces.join(counts.select("part", "length", "base"), ["part", "length"])
    ranked = ranked.select(*OWN, (F.col("base") + F.col("rank")).alias("rank"), "ids")
    schema = ", ".join(f"{n} {'int' if n == 'part' else 'long'}" for n in OWN) + ", sequence_id long, offset long, ids binary"
    placed = keep(by_batches(ranked, _placed(table), schema))

    rest = placed.where("sequence_id < 0")
    totals = rest.groupBy("part").agg(F.sum("length").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = keep(totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base")))  # one row per partition
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.withColumn("position", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(F.broadcast(totals), "part")
    rest = rest.withColumn("position", F.col("position") + F.col("base"))
    cut = by_batches(rest.select("doc_id", "start", "length", "doc_tokens", "position", "ids"), _cut(first, window), ", ".join(f"{n} long" for n in RESULT))
    return placed.where("sequence_id >= 0").withColumnRenamed("crc", "ids_crc32").select(*RESULT).unionByName(cut)
