"""Helpers shared by the operators: frames kept in the shared folder, text kernels, files."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimspark.session import shared_dir, shuffles_freed

#: Rows in an Arrow batch; texts may be long, so batches are kept short.
BATCH_ROWS = 500
BATCH_BYTES = 1 << 23
#: Bytes of text that one numpy step works on.
SLICE_BYTES = 1 << 20
#: Bytes that separate words: blank and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def _draw(seed: str, n: int) -> np.ndarray:
    """n odd 64-bit constants that depend on the seed alone."""
    raw = b"".join(hashlib.blake2b(f"{seed}:{i}".encode(), digest_size=8).digest() for i in range(n))
    return np.frombuffer(raw, np.uint64) | np.uint64(1)


BYTE_VALUE = np.where(SPACE, np.uint64(0), _draw("byte", 256))
PLACE = _draw("place", 64)
_BASE = int(_draw("step", 1)[0])
with np.errstate(over="ignore"):
    STEP = np.cumprod(np.full(SLICE_BYTES, _BASE, np.uint64))
    BACK = np.cumprod(np.full(SLICE_BYTES, pow(_BASE, -1, 1 << 64), np.uint64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with short batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def by_bytes(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches of up to BATCH_BYTES, or one row: few for short rows, bounded for long ones."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def unused(name: str, columns: list[str]) -> str:
    """The name, lengthened until none of the columns has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared one."""
    return f"{shared_dir(spark)}/{name}/{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back; cuts lineage and survives lost executors."""
    path = folder(df.sparkSession, "kept")
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_dealt(df: DataFrame, column: str) -> DataFrame:
    """Like ``keep``, in buckets of a column: a later grouping by it reads the buckets and moves no row."""
    spark = df.sparkSession
    name = f"kept_{uuid.uuid4().hex}"
    dealt = df.write.option("compression", "zstd").option("path", folder(spark, "kept"))
    dealt.bucketBy(partitions(spark), column).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its entry in the catalog; the files stay, and the frame knows them
    return out


def texts(column: pa.Array) -> list[str]:
    """Strings of an Arrow column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans ascend and do not overlap."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SLICE_BYTES, side="right")))
        s = start[i:j] - start[i]
        raw = data[start[i] : end[j - 1]]
        if len(raw) > SLICE_BYTES:  # one word longer than a slice
            out[i] = np.frombuffer(hashlib.blake2b(raw.tobytes(), digest_size=8).digest(), np.uint64)[0]
        else:
            # a polynomial in the place of each byte, shifted back to the word's start; blanks count 0
            out[i:j] = np.add.reduceat(BYTE_VALUE[raw] * STEP[: len(raw)], s) * BACK[s]
        i = j
    return mix(out)


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z lower-cased, and the number of words per text."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    base, stop = int(offsets[0]), int(offsets[-1])
    if base == stop:
        return np.empty(0, np.uint64), np.zeros(len(column), np.int64)
    data = LOWER[np.frombuffer(column.buffers()[2], np.uint8)[base:stop]]
    offsets = offsets - base
    word = ~SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    first[inner] = word[inner]  # a text starts a word
    last = word.copy()
    last[:-1] &= ~word[1:]
    closing = offsets[1:][offsets[1:] > 0] - 1
    last[closing] = word[closing]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(start, offsets))
    return _hash_spans(data, start, end), counts


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text each, one row at least."""
    sizes = np.array([len(x) if x is not None else 0 for x in batch.column(text).cast(pa.large_binary()).to_pylist()], np.int64)
    i = 0
    while i < len(sizes):
        j = max(i + 1, i + int(np.searchsorted(np.cumsum(sizes[i:]), SLICE_BYTES)))
        yield batch.slice(i, j - i)
        i = j


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text.

    A text with fewer words has one: its whole sequence. A text without words has none.
    """
    hashes, counts = words_of(column)
    sets, at = [], 0
    for n in counts:
        w, at = hashes[at : at + n], at + n
        if n == 0:
            sets.append(np.empty(0, np.uint64))
            continue
        take = min(k, int(n))
        s = np.zeros(n - take + 1, np.uint64)
        for j in range(take):
            s += w[j : n - take + 1 + j] * PLACE[j]
        sets.append(np.unique(mix(s + np.uint64(take))))
    return sets


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column made of arrays, without a Python object per value."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


class Files:
    """Plain files in the shared folder, for formats that Spark's writers do not have."""

    def __init__(self, uri: str):
        self.fs, self.path = pafs.FileSystem.from_uri(uri)

    def write(self, name: str, parts: Callable[[pa.NativeFile], None]) -> int:
        """Write under a name of this attempt, then move into place: a repeated task leaves one whole file."""
        self.fs.create_dir(self.path, recursive=True)
        temporary = f"{self.path}/.{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(temporary) as out:
            parts(out)
            size = out.tell()
        self.fs.move(temporary, f"{self.path}/{name}")
        return size

    def open(self, name: str) -> pa.NativeFile:
        return self.fs.open_input_file(f"{self.path}/{name}")
