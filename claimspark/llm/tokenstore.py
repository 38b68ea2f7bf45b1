"""Token ids of documents in shard files, with a minimal perfect hash index for keyed access.

A shard is two files. ``NAME.ids`` is the raw payload: ids as little-endian unsigned
integers of 2 or 4 bytes, no header. ``NAME.idx`` is a numpy archive: level bitmaps of the hash,
and per slot a 64-bit fingerprint, the offset and the number of ids. A key costs a few
hash probes, a fingerprint comparison and one read of its range, whatever the shard's size.
Files are written under a name of the attempt and moved into place, so a repeated task
leaves one whole file.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import Files, by_batches, folder, keep, mix, partitions, slices
from claimspark.llm.words import encoder

#: Documents after which a task begins another shard, so that its keys stay in memory.
SHARD_DOCS = 1_000_000
LEVELS, LOAD = 32, 2
MANIFEST = "name string, first long, nulls boolean, docs long, tokens long"


def _mixed(key: np.ndarray, seed: int) -> np.ndarray:
    return mix(key + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))


def key_hash(doc_id: np.ndarray, null: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    """Keys are the id (or its absence) and the place among rows with equal ids."""
    plain = mix(doc_id.astype(np.int64).view(np.uint64) + null.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return mix(plain ^ (repeat.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))


class PerfectHash:
    """Minimal perfect hash: on each level, keys alone at their bit stay; the others go on.

    A slot is the number of set bits before the key's. Keys left after the last level (equal
    64-bit hashes can be) are listed, and take the last slots.
    """

    def __init__(self, words: list[np.ndarray], rest: np.ndarray):
        self.words, self.rest = words, rest
        counts = [np.bitwise_count(w).astype(np.int64) for w in words]
        self.before, total = [], 0
        for c in counts:
            self.before.append(total + np.cumsum(c) - c)
            total += int(c.sum())
        self.placed = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        words, left = [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(1, -(-len(left) * LOAD // 64))
            at = (_mixed(left, level + 1) % np.uint64(size * 64)).astype(np.int64)
            alone = np.bincount(at, minlength=size * 64) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(words, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; keys outside the set get any slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (w, before) in enumerate(zip(self.words, self.before)):
            at = (_mixed(keys[open_], level + 1) % np.uint64(len(w) * 64)).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (w[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(w[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[open_[hit]] = before[word[hit]] + below
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.placed + at[hit]
        return out


class Shard:
    """An index read back, and its payload open for ranges."""

    def __init__(self, files: Files, name: str):
        with files.open(f"{name}.idx") as f:
            held = np.load(io.BytesIO(f.read()))
        self.hash = PerfectHash([held[f"level{i}"] for i in range(int(held["levels"]))], held["rest"])
        self.fingerprint, self.offset, self.count = held["fingerprint"], held["offset"], held["count"]
        self.kind = np.dtype(f"<u{int(held['width'])}")
        self.payload = files.open(f"{name}.ids")

    def find(self, doc_id: np.ndarray, null: np.ndarray, repeat: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 where the fingerprint differs: no such key."""
        keys = key_hash(doc_id, null, repeat)
        slots = self.hash.slots(keys)
        if not len(self.fingerprint):
            return np.full(len(keys), -1)
        return np.where((slots >= 0) & (self.fingerprint[slots] == _mixed(keys, 0)), slots, -1)

    def ids(self, slot: int) -> np.ndarray:
        width = self.kind.itemsize
        self.payload.seek(int(self.offset[slot]) * width)
        return np.frombuffer(self.payload.read(int(self.count[slot]) * width), self.kind)


def save_index(files: Files, name: str, keys: np.ndarray, offset: np.ndarray, count: np.ndarray, width: int) -> None:
    hash_ = PerfectHash.build(keys)
    slots = hash_.slots(keys)
    if len(hash_.rest) > len(np.unique(hash_.rest)):
        raise ValueError("two keys of a shard share a 64-bit hash")
    order = np.argsort(slots)
    arrays = {f"level{i}": w for i, w in enumerate(hash_.words)}
    arrays |= {"levels": np.int64(len(hash_.words)), "rest": hash_.rest, "width": np.int64(width)}
    arrays |= {"fingerprint": _mixed(keys, 0)[order], "offset": offset[order], "count": count[order]}
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    files.write(f"{name}.idx", lambda out: out.write(buffer.getvalue()))


def _rows(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids with the end id) row by row."""
    coder, last = encoder(path), np.uint32(end).tobytes()
    for batch in batches:
        for part in slices(batch):
            raw = part.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), coder.encode(raw)):
                yield doc_id, ids + last


def _writer(uri: str, path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(uri)
        width = 2 if max(encoder(path).size, end + 1) <= 1 << 16 else 4
        rows = _rows(batches, path, end)
        row = next(rows, None)
        while row is not None:
            name = uuid.uuid4().hex
            ids, nulls, repeats, counts = [], [], [], []

            def payload(out: pa.NativeFile) -> None:
                nonlocal row
                while row is not None:
                    doc_id, raw = row
                    same = bool(ids) and (ids[-1], nulls[-1]) == (doc_id or 0, doc_id is None)
                    if len(ids) >= SHARD_DOCS and not same:  # rows with equal ids share a shard
                        return
                    repeats.append(repeats[-1] + 1 if same else 0)
                    ids.append(doc_id or 0)
                    nulls.append(doc_id is None)
                    counts.append(len(raw) // 4)
                    out.write(np.frombuffer(raw, np.uint32).astype(f"<u{width}").tobytes())
                    row = next(rows, None)

            files.write(f"{name}.ids", payload)
            count = np.array(counts, np.int64)
            keys = key_hash(np.array(ids, np.int64), np.array(nulls), np.array(repeats, np.int64))
            save_index(files, name, keys, np.cumsum(count) - count, count, width)
            firsts = [i for i, n in zip(ids, nulls) if not n]
            yield pa.RecordBatch.from_pylist(
                [{"name": name, "first": firsts[0] if firsts else None, "nulls": nulls[0], "docs": len(ids), "tokens": int(count.sum())}],
                schema=pa.schema(
                    [("name", pa.string()), ("first", pa.int64()), ("nulls", pa.bool_()), ("docs", pa.int64()), ("tokens", pa.int64())]
                ),
            )

    return run


def write_store(docs: DataFrame, path: str, end: int = 1, uri: str | None = None) -> tuple[str, DataFrame]:
    """Write the ids of docs (doc_id, text) and return the folder and its manifest, one row per shard.

    Documents lie in ascending order of doc_id (nulls first, equal ids by text), each with the end
    id. The text is range-partitioned before it is encoded, so it is encoded once and no ids
    are moved. A null text has the end id alone. No rows: no shards.
    """
    uri = uri or folder(docs.sparkSession, "tokens")
    docs = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(partitions(docs.sparkSession), "doc_id")
    return uri, keep(by_batches(docs.sortWithinPartitions("doc_id", "text"), _writer(uri, path, end), MANIFEST))


def _reader(uri: str, shards: list[tuple], output):
    """shards: (name, first, nulls, start) in order of keys."""
    firsts = np.array([s[1] for s in shards if s[1] is not None], np.int64)
    named = [s for s in shards if s[1] is not None]
    with_nulls = [s for s in shards if s[2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, name, shard = Files(uri), None, None
        for batch in batches:
            null = np.array([x is None for x in batch.column("doc_id").to_pylist()], bool)
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            at = np.maximum(np.searchsorted(firsts, ids, side="right") - 1, 0)
            at[null] = -1
            found = []
            for place in np.unique(at):
                own = np.flatnonzero(at == place)
                for entry in with_nulls if place < 0 else named[place : place + 1]:
                    if name != entry[0]:
                        name, shard = entry[0], Shard(files, entry[0])
                    repeat = 0
                    rows = own
                    while len(rows):  # rows with equal ids are asked for until there is none
                        slots = shard.find(ids[rows], null[rows], np.full(len(rows), repeat))
                        rows, slots = rows[slots >= 0], slots[slots >= 0]
                        for i, slot in zip(rows, slots):
                            found.append((None if null[i] else int(ids[i]), entry[3] + int(shard.offset[slot]), shard.ids(slot)))
                        repeat += 1
            yield output(found)

    return run


def _ids(found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())]
    ids = pa.array([f[2].astype(np.int64) for f in found], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([*columns, ids], ["doc_id", "start", "ids"])


def _checksums(found: list[tuple]) -> pa.RecordBatch:
    rows = [(d, s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, s, ids in found]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names)


def _read(keys: DataFrame, uri: str, manifest: DataFrame, output, schema: str) -> DataFrame:
    # one row per shard comes to the driver, none per document
    shards = sorted(manifest.collect(), key=lambda s: (not s["nulls"], s["first"] is not None, s["first"] or 0))
    start, entries = 0, []
    for s in shards:
        entries.append((s["name"], s["first"], s["nulls"], start))
        start += s["tokens"]
    keys = keys.select(F.col("doc_id").cast("long")).distinct()
    keys = keys.repartitionByRange(partitions(keys.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    return by_batches(keys, _reader(uri, entries, output), schema)


def read_ids(keys: DataFrame, uri: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of the rows stored under the keys (doc_id). Unknown keys give no row.

    A stored id that several rows share gives all of them. Keys are sent to the tasks in
    the shards' order, so a task opens few shards.
    """
    return _read(keys, uri, manifest, _ids, "doc_id long, start long, ids array<long>")


def stored_digests(docs: DataFrame, path: str, end: int = 1) -> DataFrame:
    """Write docs and read every document back by its key: (doc_id, start, n_tokens, ids_crc32).

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is of all its ids as
    little-endian unsigned 32-bit integers. Cases as in ``write_store``.
    """
    uri, manifest = write_store(docs, path, end)
    return _read(docs, uri, manifest, _checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
