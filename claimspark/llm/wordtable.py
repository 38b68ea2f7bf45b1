"""Byte-level BPE ids of whole texts through a table of distinct words, and decoding through pieces.

Tasks split texts into words and write them as chunks: the distinct words of some megabytes of text,
and for each text the numbers of its words in that list. Only the distinct words are dealt, by
word; there, equal words of all chunks are sorted next to each other, so each is encoded once. The
ids go back to (chunk, number), and each chunk's texts are put together by position. Words and
ids travel packed, as many as one chunk has for one task, and are rows only inside tasks. A word
comes once from a chunk, so that no word is a hot key, and a chunk is bounded by its bytes, so that no group is.

A word here is a stretch of text that the library's pattern never joins to its neighbours: an
optional blank and the characters up to the next white space, with letters and closing
punctuation apart. White space is a fixed set, and which characters are letters is left to the library,
which gets the word as it stands.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimspark.llm.common import by_bytes, keep_dealt, partitions, slices

#: Bytes of text in a chunk, but one text at least.
CHUNK_BYTES = 1 << 23
#: Bits of a place that count words inside a chunk, and chunks inside a partition.
WORD_BITS, CHUNK_BITS = 28, 14
#: Encoded words that a task holds before it gives them out by chunk.
HELD = 1 << 19
#: Characters that Unicode calls white space: fixed values.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Latin letters, for words that are cut before closing punctuation.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
WORDS = re.compile(rf" ?[{LETTERS}]++(?![^{SPACE}.,;:!?])| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


class Vocabulary:
    """The library's tokenizer without truncation or padding, its word pattern and its pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        first = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or first.get("type") != "ByteLevel" or first.get("add_prefix_space") or not first.get("use_regex"):
            raise ValueError("not a byte-level vocabulary that splits by the usual pattern")
        added = spec["added_tokens"]
        if any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must be found as they are")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # added tokens are found first, the longest where several start
        names = sorted((x["content"] for x in added), key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, names))) if names else None
        self.bytes_of = _byte_values()

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        found = self.library.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def pieces(self) -> list[bytes]:
        """Bytes of each id's piece; a name with other than stand-ins for bytes is its own text."""
        names = {i: p for p, i in self.library.get_vocab(with_added_tokens=True).items()}
        out = []
        for i in range(max(names, default=-1) + 1):
            name = names.get(i, "")
            values = [self.bytes_of.get(c) for c in name]
            out.append(name.encode() if None in values else bytes(values))
        return out


def split(text: str, marks: re.Pattern | None) -> list[str]:
    """The words of a text, each mark one by itself; joined they give the text."""
    if marks is None or not marks.search(text):
        return WORDS.findall(text)
    out, at = [], 0
    for mark in marks.finditer(text):
        out += [*WORDS.findall(text[at : mark.start()]), mark[0]]
        at = mark.end()
    return out + WORDS.findall(text[at:])


def _byte_values() -> dict[str, int]:
    """The byte that each printable stand-in of byte-level vocabularies means."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return {chr(b) if b in shown else chr(next(hidden)): b for b in range(256)}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: ``codes`` holds the number of each word of the texts, one text behind another; ``deals`` the words, by the task
#: that encodes them, joined by MARK. The word at position p in the list of task d has the number p * tasks + d.
CHUNK = "chunk long, docs array<long>, counts array<long>, codes binary, deals array<struct<deal: int, words: string>>"
#: Stands between words, and how it and the sign of such spellings are spelled inside of words.
MARK, SPELLED = "\x01", [("\x02", "\x02b"), ("\x01", "\x02a")]


def spelled(word: str) -> str:
    if "\x01" in word or "\x02" in word:
        for sign, other in SPELLED:
            word = word.replace(sign, other)
    return word


def unspelled(word: str) -> str:
    if "\x02" in word:
        for sign, other in reversed(SPELLED):
            word = word.replace(other, sign)
    return word


def packed(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, byte by byte: the high bytes are nearly all zero."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


class _Chunk:
    """Texts gathered so far: their ids, word counts and word numbers, and the distinct words."""

    def __init__(self):
        self.size, self.docs, self.counts, self.codes, self.words = 0, [], [], [], {}

    def add(self, doc_id: int | None, text: str, words: list[str]) -> None:
        known = self.words
        codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint32, len(words))
        self.docs.append(doc_id)
        self.counts.append(len(words))
        self.codes.append(codes)
        self.size += len(text)

    def row(self, number: int, tasks: int) -> pa.RecordBatch:
        """The frequent words of each task come first, so that codes are mostly small and pack well."""
        codes = np.concatenate(self.codes) if self.codes else np.empty(0, np.uint32)
        names = list(self.words)
        deal = np.fromiter((zlib.crc32(w.encode()) % tasks for w in names), np.int64, len(names))
        order = np.lexsort((-np.bincount(codes, minlength=len(names)), deal))
        starts = np.flatnonzero(np.diff(deal[order], prepend=-1))
        place = np.empty(len(order), np.uint32)
        place[order] = (np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))) * tasks + deal[order]
        deals = []
        for own in np.split(order, starts[1:]) if len(order) else []:
            deals.append({"deal": int(deal[own[0]]), "words": MARK.join(spelled(names[i]) for i in own)})
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (self.docs, self.counts)]
        dealt = pa.array([deals], pa.list_(pa.struct([("deal", pa.int32()), ("words", pa.string())])))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *lists, pa.array([packed(place[codes])], pa.binary()), dealt],
            ["chunk", "docs", "counts", "codes", "deals"],
        )


def _chunks(marks: re.Pattern | None, limit: int, tasks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << CHUNK_BITS
        chunk = _Chunk()
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    chunk.add(doc_id, text or "", split(text or "", marks))
                    if chunk.size >= limit or len(chunk.words) >> (WORD_BITS - 1):
                        yield chunk.row(number, tasks)
                        number, chunk = number + 1, _Chunk()
        if chunk.docs:
            yield chunk.row(number, tasks)

    return run


GATHERED = "chunk long, n int, numbers binary, lengths binary, total int, ids binary"


def _gathered(places: np.ndarray, ids: pa.Array) -> Iterator[pa.RecordBatch]:
    """The words of each chunk in a row, with their ids."""
    order = np.argsort(places, kind="stable")
    places, ids = places[order], ids.take(pa.array(order))
    chunks = places >> WORD_BITS
    starts = np.flatnonzero(np.diff(chunks, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(places)]):
        numbers, own = places[a:b] & ((1 << WORD_BITS) - 1), ids[a:b]
        flat = np.frombuffer(b"".join(own.to_pylist()), "<u4")
        lengths = pc.binary_length(own).to_numpy() // 4
        values = [int(chunks[a]), b - a, packed(np.diff(numbers, prepend=0)), packed(lengths), len(flat), packed(flat)]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [x.split()[0] for x in GATHERED.split(", ")])


def _encoded(path: str, held_rows: int = HELD):
    """Ids of the words, a row per chunk and ``held_rows``; rows come sorted by word, so that a word is new only where it changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary(path).encode
        last, before = None, b""
        places, ids, rows = [], [], 0
        for batch in batches:
            runs = pc.run_end_encode(batch.column("word"))
            words, stops = runs.values.to_pylist(), runs.run_ends.to_numpy()
            new = words[1:] if words and words[0] == last else words
            found = encode([unspelled(w) for w in new])
            found = [before, *found] if len(found) < len(words) else found
            if words:
                last, before = words[-1], found[-1]
            places.append(batch.column("place").to_numpy())
            ids.append(pa.array(found, pa.binary()).take(pa.array(np.repeat(np.arange(len(stops)), np.diff(stops, prepend=0)))))
            rows += batch.num_rows
            if rows >= held_rows:
                yield from _gathered(np.concatenate(places), pa.concat_arrays(ids))
                places, ids, rows = [], [], 0
        if rows:
            yield from _gathered(np.concatenate(places), pa.concat_arrays(ids))

    return run


def spans(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of values that start and length tell, one behind another."""
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    return values[shift + np.arange(len(shift))]


def _assembled(chunks: pa.Table, table: pa.Table) -> pa.Table:
    """(doc_id, ids) of the texts of one chunk: the ids of its words, taken by position."""
    rows = table.to_pylist()
    placed = [np.cumsum(unpacked(row["numbers"], row["n"]), dtype=np.int64) for row in rows]
    total = max((int(x[-1]) + 1 for x in placed), default=0)
    start, length, parts, at = np.zeros(total, np.int64), np.zeros(total, np.int64), [], 0
    for row, numbers in zip(rows, placed):
        lengths = unpacked(row["lengths"], row["n"]).astype(np.int64)
        length[numbers] = lengths
        start[numbers] = at + np.cumsum(lengths) - lengths
        parts.append(unpacked(row["ids"], row["total"]))
        at += row["total"]
    ids = np.concatenate(parts) if parts else np.empty(0, "<u4")
    docs, out = [], []
    for row in chunks.to_pylist():
        codes = unpacked(row["codes"], sum(row["counts"]))
        at = 0
        for doc_id, n in zip(row["docs"], row["counts"]):
            own = codes[at : at + n]
            docs.append(doc_id)
            out.append(spans(ids, start[own], length[own]).tobytes())
            at += n
    return pa.table([pa.array(docs, pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "ids"])


def encode(docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, ids) for each row of docs (doc_id, text); ids as little-endian unsigned 32-bit integers.

    As the library encodes the whole text, without special tokens but with those that the text spells
    out. Null or empty text: no ids. Null and repeated doc_ids and repeated rows each give a row.
    A text longer than a chunk is one by itself. No rows: no rows. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    tasks = partitions(docs.sparkSession)
    chunks = keep_dealt(by_bytes(docs, _chunks(vocabulary(path).marks, chunk_bytes, tasks), CHUNK), "chunk")
    dealt = chunks.select("chunk", F.explode("deals").alias("x")).repartition(tasks, "x.deal")
    words = dealt.select("chunk", "x.deal", F.posexplode(F.split("x.words", MARK)).alias("at", "word"))
    place = F.shiftleft("chunk", WORD_BITS) + F.col("at").cast("long") * tasks + F.col("deal")
    words = words.select(place.alias("place"), "word").sortWithinPartitions("word")
    table = by_bytes(words, _encoded(path), GATHERED)
    texts = chunks.select("chunk", "docs", "counts", "codes").groupBy("chunk")
    return texts.cogroup(table.groupBy("chunk")).applyInArrow(_assembled, "doc_id long, ids binary")


class Pieces:
    """The id-to-piece table: as long as the vocabulary, so every task gets it."""

    def __init__(self, path: str):
        pieces = vocabulary(path).pieces()
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def joined(self, ids: np.ndarray) -> bytes:
        """Bytes of the pieces of the ids, one behind another; ids without a piece give none."""
        ids = ids[ids < len(self.length)]
        return spans(self.data, self.start[ids], self.length[ids]).tobytes()


def _decoded(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = pieces.joined
        for batch in batches:
            for part in slices(batch, "ids"):
                raw = (joined(np.frombuffer(x or b"", "<u4")) for x in part.column("ids").to_pylist())
                # bytes that are no UTF-8 are shown as the replacement character, as the library does
                texts = pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of encoded (ids) with the text ``decoded`` from them by a join of ids to pieces.

    The table of pieces has a row per id of the vocabulary (50,257), a size that does not grow with
    the data, so the join is made inside each task. Null or no ids: empty text. Other columns
    are kept; one called ``decoded`` is replaced.
    """
    rest = encoded.drop("decoded")
    return by_bytes(rest, _decoded(Pieces(path)), StructType([*rest.schema.fields, StructField("decoded", StringType())]))
