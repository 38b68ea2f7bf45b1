"""SentencePiece encoding by a score-ordered agenda of adjacent symbol pairs, and decoding.

No piece of a vocabulary has a word mark after another character, so text falls into
chunks at word marks that never merge across. Equal chunks are encoded once per worker. Short
chunks are merged together in numpy: each step takes every chunk's best pair (highest
score, leftmost on ties). Long ones use a heap. Every new chunk is checked against the
library's ids, in one call per Arrow batch.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import by_batches, lists, slices, texts

MARK = "▁"
#: Chunks over this many characters use the heap.
WIDE = 48
#: Encoded chunks held by a worker between batches; the later half is dropped when the number is passed.
HELD = 500_000
NONE = np.int32(1 << 30)
#: A run of word marks and what follows it, or text before the first mark.
RUNS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


class PieceEncoder:
    """Merge-type vocabularies with byte fallback, identity normalisation and a word mark put in front."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.end = sp.eos_id()
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        piece = {sp.id_to_piece(i): i for i in normal}
        if any(MARK in p.lstrip(MARK) for p in piece):
            raise ValueError("a piece has a word mark inside: chunks would merge")
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # characters that only occur inside pieces get symbols after the vocabulary's
        inner = sorted({c for p in piece for c in p} - piece.keys())
        self.symbol = piece | {c: size + i for i, c in enumerate(inner)}
        self.pieces, self.unknown = size, size + len(inner)
        self.width = self.unknown + 1
        ranks = np.unique(np.array([-sp.get_score(i) for i in normal]), return_inverse=True)[1]
        rank = dict(zip(normal, ranks.tolist()))
        pairs = {}
        for p, i in piece.items():
            for cut in range(1, len(p)):
                left, right = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (rank[i], i)
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.of_char = np.full(0x110000, self.unknown, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.memo: dict[str, bytes] = {"": b""}
        self.differing: set[str] = set()

    # -- merging

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of the pair in the tables, or their length."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        hit = self.keys[np.minimum(at, len(self.keys) - 1)] == key
        return np.where(hit & (left >= 0) & (right >= 0), at, len(self.keys))

    def _merge_short(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of all chunks, one after another, and their number per chunk."""
        length = np.fromiter(map(len, chunks), np.int64, len(chunks))
        wide = int(length.max())
        s = np.full((len(chunks), wide + 1), -1, np.int32)
        s[np.arange(wide + 1) < length[:, None]] = self.of_char[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        final = np.full_like(s, -1)
        rank, made = np.append(self.rank, NONE), np.append(self.made, -1)
        r = rank[self._find(s[:, :-1].ravel(), s[:, 1:].ravel())].reshape(len(s), wide)
        rows = np.arange(len(chunks))
        columns = np.arange(wide + 1)
        while True:
            n = np.arange(len(rows))
            best = r.argmin(axis=1)  # the leftmost of the best
            live = r[n, best] < NONE
            if not live.all():
                final[rows[~live]] = s[~live]
                s, r, rows, best = s[live], r[live], rows[live], best[live]
                n = np.arange(len(rows))
            if not len(rows):
                break
            merged = made[self._find(s[n, best], s[n, best + 1])]
            shift = np.minimum(columns + (columns > best[:, None]), wide)
            s, r = np.take_along_axis(s, shift, 1), np.take_along_axis(r, shift[:, :wide].clip(max=wide - 1), 1)
            s[n, best], s[:, wide], r[:, wide - 1] = merged, -1, NONE
            before = np.maximum(best - 1, 0)
            around = rank[self._find(s[np.concatenate((n, n)), np.concatenate((best, before))], s[np.concatenate((n, n)), np.concatenate((best, before)) + 1])]
            r[n, best] = around[: len(n)]
            r[n, before] = np.where(best > 0, around[len(n) :], r[n, before])
        held = final >= 0
        return final[held], held.sum(axis=1)

    def _merge_long(self, chunk: str) -> list[int]:
        """The same with a heap of (rank, place) over a linked list of symbols."""
        s = [self.symbol.get(c, self.unknown) for c in chunk]
        follow, before = list(range(1, len(s) + 1)), list(range(-1, len(s) - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def propose(i: int) -> None:
            if i >= 0 and (j := follow[i]) < len(s) and (hit := self.pairs.get(s[i] * self.width + s[j])):
                heapq.heappush(agenda, (hit[0], i, s[i], s[j]))

        for i in range(len(s)):
            propose(i)
        while agenda:
            _, i, left, right = heapq.heappop(agenda)
            j = follow[i]
            if s[i] != left or j >= len(s) or s[j] != right:
                continue  # a neighbour has merged meanwhile
            s[i], s[j], follow[i] = self.pairs[left * self.width + right][1], -1, follow[j]
            if follow[j] < len(s):
                before[follow[j]] = i
            propose(i)
            propose(before[i])
        return [x for x in s if x >= 0]

    def _ids(self, chunk: str, symbols: list[int]) -> list[int]:
        """Symbols that are no pieces become the bytes of their characters."""
        if max(symbols) < self.pieces:
            return symbols
        out, at, name = [], 0, self.library.id_to_piece
        for x in symbols:
            length = len(name(x)) if x < self.pieces else 1
            out += [x] if x < self.pieces else [self.bytes[b] for b in chunk[at : at + length].encode()]
            at += length
        return out

    # -- chunks

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Chunks in order; some may be empty strings."""
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        if MARK + MARK in text or text[-1] == MARK:
            return RUNS.findall(text)
        return text.replace("\n", " \n ").replace(MARK, " " + MARK).split(" ")

    def learn(self, new: list[str]) -> None:
        """Encode chunks, compare with the library in one call, and hold them."""
        new = sorted((c for c in new if c), key=len)
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            short = [c for c in part if len(c) <= WIDE]
            flat, count = self._merge_short(short) if short else (np.empty(0, np.int32), np.empty(0, np.int64))
            for c in part[len(short) :]:
                symbols = self._merge_long(c)
                flat, count = np.append(flat, np.array(symbols, np.int32)), np.append(count, len(symbols))
            # the library puts a mark in front; a chunk without one follows a line break, whose ids are cut off
            expected = self.library.encode([c[1:].replace(MARK, " ") if c[0] == MARK else "\n" + c for c in part], num_threads=1)
            expected = [ids if c[0] == MARK else ids[2:] for c, ids in zip(part, expected)]
            theirs = np.fromiter(chain.from_iterable(expected), np.int32)
            raw, stop = flat.astype(np.int32).tobytes(), np.cumsum(count).tolist()
            own = [raw[4 * i : 4 * j] for i, j in zip([0, *stop], stop)]
            if not np.array_equal(flat, theirs) or not np.array_equal(count, [len(x) for x in expected]):
                own = [self._compared(c, np.frombuffer(x, np.int32).tolist(), ids) for c, x, ids in zip(part, own, expected)]
            self.memo.update(zip(part, own))

    def _compared(self, chunk: str, symbols: list[int], expected: list[int]) -> bytes:
        ids = self._ids(chunk, symbols)
        if ids != expected and not (chunk == MARK and not expected):
            self.differing.add(chunk)
        return np.array(ids, np.int32).tobytes()

    def encode(self, batch: list[str]) -> list[tuple[bytes, bool]]:
        """Ids of each text as 32-bit integers, with the end id, and whether all its chunks agreed
        with the library; the ids are the agenda's own."""
        gc.disable()  # nothing here makes cycles, and the many small objects would set it off all the time
        parts = [self.chunks(t) for t in batch]
        needed = set().union(*parts)
        if new := needed.difference(self.memo):
            if len(self.memo) + len(new) > HELD:  # what came first is what comes often
                self.memo = dict(islice(self.memo.items(), HELD // 2))
                new = needed.difference(self.memo)
            self.learn(list(new))  # nothing is dropped until the batch is done
        get, end = self.memo.__getitem__, np.int32(self.end).tobytes()
        bad = self.differing
        gc.enable()
        return [(b"".join(map(get, p)) + end, not bad or bad.isdisjoint(p)) for p in parts]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _coded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        word = [str(i) for i in range(coder.pieces)]
        for batch in batches:
            for part in slices(batch):
                coded = coder.encode(texts(part.column("text")))
                found = []
                for raw, _ in coded:
                    ids = np.frombuffer(raw, np.int32).tolist()
                    spelled = " ".join([word[x] for x in ids]).encode()
                    decoded = coder.library.decode(ids).encode()
                    found.append((len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                size, spelled, decoded = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(spelled),
                        pa.array(decoded),
                        pa.array([ok for _, ok in coded]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agreed"],
                )

    return run


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for part in slices(batch):
                ids = [np.frombuffer(raw, np.int32) for raw, _ in coder.encode(texts(part.column("text")))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), lists(ids, pa.int32())], ["doc_id", "ids"])

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(path).library
        for batch in batches:
            ids = [x or [] for x in batch.column("ids").to_pylist()]
            text = library.decode(ids, num_threads=1) if ids else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(text, pa.string())], ["doc_id", "text"])

    return run


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) per row: the ids of the text and the end id. Null text: the end id alone."""
    return by_batches(docs.select(F.col("doc_id").cast("long"), "text"), _encoded(path), "doc_id long, ids array<int>")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) per row of (doc_id, ids), by the library. Null ids: empty text."""
    return by_batches(encoded.select("doc_id", "ids"), _decoded(path), "doc_id long, text string")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agreed) for each row of docs (doc_id, text).

    ``agreed`` is false where a chunk's ids differed from the library's; they stay as the agenda made them.
    Null and empty texts have the end id alone. Null or repeated ids: rows stay as they are.
    No rows: no rows. No shuffle: each row is worked on where it is read.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agreed boolean"
    return by_batches(docs.select(F.col("doc_id").cast("long"), "text"), _coded(path), schema)
