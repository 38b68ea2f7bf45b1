"""Document fingerprints: Merkle trees over sections, paragraphs and phrases.

A section ends at a blank line, a paragraph at a line break, a phrase after four words. A
fingerprint is the root and, by section and paragraph, a short hash per phrase:
``root:aaaabbbb.cccc/dddd`` has two sections, the first with two paragraphs. Equal roots mean
equal texts. Branches that differ tell where texts differ, and the share of
equal leaves is their likeness.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import by_batches, keep, partitions, slices

#: Words in a phrase.
PHRASE = 4
_WORD = re.compile(r"\s*\S+\s*|\s+")
_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
_PAIR = [a + b for a in _SIGNS for b in _SIGNS]


def _paragraph(text: str) -> tuple[bytes, str]:
    """Node hash of a paragraph and its leaves, each as four characters."""
    words = _WORD.findall(text)
    node, leaves = hashlib.blake2b(digest_size=16), []
    for i in range(0, len(words), PHRASE):
        leaf = xxhash.xxh3_128_digest("".join(words[i : i + PHRASE]))
        node.update(leaf)
        x = int.from_bytes(leaf[:3])
        leaves.append(_PAIR[x >> 12] + _PAIR[x & 4095])
    return node.digest(), "".join(leaves)


def fingerprint(text: str) -> str:
    """Root of the tree, and the leaves by section and paragraph."""
    root, sections = hashlib.blake2b(digest_size=16), []
    for section in text.split("\n\n"):
        node, parts = hashlib.blake2b(digest_size=16), []
        for paragraph in section.split("\n"):
            digest, leaves = _paragraph(paragraph)
            node.update(digest)
            parts.append(leaves)
        root.update(node.digest() + len(parts).to_bytes(8))
        sections.append(".".join(parts))
    return f"{root.hexdigest()}:{'/'.join(sections)}"


def _leaves(print_: str) -> Counter:
    found: Counter = Counter()
    for paragraph in print_.partition(":")[2].replace("/", ".").split("."):
        found.update(paragraph[i : i + 4] for i in range(0, len(paragraph), 4))
    return found


def likeness(a: str, b: str) -> float:
    """Share of equal leaves, 2 * common / (all of a + all of b); 1 if and only if the roots are equal."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return 1.0
    x, y = _leaves(a), _leaves(b)
    total = x.total() + y.total()
    return min(2 * (x & y).total() / total, total / (total + 1)) if total else 0.0


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of the branches of a that differ from b's in the same place, or are missing there."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return []
    one, other = ([s.split(".") for s in x.partition(":")[2].split("/")] for x in (a, b))
    found = []
    for i, section in enumerate(one):
        theirs = other[i] if i < len(other) else []
        if section != theirs:
            found += [(i, j) for j, p in enumerate(section) if j >= len(theirs) or p != theirs[j]]
    return found


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
NAMES = [x.split()[0] for x in RESULT.split(", ")]


def _row(doc_id: int | None, text: str, own: str, following: str, theirs: str) -> tuple:
    changed = edited(text, following)
    mark = fingerprint(changed)
    sha = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), sha, own, mark, likeness(own, mark), likeness(own, theirs)


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in order: results for all but the last, whose text waits for the next partition.

    edge 0: a result; 1: the partition's first text; 2: its last.
    """
    part = TaskContext.get().partitionId()
    kinds, names = [*KINDS, pa.int32(), pa.int32(), pa.string()], [*NAMES, "part", "edge", "text"]
    none = (None,) * 6
    before = None
    for batch in batches:
        for piece in slices(batch):
            rows = []
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                text = text or ""
                now = (doc_id, text, fingerprint(text))
                if before is None:
                    rows.append((doc_id, *none, part, 1, text))
                else:
                    rows.append((*_row(*before, *now[1:]), part, 0, None))
                before = now
            yield _batch(rows, kinds, names)
    if before is not None:
        yield _batch([(before[0], *none, part, 2, before[1])], kinds, names)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            rows.append(_row(r["doc_id"], r["text"], fingerprint(r["text"]), r["following"], fingerprint(r["following"])))
        yield _batch(rows, KINDS, NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row of docs (doc_id, text) and of its edited text, and their likeness.

    The next document is that with the next smaller id (null ids last, equal ids by text), after the
    last the first; a single document is its own next. Null text: empty, with a fingerprint
    of its own. Equal texts have equal fingerprints. No rows: no rows.

    Texts are moved once, into ranges of ids. A task walks its range in order; the last text of each
    range meets the first of the next in a join of one row per partition.
    """
    ranged = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(partitions(docs.sparkSession), F.desc("doc_id"))
    ranged = ranged.sortWithinPartitions(F.desc("doc_id"), "text")
    walked = keep(by_batches(ranged, _inside, RESULT + ", part int, edge int, text string"))

    parts = walked.where("edge = 1").select("part")
    follow = Window.orderBy("part")
    whole = follow.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select("part", F.coalesce(F.lead("part").over(follow), F.min("part").over(whole)).alias("following_part"))
    first = walked.where("edge = 1").select(F.col("part").alias("following_part"), F.col("text").alias("following"))
    last = walked.where("edge = 2").select("part", "doc_id", "text")
    edges = last.join(parts, "part").join(first, "following_part").select("doc_id", "text", "following")
    return walked.where("edge = 0").select(*NAMES).unionByName(by_batches(edges, _across, RESULT))
