"""Spelling variants by permuterm rotations.

Every word gets a terminator and is rotated to each of its characters. A word whose edited
character is turned to the end agrees with its neighbour in all that stands before: two words that differ by a
replaced character share that prefix, and a word that lacks the character is the prefix. So in
the sorted rotations, neighbours stand in one range: the rotation itself and its continuations
by one character. A range has at most one row per character of the alphabet and one more.

Ranges are scanned by window: each member learns how many neighbours it has there and the best of
them; pairs are not formed. Words are numbered from the best (most occurrences, then code-point order)
to the last, so that the best neighbour is the least number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import by_batches, keep
from claimspark.sources.keys import assign_ids

#: Letters that make words, as a character class: fixed values.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks the end of a word; words do not hold it.
END = "\0"
#: Characters of a rotation that are sorted as text; what follows them is told apart by a digest, as all
#: rotations of a word of a million characters would be a million million characters.
HEAD = 32
#: Digests are polynomials modulo this prime, at a place drawn once.
PRIME = (1 << 127) - 1
PLACE = 0x5A3D1E70C94B2F86_1B7D90E4A6523CF9 % PRIME
ROWS = 10_000


def runs(docs: DataFrame, least: int = 6, drop: int | None = None) -> DataFrame:
    """(word) for each run of at least ``least`` letters in docs (doc_id, text), A-Z lower-cased.

    With ``drop``, a run whose checksum with its doc_id is divisible by it loses the character
    that the checksum points at; it may then be shorter than ``least``. Null text: no runs. A null doc_id
    counts as an empty one.
    """
    found = F.regexp_extract_all("text", F.lit(f"({LETTERS}{{{least},}})"), F.lit(1))
    out = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(found).alias("run"))
    out = out.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    if drop is None:
        return out.select(F.col("run").alias("word"))
    check = F.crc32(F.encode(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), F.col("run")), "UTF-8"))
    out = out.select("run", check.alias("check"))
    at = (F.col("check") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return out.select(F.when(F.col("check") % drop == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = 6, often: int = 5) -> DataFrame:
    """(word, n) of the words (word) with at least ``least`` characters that occur ``often`` times or more."""
    counted = words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= often)


ROTATION = "head string, size int, digest binary, rank long, whole boolean, once boolean"


def rotated(word: str) -> Iterator[tuple[str, int, bytes | None, bool, bool]]:
    """(head, size, digest, whole, once) of the rotations of a word, and of each without its last character.

    ``once``: of the equal neighbouring characters that may be taken out with the same result, the first.
    """
    twice, n = f"{word}{END}{word}", len(word)
    before = [0]
    if n >= HEAD:
        for c in twice:
            before.append((before[-1] * PLACE + ord(c)) % PRIME)
    for size, whole, starts in ((n + 1, True, range(n + 1)), (n, False, range(1, n + 1))):
        step = pow(PLACE, size, PRIME)
        for i in starts:
            digest = None
            if size > HEAD:
                digest = ((before[i + size] - before[i] * step) % PRIME).to_bytes(16, "big")
            once = not whole and (i == 1 or word[i - 2] != word[i - 1])
            yield twice[i : i + min(size, HEAD)], size, digest, whole, once


def _rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_()]
    names = [x.split()[0] for x in ROTATION.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    rows: list[tuple] = []
    for batch in batches:
        for rank, word in zip(batch.column("rank").to_pylist(), batch.column("word").to_pylist()):
            for head, size, digest, whole, once in rotated(word):
                rows.append((head, size, digest, rank, whole, once))
                if len(rows) == ROWS:
                    yield batch_of(rows)
                    rows = []
    if rows:
        yield batch_of(rows)


def neighbours(words: DataFrame) -> DataFrame:
    """(rank, n_near, near) of the words (rank, word) that have a neighbour.

    Neighbours differ by exactly one inserted, deleted or replaced character. ``near`` is the
    least rank of a neighbour. Words are distinct, not null and without the terminator.
    """
    turned = by_batches(words.select("rank", "word"), _rotations, ROTATION)
    span = Window.partitionBy("head", "size", "digest")
    part = ~F.col("whole")

    def of(rows: Column, value: str = "rank") -> Column:
        return F.min(F.when(rows, F.col(value))).over(span)

    # one row at most is whole: the word that lacks the last character of the others
    scanned = turned.withColumns(
        {
            "parts": F.sum(part.cast("int")).over(span),
            "singles": F.sum(F.col("once").cast("int")).over(span),
            "shorter": of(F.col("whole")),
            "best": of(part),
            "best_single": of(F.col("once")),
        }
    ).where("parts > 1 or (parts = 1 and shorter is not null)")
    scanned = scanned.withColumn("next", of(part & (F.col("rank") > F.col("best"))))
    indel = F.col("once") & F.col("shorter").isNotNull()
    met = F.when(F.col("whole"), F.col("singles")).otherwise(F.col("parts") - 1 + indel.cast("int"))
    other = F.when(F.col("rank") == F.col("best"), F.col("next")).otherwise(F.col("best"))
    near = F.when(F.col("whole"), F.col("best_single")).otherwise(F.least(other, F.when(indel, F.col("shorter"))))
    found = scanned.select("rank", met.alias("met"), near.alias("near")).where("met > 0")
    return found.groupBy("rank").agg(F.sum("met").alias("n_near"), F.min("near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(rank, root) from (rank, form): the end of each chain, by doubling its steps.

    A form occurs several times as often as its word, so chains are as short as the logarithm of the counts.
    """
    hops = keep(forms.select("rank", F.col("form").alias("root")))
    while True:
        further = hops.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        longer = keep(hops.join(further, "root", "left"))
        if longer.where("further is not null").isEmpty():
            return hops
        hops = keep(longer.select("rank", F.coalesce("further", "root").alias("root")))


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of words (word, n), both not null, words distinct.

    ``form``: the neighbour that occurs most (ties: the smallest word), if it occurs ``ratio`` times
    as often or more, else null. ``root``: the word at the end of the chain of forms, the word itself
    without a form. No rows: no rows. Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("chains of forms must rise")
    ranked = keep(assign_ids(words.select("word", "n"), [F.desc("n"), "word"], 1, "rank"))
    near = keep(neighbours(ranked))
    name = ranked.select(F.col("rank").alias("near"), F.col("n").alias("near_n"))
    forms = near.join(name, "near").join(ranked.select("rank", "n"), "rank").where(F.col("near_n") >= ratio * F.col("n"))
    forms = keep(forms.select("rank", F.col("near").alias("form"), F.col("near_n").alias("form_n")))
    roots = _roots(forms)
    named = forms.join(roots, "rank")
    for column in ("form", "root"):
        text = ranked.select(F.col("rank").alias(column), F.col("word").alias(f"{column}_word"))
        named = named.join(text, column)
    out = ranked.join(near.select("rank", "n_near"), "rank", "left").join(named.select("rank", "form_word", "root_word", "form_n"), "rank", "left")
    return out.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
