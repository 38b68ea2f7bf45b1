"""Fill-in-middle transformation by in-place block rotation, and its exact inverse.

A text is scanned for line ends, cut into prefix, middle and suffix at two drawn lines, and its
blocks change places inside one bytearray: the sentinels are inserted in front of their segments,
and two neighbouring blocks are exchanged by three reversals (each block, then both together).
The inverse finds the sentinels, rotates back and deletes them. Nothing is copied but STEP bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimspark.llm.common import by_batches, slices

#: Bytes that one step of a reversal exchanges.
STEP = 1 << 16
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Plan:
    """How documents are drawn: of 100, ``rate`` are transformed, and of 100 of these ``spm`` put the suffix first."""

    seed: str = "7"
    rate: int = 100
    spm: int = 50
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self):
        marks = self.prefix, self.suffix, self.middle
        if any(len(m) < 2 or m.find(m[:1], 1) >= 0 or m[:1] != marks[0][:1] for m in marks) or len(set(marks)) < 3:
            # then no mark can arise where a text and a mark meet
            raise ValueError("sentinels must differ and share a first byte that none of them repeats")

    def draws(self, doc_id: int | None) -> tuple[int, ...]:
        text = f"{self.seed}:{'' if doc_id is None else doc_id}"
        raw = hashlib.sha256(text.encode()).hexdigest()
        return tuple(int(raw[i : i + 8], 16) for i in range(0, 32, 8))


def reverse(data: bytearray, start: int, stop: int) -> None:
    """Reverse data[start:stop] in place."""
    while stop - start > 1:
        n = min(STEP, (stop - start) // 2)
        head = data[start : start + n]
        data[start : start + n] = data[stop - n : stop][::-1]
        data[stop - n : stop] = head[::-1]
        start, stop = start + n, stop - n


def exchange(data: bytearray, start: int, border: int, stop: int) -> None:
    """Exchange the blocks [start, border) and [border, stop) by three reversals."""
    reverse(data, start, border)
    reverse(data, border, stop)
    reverse(data, start, stop)


def code_points(data: bytearray, start: int, stop: int) -> int:
    """Characters of a UTF-8 span: bytes that do not continue one."""
    return int(np.count_nonzero(np.frombuffer(data, np.uint8, stop - start, start) & 0xC0 != 0x80)) if stop > start else 0


def unit_ends(data: bytes) -> np.ndarray:
    """Where each line ends, its line feed included; the last may lack it."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A) + 1
    return ends if len(ends) and ends[-1] == len(data) or not data else np.append(ends, len(data))


def transform(text: bytes, doc_id: int | None, plan: Plan) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, prefix_chars, middle_chars, output) of one text."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = plan.draws(doc_id)
    if not text or any(m in text for m in (plan.prefix, plan.suffix, plan.middle)) or h3 % 100 >= plan.rate:
        return n, PLAIN, None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[i - 1]) if i else 0 for i in (low, high))
    data = bytearray(text)
    chars = code_points(data, 0, a), code_points(data, a, b)
    data[b:b] = plan.suffix
    data[a:a] = plan.middle
    data[0:0] = plan.prefix
    a += len(plan.prefix)  # the middle block with its mark starts here
    b += len(plan.prefix) + len(plan.middle)  # and the suffix block here
    form = SPM if h4 % 100 < plan.spm else PSM
    exchange(data, 0 if form == SPM else a, b, len(data))
    return n, form, *chars, bytes(data)


def restore(output: bytes, form: str, plan: Plan) -> bytes:
    """The text that ``transform`` was given, from its output and form alone."""
    if form == PLAIN:
        return output
    data = bytearray(output)
    suffix, middle = data.index(plan.suffix), data.index(plan.middle)
    if form == SPM:
        border = data.index(plan.prefix)
        exchange(data, 0, border, len(data))  # prefix, middle, suffix
        middle, suffix = middle - border, len(data) - border
    else:
        exchange(data, suffix, middle, len(data))
        middle, suffix = suffix, suffix + len(data) - middle
    del data[suffix : suffix + len(plan.suffix)]
    del data[middle : middle + len(plan.middle)]
    del data[: len(plan.prefix)]
    return bytes(data)


FILLED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_string()).fill_null("").cast(pa.large_binary()).to_pylist()


def _filled(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = part.column("doc_id").to_pylist()
                rows = list(zip(*(transform(t, i, plan) for i, t in zip(ids, _texts(part.column("text"))))))
                n, form, prefix, middle, output = rows or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.binary()).cast(pa.string()),
                    ],
                    [x.split()[0] for x in FILLED.split(", ")],
                )

    return run


def fill_in_middle(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of docs (doc_id, text).

    Units are lines, line feed included. The draws depend on doc_id alone, so rows of one id are cut
    alike as far as they have equally many lines; repeated rows give repeated results. A null id
    draws as an empty one. Form ``plain`` (the text as it is, no counts) if the text is null (taken as empty),
    empty, holds a sentinel or is not drawn. Any segment may be empty. Whole texts are moved, whatever
    their length. No rows: no rows. Other columns are not read.
    """
    return by_batches(docs.select(F.col("doc_id").cast("long"), "text"), _filled(plan), FILLED)


def _restored(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "output"):
                forms = part.column("form").to_pylist()
                texts = [restore(t, f, plan) for t, f in zip(_texts(part.column("output")), forms)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*part.schema.names, "restored"]
                )

    return run


def restored(filled: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of ``fill_in_middle`` (null output: empty) with the text ``restored`` from output and form."""
    rest = filled.drop("restored")
    return by_batches(rest, _restored(plan), StructType([*rest.schema.fields, StructField("restored", StringType())]))
