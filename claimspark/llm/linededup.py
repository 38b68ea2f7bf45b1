"""Line dedup by an exact set-similarity join.

Lines with the same token set are one class, named by its first place (doc_id, row, line).
Tokens of a line are ordered by rarity. Two similar sets differ in few tokens, and each of these parts at
most two neighbours among the shared ones: so among the first tokens there are two that follow one another in
both sets. Classes meet in these pairs of neighbours in their prefix, of which unrelated lines share few,
however much text there is; a single rare token is shared by more lines the more there are. Sets too different
for that at a low similarity meet in the single tokens of the usual prefix. So do all sets in their rare tokens,
whose lists are short: rare tokens come first, so if two sets share one, they share one in that prefix, and if
they share none, all of them count among the differences and fewer neighbours do. Length and position rule pairs
out, and so does the distance of two parity sketches, which is never above the symmetric difference: a member that
no other one of its list can be similar to is left out before anything is joined. Jaccard on the full sets of
what is left decides.

Each list is first joined to its earliest class (a star); classes without an earlier match go on to further
centres until all earlier ones were tried, so that the pairs of a group of alike lines are not formed. The list
of a frequent token is dealt over several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import PLACE, by_batches, by_bytes, keep, mix, slices, unused, words_of
from claimspark.session import Run
from claimspark.sources.keys import assign_ids

#: Lines with fewer distinct tokens stay as they are: only blank ones, unless the caller asks for more.
LEAST = 1
#: Fixed number of counters for token frequencies, and of those in a block; any order of tokens is exact, a good one is fast.
COUNTERS, BLOCK = 1 << 22, 1 << 14
#: Counts up to EXACT have a level of their own, beyond it there are STEPS levels for each doubling.
EXACT, STEPS = 128, 4
#: Tokens up to this level are rare: single tokens of a prefix make lists.
RARE = 64
#: Rows of lists that a task collects before it deals them out, and words for which they are dealt to one group more.
ROWS, GROUP = 1 << 19, 1 << 16
#: Members of a list that are compared with one another before anything is joined; longer lists go on whole.
COMPARED = 256
#: Words of a token for which its lists get one more task.
SHARE = 1 << 14
#: Centres of a list in the second round, and the factor for each further round.
CENTRES, GROWTH = 16, 16
#: A list's low bits number its shares (0: not dealt); a member's low bits are its position there, LATE or more.
SHARE_BITS, POSITION_BITS = 16, 8
LATE = (1 << POSITION_BITS) - 1
#: Classes a task remembers so as not to list a line again.
SEEN = 1 << 18


class Lines:
    """The lines of some texts: lines per text, and the sorted distinct token hashes of each line."""

    def __init__(self, column: pa.Array):
        parts = [t.split(b"\n") for t in column.fill_null("").cast(pa.binary()).to_pylist()]
        self.counts = np.array([len(p) for p in parts], np.int64)
        flat = pa.array([line for p in parts for line in p], pa.binary()).cast(pa.string())
        hashes, words = words_of(flat)
        of = np.repeat(np.arange(len(flat)), words)
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        new = np.ones(len(of), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        self.tokens, self.of = hashes[new], of[new]
        self.sizes = np.bincount(self.of, minlength=len(flat))
        self.ends = np.cumsum(self.sizes)

    def folded(self, values: np.ndarray, fold: np.ufunc) -> np.ndarray:
        """One number per line of the values of its tokens; 0 for a line without tokens."""
        out = np.zeros(len(self.sizes), np.uint64)
        held = np.flatnonzero(self.sizes)
        if len(held):
            out[held] = fold.reduceat(values, (self.ends - self.sizes)[held])
        return out.view(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS, np.int32)
    held: list[np.ndarray] = []
    for batch in batches:
        for part in slices(batch):
            hashes, _ = words_of(part.column("text"))
            held.append((hashes & np.uint64(COUNTERS - 1)).astype(np.int32))
            if sum(map(len, held)) >= COUNTERS:
                total += np.bincount(np.concatenate(held), minlength=COUNTERS).astype(np.int32)
                held = []
    if held:
        total += np.bincount(np.concatenate(held), minlength=COUNTERS).astype(np.int32)
    blocks = total.reshape(-1, min(BLOCK, COUNTERS))
    some = np.flatnonzero(blocks.any(axis=1))
    packed = [pa.compress(blocks[i].tobytes(), "zstd", asbytes=True) for i in some]
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(packed, pa.binary())], ["block", "counts"])


def levels(counts: np.ndarray) -> np.ndarray:
    """A byte for each count; a higher count never has a lower one."""
    beyond = EXACT + STEPS * np.log2(np.maximum(counts, EXACT) / EXACT)
    return np.minimum(np.where(counts < EXACT, counts, beyond), 255).astype(np.uint8)


#: Counts that the levels stand for, at most.
COUNTS = np.array([n if n < EXACT else int(EXACT * 2 ** ((n + 1 - EXACT) / STEPS)) for n in range(256)], np.int64)


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros(min(BLOCK, COUNTERS), np.int64)
    for packed in group.column("counts").to_pylist():
        total += np.frombuffer(pa.decompress(packed, total.size * 4, "zstd", asbytes=True), np.int32)
    block = group.column("block").slice(0, 1).combine_chunks()
    return pa.table({"block": block, "level": pa.array([levels(total).tobytes()], pa.binary()), "words": pa.array([int(total.sum())])})


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(level of each counter over all texts, words of all texts); COUNTERS bytes come to the driver, whatever the input."""
    out = np.zeros((COUNTERS // min(BLOCK, COUNTERS), min(BLOCK, COUNTERS)), np.uint8)
    counted = by_batches(docs.select("text"), _counted, "block int, counts binary")
    table = counted.groupBy("block").applyInArrow(_summed, "block int, level binary, words long").toArrow()
    for block, level in zip(table["block"].to_pylist(), table["level"].to_pylist()):
        out[block] = np.frombuffer(level, np.uint8)
    return out.reshape(-1), sum(table["words"].to_pylist())


#: ``a`` and ``b`` name the token set, ``even`` and ``odd`` are its sketch.
LINED = "doc_id long, row long, n_lines int, lines array<struct<line: int, a: long, b: long, n: int, even: long, odd: long>>"


def _named(x: Lines) -> tuple[np.ndarray, np.ndarray]:
    """The names a and b of each line's token set; the low bits of a are free for a position."""
    a, b = (x.folded(mix(x.tokens * PLACE[i] + PLACE[i + 2]), np.add) for i in (0, 1))
    return a & np.int64(~LATE), b


def _sketch(x: Lines) -> tuple[np.ndarray, np.ndarray]:
    """128 parities of each line's token set, in two halves; one xor the other are 64 parities of it.

    64 tell lines of up to some 90 words apart, 128 up to 200: unlike sets differ in half of the parities.
    """
    place = mix(x.tokens * PLACE[4])
    bit, odd = np.uint64(1) << (place & np.uint64(63)), (place >> np.uint64(6) & np.uint64(1)).astype(bool)
    return x.folded(np.where(odd, np.uint64(0), bit), np.bitwise_xor), x.folded(np.where(odd, bit, np.uint64(0)), np.bitwise_xor)


def _lined(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = Lines(part.column("text"))
                a, b = _named(x)
                sketch = _sketch(x)
                text = np.repeat(np.arange(len(x.counts)), x.counts)
                number = np.arange(len(text)) - np.repeat(np.cumsum(x.counts) - x.counts, x.counts)
                use = np.flatnonzero(x.sizes >= max(least, 1))
                held = [number[use].astype(np.int32), a[use], b[use], x.sizes[use].astype(np.int32), *(h[use] for h in sketch)]
                held = pa.StructArray.from_arrays([pa.array(v) for v in held], ["line", "a", "b", "n", "even", "odd"])
                per_text = np.concatenate(([0], np.cumsum(np.bincount(text[use], minlength=len(x.counts))))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("row"),
                        pa.array(x.counts.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(per_text), held),
                    ],
                    ["doc_id", "row", "n_lines", "lines"],
                )

    return run


def prefixes(n: int, percent: int) -> tuple[int, int]:
    """Tokens of a set of n in its prefix of single tokens and in its prefix of neighbours, 0 if there is none.

    A partner of m tokens shares o or more of them and differs in D or fewer. Of the first D + 2 shared tokens two are
    neighbours in both sets, and they lie within the first D + 2 + n - o. Where o is less than D + 2, one shared token
    within the first n - o + 1 must do. Which of the two holds depends on both sizes alike.
    """
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1, dtype=np.int64)
    apart = (n + m) * (100 - percent) // (100 + percent)
    apart -= (n + m - apart) % 2
    shared = (n + m - apart) // 2
    meant = (apart > 0) & (shared <= np.minimum(n, m))
    near = meant & (shared >= apart + 2)
    single = n - shared[meant & ~near] + 1
    pairs = (apart + 2 + n - shared)[near]
    return int(single.max(initial=0)), int(pairs.max(initial=0))


def wanted(n: int, percent: int) -> tuple[int, int, np.ndarray]:
    """What a set of n tokens lists: (single tokens, single tokens if rare, tokens of its prefix of neighbours by the number of rare ones).

    Rare tokens come first. Sets that share one share one within the first n - o + 1 of either (o and D as in ``prefixes``).
    Of sets that share none, all rare tokens, r, are among the n - o or fewer that are not shared, and D - r others are left
    at most: the neighbours lie in the first D - r + 2 + (n - r) - o of the tokens behind the rare ones. Where o is less
    than D + 2, which depends on both sizes alike, any single token must do.
    """
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1, dtype=np.int64)
    apart = (n + m) * (100 - percent) // (100 + percent)
    apart -= (n + m - apart) % 2
    shared = (n + m - apart) // 2
    meant = (apart > 0) & (shared <= np.minimum(n, m))
    near = meant & (shared >= apart + 2)
    single, rare = (int((n - shared[x] + 1).max(initial=0)) for x in (meant & ~near, meant))
    alone, length = (n - shared)[near], (apart + 2 + n - shared)[near]
    rows = range(int(alone.max(initial=-1)) + 1)
    return single, rare, np.array([length[alone >= r].max() - 2 * r for r in rows], np.int64)


#: The rows of a group of lists, packed: list, member, sketch, size.
PACKED = {"lists": np.int64, "members": np.int64, "sketches": np.uint64, "sizes": np.int32}
PACKED_SCHEMA = "part int, " + ", ".join(f"{c} binary" for c in PACKED)


def _packed(rows: list[tuple[np.ndarray, ...]], parts: int) -> pa.RecordBatch:
    """Rows of lists, dealt to parts by list, one row of bytes for each part."""
    columns = [np.concatenate(c) for c in zip(*rows)]
    part = (mix(columns[0].view(np.uint64) + PLACE[8]) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    some, first = np.unique(part[order], return_index=True)
    ends = [*first[1:].tolist(), len(part)]
    packed = [[c[i:j].tobytes() for i, j in zip(first.tolist(), ends)] for c in (c[order] for c in columns)]
    return pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(p, pa.binary()) for p in packed]], ["part", *PACKED])


def _listed(often: np.ndarray, percent: int, least: int, parts: int):
    """The lists of the classes of some texts, packed: one row per single token or pair of neighbours in a prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[int, int, np.ndarray]] = {}
        seen: set[int] = set()
        rows: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for part in slices(batch):
                x = Lines(part.column("text"))
                a, _ = _named(x)
                if len(seen) > SEEN:
                    seen.clear()
                new = np.zeros(len(a), bool)
                names = a.tolist()
                for i in np.flatnonzero(x.sizes >= max(least, 1)).tolist():
                    if names[i] not in seen:
                        seen.add(names[i])
                        new[i] = True
                # lists travel with the narrower sketch
                sketch = np.bitwise_xor(*_sketch(x))
                level = often[(x.tokens & np.uint64(COUNTERS - 1)).astype(np.int64)]
                # tokens of a line ascend, so a stable sort leaves those that are as rare in that order
                order = np.argsort(x.of.astype(np.int64) << 32 | level, kind="stable")
                tokens, level = x.tokens[order], level[order]
                at = np.arange(len(order)) - (x.ends - x.sizes)[x.of]
                rare = np.bincount(x.of[level <= RARE], minlength=len(x.sizes))
                single, short, near = (np.zeros(len(x.sizes), np.int64) for _ in range(3))
                alike, back = np.unique(np.stack([x.sizes[new], rare[new]], axis=1), axis=0, return_inverse=True)
                found = []
                for n, r in alike.tolist():
                    if n not in known:
                        known[n] = wanted(n, percent)
                    one, few, pairs = known[n]
                    found.append((one, few, pairs[r] if r < len(pairs) else 0))
                single[new], short[new], near[new] = np.array(found, np.int64).reshape(-1, 3)[back.reshape(-1)].T
                behind = at - rare[x.of]
                alone = new[x.of] & ((at < single[x.of]) | (at < short[x.of]) & (level <= RARE))
                # the last token of a prefix has no neighbour in it
                paired = new[x.of] & (behind >= 0) & (behind + 1 < np.minimum(near, x.sizes - rare)[x.of])
                for kind, chosen in enumerate((alone, paired)):
                    first = np.flatnonzero(chosen)
                    name = mix(tokens[first] * PLACE[5])
                    if kind:
                        name = mix(name + tokens[first + 1] * PLACE[6])
                    of = x.of[first]
                    # a list is no longer than its first token is frequent, whichever line asks
                    shares = np.minimum(COUNTS[level[first]] // SHARE + 1, (1 << SHARE_BITS) - 1).astype(np.uint64)
                    share = np.where(shares > 1, mix(a[of].view(np.uint64) + PLACE[7]) % shares + np.uint64(1), np.uint64(0))
                    name = name >> np.uint64(SHARE_BITS) << np.uint64(SHARE_BITS) | share
                    rows.append((name.view(np.int64), a[of] | np.minimum(at[first], LATE), sketch[of], x.sizes[of].astype(np.int32)))
                if sum(len(r[0]) for r in rows) >= ROWS:
                    yield _packed(rows, parts)
                    rows = []
        if rows:
            yield _packed(rows, parts)

    return run


def _met(percent: int):
    """(list, member) of the packed rows of some whole lists, without members that no other one can be similar to."""

    def run(group: pa.Table) -> pa.Table:
        lists, members, sketches, sizes = (np.frombuffer(b"".join(group.column(c).to_pylist()), t) for c, t in PACKED.items())
        # a class comes from as many tasks as have a line of it
        order = np.lexsort((sizes, sketches, members, lists))
        lists, members, sketches, sizes = (c[order] for c in (lists, members, sketches, sizes))
        new = np.ones(len(lists), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in (lists, members, sketches, sizes)], axis=0)
        lists, members, sketches, sizes = (c[new] for c in (lists, members, sketches, sizes))
        first = np.flatnonzero(np.diff(lists, prepend=~lists[:1]))
        length = np.diff(first, append=len(lists))
        left = np.repeat(first + length, length) - np.arange(len(lists)) - 1
        # the shares of a dealt list meet others elsewhere
        dealt = lists & ((1 << SHARE_BITS) - 1) > 0
        length = np.repeat(length, length)
        stay = dealt | (length > COMPARED)
        place, n = members & LATE, sizes.astype(np.int64)
        u, step = np.flatnonzero(~stay & (left > 0)), 1
        while len(u):
            v = u + step
            both, least = n[u] + n[v], np.minimum(place[u], place[v])
            most = least + np.minimum(n[u] - place[u], n[v] - place[v])
            placed = (np.maximum(place[u], place[v]) >= LATE) | (most * (100 + percent) >= both * percent)
            # unsigned: of a negative number numpy counts the bits of its absolute value
            apart = np.bitwise_count(sketches[u] ^ sketches[v]).astype(np.int64)
            likely = placed & (apart * (100 + percent) <= both * (100 - percent))
            likely &= np.minimum(n[u], n[v]) * 100 >= np.maximum(n[u], n[v]) * percent
            stay[u[likely]] = stay[v[likely]] = True
            step += 1
            u = u[left[u] >= step]
        return pa.table({"list": pa.array(lists[stay]), "member": pa.array(members[stay])})

    return run


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) of the wanted lines (line, id) of each text."""
    for batch in batches:
        for part in slices(batch):
            parts = [t.split(b"\n") for t in part.column("text").fill_null("").cast(pa.binary()).to_pylist()]
            wanted = part.column("wanted")
            of = np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy())
            line, name = wanted.flatten().flatten()
            found = pa.array([parts[i][j] for i, j in zip(of, line.to_pylist())], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([name, found], ["id", "text"])


def _alike(percent: int):
    """The v of rows (v, su, sv) whose lines have 100 * overlap >= percent * union of their distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = Lines(batch.column("su")), Lines(batch.column("sv"))
            of, tokens = np.concatenate((u.of, v.of)), np.concatenate((u.tokens, v.tokens))
            order = np.lexsort((tokens, of))
            of, tokens = of[order], tokens[order]
            twice = of[1:][(of[1:] == of[:-1]) & (tokens[1:] == tokens[:-1])]
            overlap = np.bincount(twice, minlength=len(batch))
            found = pa.array(100 * overlap >= percent * (u.sizes + v.sizes - overlap))
            yield pa.RecordBatch.from_arrays([batch.column("v").filter(found)], ["id"])

    return run


def _row(text: str = "text") -> Column:
    """Tells rows with equal ids apart; rows equal in this too are taken as one document."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _possible(u: Column, v: Column, percent: int) -> Column:
    """Whether two members (n, pos, even, odd) of a list may be similar, by length, position and sketch.

    Shared tokens before that of the list stand before it in both sets, and those behind it behind it in both.
    """
    both, alike = u["n"] + v["n"], F.least(u["n"], v["n"]) * 100 >= F.greatest(u["n"], v["n"]) * percent
    most = F.least(u["pos"], v["pos"]) + F.least(u["n"] - u["pos"], v["n"] - v["pos"])
    placed = (F.greatest(u["pos"], v["pos"]) >= LATE) | (most * (100 + percent) >= both * percent)
    apart = F.bit_count(u["even"].bitwiseXOR(v["even"])) + F.bit_count(u["odd"].bitwiseXOR(v["odd"]))
    return alike & placed & (apart * (100 + percent) <= both * (100 - percent))


def _later(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(id) of the v of pairs (u, v), u the earlier, that are similar."""
    both = pairs.distinct().join(texts.select(F.col("id").alias("u"), F.col("text").alias("su")), "u")
    both = both.join(texts.select(F.col("id").alias("v"), F.col("text").alias("sv")), "v").select("v", "su", "sv")
    return by_bytes(both, _alike(percent), "id long").distinct()


def line_matches(docs: DataFrame, percent: int = 80, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(per document lines, classes with a copy or an earlier match).

    The first: doc_id, row, n_lines, lines (line, a, b). The second: a, b, first (its first
    line: doc_id, row, line), matched (an earlier line of another class is similar).
    """
    source = docs.select(F.col("doc_id").cast("long"), "text", _row().alias("row"))
    lined = keep(by_batches(source, _lined(least), LINED))
    with Run(docs.sparkSession) as run:
        each = lined.select("doc_id", "row", F.explode("lines").alias("l"))
        place = F.struct("doc_id", "row", F.col("l.line").alias("line"))
        # size and sketch of a class are the same wherever they come from
        same = F.struct(*[F.col(f"l.{c}").alias(c) for c in ("n", "even", "odd")])
        classes = each.groupBy("l.a", "l.b").agg(F.min(place).alias("first"), F.first(same).alias("c"), F.count("*").alias("copies"))
        # numbered in the order of their first places
        classes = assign_ids(run.keep(classes.select("a", "b", "first", "c.*", "copies")), ["first"], 1, "id", run.keep)
        matched = _matched(run, source, classes, percent, least)
        out = classes.join(matched.withColumn("matched", F.lit(True)), "id", "left")
        out = out.select("a", "b", "first", F.coalesce("matched", F.lit(False)).alias("matched"), "copies").where("matched or copies > 1")
        out = keep(out)
    names = F.transform("lines", lambda x: F.struct(x["line"], x["a"], x["b"]))
    return lined.select("doc_id", "row", "n_lines", names.alias("lines")), out


def _matched(run: Run, source: DataFrame, classes: DataFrame, percent: int, least: int) -> DataFrame:
    """(id) of the classes with an earlier similar one."""
    often, words = frequencies(source)
    # as many groups as the rows need; a list is no longer than SHARE allows
    listed = _listed(often, percent, least, min(max(words // GROUP, 64), 1 << 16))
    rows = by_batches(source.select("text"), listed, PACKED_SCHEMA)
    rows = rows.groupBy("part").applyInArrow(_met(percent), "list long, member long").distinct()
    name, dealt = F.col("member").bitwiseAND(F.lit(~LATE)), F.col("list").bitwiseAND(F.lit((1 << SHARE_BITS) - 1)) > 0

    x = F.struct("n", F.col("member").bitwiseAND(F.lit(LATE)).cast("int").alias("pos"), "even", "odd").alias("x")
    token = F.shiftright("list", SHARE_BITS).alias("token")
    ordered = Window.partitionBy("list").orderBy("id")
    with Run(source.sparkSession) as part:
        members = part.keep(rows).withColumn("a", name).join(classes.select("a", "id", "n", "even", "odd"), "a").select("list", "id", x)
        centre = F.first(F.struct("id", "x")).over(ordered)
        members = members.withColumns({"rank": F.row_number().over(ordered), "centre": centre})
        near = (F.col("rank") > 1) & _possible(F.col("centre.x"), F.col("x"), percent)
        members = members.withColumn("near", F.when(near, F.col("centre.id"))).drop("centre")
        members = run.keep(members).withColumns({"token": token, "dealt": dealt})

    ends = classes.join(members.select("id").distinct(), "id", "left_semi").select("first.*", "id")
    wanted = ends.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.collect_list(F.struct("line", "id")).alias("wanted"))
    found = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")))
    texts = by_batches(found.select("doc_id", "row", "text", "wanted"), _lines, "id long, text string")
    # repeated rows need to be read once
    texts = run.keep(texts.dropDuplicates(["id"]))

    matched = run.keep(_later(members.where("near is not null").select(F.col("near").alias("u"), F.col("id").alias("v")), texts, percent))
    low, high = 1, CENTRES
    while True:
        open_ = members.join(matched, "id", "left_anti")
        # lists with a class that has no match and stands behind a centre not yet tried
        last = open_.groupBy("token").agg(F.max("id").alias("last"))
        # the shares of a dealt list have not met yet in the second round
        tried = F.when(F.col("dealt") & F.lit(low == 1), 0).otherwise(low)
        centres = members.where((F.col("rank") > tried) & (F.col("rank") <= high)).join(last, "token").where(F.col("id") < F.col("last"))
        centres = run.keep(centres.select("token", F.col("list").alias("lu"), F.col("id").alias("u"), F.col("x").alias("xu"), F.col("rank").alias("at")))
        if centres.isEmpty():
            return matched
        meet = (F.col("u") < F.col("id")) & _possible(F.col("xu"), F.col("x"), percent) & ((F.col("at") > 1) | (F.col("list") != F.col("lu")))
        pairs = open_.join(centres, "token").where(meet).select("u", F.col("id").alias("v"))
        matched = run.keep(matched.unionAll(_later(run.keep(pairs.distinct()), texts, percent)))
        low, high = high, high * GROWTH


def repeated_lines(docs: DataFrame, percent: int = 80, least: int = LEAST) -> DataFrame:
    """(doc_id, row, n_lines, n_removed, removed) for each row of docs (doc_id, text).

    ``removed`` lists the lines (from 0) that come after a similar one: an equal token set, or
    Jaccard of percent or more of the distinct words (A-Z lower-cased). Order is by doc_id
    (nulls first), then row (a hash of the text), then line; a match counts whether or not the earlier
    line itself is removed. Lines with fewer than ``least`` distinct words stay, and so do blank ones. Null text: one
    empty line. Rows equal in id and text are taken as one document, with equal results. No rows:
    no rows.
    """
    lined, classes = line_matches(docs, percent, least)
    each = lined.select("doc_id", "row", F.explode("lines").alias("l")).select("doc_id", "row", "l.line", "l.a", "l.b")
    place = F.struct("doc_id", "row", "line")
    gone = each.join(classes, ["a", "b"]).where(F.col("matched") | (place != F.col("first")))
    # null ids: the struct comparison above is null-safe, the join below is made so
    gone = gone.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("line")).alias("removed")).withColumnRenamed("doc_id", "d").withColumnRenamed("row", "r")
    gone = keep(gone)
    out = lined.select("doc_id", "row", "n_lines").join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", "row", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"))


def drop_repeated_lines(docs: DataFrame, percent: int = 80, least: int = LEAST, emptied: bool = True) -> DataFrame:
    """docs without the lines that ``repeated_lines`` removes; n_chars, if there, follows.

    All rows stay; not ``emptied``: without those that lost lines and have no word left. Rows that had no word before stay.
    """
    d, r, removed = (unused(c, docs.columns) for c in ("_d", "_r", "_removed"))
    found = repeated_lines(docs, percent, least).where("n_removed > 0").select(F.col("doc_id").alias(d), F.col("row").alias(r), F.col("removed").alias(removed))
    found = keep(found.dropDuplicates([d, r]))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (_row() == F.col(r))
    lines = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(removed, i))
    left = F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))
    out = docs.join(found, on, "left").withColumn("text", left)
    if not emptied:
        out = out.where(F.col(removed).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
