"""Near-duplicate documents by one-permutation MinHash.

One hash per shingle serves all bins (one-permutation hashing); empty bins copy a
full one along a fixed random sequence of bins (optimal densification). Bands of
bins make buckets. A bucket joins its members to a star's centre instead of forming
pairs; links are confirmed on the full shingle sets. The centre is the member that meets
most others over all its buckets, so the original of a group of copies comes before
its copies. Buckets whose members are not yet in one component get further centres, until
every member has been one; sketches rule out most of those pairs before sets are read: parities
of the set for small sets, without loss, and bits of the signature for large ones. Components come from star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from claimspark.llm.common import by_batches, by_bytes, digest, keep, lists, mix, shingle_sets, slices, unused
from claimspark.llm.components import components
from claimspark.session import Run

#: 32 bands of 4 bins: a pair of similarity 0.8 shares no band with probability 5e-8.
BINS, BAND = 128, 4
#: Centres per bucket in the first and each further round grow by this factor.
GROWTH = 16
#: Words of 64 bits that say which documents' texts are fetched; a fixed number, so at most 8 MB are broadcast.
FILTER = 1 << 19
#: Members of a bucket that are ranked in one task; a larger bucket is dealt over several.
DEAL = 1 << 10
#: Sets with fewer shingles have 256 parities as their sketch, whose distance is never above the symmetric
#: difference. In larger ones nearly every bin is full, so bins are as good as independent: two bits of
#: each bin tell how alike two sets are, as equal bins agree and others by chance in half. A pair of
#: similarity 0.8 has 230 of 256 bits equal, with a deviation of 6. Pairs of two large sets whose equal
#: bits speak for a similarity lower by SLACK are not read: over six deviations. A pair of a small and a
#: large set is always read.
SURE, SLACK = 4 * BINS, 0.3
FEATURES = "doc_id long, n_shingles long, node binary, bands array<long>, sketch array<long>"


def _sources() -> np.ndarray:
    """Bin from which an empty bin copies, by attempt."""
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(0, BINS, (4096, BINS))


SOURCES = _sources()
BAND_PLACE = mix(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One-permutation signatures with optimal densification; every set has a member."""
    low = np.zeros((len(sets), BINS), np.uint64)
    full = np.zeros((len(sets), BINS), bool)
    for i, s in enumerate(sets):  # sorted, so the first value of a bin is its least
        bins = (s >> np.uint64(57)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        low[i, bins[first]] = s[first]
        full[i, bins[first]] = True
    done = full.copy()
    attempt = 0
    while not done.all():
        rows = np.flatnonzero(~done.all(axis=1))
        source = SOURCES[attempt] if attempt < len(SOURCES) else (np.arange(BINS) + attempt) % BINS
        hit = ~done[rows] & full[rows][:, source]
        at, bin_ = np.nonzero(hit)
        low[rows[at], bin_] = low[rows[at], source[bin_]]
        done[rows[at], bin_] = True
        attempt += 1
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """A 64-bit bucket key per band; the band's place is part of it."""
    parts = (mix(low + BAND_PLACE) * BAND_PLACE).reshape(len(low), BINS // BAND, BAND)
    return mix(parts.sum(axis=2, dtype=np.uint64)).view(np.int64)


def sketches(sets: list[np.ndarray], low: np.ndarray) -> np.ndarray:
    """Two bits of each bin, or parities of the set if it is small, packed in four integers."""
    bits = np.concatenate((low & np.uint64(1), low >> np.uint64(1) & np.uint64(1)), axis=1).astype(np.uint8)
    for i, s in enumerate(sets):
        if len(s) < SURE:
            bits[i] = np.bincount((s & np.uint64(2 * BINS - 1)).astype(np.int64), minlength=2 * BINS) & 1
    return np.packbits(bits, axis=1).view(np.int64)


def _features(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"), k)
                held = [i for i, s in enumerate(sets) if len(s)]
                bands: list[np.ndarray] = [np.empty(0, np.int64)] * len(sets)
                drawn = bands.copy()
                if held:
                    own = [sets[i] for i in held]
                    low = signatures(own)
                    for i, key, sketch in zip(held, band_keys(low), sketches(own, low)):
                        bands[i], drawn[i] = key, sketch
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                        lists(bands, pa.int64()),
                        lists(drawn, pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "node", "bands", "sketch"],
                )

    return run


def _own_texts(k: int):
    """(node, text) of the rows (node, text) whose text has the set that node names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                nodes = [digest(s) if len(s) else None for s in shingle_sets(part.column("text"), k)]
                yield part.filter(pa.array([n == node for n, node in zip(part.column("node").to_pylist(), nodes)], pa.bool_()))

    return run


def _alike(k: int, percent: int):
    """The (u, v) of rows (u, v, su, sv) whose texts' full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[bytes, np.ndarray] = {}
            names = [batch.column(c).to_pylist() for c in ("u", "v")]
            for own, text in zip(names, ("su", "sv")):
                # a text that meets many others is cut into shingles once a batch
                first = {n: i for i, n in enumerate(own) if n not in sets}
                sets |= zip(first, shingle_sets(batch.column(text).take(pa.array(list(first.values()), pa.int64())), k))
            found = []
            for u, v in zip(*names):
                both = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
                found.append(100 * both >= percent * (len(sets[u]) + len(sets[v]) - both))
            yield batch.select(["u", "v"]).filter(pa.array(found, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets have 100 * intersection >= percent * union.

    Texts travel, not sets: a text packs well, its hashes not at all.
    """
    both = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("su")), "u")
    both = both.join(texts.select(F.col("node").alias("v"), F.col("text").alias("sv")), "v")
    return by_bytes(both.select("u", "v", "su", "sv"), _alike(k, percent), "u binary, v binary")


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the rows of docs with an id of wanted (node, doc_id).

    Most documents meet no other. A bit per hash of a wanted id keeps their texts from being shuffled; the join
    decides, so ids that share a bit cost a move and change nothing.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER * 64))
    word, one = F.shiftright(bit, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(bit % 64 as int))")
    bits = wanted.withColumn("bit", bit).groupBy(word).agg(F.bit_or(one).alias("bits"))
    asked = docs.select("doc_id", "text", bit.alias("bit"), word).join(F.broadcast(bits), "word").where(F.col("bits").bitwiseAND(one) != 0)
    return asked.join(wanted, "doc_id").select("node", "text")


def _likely(percent: int) -> Column:
    """Sizes allow the similarity, and the sketches do not speak against it."""
    less, more = F.least("xu.n", "xv.n"), F.greatest("xu.n", "xv.n")
    apart = sum((F.bit_count(F.col("xu.sketch")[i].bitwiseXOR(F.col("xv.sketch")[i])) for i in range(4)), F.lit(0))
    small = apart * (100 + percent) <= (less + more) * (100 - percent)
    large = 256 - apart >= int(128 * (1 + percent / 100 - SLACK))
    return (less * 100 >= more * percent) & F.when(more < SURE, small).when(less >= SURE, large).otherwise(True)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, n_links, class_id) for each row of docs (doc_id, text).

    Links: 100 * intersection >= percent * union of the distinct k-word shingles. Equal sets
    are one class, worked on once. ``component_id`` is the smallest doc_id reachable,
    ``class_id`` the smallest with the same set, ``n_links`` the confirmed links of the class to
    other sets that joined its component (a star has as many as it needs, not all pairs).

    Null, empty or blank text: no shingles, own component. Null doc_id: not linked, null
    component, kept. Repeated ids: each row has the component of its own text. No rows: no rows.
    Other columns are not read.
    """
    return _grouped(docs, k, percent).drop("node", "root")


def _grouped(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The same with the digest of the row's set and that of its component's root, both null for rows that are not linked."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    features = keep(by_batches(docs, _features(k), FEATURES))
    with Run(docs.sparkSession) as run:
        linked = F.col("doc_id").isNotNull() & F.col("node").isNotNull()
        classes = run.keep(features.where(linked).groupBy("node").agg(F.min("doc_id").alias("class_id"), F.max("n_shingles").alias("n")))

        # one row per class and band; only buckets with two classes or more go on
        one = features.where(linked).join(classes.withColumnRenamed("class_id", "doc_id"), ["node", "doc_id"], "left_semi").dropDuplicates(["node", "doc_id"])
        with Run(docs.sparkSession) as part:
            rows = part.keep(one.select("node", F.explode("bands").alias("bucket")))
            heads = rows.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
            met = run.keep(rows.join(part.keep(heads), "bucket"))
            weights = met.groupBy("node").agg(F.sum("m").alias("w"))
            held = one.select("node", F.col("n_shingles").alias("n"), "sketch")
            nodes = run.keep(held.join(weights, "node").select("node", F.struct("n", "w", "sketch").alias("x")))

        # buckets hold names alone; what is known of a member is joined to the pairs that are left
        top = F.max(F.struct("w", F.col("node").alias("u"))).alias("top")
        top = run.keep(met.join(nodes.select("node", "x.w"), "node").groupBy("bucket").agg(top).select("bucket", "top.u"))
        stars = met.select("bucket", F.col("node").alias("v")).join(top, "bucket").where("u != v").select("u", "v").distinct()
        ends = [nodes.select(F.col("node").alias(c), F.col("x").alias(f"x{c}")) for c in "uv"]
        stars = run.keep(stars.join(ends[0], "u").join(ends[1], "v").where(_likely(percent)).select("u", "v"))

        wanted = nodes.select("node").join(classes, "node").select("node", F.col("class_id").alias("doc_id"))
        texts = by_batches(_fetched(docs, run.keep(wanted)), _own_texts(k), "node binary, text string")
        # a node names one id, so only rows of repeated ids can bring its text twice
        twice = features.groupBy("doc_id").count().where("doc_id is not null and count > 1")
        texts = run.keep(texts if twice.isEmpty() else texts.dropDuplicates(["node"]))
        links = run.keep(_confirmed(stars, texts, k, percent))
        roots = run.keep(components(links))

        low, high = 1, GROWTH
        while True:
            with Run(docs.sparkSession) as part:
                # buckets that still hold several components: more of their members become centres
                now = part.keep(met.select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
                open_ = now.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("m")).where("a < b")
                open_ = part.keep(open_.where(F.col("m") > low).select("bucket", "m"))
                if open_.isEmpty():
                    break
                # every share of a bucket ranks its own: the order of a bucket is by rank, then node
                share = F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / DEAL))
                rank = F.row_number().over(Window.partitionBy("bucket", "share").orderBy(F.desc("x.w"), F.desc("node")))
                ranked = part.keep(now.join(open_, "bucket").join(nodes, "node").withColumn("share", share).withColumn("rank", rank).drop("share"))
                # of a bucket in one share the first was the star's centre; of several shares only one share's first was
                done = F.when(F.col("m") > DEAL, 0).otherwise(1) if low == 1 else F.lit(low)
                middle = ranked.where((F.col("rank") <= high) & (F.col("rank") > done))
                middle = middle.select("bucket", F.col("node").alias("u"), F.col("x").alias("xu"), F.col("root").alias("ru"), F.col("rank").alias("at"))
                pairs = ranked.select("bucket", F.col("node").alias("v"), F.col("x").alias("xv"), F.col("root").alias("rv"), "rank")
                pairs = pairs.join(part.keep(middle), "bucket").where(
                    (F.struct("rank", "v") > F.struct("at", "u")) & (F.col("ru") != F.col("rv")) & _likely(percent)
                )
                found = run.keep(_confirmed(part.keep(pairs.select("u", "v").distinct()), texts, k, percent))
            low, high = high, high * GROWTH
            if not found.isEmpty():
                links = run.keep(links.unionAll(found))
                # the stars found before stand for their links
                stars = roots.where("node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))
                roots = run.keep(components(stars.unionAll(found)))

        ends = links.select(F.col("u").alias("node")).unionAll(links.select(F.col("v").alias("node")))
        ends = ends.groupBy("node").agg(F.count("*").alias("n_links"))
        members = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        members = run.keep(members.join(ends, "node", "left"))
        least = run.keep(members.groupBy("root").agg(F.min("class_id").alias("component_id")))
        named = keep(members.join(least, "root").select("node", "root", "class_id", "component_id", "n_links"))
    out = features.select("doc_id", "n_shingles", F.when(linked, F.col("node")).alias("node")).join(named, "node", "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        "node",
        "root",
    )


def _with_node(k: int, name: str):
    """Each row of a batch with the digest of its text's set in a further column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                nodes = [digest(s) if len(s) else None for s in shingle_sets(part.column("text"), k)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes, pa.binary())], [*part.schema.names, name])

    return run


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs with one document of each near-duplicate group, all columns kept.

    The document with the smallest id stays. Where rows of that id differ, each is judged by its own
    text: of those in one group the first by text, then by its other columns, stays. Rows without shingles
    or without an id all stay.
    """
    found = keep(_grouped(docs, k, percent).where("doc_id is not null").select("doc_id", "kept", "node", "root"))
    twice = keep(found.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    kept = found.where("kept")
    once = kept.join(twice, "doc_id", "left_anti").select("doc_id")
    out = docs.join(keep(once), "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
    if twice.isEmpty():
        return out.select(docs.columns)
    # rows of repeated ids: the text's set tells which of them is meant
    node, root = (unused(c, docs.columns) for c in ("_node", "_root"))
    rows = docs.join(twice, "doc_id", "left_semi").select(docs.columns)
    rows = keep(by_batches(rows, _with_node(k, node), StructType([*rows.schema.fields, StructField(node, BinaryType())])))
    meant = kept.where("node is not null").join(twice, "doc_id", "left_semi").select("doc_id", F.col("node").alias(node), F.col("root").alias(root))
    whole = F.struct(*docs.columns)
    first = rows.join(keep(meant.distinct()), ["doc_id", node]).groupBy(root).agg(F.min_by(whole, F.struct("text", F.to_json(whole))).alias("row"))
    return out.unionByName(rows.where(F.col(node).isNull())[docs.columns]).unionByName(first.select("row.*")).select(docs.columns)
