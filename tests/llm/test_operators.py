"""Each operator against a brute-force version on rows with nulls, ties, repeats, long and empty texts."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimspark.llm import linededup, merkle, minhash, packing, pieces, pii, quality, sharding, tokenstore, warc, words
from claimspark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, size int"


def prose(rng: random.Random, n: int) -> str:
    parts = ["the", "of", "and", "rain", "river", "stone", "Éa", "naïve", "o'er", "tion", "42", "well-known", "中文"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) + rng.choice(["", "", ".", ",\n", "\n"]) for _ in range(n))


def sample_rows() -> list[tuple]:
    rng = random.Random(4)
    long = prose(rng, 4000)
    base = prose(rng, 200)
    near = base.split(" ")
    near[50] = "changed"
    texts = [base, base, " ".join(near), base + " more at the end", long, long[: len(long) // 2], "", None, " \n\t ", "one two", "one two"]
    texts += ["ONE Two", "a b c d e f g", "a b c d e f g\na b c d e f g\nx y", "mail a.b@x.org or +1 (212) 555-0100\n10.1.2.300 4111 1111 1111 1111"]
    texts += [prose(rng, n) for n in (1, 3, 60, 90, 500)] + ["#$%& " * 60, "same words again " * 40]
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or ""), "x", 1) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[4], (None, base, "en", "s", 1, "x", 1), (None, None, "en", "s", 1, "x", 1), (3, "another text with the id three", "en", "s", 1, "x", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None, k: int) -> frozenset:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def test_near_duplicates(docs, empty):
    rows = sample_rows()
    sets = [(r[0], shingles(r[1], 4)) for r in rows]
    group = {s: s for i, s in sets if s and i is not None}

    def top(s):
        while group[s] is not s:
            s = group[s]
        return s

    for a in group:
        for b in group:
            if 100 * len(a & b) >= 80 * len(a | b):
                group[top(a)] = top(b)
    least: dict = {}
    for i, s in sets:
        if s and i is not None:
            least[top(s)] = min(i, least.get(top(s), i))
    want = Counter()
    for i, s in sets:
        own = least[top(s)] if s and i is not None else i
        want[(i, len(s), own, True if i is None else i == own)] += 1
    got = Counter(tuple(r) for r in minhash.near_duplicates(docs, 4).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == want
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.drop_near_duplicates(docs, 4)
    assert kept.columns == docs.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert ids.count(0) == 1 and 1 not in ids and ids.count(None) == 2


def test_links_of_short_texts_are_not_lost(spark):
    """Texts of 8 and 7 words share 4 of 5 shingles: every pair is linked, however alike its sketches."""
    rows = []
    for i in range(0, 6000, 2):
        w = [f"w{i}x{j}" for j in range(8)]
        rows += [(i, " ".join(w)), (i + 1, " ".join(w[:7]))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: i - i % 2 for i, _ in rows}


def test_first_of_every_share_becomes_a_centre(spark, monkeypatch):
    """A bucket is dealt over shares that rank their own; the first of each meets the others too, not the bucket's top alone."""
    monkeypatch.setattr(minhash, "DEAL", 1)
    rng = np.random.Generator(np.random.PCG64(5))
    sets = [frozenset(range(60)) | {60 + int(w) for w in np.flatnonzero(rng.random(60) < 0.38)} for _ in range(90)]
    docs = spark.createDataFrame([(i, " ".join(f"w{w}" for w in sorted(s))) for i, s in enumerate(sets)], "doc_id long, text string")
    least = list(range(len(sets)))
    for _ in sets:
        least = [min(least[j] for j, b in enumerate(sets) if 100 * len(a & b) >= 80 * len(a | b)) for a in sets]
    got = minhash.near_duplicates(docs, 1)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(enumerate(least))


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    copy = "one two three four five six seven eight"
    rows = [(1, copy), (3, "rain falls on the old river"), (3, "another text of the same id"), (3, copy + "."), (3, copy), (3, ""), (3, "  ")]
    rows += [(5, "p q r s t u v w"), (5, "p q r s t u v"), (7, "once only and alone"), (None, copy)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [rows[i] for i in (0, 1, 2, 3, 5, 6, 8, 9, 10)]  # of the two like texts of id 5 the first by text stays
    assert Counter(map(tuple, minhash.drop_near_duplicates(docs, 4).collect())) == Counter(want)


def test_densification_fills_every_bin():
    one = [np.array([5], np.uint64), np.arange(1, 2000, dtype=np.uint64) << np.uint64(50)]
    low = minhash.signatures(one)
    assert (low[0] == 5).all() and set(low[1].tolist()) <= set(one[1].tolist())


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, x) for x in range(101, 160)] + [(7, 7), (3, 2)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(21)} == {0} and {got[i] for i in range(100, 160)} == {100}


def test_pieces(docs, empty):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter()
    for r in sample_rows():
        ids = sp.encode(r[1] or "") + [2]
        spelled = " ".join(map(str, ids))
        want[(r[0], len(ids), hashlib.sha256(spelled.encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest(), True)] += 1
    assert Counter(tuple(r) for r in pieces.piece_digests(docs, PIECES).collect()) == want
    assert pieces.piece_digests(empty, PIECES).count() == 0
    back = pieces.decode_pieces(pieces.encode_pieces(docs, PIECES), PIECES)
    assert Counter(r["text"] for r in back.collect()) == Counter(r[1] or "" for r in sample_rows())


def test_pieces_of_odd_texts_by_heap_and_by_table():
    coder = pieces.PieceEncoder(PIECES)
    rng = random.Random(1)
    odd = ["a  b", "   a", "a ", " ", "\n", "a▁b", "<s>", "①", "a" * 500, "x" * 60 + " \x00 é", "中文 分词", "\t\r\n", " ".join(["ab  c"] * 90)]
    odd += ["".join(rng.choice("ab  \n.thein▁é中😀") for _ in range(rng.randrange(200))) for _ in range(200)]
    for text, (raw, agreed) in zip(odd, coder.encode(odd)):
        assert np.frombuffer(raw, np.int32).tolist() == coder.library.encode(text) + [2] and agreed
    for chunk in ("▁thetherein", "▁aaaaab", "▁▁▁x"):
        flat, _ = coder._merge_short([chunk])
        assert flat.tolist() == coder._merge_long(chunk)


def test_a_fault_of_the_agenda_shows_in_the_ids():
    coder = pieces.PieceEncoder(PIECES)
    coder.rank, coder.made = coder.rank[:1], coder.made[:1]
    coder.keys, coder.pairs = coder.keys[:1], {}
    (raw, agreed), = coder.encode(["the river"])
    ids = np.frombuffer(raw, np.int32).tolist()
    assert not agreed and ids != coder.library.encode("the river") + [2] and len(ids) == len("▁the▁river") + 1


def test_words_equal_the_library():
    coder, library = words.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    odd = ["", " ", "it's a DON'T", "a<|endoftext|>b", "ﬁ İstanbul Ａ１２", "é é", "x\x1cy", "a\x0bb c\x0cd", "😀 ok", "½²ª", "l'amour 'tis", "__a_b--", "ΑΣ", "q\xada\x85b"]
    odd += [r[1] or "" for r in sample_rows()]
    for text, raw in zip(odd, coder.encode([t.encode() for t in odd])):
        assert np.frombuffer(raw, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_batches_beyond_what_a_worker_holds(monkeypatch):
    """One batch has more words than are held, some of them known and later than what stays."""
    monkeypatch.setattr(words, "HELD", 40)
    monkeypatch.setattr(pieces, "HELD", 40)
    batches = [[" ".join(f"w{i}" for i in range(a, b))] for a, b in ((0, 38), (15, 95), (0, 200), (190, 230), (5, 12))]
    coder, library = words.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    piece = pieces.PieceEncoder(PIECES)
    for batch in batches:
        assert np.frombuffer(coder.encode([t.encode() for t in batch])[0], np.uint32).tolist() == library.encode(batch[0], add_special_tokens=False).ids
        assert np.frombuffer(piece.encode(batch)[0][0], np.int32).tolist() == piece.library.encode(batch[0]) + [2]


def ids_of(text: str | None) -> np.ndarray:
    return np.array(Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_token_store(docs, empty):
    rows = sorted(((r[0], r[1]) for r in sample_rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = Counter(), 0
    for doc_id, text in rows:
        ids = ids_of(text)
        want[(doc_id, start, len(ids), zlib.crc32(ids.tobytes()))] += 1
        start += len(ids)
    assert Counter(tuple(r) for r in tokenstore.stored_digests(docs, WORDS).collect()) == want
    assert tokenstore.stored_digests(empty, WORDS).count() == 0
    uri, manifest = tokenstore.write_store(docs, WORDS)
    found = tokenstore.read_ids(docs.sparkSession.createDataFrame([(9,), (777,)], "doc_id long"), uri, manifest).collect()
    assert [(r["doc_id"], r["ids"]) for r in found] == [(9, ids_of("one two").tolist())]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64))
    built = tokenstore.PerfectHash.build(keys)
    assert sorted(built.slots(keys).tolist()) == list(range(len(keys)))
    assert tokenstore.PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3


def test_packing(docs, empty):
    got = packing.pack(docs, WORDS, window=64).collect()
    texts = Counter()
    for r in got:
        texts[(r["doc_id"], r["doc_tokens"])] += r["length"]
    wanted = [(r[0], ids_of(r[1])) for r in sample_rows()]
    assert sum(texts.values()) == sum(len(i) for _, i in wanted)
    crcs = {(d, s, n): zlib.crc32(i[s : s + n].tobytes()) for d, i in wanted for s, n in [(r["start"], r["length"]) for r in got if r["doc_id"] == d]}
    several = {i for i, n in Counter(d for d, _ in wanted).items() if n > 1}
    assert all(r["ids_crc32"] == crcs[(r["doc_id"], r["start"], r["length"])] for r in got if r["doc_id"] not in several)
    sequences: dict = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert sum(n < 64 for n in sequences.values()) <= 1 and max(sequences.values()) == 64
    assert packing.pack(empty, WORDS).count() == 0


def test_plan_never_exceeds_the_histogram():
    h = np.random.default_rng(2).integers(0, 40, 65)
    used = np.zeros_like(h)
    for lengths, times in packing.plan(h):
        assert sum(lengths) == 64
        for v in lengths:
            used[v] += times
    assert (used <= h).all() and used.sum() > 0.5 * h[1:64].sum()


def test_warc(spark):
    html = ["<p>é</p>", "<p>é</p>", "", None, "x" * 300_000, "x" * 300_000, "\x1f\x8b\x08 no gzip"]
    pages = spark.createDataFrame([(i, f"http://h/{i} \r\n" if i else None, h) for i, h in enumerate(html)] + [(None, "u", ""), (-5, "u", "<p>é</p>")], "page_id long, url string, html string")
    rows = [tuple(r) for r in pages.collect()]
    holder = {}
    for i, _, h in rows:
        if i is not None:
            holder[h or ""] = max(i, holder.get(h or "", i))
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        first = i == holder[h or ""]
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit", None if first else holder[h or ""])] += 1
    uri, files = warc.write_archive(pages)
    for split in (97, 8 << 20):
        got = warc.read_archive(uri, files, split, payloads=True)
        assert Counter(tuple(r)[:5] for r in got.collect()) == want and got.where("not intact").count() == 0
    assert warc.archived(pages.limit(0)).count() == 0


def test_fingerprints(docs, empty):
    rows = sorted(((r[0], r[1] or "") for r in sample_rows() if r[0] is not None), key=lambda r: (-r[0], r[1]))
    rows += sorted(((None, r[1] or "") for r in sample_rows() if r[0] is None), key=lambda r: r[1])
    want = Counter()
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, mark = merkle.fingerprint(text), merkle.fingerprint(changed)
        want[(i, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, mark, merkle.likeness(own, mark), merkle.likeness(own, merkle.fingerprint(following)))] += 1
    assert Counter(tuple(r) for r in merkle.fingerprints(docs).collect()) == want
    assert merkle.fingerprints(empty).count() == 0


def test_differing_branches():
    a, b = merkle.fingerprint("one\ntwo\n\nthree words here"), merkle.fingerprint("one\nTWO\n\nthree words here")
    assert merkle.differing(a, b) == [(0, 1)] and merkle.differing(a, a) == []
    assert merkle.likeness(a, a) == 1.0 and 0 < merkle.likeness(a, b) < 1


def test_shards(docs, empty):
    got = sharding.byte_shards(docs, 4).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in sample_rows()
    )
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(4):
        own = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 4) <= largest
    assert sharding.byte_shards(empty).count() == 0


def test_quality(docs, empty, spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)] + [(None, 1, 0), (3, None, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    want = Counter()
    for r in sample_rows():
        w = WORD.findall(r[1] or "")
        grams = Counter(zip(w, w[1:], w[2:]))
        repeat = {j for i in range(len(w) - 2) if grams[(w[i], w[i + 1], w[i + 2])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (r[1] or "").split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        symbols = len(re.findall(r"[#*$%&|<>]", r[1] or ""))
        want[(r[0], len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeat), failed, not failed)] += 1
    assert Counter(tuple(r)[:-1] for r in quality.quality(docs, labels).collect()) == want
    assert quality.quality(empty, labels).count() == 0
    kept = quality.keep_quality(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if k[-1])


def test_certified_level_and_binomial_tail(spark):
    from math import comb, lgamma, log

    x = spark.createDataFrame([(0.0, 50.0), (3.0, 120.0), (17.0, 400.0)], "k double, n double")
    for k, n, tail in x.select("k", "n", quality.log_binomial_tail(F.col("k"), F.col("n"), 0.1)).collect():
        exact = log(sum(comb(int(n), i) * 0.1**i * 0.9 ** (int(n) - i) for i in range(int(k) + 1)))
        assert abs(tail - exact) < 1e-8
    # many terms, below, at and above the mean: all of them are summed, in numpy's way
    x = spark.createDataFrame([(2_990_000.0, 1e8), (3_000_000.0, 1e8), (3_020_000.0, 1e8), (29_999_000_000.0, 1e12)], "k double, n double")
    for k, n, tail in x.select("k", "n", quality.log_binomial_tail(F.col("k"), F.col("n"), 0.03)).collect():
        i = np.arange(k, max(k - 4e6, 0), -1)
        total = 1 + np.exp(np.cumsum(np.log(i / (n - i + 1) * (0.97 / 0.03)))).sum()
        head = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(0.03) + (n - k) * log(0.97)
        assert abs(tail - head - log(total)) < (1e-4 if n < 1e9 else 0.1)  # the head's own rounding
    held = [(i, "a", len(quality.LADDER) if i >= 4 else 6, False) for i in range(500)] + [(1000 + i, "b", 0, False) for i in range(500)]
    judged = spark.createDataFrame(held, "doc_id long, stratum string, strict int, base_failed boolean")
    labels = judged.select("doc_id", F.lit(1).alias("quality"))
    assert {tuple(r) for r in quality.certified_levels(judged, labels).collect()} == {("a", 7)}


def test_line_dedup(docs, empty):
    rows = {(r[0], r[1]) for r in sample_rows()}
    got = linededup.repeated_lines(docs)
    found = {(r["doc_id"], r["row"]): set(r["removed"]) for r in got.collect()}
    assert got.count() == len(sample_rows())
    keys = {(r["doc_id"], r["text"]): r["row"] for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row")).collect()}
    lines = []
    for doc_id, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            tokens = frozenset(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), line)))
            if len(tokens) >= linededup.LEAST:
                lines.append(((doc_id is not None, doc_id or 0, keys[(doc_id, text)], i), tokens, (doc_id, keys[(doc_id, text)])))
    want: dict = {k: set() for k in found}
    for place, tokens, key in lines:
        if any(p < place and 100 * len(t & tokens) >= 80 * len(t | tokens) for p, t, _ in lines):
            want[key].add(place[3])
    assert found == want and any(want.values())
    assert linededup.repeated_lines(empty).count() == 0
    out = linededup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == len(sample_rows())
    assert all(r["n_chars"] == len(r["text"]) for r in out.where("text is not null").collect())


def test_line_dedup_of_short_lines(spark):
    """Lines of one to four distinct words: equal sets go, and so do four words beside the same and one more."""
    texts = ["all rights reserved.\nx\na b c d\n\np q r s t", "All Rights reserved.\nX\na b c\n\np q r s", "a b c d e\nx x\nd c b a\nb a\n\na b"]
    got = linededup.repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["removed"] for r in got.collect()} == {0: [], 1: [0, 1, 4], 2: [0, 1, 2, 5]}


def test_similar_sets_meet_in_their_prefixes():
    """Random pairs of similar sets, few and many tokens, several similarities: each shares a token or two neighbours."""
    rng, met = np.random.default_rng(3), 0
    for percent in (30, 50, 80, 90):
        for _ in range(4000):
            shared, left, right = (int(rng.integers(0, most)) for most in (40, 8, 8))
            places = rng.permutation(shared + left + right)
            u, v = set(places[: shared + left].tolist()), set(places[:shared].tolist()) | set(places[shared + left :].tolist())
            if not u or not v or u == v or 100 * len(u & v) < percent * len(u | v):
                continue
            met += 1
            single, pairs = [], []
            for own in (sorted(u), sorted(v)):
                one, two = linededup.prefixes(len(own), percent)
                single.append(set(own[:one]))
                pairs.append(set(zip(own[:two], own[1:two])))
            assert single[0] & single[1] or pairs[0] & pairs[1], (percent, u, v)
    assert met > 3000


def test_similar_sets_meet_whatever_is_rare():
    """Rare tokens list singly, the others by neighbours: similar sets share a list, however many of their tokens are rare."""
    rng, met = np.random.default_rng(5), 0
    for percent in (30, 50, 80, 90):
        for _ in range(4000):
            shared, left, right = (int(rng.integers(0, most)) for most in (40, 8, 8))
            places = rng.permutation(shared + left + right)
            u, v = set(places[: shared + left].tolist()), set(places[:shared].tolist()) | set(places[shared + left :].tolist())
            if not u or not v or u == v or 100 * len(u & v) < percent * len(u | v):
                continue
            met += 1
            for rare in (0, 3, int(rng.integers(0, 56)), 56):
                single, pairs = [], []
                for own in (sorted(u), sorted(v)):
                    one, few, near = linededup.wanted(len(own), percent)
                    others = [x for x in own if x >= rare]
                    held = len(own) - len(others)
                    others = others[: near[held] if held < len(near) else 0]
                    single.append(set(own[:one]) | {x for x in own[:few] if x < rare})
                    pairs.append(set(zip(others, others[1:])))
                assert single[0] & single[1] or pairs[0] & pairs[1], (percent, rare, u, v)
    assert met > 3000
    # a line of 47 words: rows with many rare words, with none
    assert linededup.wanted(47, 80)[1] < 12 < linededup.prefixes(47, 80)[1]


def test_members_that_meet_nothing_similar_are_left_out():
    """Of unlike sets in one list none goes on, of alike ones both; a dealt list and a long one stay whole."""
    long = linededup.COMPARED + 1
    rows = [(1 << 16, 1 << 8, 0, 10), (1 << 16, 2 << 8, -1, 10), (2 << 16, 1 << 8, 0, 10), (2 << 16, 3 << 8, 1, 10), (2 << 16, 3 << 8, 1, 10)]
    rows += [(3 << 16 | 1, 1 << 8, 0, 10), (4 << 16, 1 << 8, 0, 10), (4 << 16, 4 << 8, 0, 20)]
    rows += [(5 << 16, i << 8, 0, 4**i) for i in range(1, 3)] + [(6 << 16, i << 8, -1 * (i % 2), 10 + i) for i in range(long)]
    # sketches that differ in all bits but one: few bits if they were read as a signed number
    rows += [(7 << 16, 1 << 8, 0, 10), (7 << 16, 2 << 8, -2, 10), (8 << 16, 1 << 8, 1 << 62, 20), (8 << 16, 2 << 8, -(1 << 62), 20)]
    columns = dict(zip(linededup.PACKED.items(), zip(*rows)))
    signed = {c: [np.array(v[:3], np.int64), np.array(v[3:], np.int64)] for (c, _), v in columns.items()}
    packed = {c: pa.array([x.astype(t).tobytes() for x in signed[c]], pa.binary()) for c, t in linededup.PACKED.items()}
    got = linededup._met(80)(pa.table(packed)).to_pydict()
    got = list(zip(got["list"], got["member"]))
    assert got[:3] == [(2 << 16, 1 << 8), (2 << 16, 3 << 8), (3 << 16 | 1, 1 << 8)]
    assert len(got) == 5 + long and {x for x, _ in got[3:-2]} == {6 << 16}
    assert got[-2:] == [(8 << 16, 1 << 8), (8 << 16, 2 << 8)]  # one bit apart, the sign


def test_line_dedup_of_long_lists(spark, monkeypatch):
    """Lists longer than one pass, dealt over tasks, with chains of near lines: equal to all pairs by hand."""
    monkeypatch.setattr(linededup, "SHARE", 16)
    monkeypatch.setattr(linededup, "CENTRES", 2)
    lines = []
    for i in range(60):  # neighbours share 9 of 11 words, others fewer
        lines.append(" ".join(f"w{j}" for j in range(i // 2, i // 2 + 10)) + (" same" if i % 3 else ""))
    rows = [(i // 4, "\n".join(lines[i : i + 4])) for i in range(0, 60, 4)]
    got = linededup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    places = [(d, k, set(x.split())) for d, text in rows for k, x in enumerate(text.split("\n"))]
    want = {d: [] for d, _ in rows}
    for i, (d, k, words_) in enumerate(places):
        if any(100 * len(words_ & w) >= 80 * len(words_ | w) for _, _, w in places[:i]):
            want[d].append(k)
    assert {r["doc_id"]: r["removed"] for r in got.collect()} == want
    assert sum(map(len, want.values())) > 10


def test_personal_data(docs, empty):
    text = "mail a.b@x.org or +1 (212) 555-0100\n10.1.2.300 x 4111 1111 1111 1111"
    assert [pii.KINDS[k] for k, _, _ in pii.base_spans(text)] == ["email", "card", "phone"]
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"]
    odd = ["a@b.c_d@e.f@g.h", "@x.y a@ b@c d@e.", "1.2.3.4.5.6.7.8 1.2.3.256 01.02.3.4", "x@y.z" * 3, "..a@b-.c-", "4111-1111 1111 1111 +12 345 6789-"]
    for t in odd:
        plain = [(0, *m.span()) for m in re.finditer(patterns[0], t)]
        plain += [(1, *m.span()) for m in re.finditer(patterns[1], t) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [s for s in pii.base_spans(t) if s[0] < 2] == plain
    model = pii.train(docs, passes=1)
    rows = pii.personal_data(docs, model).collect()
    assert len(rows) == len(sample_rows()) and sum(r["n_email"] for r in rows) == 1
    assert pii.personal_data(empty).count() == 0
    out = pii.mask_personal_data(docs, model)
    assert out.schema == docs.schema and out.where("text like '%[EMAIL]%'").count() == 1
    assert out.where("text is null").count() == 2


def test_tagger_learns_and_windows_settle_globally(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.col("text").rlike("[0-9@]"))
    texts = [r["text"] for r in docs.orderBy(F.xxhash64("doc_id")).limit(500).collect()]
    x, y = pii.training_windows(texts[:400])
    model = pii.Tagger()
    model.fit(x, y)
    held_x, held_y = pii.training_windows(texts[400:])
    tags, _ = model.decode(held_x)
    assert (tags == held_y)[held_y > 0].mean() > 0.9 and (tags == held_y).mean() > 0.98
    for text, spans in zip(texts[400:], pii.added_spans(model, texts[400:], [[] for _ in texts[400:]])):
        ends = sorted((s, e) for _, s, e in spans)
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:])) and all(0 <= s < e <= len(text) for s, e in ends)


def plain_personal_data(text: str) -> list[tuple[str, int, int]]:
    """The pattern spans by the patterns as they are stated."""
    def digits(m: re.Match) -> str:
        return "".join(c for c in m[0] if c in "0123456789")

    def luhn(d: str) -> bool:
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    octets = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    out += [("ip", *m.span()) for m in octets if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]


def test_personal_data_equals_the_patterns_in_all_columns(spark):
    """Every document of the table and hand-made edges; the model's spans come on top and overlap none."""
    odd = ["4111 1111 1111 1111 4111-1111-1111-1112", "5500005555555559 1", "+1 (212) 555-0100 +12 +1234567890123456 +(1) 23", "", None]
    odd += ["a@b.c 1.2.3.4.5 +49.30.1234567 é@é.é", "x" * 300 + "@y.z" * 40, "0" * 400, "jo [at] mail [dot] org or (212) 555-0100", "7.7.7.7\n" * 90]
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = given.unionAll(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    got = {r["doc_id"]: r for r in pii.personal_data(rows).collect()}
    assert got.keys() == texts.keys()
    for d, text in texts.items():
        base = plain_personal_data(text)
        row = got[d]
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(k == b[0] for b in base) for k in pii.KINDS]
        assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in row["spans"].split(",") if x)]
        assert set(base) <= set(spans) and len(spans) == len(set(spans))
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), x[1]))
        added = [x for x in spans if x not in base]
        assert all(e <= a or s >= b for _, s, e in added for _, a, b in base)


def test_tagger_finds_spellings_that_no_pattern_matches(spark):
    """Held-out documents with their spans rewritten: recall and precision of what the model adds."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = docs.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= 20_000))
    texts = [r["text"] for r in held.orderBy(F.xxhash64("doc_id")).limit(900).collect()]
    model = pii.Tagger()
    model.fit(*pii.training_windows(texts[:400]))
    rng = np.random.Generator(np.random.PCG64(23))
    wanted, found, both, kinds = 0, 0, 0, set()
    for text in set(texts[400:]) - set(texts[:400]):
        new, spans = pii.respelled(rng, text)
        base = pii.base_spans(new)
        # numbers that fail the check digit are no card numbers in any spelling
        want = {s for s in spans if s not in base and pii._plausible(s[0], new[s[1] : s[2]])}
        got = set(pii.added_spans(model, [new], [base])[0])
        wanted, found, both = wanted + len(want), found + len(got), both + len(want & got)
        kinds |= {s[0] for s in want & got}
    assert wanted > 100 and kinds == {0, 1, 2, 3}
    assert both >= 0.9 * wanted and both >= 0.9 * found


def test_columns_named_like_the_operators_own(spark):
    """Clashing column names, and rows equal in id and text but not elsewhere."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, 5, "b", "c", "d"), (1, text, 4, "b", "c", "d"), (1, "other words here\nother words here", 3, "b", "c", "d"), (2, text + " end", 2, "b", "c", "d")]
    near = spark.createDataFrame(rows, "doc_id long, text string, _node int, _root string, node string, root string")
    assert sorted(map(tuple, minhash.drop_near_duplicates(near).collect())) == [rows[2], rows[1]]
    lines = spark.createDataFrame(rows, "doc_id long, text string, _d int, _r string, _removed string, lines string")
    texts = {(r["text"], r["_d"]) for r in linededup.drop_repeated_lines(lines).collect()}
    # rows equal in id and text are one document, so the line of the two first ones stays in both
    assert texts == {(text, 5), (text, 4), ("other words here", 3), ("", 2)}
    assert linededup.drop_repeated_lines(lines, emptied=False).where("doc_id = 2").isEmpty()
