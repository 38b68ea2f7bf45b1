"""Fill-in-middle, byte-level BPE and spelling variants against plain versions, on odd and ordinary rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimspark.llm import fim, spelling, wordtable

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, output string, decoded string, ids binary, word string, rank int"
ODD = ["", None, "\n", "\n\n", "a", "a\n", "\na", "no end\nhere", "<P", "a<\nS>\n", "x <M> y\nz", "é\n中文\n😀\n", "b\r\nc\r\n", " ", "   two  blanks ", "tab\t\tend\t"]
ODD += ["it's we'll I'VE 'tis don't", "a.b,c;d:e!f? (g) word. word, word!? Wort, naïve. ß. 1.5, 2024-01-05", "a b 　c d\u0085e\x1cf\x1fg", "abc <|endoftext|> def  <|endoftext|><|endoftext|>\n", "<|endoftext"]
ODD += ["᠎​ x", "x \n y\n \nz \t\n", "é ﬁ Ⅷ ² ١٢", "\U0001f468‍\U0001f469 ️", "\x00nul", "a\x01b \x02 \x02a\x01\x01\x02b\x02", "-" * 300 + "a" * 5000, "中" * 400]


def prose(rng: random.Random, n: int) -> str:
    parts = ["the", "of", "rain", "river", "stone", "Éa", "naïve", "o'er", "42", "well-known", "中文"]
    ends = [" ", " ", " ", ", ", ".\n", "\n\n", "  "]
    return "".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 3))) + rng.choice(ends) for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(5)
    texts = [*ODD, *(prose(rng, n) for n in (5, 40, 300, 40_000))]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [out[-1], out[-2], (None, "null id\nwith lines\n"), (None, None), (7, "another text\nof the id seven\nthree"), (-3, "x\ny\nz\n"), (2**60, "x\ny\nz\n")]
    return [(i, t, "clash", "clash", b"clash", "clash", 1) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def filled(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    raw = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(raw[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, n, form, len(p), len(m), out, text


@pytest.mark.parametrize("rate", [100, 60])
def test_fill_in_middle(docs, empty, rate):
    plan = fim.Plan(rate=rate)
    got = fim.restored(fim.fill_in_middle(docs, plan), plan)
    want = [filled(r[0], r[1], rate) for r in rows()]
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fim.restored(fim.fill_in_middle(empty)).count() == 0


def test_blocks_change_places_in_place():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 50, 3 * fim.STEP + 5):
        raw = rng.randbytes(n)
        for _ in range(5):
            a, b, c = sorted(rng.randrange(n + 1) for _ in range(3))
            data = bytearray(raw)
            fim.exchange(data, a, b, c)
            assert data == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


def test_sentinels_that_could_arise_by_chance_are_refused():
    for marks in ({"prefix": b"<<P>"}, {"middle": b"[M]"}, {"suffix": b"<P>"}, {"prefix": b"<"}):
        with pytest.raises(ValueError):
            fim.Plan(**marks)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_split_joins_to_the_text_and_encodes_alike(library):
    own = wordtable.vocabulary(PATH)
    rng = random.Random(9)
    signs = "ab Zé.,!?' \n\t 　​中1²-<|😀ß\x1c"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    texts += [f"{a}<|endoftext|>{b}" for a, b in zip(texts[100:200], texts[200:300])]
    for text in texts:
        words = wordtable.split(text, own.marks)
        assert "".join(words) == text
        ids = [i for raw in own.encode(words) for i in np.frombuffer(raw, "<u4").tolist()]
        assert ids == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("chunk_bytes", [1, 2000, 1 << 23])
def test_ids_and_texts_equal_the_library(docs, empty, library, chunk_bytes):
    got = wordtable.decode(wordtable.encode(docs, PATH, chunk_bytes), PATH)
    want = []
    for doc_id, text, *_ in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert Counter((i, bytes(x), t) for i, x, t in got.collect()) == Counter(want)
    assert wordtable.decode(wordtable.encode(empty, PATH), PATH).count() == 0


def test_each_distinct_word_is_encoded_once(spark, monkeypatch):
    import pyarrow as pa

    words = ["a"] * 5 + ["b"] * 700 + ["c"] + ["d"] * 40
    seen = []
    own = wordtable.vocabulary(PATH)
    real = own.encode
    monkeypatch.setattr(own, "encode", lambda w: seen.extend(w) or real(w))
    place = [((i * 7) % 3 << wordtable.WORD_BITS) + i for i in range(len(words))]
    table = pa.table({"place": place, "word": words})
    for held in (1, 100, 10**6):
        seen.clear()
        got = {}
        for batch in wordtable._encoded(PATH, held)(iter(table.to_batches(max_chunksize=3))):
            for x in batch.to_pylist():
                numbers = np.cumsum(wordtable.unpacked(x["numbers"], x["n"]))
                stops = np.cumsum(wordtable.unpacked(x["lengths"], x["n"]))
                ids = wordtable.unpacked(x["ids"], x["total"])
                got |= {(x["chunk"] << wordtable.WORD_BITS) + int(i): part.tobytes() for i, part in zip(numbers, np.split(ids, stops[:-1]))}
        assert seen == ["a", "b", "c", "d"]
        assert got == dict(zip(place, real(words)))


def test_decode_of_any_ids(spark, library):
    rng = random.Random(2)
    lists = [[rng.randrange(50257) for _ in range(rng.randrange(12))] for _ in range(300)] + [[], [50256], [127, 50256, 222]]
    data = [(i, np.array(x, "<u4").tobytes(), "clash") for i, x in enumerate(lists)] + [(-1, None, "clash")]
    got = wordtable.decode(spark.createDataFrame(data, "doc_id long, ids binary, decoded string"), PATH)
    want = {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)} | {-1: ""}
    assert {r.doc_id: r.decoded for r in got.collect()} == want


def test_a_vocabulary_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        wordtable.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def variants(counts: dict[str, int], ratio: int = 5) -> set[tuple]:
    near, masked = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            masked[w[:i] + "\1" + w[i + 1 :]].add(w)
            if (x := w[:i] + w[i + 1 :]) in counts:
                near[w].add(x)
                near[x].add(w)
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda x: (-counts[x], x.encode())) for w in counts if near[w]}
    form = {w: b for w, b in best.items() if counts[b] >= ratio * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def test_variant_groups(spark):
    rng = random.Random(3)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randrange(6, 9))): rng.choice([5, 6, 25, 30, 125, 700, 4000]) for _ in range(900)}
    long = "".join(rng.choice("abcdé") for _ in range(3 * spelling.HEAD))
    counts |= {long: 900, long[:50] + long[51:]: 100, long[:50] + "z" + long[51:]: 100, long[1:]: 7, long[:-1]: 7, long + "a": 5, "a" * 70: 9, "a" * 71: 60, "a" * 72: 400}
    # words as long as the sorted head, one shorter and one longer
    edge = long[: spelling.HEAD]
    counts |= {edge: 50, edge[:-1]: 5, edge + "b": 6, edge[1:]: 5, "😀" + edge[1:]: 5, "￿bcdef": 30, "\U00010000bcdef": 30, "abcdef": 5}
    frame = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n long, rank int").repartition(3)
    want = variants(counts)
    assert set(map(tuple, spelling.variant_groups(frame).collect())) == want
    assert any(w[1] and w[1] != w[2] for w in want)
    assert spelling.variant_groups(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.variant_groups(frame, ratio=1)


@pytest.mark.parametrize("drop", [None, 3])
def test_runs_and_vocabulary(spark, docs, drop):
    rng = random.Random(8)
    extra = [(i, " ".join(rng.choice(["Straße", "naïveté", "ABCDEFG", "ÉLAN-vital×x", "shorts", "abcdefg1hijklmn"]) for _ in range(60))) for i in range(5)]
    frame = docs.select("doc_id", "text").unionAll(spark.createDataFrame(extra, "doc_id long, text string"))
    counts = Counter()
    for doc_id, text in [r[:2] for r in rows()] + extra:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            if len(w) < 6:
                continue
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if drop and h % drop == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    got = spelling.vocabulary(spelling.runs(frame, 6, drop), 6, 5)
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
