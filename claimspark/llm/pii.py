"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The model is trained in numpy on a bounded sample of spans that the patterns label, rewritten in
spellings that no pattern matches: addresses with [at] and [dot], spaced octets, cards with dots, national phone numbers. Texts are cut into overlapping windows; each is
decoded by itself, and a text's spans are settled over all its windows at once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import by_batches, slices, texts

KINDS = ["email", "ip", "card", "phone"]
#: A window and its step: every span of up to STEP characters lies whole in some window.
WINDOW, STEP = 128, 64
#: Bound of the training sample (documents), training passes, hidden size.
SAMPLE, PASSES, HIDDEN = 400, 8, 20
#: Windows decoded at once.
DECODED = 512
#: Least mean probability of a span's characters for it to be added.
SURE = 0.95

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What every span of the model has: a digit, an at-sign, or one spelled out in brackets.
TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]")
Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at-signs: long runs without one cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", found.end() if found else at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str, checked: bool = True) -> list[Span]:
    """Pattern spans by kind, then start. Matches that fail their check are dropped, not tried again.

    Not ``checked``: card numbers whatever their check digit, whose characters look the same.
    """
    if not TRIGGER.search(text):
        return []
    out = [(0, s, e) for s, e in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and (luhn(d) or not checked)]
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# -- characters and tags

_SINGLE = "@.-+()[]_%=\"'/:,; \n"
CLASSES = 1 + len(_SINGLE) + 5  # padding, single signs, then digit, lower, upper, other letter, other
TAGS = 1 + 2 * len(KINDS)  # outside, begin and inside of each kind


def _class_of(c: str) -> int:
    if c in _SINGLE:
        return 1 + _SINGLE.index(c)
    if c in "0123456789":
        return len(_SINGLE) + 1
    if not c.isalpha():
        return len(_SINGLE) + 5
    return len(_SINGLE) + (2 if "a" <= c <= "z" else 3 if "A" <= c <= "Z" else 4)


_NEAR = np.array([_class_of(chr(i)) for i in range(0x250)], np.int8)


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < len(_NEAR), _NEAR[np.minimum(points, len(_NEAR) - 1)], len(_SINGLE) + 5)


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Cost of tag pairs and first tags that cannot be: inside must follow its own begin or inside."""
    pair, first = np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32)
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        pair[:, inside] = -1e4
        pair[inside - 1, inside] = pair[inside, inside] = 0
        first[inside] = -1e4
    return pair, first


PAIR, FIRST = _allowed()


def tags_of(spans: list[Span], length: int) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for kind, start, end in spans:
        out[start:end] = 2 + 2 * kind
        out[start] = 1 + 2 * kind
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _softmax_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    """Bidirectional LSTM over character classes, linear emissions, and CRF transitions."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.Generator(np.random.PCG64(seed))
        h = hidden

        def draw(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(h)).astype(np.float32)

        self.hidden = h
        self.p = {"e": draw(2 * h, TAGS), "eb": np.zeros(TAGS, np.float32), "t": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": draw(CLASSES, 4 * h), f"h{d}": draw(h, 4 * h), f"b{d}": np.zeros(4 * h, np.float32)}
            self.p[f"b{d}"][h : 2 * h] = 1  # forget little at first

    def _run(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states in reading order of the direction; x is (windows, places)."""
        h = self.hidden
        given = self.p[f"x{d}"] + self.p[f"b{d}"]
        state, cell = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
        out, tape = np.empty((x.shape[1], len(x), h), np.float32), []
        for t in range(x.shape[1]):
            a = given[x[:, t]] + state @ self.p[f"h{d}"]
            gates, new = _sigmoid(a[:, : 3 * h]), np.tanh(a[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            old, cell = cell, f * cell + i * new
            squashed = np.tanh(cell)
            if keep:
                tape.append((i, f, o, new, old, squashed, state))
            state = o * squashed
            out[t] = state
        return out, tape

    def emissions(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """(places, windows, tags) and what the gradient needs."""
        ahead, tf = self._run(x, "f", keep)
        back, tb = self._run(x[:, ::-1], "b", keep)
        both = np.concatenate((ahead, back[::-1]), 2)
        return both @ self.p["e"] + self.p["eb"], (both, tf, tb)

    def _sums(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log sums of the CRF."""
        pair = self.p["t"] + PAIR
        ahead, back = np.empty_like(e), np.zeros_like(e)
        ahead[0] = e[0] + FIRST
        for t in range(1, len(e)):
            ahead[t] = _softmax_sum(ahead[t - 1][:, :, None] + pair, 1) + e[t]
        for t in range(len(e) - 2, -1, -1):
            back[t] = _softmax_sum(pair + (e[t + 1] + back[t + 1])[:, None, :], 2)
        return ahead, back

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss per window (negative log likelihood of the tags y) and its gradient."""
        e, (both, tf, tb) = self.emissions(x, keep=True)
        ahead, back = self._sums(e)
        whole = _softmax_sum(ahead[-1], 1)
        n, y = len(x), y.T
        pair = self.p["t"] + PAIR
        one = np.exp(ahead + back - whole[:, None])
        places, rows = np.meshgrid(np.arange(len(e)), np.arange(n), indexing="ij")
        loss = whole.sum() - e[places, rows, y].sum() - pair[y[:-1], y[1:]].sum() - FIRST[y[0]].sum()
        de = one.copy()
        de[places, rows, y] -= 1
        dt = np.zeros_like(pair)
        for t in range(1, len(e)):
            dt += np.exp(ahead[t - 1][:, :, None] + pair + (e[t] + back[t])[:, None, :] - whole[:, None, None]).sum(0)
        np.subtract.at(dt, (y[:-1].ravel(), y[1:].ravel()), 1)
        g = {"t": dt * (PAIR == 0), "e": np.einsum("tnh,tnk->hk", both, de), "eb": de.sum((0, 1))}
        dh = de @ self.p["e"].T
        h = self.hidden
        for d, tape, own, xs in (("f", tf, dh[:, :, :h], x), ("b", tb, dh[::-1, :, h:], x[:, ::-1])):
            dx, dw = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(self.p[f"h{d}"])
            later, dcell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t in range(len(tape) - 1, -1, -1):
                i, f, o, new, old, squashed, state = tape[t]
                ds = own[t] + later
                dcell = dcell + ds * o * (1 - squashed**2)
                da = np.concatenate((dcell * new * i * (1 - i), dcell * old * f * (1 - f), ds * squashed * o * (1 - o), dcell * i * (1 - new**2)), 1)
                np.add.at(dx, xs[:, t], da)
                dw += state.T @ da
                later, dcell = da @ self.p[f"h{d}"].T, dcell * f
            g |= {f"x{d}": dx, f"h{d}": dw, f"b{d}": dx.sum(0)}
        return float(loss) / n, {k: v / n for k, v in g.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, passes: int = PASSES, rate: float = 0.02, batch: int = 48) -> float:
        """Adam with clipped gradients; the loss of the last pass."""
        rng = np.random.Generator(np.random.PCG64(5))
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, loss = 0, 0.0
        for turn in range(passes):
            order, losses = rng.permutation(len(x)), []
            for at in range(0, len(x), batch):
                own = order[at : at + batch]
                value, g = self.gradient(x[own], y[own])
                losses.append(value)
                norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
                step += 1
                for k, v in g.items():
                    v = v * min(1.0, 5 / max(norm, 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.99 * second[k] + 0.01 * v * v
                    scale = rate * (1 - turn / passes) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    self.p[k] = (self.p[k] - scale * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
            loss = float(np.mean(losses))
        return loss

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (windows, places) and the probability of each chosen tag."""
        e, _ = self.emissions(x)
        pair = self.p["t"] + PAIR
        best, back = e[0] + FIRST, np.zeros(e.shape, np.int8)
        for t in range(1, len(e)):
            score = best[:, :, None] + pair
            back[t] = score.argmax(1)
            best = score.max(1) + e[t]
        n = np.arange(len(x))
        tags = np.empty((len(e), len(x)), np.int64)
        tags[-1] = best.argmax(1)
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = back[t][n, tags[t]]
        ahead, behind = self._sums(e)
        chance = np.exp(ahead + behind - _softmax_sum(ahead[-1], 1)[:, None])
        return tags.T, np.take_along_axis(chance, tags[:, :, None], 2)[:, :, 0].T


# -- windows

def windows(text: str, coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and classes of the windows with a digit or at-sign, spelled out or not.

    Spans without any are never added, and a window is decoded by itself, so windows without
    them cannot change the result.
    """
    hot = np.array(sorted({m.start() // STEP for m in TRIGGER.finditer(text)}), np.int64)
    grid = np.unique(np.concatenate((hot, np.maximum(hot - 1, 0)))) if len(hot) else hot
    padded = np.zeros(len(coded) + WINDOW, np.int64)
    padded[: len(coded)] = coded
    starts = grid * STEP
    return starts, padded[starts[:, None] + np.arange(WINDOW)] if len(starts) else np.zeros((0, WINDOW), np.int64)


def _spans(tags: np.ndarray, chance: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, mean probability) of a window."""
    out = []
    for i in np.flatnonzero(tags % 2 == 1):
        j = i + 1
        while j < len(tags) and tags[j] == tags[i] + 1:
            j += 1
        out.append((int(tags[i] // 2), int(i), int(j), float(chance[i:j].mean())))
    return out


def plain_mail(text: str) -> str:
    """An address with its signs written as signs."""
    return re.sub(r" ?[\[(]dot[\])] ?", ".", re.sub(r" ?[\[(]at[\])] ?", "@", text))


def _plausible(kind: int, text: str) -> bool:
    """What a span must have whatever the model says."""
    digits = len(_digits(text))
    if kind == 0:
        return "@" in plain_mail(text) and digits + sum(c.isalpha() for c in text) >= 3
    if kind == 1:
        text = re.sub(r" ?\. ?", ".", text)
        return text.count(".") == 3 and all(p.isascii() and p.isdigit() and int(p[:9]) <= 255 and len(p) < 4 for p in text.split("."))
    return 13 <= digits <= 19 and luhn(_digits(text)) if kind == 2 else 7 <= digits <= 15


def added_spans(model: Tagger, texts_: list[str], bases: list[list[Span]]) -> list[list[Span]]:
    """Spans of the model for each text, settled over all its windows: the surest first, none that overlaps
    another or a base span, none cut by a window's edge (the next window has it whole)."""
    found: list[list[tuple]] = [[] for _ in texts_]
    waiting: list[tuple[int, int]] = []
    rows: list[np.ndarray] = []

    def settle(count: int) -> None:
        tags, chance = model.decode(np.array(rows[:count]))
        for w in np.flatnonzero(tags.any(1)):
            i, begin = waiting[w]
            for kind, s, e, sure in _spans(tags[w], chance[w]):
                cut = (s == 0 and begin > 0) or (e == WINDOW and begin + WINDOW < len(texts_[i]))
                piece = texts_[i][begin + s : begin + e]
                if not cut and sure >= SURE and piece == piece.strip() and _plausible(kind, piece):
                    found[i].append((-round(sure, 6), begin + s, begin + e, kind))
        del rows[:count], waiting[:count]

    for i, text in enumerate(texts_):
        if TRIGGER.search(text):
            starts, x = windows(text, classes(text))
            waiting += [(i, int(s)) for s in starts]
            rows += list(x)
            while len(rows) >= DECODED:
                settle(DECODED)
    if rows:
        settle(len(rows))
    out = []
    for base, spans in zip(bases, found):
        taken = [(s, e) for _, s, e in base]
        own = []
        for _, s, e, kind in sorted(set(spans)):
            if all(e <= a or s >= b for a, b in taken):
                taken.append((s, e))
                own.append((kind, s, e))
        out.append(own)
    return out


# -- training

def _respelled(rng: np.random.Generator, kind: int, piece: str) -> str:
    """The same as people also write it, in forms that mostly no pattern matches."""
    ways = [piece]
    digits = _digits(piece)
    if kind == 0:
        ways += [piece.replace("@", sign) for sign in (" [at] ", "(at)")]
        ways.append(piece.replace("@", " [at] ").replace(".", " [dot] "))
    elif kind == 1:
        ways.append(piece.replace(".", " . "))
    elif kind == 2:
        ways.append(".".join(digits[i : i + 4] for i in range(0, len(digits), 4)))
    elif len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        ways += [f"({a}) {b}-{c}", f"{a}-{b}-{c}"]
    return ways[rng.integers(len(ways))]


def respelled(rng: np.random.Generator, text: str) -> tuple[str, list[Span]]:
    """The text with its pattern spans in other spellings, and where they are now."""
    base = sorted({s: (k, s, e) for k, s, e in reversed(base_spans(text, checked=False))}.values(), key=lambda s: s[1])
    parts, spans, at, size = [], [], 0, 0
    for kind, s, e in base:
        if s < at:
            continue
        piece = _respelled(rng, kind, text[s:e])
        parts += [text[at:s], piece]
        size += s - at
        spans.append((kind, size, size + len(piece)))
        size, at = size + len(piece), e
    return "".join([*parts, text[at:]]), spans


def training_windows(sample: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags from the pattern spans of the texts, in several spellings."""
    rng = np.random.Generator(np.random.PCG64(11))
    xs, ys = [], []
    for text in sample:
        new, spans = respelled(rng, text)
        tags = np.concatenate((tags_of(spans, len(new)), np.zeros(WINDOW, np.int64)))
        starts, x = windows(new, classes(new))
        for begin, row in zip(starts.tolist(), x):
            y = tags[begin : begin + WINDOW].copy()
            k = 0
            while k < WINDOW and y[k] and y[k] % 2 == 0:  # a span that began before the window begins with it
                y[k] = y[k] - (k == 0)
                k += 1
            xs.append(row)
            ys.append(y)
    return np.array(xs).reshape(-1, WINDOW), np.array(ys).reshape(-1, WINDOW)


def train(docs: DataFrame, sample: int = SAMPLE, passes: int = PASSES) -> Tagger:
    """A tagger fitted on at most ``sample`` documents that have digits or at-signs, by order of a hash of the id.

    Only these come to the driver, none over 20,000 characters. Without any such document the
    tagger stays as drawn and finds nothing.
    """
    held = docs.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= 20_000))
    held = held.select("text", F.xxhash64("doc_id", "text").alias("h"))
    # the hashes first: a task sends numbers, and texts only below the cut
    cut = held.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = held.where(F.col("h") <= F.lit(cut).cast("long")).orderBy("h").limit(sample).collect()
    model = Tagger()
    x, y = training_windows([r["text"] for r in rows])
    if len(x):
        model.fit(x, y, passes)
    else:
        model.p["eb"][0] = 50
    return model


# -- operators

def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _both(model: Tagger, column: pa.Array) -> Iterator[tuple[str, list[Span], list[Span]]]:
    """(text, base spans, all spans) of a batch, whose windows are decoded together."""
    held = texts(column)
    bases = [base_spans(t) for t in held]
    for text, base, added in zip(held, bases, added_spans(model, held, bases)):
        yield text, base, base + added


def _found(model: Tagger):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, base, spans in _both(model, batch.column("text")):
                counts = [sum(k == kind for k, _, _ in base) for kind in range(4)]
                rows.append((*counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names)

    return run


def personal_data(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of docs (doc_id, text).

    Counts and digest are of the pattern spans; ``spans`` has these and the model's, by kind, then
    start, as kind:start:end in code points. Null, empty or clean texts have none. Repeated
    rows and null ids: each row by itself. No rows: no rows. No shuffle but the sample's.
    """
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return by_batches(docs.select(F.col("doc_id").cast("long"), "text"), _found(model or train(docs)), schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap become one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        out += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """docs with personal data in the text replaced; n_chars, if there, follows. Null texts stay null."""
    model = model or train(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            given = batch.column("text")
            new = [masked(text, spans) for text, _, spans in _both(model, given)]
            text = [t if was else None for t, was in zip(new, given.is_valid().to_pylist())]
            yield batch.set_column(at, batch.schema.field(at), pa.array(text, batch.schema.field(at).type))

    out = by_batches(docs, run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
