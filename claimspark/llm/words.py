"""Ids of whole texts by the tokenizers library, each distinct word encoded once per worker."""

from __future__ import annotations

import gc
import json
import os
from array import array
from functools import lru_cache
from itertools import islice

import regex

#: Words and word parts held by a worker between batches; the later half is dropped when the number is passed.
HELD = 400_000
#: A word with other characters than these sends its text to the library whole: outside them, Unicode
#: versions, white space, composition and case may differ between the library and Python.
UNSAFE = regex.compile("[^\x21-\x7e\xa1-į]|<\\|")


def _byte_names() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class WordEncoder:
    """For tokenizers that drop white space, lower-case, split by a pattern and use byte-level pieces.

    Other tokenizers are used as they are, text by text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.size = self.library.get_vocab_size()
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
        if self.by_word:
            self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.names = dict(enumerate(_byte_names()))
        self.word: dict[str, bytes] = {}
        self.part: dict[str, bytes] = {}

    def _parts(self, word: bytes) -> list[str] | None:
        """Pre-tokens of a word; none if its text must go to the library whole."""
        text = word.decode()
        if UNSAFE.search(text):
            return None
        text = text.lower()
        if text.isalpha():
            return [text]
        if text[-1] in ".,;:!?" and text[:-1].isalpha():
            return [text[:-1], text[-1]]
        return self.pattern.findall(text)

    def _learn(self, words: list[bytes]) -> None:
        if len(self.part) > HELD:
            self.part = dict(islice(self.part.items(), HELD // 2))
        split = [self._parts(w) for w in words]
        tokenize, names, parts = self.model.tokenize, self.names, self.part
        for part in set().union(*(x for x in split if x)).difference(parts):
            spelled = part.encode().decode("latin-1").translate(names)
            parts[part] = array("I", [t.id for t in tokenize(spelled)]).tobytes()
        get = parts.__getitem__
        for w, x in zip(words, split):
            self.word[w] = None if x is None else get(x[0]) if len(x) == 1 else b"".join(map(get, x))

    def _whole(self, text: bytes) -> bytes:
        return array("I", self.library.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def encode(self, batch: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return [self._whole(t) for t in batch]
        gc.disable()  # nothing here makes cycles, and the many small objects would set it off all the time
        words = [t.lower().split() for t in batch]
        needed = set().union(*words)
        if new := needed.difference(self.word):
            if len(self.word) + len(new) > HELD:  # what came first is what comes often
                self.word = dict(islice(self.word.items(), HELD // 2))
                new = needed.difference(self.word)
            self._learn(list(new))  # nothing is dropped until the batch is done
        get = self.word.__getitem__
        out = []
        for text, own in zip(batch, words):
            try:
                out.append(b"".join(map(get, own)))
            except TypeError:
                out.append(self._whole(text))
        gc.enable()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
