"""Ids of whole texts by a tokenizers file that lower-cases and cuts at words, each distinct word encoded once."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from tidewater.llm.bpe import LETTERS, NUMBERS, SPACES, STRANGE, byte_symbols

KNOWN_WORDS = 200_000  # words of each of the two generations that a worker remembers, from one task to the next
#: the file's own cut of texts, which it normalizes first; without look-around, so a word alone is cut the same
WORD_PATTERN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
NORMALIZERS, CUTTERS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]


class WordTokenizer:
    """Encodes with the tokenizers library; where the text allows, word by word with a memory of words.

    A text of code points below U+0250 has no combining marks, so its normal form is itself and lower case is
    by character; its words are then cut here.  Others, and files of another kind, go to the library whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        spec = json.loads(text)
        self.library = Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        kinds = [[x["type"] for x in ((spec.get(part) or {}).get(inner) or [])]
                 for part, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.by_word = kinds == [NORMALIZERS, CUTTERS]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.symbols = {b: c for c, b in byte_symbols().items()}

    def _word(self, word: str) -> bytes:
        """Ids of one word by the library's BPE model, which reads bytes as symbols."""
        tokens = self.library.model.tokenize(word.encode().decode("latin-1").translate(self.symbols))
        return np.array([t.id for t in tokens], "<u4").tobytes()

    def _ids(self, words: set[str]) -> dict[str, bytes]:
        """Ids of distinct words.  Words of the last generation that are met again move on; the others go with it."""
        known, older = self.known, self.older
        out = {w: known.get(w) or older.get(w) for w in words}
        for w, ids in out.items():
            if ids is None:
                out[w] = self._word(w)
        known.update(out)
        if len(known) > KNOWN_WORDS:
            self.older, self.known = known if len(known) <= 2 * KNOWN_WORDS else out, {}
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        out, cut = [b""] * len(texts), {}
        for i, t in enumerate(texts):
            if self.by_word and not STRANGE.search(t) and not any(s in t for s in self.special):
                low = t.lower()
                # a capital whose lower case is two characters leaves the plain range
                cut[i] = None if STRANGE.search(low) else WORD_PATTERN.findall(low)
            else:
                cut[i] = None
        whole = [i for i, words in cut.items() if words is None]
        for i, ids in zip(whole, self._whole([texts[i] for i in whole]) if whole else []):
            out[i] = ids
        get = self._ids(set().union(*(words for words in cut.values() if words))).__getitem__
        for i, words in cut.items():
            if words:
                out[i] = b"".join(map(get, words))
        return out


@lru_cache(maxsize=2)
def load(path: str) -> WordTokenizer:
    return WordTokenizer(path)
