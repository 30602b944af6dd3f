"""Ids of whole texts by a byte-level BPE file of the tokenizers library, one text at a time as an array."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from tidewater.llm.bpe import STRANGE, byte_symbols

SEPARATE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _token_ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes of each token and its id, if ids ascend as merges do (then an id is a rank); else None."""
    vocab, symbol, cutter = spec["model"]["vocab"], byte_symbols(), spec.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
    if not plain or spec.get("normalizer") or spec["model"].get("ignore_merges"):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [vocab[a + b] for a, b in merges]
    single = [vocab[s] for s in symbol]
    if any(a >= b for a, b in zip(made, made[1:])) or max(single) >= made[0]:
        return None
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(symbol[c] for c in t): i for t, i in vocab.items() if t not in special}


class ByteIds:
    """The library's ids.  Plain texts (code points below U+0250, no special token) go through tiktoken over the same
    vocabulary, which is several times faster; all others, and white space too long for it, through the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        spec = json.loads(text)
        self.library = Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.size = self.library.get_vocab_size()
        ranks, self.quick = _token_ranks(spec), None
        if ranks:
            import tiktoken

            self.quick = tiktoken.Encoding("ranks of the file", pat_str=SEPARATE_WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """uint32 ids of a whole text, without added special tokens."""
        if self.quick and not STRANGE.search(text) and not any(s in text for s in self.special):
            try:
                return self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)
            except ValueError:  # its expression gives up on very long white space
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def load(path: str) -> ByteIds:
    return ByteIds(path)
