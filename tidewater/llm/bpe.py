"""Byte-level BPE encoding and decoding with contiguous rank arrays.

A text is cut into short words by the tokenizer's pattern; each distinct word is merged once.  For a word, the
parts between its boundaries and the rank of each adjacent pair stand in one contiguous array: the least rank
is found by a scan, its boundary deleted, and the ranks of the two neighbouring pairs refreshed, until no
adjacent pair can merge.  Words of equal length are rows of one matrix, so a scan, a deletion and a refresh
are each one array operation for thousands of words.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN_WORDS = 400_000  # distinct words that a worker remembers
PLAIN = 0x250  # texts of code points below are cut by a pattern here, others by the tokenizer's own cutter
NONE = np.int32(2**31 - 1)


def _class(test) -> str:
    return "".join(re.escape(chr(i)) for i in range(PLAIN) if test(unicodedata.category(chr(i))))


LETTERS, NUMBERS = _class(lambda c: c[0] == "L"), _class(lambda c: c[0] == "N")
SPACES = "\t\n\x0b\x0c\r \x85\xa0"
BYTE_PATTERN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
STRANGE = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]")


def byte_symbols() -> dict[str, int]:
    """Symbol of each byte in the vocabulary file: printable Latin-1 as itself, the others from U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Vocabulary, merge ranks and words known so far, of a tokenizers file of kind byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbol = spec["model"]["vocab"], byte_symbols()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        tokens = [b""] * size
        for token, i in vocab.items():
            tokens[i] = bytes(symbol[c] for c in token)
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_length = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.of_byte = np.zeros(256, np.int64)
        for c, b in symbol.items():
            self.of_byte[b] = vocab[c]
        self.size = size
        pair = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(pair, kind="stable")
        self.pair, self.rank, self.made = pair[order], np.arange(len(pair), dtype=np.int32)[order], made[order]
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}
        self._cutter = None

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged token) of pairs; NONE where they don't merge or right is no token (-1)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        ok = (self.pair[at] == key) & (right >= 0)
        return np.where(ok, self.rank[at], NONE), self.made[at]

    def _merge(self, raw: np.ndarray) -> list[bytes]:
        """Little-endian int32 ids of words of one length; raw: a row of bytes per word."""
        n, length = raw.shape
        part = np.full((n, length + 1), -1, np.int64)
        part[:, :length] = self.of_byte[raw]
        rank, made = self._ranks(part[:, :-1], part[:, 1:])
        left = np.full(n, length)
        rows = np.arange(n)
        while len(rows):
            at = rank[rows].argmin(1)
            go = rank[rows, at] != NONE
            rows, at = rows[go], at[go]
            if not len(rows):
                break
            # the boundary after `at` goes: all behind it moves up by one place
            moved = np.arange(length)[None, :]
            moved = moved + (moved > at[:, None])
            merged = made[rows, at]
            new = np.take_along_axis(part[rows], np.minimum(moved, length), 1)
            new[np.arange(len(rows)), at] = merged
            part[rows, :length] = new
            part[rows, length] = -1
            moved = np.minimum(moved, length - 1)
            new_rank, new_made = np.take_along_axis(rank[rows], moved, 1), np.take_along_axis(made[rows], moved, 1)
            left[rows] -= 1
            last = left[rows] - 1
            new_rank[np.arange(length)[None, :] >= last[:, None]] = NONE
            rank[rows], made[rows] = new_rank, new_made
            for side in (at - 1, at):
                ok = (side >= 0) & (side < last)
                r, s = rows[ok], side[ok]
                rank[r, s], made[r, s] = self._ranks(part[r, s], part[r, s + 1])
        ids = part.astype("<i4")
        return [ids[i, : left[i]].tobytes() for i in range(n)]

    def learn(self, words: set[str]) -> None:
        """Encode the words not known yet."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = list(words)
        by_length: dict[int, list] = {}
        for w in new:
            b = w.encode()
            by_length.setdefault(len(b), []).append((w, b))
        for length, group in by_length.items():
            step = max(1, 400_000 // length)
            for i in range(0, len(group), step):
                part = group[i : i + step]
                raw = np.frombuffer(b"".join(b for _, b in part), np.uint8).reshape(len(part), length)
                self.known.update(zip((w for w, _ in part), self._merge(raw)))

    def cut(self, text: str) -> list[str]:
        """Short words of a text without special tokens."""
        if not STRANGE.search(text):
            return BYTE_PATTERN.findall(text)
        if self._cutter is None:
            from tokenizers import pre_tokenizers

            self._cutter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self._cutter.pre_tokenize_str(text)]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """ids (int32) of each text; special tokens written out in a text count as such."""
        out, cut = [], []
        for t in texts:
            if self.split_special and self.split_special.search(t):
                pieces = self.split_special.split(t)
                cut.append([w for p in pieces for w in ([p] if p in self.special else self.cut(p))])
            else:
                cut.append(self.cut(t))
        self.learn(set().union(*cut) - self.special.keys())
        known = self.known
        if any(s in t for s in self.special for t in texts):
            known = known | {s: np.int32(i).tobytes() for s, i in self.special.items()}
        for words in cut:
            out.append(np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4"))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, one after the other."""
        length = self.token_length[ids]
        begin = np.cumsum(length) - length
        at = np.arange(int(length.sum())) + np.repeat(self.token_start[ids] - begin, length)
        return self.token_bytes[at].tobytes()


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def runs(texts: list[str], most: int = 4 << 20):
    """Index ranges of about `most` characters."""
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= most):
            held += len(texts[j])
            j += 1
        yield i, j
        i = j


def _encode(batches, path):
    bpe = load(path)
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
        for i, j in runs(texts):
            ids = bpe.encode_batch(texts[i:j])
            offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            kept = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), flat)],
                                             names=[*kept.schema.names[:-1], "ids"])


def encode(docs: DataFrame, path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` and ids (array<int>), of whole texts; null texts count as empty.

    ids are those of the tokenizers library for this file, without added special tokens, unless the text writes them
    out.  path must name the file on every executor.
    """
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(partial(_encode, path=path), f"{schema}, ids array<int>")


def _decode(batches, path):
    bpe = load(path)
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        texts = []
        for x in column:
            v = x.values
            texts.append(bpe.decode(np.asarray(v)).decode("utf-8", "replace") if v is not None and len(v) else "")
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                         names=[*batch.schema.names[:-1], "decoded"])


def decode(encoded: DataFrame, path: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """The columns `keep` and decoded, the text of the ids; null and empty ids give the empty text.

    Bytes that are no UTF-8 become U+FFFD, as ids cut within a character may give.
    """
    rows = encoded.select(*keep, F.col(ids_col).alias("_ids"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(partial(_decode, path=path), f"{schema}, decoded string")
