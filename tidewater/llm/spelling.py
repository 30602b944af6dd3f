"""Spelling variants: words that differ by one character, found by permuterm rotations.

A word's rotations are those of the word with a terminator behind it: of `x c y`, the one that starts after c is
`y $ x c`.  All words that differ from it in that place alone have a rotation with the prefix `y $ x` and one more character, and
the word without c has that prefix as its whole rotation.  So each rotation is dealt out under its own text (nothing
follows) and under its text but for the last character (which follows); tasks sort theirs and scan the ranges of one prefix.  A
range holds at most one word per character and one without, whatever the corpus, and each near pair lies in one range: a
character that repeats the one before it is skipped for replacements only, as skipping either gives the same word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.exchange import discard, materialized

LEAST_LENGTH = 6
LEAST_COUNT = 5
SLIP = 199  # a run whose hash this divides loses a character
TIMES = 5  # a form is this many times as frequent as its variant, at least
HELD_WORDS = 400_000  # distinct words that a task counts before it hands them on
BLOCK = 1 << 20  # characters of a text that are cut at a time
END = "$"  # terminator; no letter

#: byte of each Latin-1 character in a run, A-Z lower-cased; a space for all that separates runs
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> Iterator[list[bytes]]:
    """Lower-cased runs of letters (A-Z, a-z, U+00C0 to U+00FF) as Latin-1 bytes, some BLOCK characters at a time."""
    at = 0
    while at < len(text):
        part = text[at : at + BLOCK].encode("latin-1", "replace").translate(_LETTERS)
        end = len(part)
        if at + end < len(text):  # cut behind the last run that ends in the block
            end = part.rfind(b" ") + 1
            more = at + BLOCK
            while not end:
                step = text[more : more + BLOCK].encode("latin-1", "replace").translate(_LETTERS)
                if not step:
                    end = len(part)
                    break
                end = len(part) + step.find(b" ") + 1 if b" " in step else 0
                part += step
                more += BLOCK
        yield part[:end].split()
        at += end


def slipped(run: bytes, code: int) -> bytes:
    """The run without its character code % length."""
    i = code % len(run)
    return run[:i] + run[i + 1 :]


def _count(batches, least, slip):
    """(word, n) of a task's texts, summed until too many words are held; rows (prefix of the hash, text)."""
    held, utf8 = Counter(), {}
    for batch in batches:
        for prefix, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            start = zlib.crc32(prefix.encode())
            for part in runs(text.as_py() or ""):
                for run, n in Counter(part).items():
                    if len(run) < least:
                        continue
                    raw = utf8.get(run)
                    if raw is None:
                        raw = utf8[run] = run.decode("latin-1").encode() if max(run) > 127 else run
                    code = zlib.crc32(raw, start)
                    if code % slip:
                        held[run] += n
                    elif len(run) > least:
                        held[slipped(run, code)] += n
            if len(held) > HELD_WORDS or len(utf8) > HELD_WORDS:
                yield _words(held)
                held, utf8 = Counter(), {}
    if held:
        yield _words(held)


def _words(held):
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                       pa.array(list(held.values()), pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = SLIP,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least least_length characters that occur least_count times or more in all texts.

    Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case; a run for which slip divides crc32 of
    `<doc_id>:<run>` loses its character crc32 % length first.  Null texts have none; a null doc_id is the empty string there.
    """
    prefix = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    rows = docs.select(prefix.alias("prefix"), F.col(text_col).cast("string").alias("text"))
    parts = rows.mapInArrow(partial(_count, least=least_length, slip=slip), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, last, word, n): each rotation of word and terminator, whole (last is empty) and but for its last character."""
    whole = F.expr(f"transform(sequence(0, length(word)), i -> struct(concat(substr(word, i + 1), '{END}', substr(word, 1, i)) as prefix, "
                   "'' as last))")
    short = F.expr(f"transform(sequence(1, length(word)), i -> struct(concat(substr(word, i + 1), '{END}', substr(word, 1, i - 1)) as prefix, "
                   "substr(word, i, 1) as last))")
    return words.select("word", "n", F.explode(F.concat(whole, short)).alias("r")).select("r.prefix", "r.last", "word", "n")


NEAR = "word string, near bigint, best_n bigint, best string"


def _better(a, b):
    """The more frequent of two (n, word); the first in code-point order of equally frequent ones."""
    return a if b is None or (a is not None and (-a[0], a[1]) < (-b[0], b[1])) else b


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (prefix, last, word, n) sorted by prefix and last: per range, how many words are near each one, and the best."""
    prefix, group, out = None, [], []
    for batch in batches:
        for p, last, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if p != prefix:
                _range(prefix, group, out)
                prefix, group = p, []
            group.append((last, n, word))
        yield _near(out)
        out = []
    _range(prefix, group, out)
    yield _near(out)


def _near(rows):
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    names = [x.split()[0] for x in NEAR.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _range(prefix, group, out):
    """Near words of one range: a word without the skipped character, and those with one each."""
    if len(group) < 2:
        return
    bare = (group[0][1], group[0][2]) if not group[0][0] else None
    longer = group[1:] if bare else group
    repeated = prefix[-1]  # the character before the skipped one
    first = second = None
    for _, n, word in longer:
        if _better((n, word), first) == (n, word):
            first, second = (n, word), first
        else:
            second = _better((n, word), second)
    for last, n, word in longer:
        best = second if word == first[1] else first
        near = len(longer) - 1
        if bare and last != repeated:
            near, best = near + 1, _better(bare, best)
        if near:
            out.append((word, near, *best))
    if bare:
        inserted = [(n, word) for last, n, word in longer if last != repeated]
        if inserted:
            best = None
            for x in inserted:
                best = _better(x, best)
            out.append((bare[1], len(inserted), *best))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n): how many words differ by one inserted, deleted or replaced character, and the most
    frequent of them, the first in code-point order of equals; words without any are left out.  words: distinct word, n."""
    dealt = rotations(words).repartition("prefix").sortWithinPartitions("prefix", "last")
    found = dealt.mapInArrow(_scan, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", F.col("b.w").alias("best"), (-F.col("b.m")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the word at which following forms ends.

    Each round doubles the steps that are taken.  Forms are TIMES as frequent each, so a chain is as long as a logarithm.
    """
    spark = forms.sparkSession
    step = materialized(spark, forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = step.alias("a").join(step.alias("b"), F.expr("a.root = b.word"), "left")
        new = materialized(spark, on.select(F.col("a.word"), F.coalesce("b.root", "a.root").alias("root"),
                                            F.col("b.root").isNotNull().alias("moved")), "forms")
        discard(step)
        if new.where("moved").isEmpty():
            return new.drop("moved")
        step = materialized(spark, new.drop("moved"), "forms")
        discard(new)


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = SLIP,
                      times: int = TIMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    form: the most frequent near word (ties: the first in code-point order), if it is at least `times` as frequent; else null.
    root: where forms lead to from word, or the word itself.  See vocabulary for the words and for null texts and ids.
    Repeated rows count as often as they stand; texts of any length are cut in blocks, between runs; an empty
    table, or one without such words, gives no row; other columns aren't read.
    """
    spark = docs.sparkSession
    words = materialized(spark, vocabulary(docs, least_length, least_count, slip, id_col, text_col), "vocabulary")
    near = materialized(spark, near_words(words), "near")
    formed = near.alias("a").join(words.alias("w"), F.expr("a.word = w.word"))
    forms = formed.where(F.col("best_n") >= times * F.col("w.n")).select(F.col("a.word"), F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    forms = materialized(spark, forms, "form")
    out = words.join(near.select("word", "n_near"), "word", "left").join(forms, "word", "left").join(roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                      "form_n")
