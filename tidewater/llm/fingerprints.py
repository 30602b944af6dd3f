"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text's terms are its words, weighted by how often they occur.  For each sample and term, a hash of both gives
r, c ~ Gamma(2, 1) and b ~ U(0, 1) (a Gamma(2, 1) is minus the logarithm of a product of two uniforms); with weight w,

    t = floor(ln w / r + b),    ln a = ln c - r * (t - b + 1),

and the sample of a text is its term of least a.  The same (term, t) always has the same a, and different ones
almost never, so the least a itself stands for the sample: two texts agree in it with a probability equal to their
generalised Jaccard similarity, sum(min(w)) / sum(max(w)).  Everything is minima of numbers by document, in
generated code; the text is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.indexing import with_row_index
from tidewater.llm.exchange import materialized

SAMPLES = 32
TOGETHER = 8  # samples computed from one row, few enough for one compiled method
NO_TERM = "-" * 8
SPLIT = "[\\x20\\x09-\\x0D]+"


def _uniform(h: Column, shift: int, bits: int) -> Column:
    return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("double") + 0.5) / float(1 << bits)


def minima(texts: DataFrame, key: str, versions: list[str], samples: int = SAMPLES) -> DataFrame:
    """(key, part, v<i>_<j>): for each version (a string column), ln a of sample part * TOGETHER + j; null without words.

    Rows must be unique by key.  If texts is partitioned by key, nothing is shuffled.
    """
    each = F.array(*[F.struct(F.col(v).alias("t"), F.lit(i).alias("v")) for i, v in enumerate(versions)])
    words = texts.select(key, F.explode(each).alias("x")).select(key, "x.v", F.explode(F.split("x.t", SPLIT)).alias("word"))
    counts = words.groupBy(key, "word").agg(*[
        F.sum(F.when((F.col("v") == i) & (F.col("word") != ""), 1).otherwise(0)).alias(f"n{i}") for i in range(len(versions))])
    # the logarithm of no occurrence is null, and so is all that follows from it
    logs = counts.select(key, F.xxhash64("word").alias("term"), *[F.log(F.col(f"n{i}").cast("double")).alias(f"l{i}")
                                                                  for i in range(len(versions))])
    parts = logs.withColumn("part", F.explode(F.array(*[F.lit(p) for p in range(samples // TOGETHER)])))
    drawn = []
    for j in range(TOGETHER):
        number = F.col("part") * TOGETHER + j
        h, g = F.xxhash64("term", number), F.xxhash64("term", number, F.lit(1))
        drawn += [(-F.log(_uniform(h, 0, 21) * _uniform(h, 21, 21))).alias(f"r{j}"), _uniform(h, 42, 22).alias(f"b{j}"),
                  F.log(-F.log(_uniform(g, 0, 32) * _uniform(g, 32, 32))).alias(f"c{j}")]
    drawn = parts.select(key, "part", *[f"l{i}" for i in range(len(versions))], *drawn)
    least = [F.min(F.expr(f"c{j} - r{j} * (floor(l{i} / r{j} + b{j}) - b{j} + 1)")).alias(f"v{i}_{j}")
             for i in range(len(versions)) for j in range(TOGETHER)]
    return drawn.groupBy(key, "part").agg(*least)


def _code(c: Column) -> Column:
    return F.coalesce(F.lpad(F.hex(F.xxhash64(c).bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"), F.lit(NO_TERM))


def fingerprints(minima_: DataFrame, key: str, versions: int, samples: int = SAMPLES) -> DataFrame:
    """(key, fingerprint0 ..., agree): per version eight hex digits per sample; agree: samples that versions 0 and 1 share."""
    own = [F.concat(*[F.when(F.col(f"v{i}_{j}").isNull(), F.lit(NO_TERM)).otherwise(_code(F.col(f"v{i}_{j}")))
                      for j in range(TOGETHER)]).alias(f"f{i}") for i in range(versions)]
    agree = sum(F.col(f"v0_{j}").eqNullSafe(F.col(f"v{min(1, versions - 1)}_{j}")).cast("int") for j in range(TOGETHER))
    rows = minima_.select(key, "part", *own, agree.alias("agree"))
    out = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("part", *[f"f{i}" for i in range(versions)]))).alias("p"),
                                F.sum("agree").alias("agree"))
    return out.select(key, *[F.array_join(F.col("p")[f"f{i}"], "").alias(f"fingerprint{i}") for i in range(versions)], "agree")


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    return F.expr(f"size(filter(sequence(0, {samples - 1}), i -> substring({a}, 8 * i + 1, 8) = substring({b}, 8 * i + 1, 8)))"
                  f" / cast({samples} as double)")


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and likenesses.

    The edited text has its last third of code points (rounded down) replaced by the first as many, or all, of the
    next document in descending doc_id, the first one following the last; a null doc_id comes last.
    Null texts count as empty; texts without words share one fingerprint.  Rows equal in doc_id and text are one
    document and return equal rows; texts of one doc_id follow each other by hash.  Other columns aren't read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.xxhash64("doc_id", "text", F.col("doc_id").isNull()))
    ids = rows.groupBy("k").agg(F.first("doc_id").alias("doc_id"), F.first(F.length("text")).cast("bigint").alias("n_chars"),
                                F.count(F.lit(1)).alias("copies"))
    ranked = materialized(spark, with_row_index(ids, "ix", ["doc_id", "k"]), "ranked")
    total = ranked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
    n = max(1, total["n"])
    after = ranked.select(F.pmod(F.col("ix") - 1, F.lit(n)).alias("ix"), F.col("k").alias("to"),
                          F.floor(F.col("n_chars") / 3).cast("int").alias("need"))
    gives = ranked.select("ix", "k").join(after, "ix").select("k", "to", "need")
    texts = rows.select("k", "text")
    if total["rows"] > total["n"]:
        texts = texts.dropDuplicates(["k"])
    heads = texts.join(gives, "k").select(F.col("to").alias("k"), F.expr("substring(text, 1, need)").alias("head"))
    both = texts.join(heads, "k").select(
        "k", "text", F.expr("concat(substring(text, 1, length(text) - cast(floor(length(text) / 3) as int)), head)").alias("edited"))
    prints = fingerprints(minima(both, "k", ["text", "edited"], samples), "k", 2, samples)
    prints = prints.join(both.select("k", F.sha2("edited", 256).alias("edited_sha256")), "k")
    prints = materialized(spark, prints.join(ranked, "k"), "prints")
    following = prints.select(F.pmod(F.col("ix") + 1, F.lit(n)).alias("ix"), F.col("fingerprint0").alias("next_print"))
    out = prints.join(following, "ix").withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
    return out.select("doc_id", "n_chars", "edited_sha256", F.col("fingerprint0").alias("fingerprint"),
                      F.col("fingerprint1").alias("edited_fingerprint"), (F.col("agree") / float(samples)).alias("near_edited"),
                      likeness("fingerprint0", "next_print", samples).alias("near_next"))
