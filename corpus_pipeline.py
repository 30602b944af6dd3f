"""Corpus pipeline: quality, toxicity, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  All but the last return the
columns of documents; the last returns the packed pieces.  ``run`` writes each stage's result to the shared folder
and hands the reread table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import co_training, toxicity
from tidewater.llm.best_fit import best_fit_packing
from tidewater.llm.exchange import materialized
from tidewater.llm.features import fresh
from tidewater.llm.jaccard_join import jaccard_components
from tidewater.llm.queries import LEARN, tokenizer_path
from tidewater.llm.substring_dedup import substring_dedup, text_hash


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_small_batches(stage):
    """The stage with texts on their way to Python 8 MB at a time: a batch lies in the JVM and, with the one before, in Python, for each core.

    The setting stays, as a stage's frame is worked out after the stage returns it.
    """
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH, "8m")
        return stage(spark, docs, sf_dir)

    return run


def _labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").where(LEARN).select("doc_id", column)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for good quality."""
    model = co_training.fit(docs, _labels(spark, sf_dir, "quality"))
    return co_training.good_documents(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is less likely than not."""
    index = toxicity.fit(docs, _labels(spark, sf_dir, "toxic"))
    return toxicity.clean_documents(docs, index)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of least doc_id, null being last; rows of equal doc_id and text become one.

    A row's identity is the hash of doc_id and text, so rows of one doc_id, or of none, whose texts don't link all stay.
    """
    (name,) = fresh(docs.columns, 1)
    docs_ = docs.withColumn(name, F.xxhash64(F.col("doc_id"), F.col("text")))
    groups = jaccard_components(docs_, id_col=name).select(F.col("doc_id").alias("row"), "component_id").distinct()
    ids = docs_.select(F.col(name).alias("row"), "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    stay = groups.join(ids, "row").groupBy("component_id").agg(first).select(F.col("first.row").alias(name))
    return docs_.join(stay, name, "left_semi").dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that start earlier in the corpus; texts that lose nothing stay as they are.

    A text that loses words becomes those left, joined by one space; n_chars follows.
    """
    parsed = substring_dedup(docs).where("n_removed > 0").select("doc_id", "text_hash", "kept")
    parsed = parsed.dropDuplicates(["doc_id", "text_hash"])  # repeated rows have equal results
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (text_hash(F.col("d.text")) == F.col("p.text_hash"))
    both = docs.alias("d").join(parsed.alias("p"), same, "left")
    lost = F.col("p.kept").isNotNull()
    new = {"text": F.coalesce("p.kept", "d.text"), "n_chars": F.when(lost, F.length("p.kept")).otherwise(F.col("d.n_chars"))}
    return both.select(*[new.get(c, F.col(f"d.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequences."""
    return best_fit_packing(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [(name, _in_small_batches(stage)) for name, stage in (
    ("quality_classifier", quality_classifier), ("toxicity", toxicity_filter), ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup_stage), ("best_fit_packing", pack))]

#: classifiers, components and packing aren't expressible in SQL; the tests hold the join and substring dedup against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialized(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
