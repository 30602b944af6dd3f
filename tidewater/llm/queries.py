"""Registered queries of the subpackage, each over its whole table, and their SQL where SQL is feasible."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.best_fit import best_fit_packing
from tidewater.llm.bpe import decode, encode
from tidewater.llm.co_training import fit as fit_quality, quality_classifier
from tidewater.llm.fingerprints import edited_fingerprints
from tidewater.llm.first_fit import first_fit_packing
from tidewater.llm.jaccard_join import jaccard_components
from tidewater.llm.merkle import merkle_manifest
from tidewater.llm.oracles import MANIFEST, VARIANTS
from tidewater.llm.quality_rules import fit as fit_rules, quality_rules
from tidewater.llm.spelling import spelling_variants
from tidewater.llm.substring_dedup import substring_dedup
from tidewater.llm.token_output import packed_tokens
from tidewater.llm.toxicity import fit as fit_toxicity, toxicity
from tidewater.llm.url_query import SQL as URL_SQL, captures_filtered

def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; every executor has the package that names it."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: labelled documents that a model may learn from; the others are held out
LEARN = "crc32(cast(doc_id as string)) % 5 <> 0"

SQL: dict[str, str] = {"op1_url_filter": URL_SQL, "op11_merkle_manifest": MANIFEST, "op12_spelling_variants": VARIANTS}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures_filtered(_table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    index = fit_toxicity(docs, labels.where(LEARN).select("doc_id", "toxic"))
    # a null doc_id has no remainder; such a row is never learnt from, so it is held out
    return toxicity(docs, index).select("doc_id", F.expr(f"coalesce(not ({LEARN}), true)").alias("held_out"), "score",
                                        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_classifier(docs, fit_quality(docs, labels.where(LEARN).select("doc_id", "quality")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    ids = encode(_table(spark, sf_dir, "documents"), path, ["doc_id"])
    ids = ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                     F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    out = decode(ids, path, ["doc_id", "n_tokens", "ids_sha256"])
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_rules(docs, fit_rules(docs, labels.where(LEARN).select("doc_id", "quality")))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    end_id = 49407  # <|endoftext|> of this file
    return packed_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_fit_packing(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_best_fit_packing, op3_toxicity, op4_quality_classifier, op5_bpe, op6_substring_dedup, op7_ngram_jaccard_join,
    op8_quality_rules, op9_token_output, op10_fingerprints, op11_merkle_manifest, op12_spelling_variants, op13_first_fit_packing)}
