"""The registered query of each operator: whole tables in, the contract's columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtrail.llm import (common, conversation_repair, embedding_neardup, importance_resampling, kneser_ney_toxicity,
                          license_scan, mixture, orc_tokens, ppm_language, secret_scan, simhash_neardup, spaced_seeds,
                          suffix_dedup, trie_dedup)
from webtrail.llm.license_sql import LICENSE_SQL

#: The id that ends a document in token files.
END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return common.bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _path() -> Column:
    """Each source as a file tree of nested numbered folders, which stands in for the paths that the
    table ``documents`` does not have."""
    folder = lambda n: F.concat(F.lit("d"), F.floor(F.col("doc_id") / n).cast("string"))
    return F.concat_ws("/", F.coalesce("source", F.lit("unknown")), folder(1000), folder(50),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def op1_entropy_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.balance(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_repeats=3)


def op2_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.export(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=END_ID)


def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_neardup.near_duplicates(_table(spark, sf_dir, "embeddings"), min_cosine=0.98)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return license_scan.scan(docs.withColumn("path", _path()), "doc_id", "path", "text")


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(ppm_language.fold("doc_id", 4) == 2, F.lit(False))
    found = ppm_language.identify(docs, docs.filter(ppm_language.fold("doc_id", 4) != 2))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op8_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and, by cross-fitting, the curve from folds 1 to 4 of five; fold 0 is never learned from."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.small_side(_table(spark, sf_dir, "labels").select("doc_id", "toxic"), 1_000_000)
    fold = ppm_language.fold("doc_id", 5)
    known = docs.join(labels, "doc_id").withColumnRenamed("toxic", "label")
    model = kneser_ney_toxicity.cross_fit(known, fold, (1, 2, 3, 4))
    found = kneser_ney_toxicity.score(docs, model)
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("path", _path())
    return secret_scan.scan(docs, secret_scan.known_formats(), path="path")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    found = conversation_repair.report(rows.select(F.col("conv_id").alias("conv")), conversation_repair.damage(rows))
    return found.withColumnRenamed("conv", "conv_id")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.draw(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_trie_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_dedup.owners(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_entropy_mixture, op2_orc_tokens, op3_spaced_seeds, op4_suffix_dedup, op5_embedding_neardup, op6_license_scan,
    op7_ppm_language, op8_kneser_ney_toxicity, op9_simhash_neardup, op10_secret_scan,
    op11_conversation_repair, op12_importance_resampling, op13_trie_dedup)}

OWNERS_SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS words FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY words) AS keep_id, count(*) OVER (PARTITION BY words) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY words) AS kept, sha256(words) AS text_sha256
FROM texts
"""

#: What SQL can express; the others are held against plain versions in tests/llm.
ORACLE: dict[str, str] = {"op6_license_scan": LICENSE_SQL, "op13_trie_dedup": OWNERS_SQL}
