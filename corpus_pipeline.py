"""From raw documents to token files: language ID, near-duplicates, decontamination, mixing, output.

Each stage works on all rows that the one before it kept and calls one operator of ``webtrail.llm``.
``run`` writes each stage's rows to the shared folder as Parquet and reads them again, so a lost
executor never sends the job back further than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webtrail.llm import common, mixture, orc_tokens, ppm_language, simhash_neardup, spaced_seeds
from webtrail.llm.queries import END_ID, tokenizer_path

#: Words that a process of the last stage remembers: fewer than alone, as the stages before it leave less room.
REMEMBERED = 150_000
#: Characters that it takes apart at once, a quarter of what it does alone.
CHUNK = 1 << 19


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter, or that no language's model codes
    better than noise, go.  Learned from the documents whose crc32 of the id, modulo 4, is not 2."""
    return ppm_language.reject_unknown(docs, docs.filter(ppm_language.fold("doc_id", 4) != 2))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints: the one of the smallest id."""
    return simhash_neardup.keep_one(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return spaced_seeds.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the source mixture takes it."""
    return mixture.mix(docs, weights=(5, 2, 1), max_repeats=3)


def output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed documents, and their index read from the files."""
    return orc_tokens.export(docs, tokenizer_path(), end_id=END_ID, remembered=REMEMBERED, chunk=CHUNK)


def _bounded(stage):
    """The stage with Arrow batches bound by bytes: texts may be very long."""
    return lambda spark, docs, sf_dir: stage(common.bounded_batches(spark), docs, sf_dir)


STAGES = [(stage.__name__, _bounded(stage)) for stage in (language, near_duplicates, decontaminate, mix, output)]

#: SQL cannot express SimHash, PPM and the tokenizer; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
