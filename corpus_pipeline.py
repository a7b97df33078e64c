"""A training corpus in five steps: language, near-duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, documents, table folder) and returns a DataFrame; all
but the last return the columns of ``documents``.  Every stage works on all the
stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm import language, minhash, packing, secret_scan, templates
from lakeworks.llm.names import unused
from lakeworks.session import cut_lineage

#: Near-duplicates: shingles of five words, similarity of 0.8 or more.
SHINGLE_WORDS, PERCENT = 5, 80


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin."""
    names = unused(docs.columns, "_language", "_score", "_accepted")
    found = language.detect(docs, language.fit(docs), names=tuple(names))
    return found.filter(F.col(names[2])).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return minhash.deduplicated(docs, n_words=SHINGLE_WORDS, percent=PERCENT).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, its numbers, names and units replaced or not."""
    found = templates.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return templates.without_matches(docs, found).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mask and ``n_chars`` counted anew where one was."""
    (secrets,) = unused(docs.columns, "_secrets")
    found = secret_scan.scan(docs, name=secrets)
    any_found = F.size(secrets) > 0
    changed = {"text": secret_scan.masked(F.col("text"), F.col(secrets))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(any_found, F.length(changed["text"]).cast(kind)).otherwise(F.col("n_chars"))
    return found.withColumns(changed).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents and their places in the sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

#: Compression, MinHash and tokenisation have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
