"""Registered queries of the operators; their SQL twins are in :mod:`lakeworks.llm.oracles`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm import chat, exact_substrings, fuzzy, kneser_ney, language, minhash, packing, periodic, prefix_trie, quality, secret_scan, substrings, templates
from lakeworks.llm.oracles import ORACLES
from lakeworks.session import cut_lineage

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(n: int) -> Column:
    """Fold of a document by the checksum of its id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_exact_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_substrings.repeated_spans(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_fuzzy_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy.against_edits(table(spark, folder, "documents"))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.filter(fold(5) != 0))
    found = quality.score(docs.select("doc_id", "text", (fold(5) == 0).alias("held_out")), model)
    return found.select("doc_id", "held_out", "score", "predicted")


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(table(spark, folder, "documents"))


def op6_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return templates.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold(3) == 1
    model = language.fit(docs.filter(~held_out))
    found = language.detect(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repaired(table(spark, folder, "conversations"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.earlier_spans(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def periodic_tail(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum ``h`` of its id, with its words from a place on made periodic.

    With ``g = h / 10`` the place is ``g % n`` and the period ``1 + (n - place) / (3 + g % 8)``.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    n, g = F.size("_words"), F.floor(h / 10)
    start = (g % n).cast("int")
    rest = n - F.col("_start")
    period = (1 + F.floor(rest / (3 + g % 8))).cast("int")
    repeats = F.ceil(rest / F.col("_period")).cast("int")
    once = F.slice("_words", F.col("_start") + 1, F.col("_period"))
    tail = F.slice(F.flatten(F.array_repeat(once, repeats)), F.lit(1), rest)
    # one column a step, so that the words are split once
    return (
        docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"))
        .withColumn("_start", F.when(n > 0, start))
        .withColumn("_period", period)
        .withColumn("_tail", F.when(n > 0, F.concat(F.slice("_words", F.lit(1), F.col("_start")), tail)))
        .select("doc_id", F.coalesce(F.array_join("_tail", " "), "text").alias("text"))
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(periodic_tail(table(spark, folder, "documents")))
    best = F.col("best")
    return found.withColumn("best", periodic.longest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[name].alias(name) for name in ("start", "length", "period")),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(periodic.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(7) == 2, F.lit(False))
    found = kneser_ney.score(docs, kneser_ney.fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def shared_beginnings(sequences: DataFrame) -> DataFrame:
    """Conversation c with its first h turns taken from conversation c - c % 5; h is the checksum of c modulo 9."""
    heads = sequences.select(F.col("conv_id").alias("head"), F.slice("turns", 1, 8).alias("head_turns"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    none = F.slice("turns", 1, 0)
    own = F.slice(F.col("turns"), h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    both = sequences.join(heads, F.col("head") == F.col("conv_id") - F.col("conv_id") % 5, "left")
    return both.select("conv_id", F.concat(F.coalesce(F.slice("head_turns", F.lit(1), h), none), own).alias("turns"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    sequences = prefix_trie.turn_sequences(table(spark, folder, "conversations"))
    return prefix_trie.build(shared_beginnings(cut_lineage(sequences, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_exact_substrings": op1_exact_substrings,
    "op2_fuzzy_fingerprints": op2_fuzzy_fingerprints,
    "op3_minhash": op3_minhash,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_secret_scan": op5_secret_scan,
    "op6_template_decontamination": op6_template_decontamination,
    "op7_language_id": op7_language_id,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_chat_format": op9_chat_format,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_language_model": op12_language_model,
    "op13_prefix_trie": op13_prefix_trie,
}
