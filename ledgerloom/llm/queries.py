"""One named query per operator, over its whole table, and the SQL that some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chat, classifier, decontaminate, jaccard, language, lines, minhash, mixing, periodic, quality, resample, secrets, suffixes
from ledgerloom.llm.sql import ORACLES as ORACLES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_digest(quality.judge(table(spark, folder, "documents").select("doc_id", "text", "source")))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link_documents(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    told = classifier.classify(docs, table(spark, folder, "labels"))
    return told.select("doc_id", "e_quality", "e_toxic", "p_quality", "p_toxic", "kept")


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = lines.mark_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return marked.select("doc_id", F.col("lines").alias("n_lines"), F.size("cut").cast("long").alias("n_removed"), F.col("cut").alias("removed"))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets_digest(secrets.find_secrets(table(spark, folder, "documents").select("doc_id", "text")))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.cut_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    out = language.held_out(F.col("doc_id"))
    model = language.train(docs.where(~out).select("text", "lang"))
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.chat_digest(chat.format_chats(turns.unionByName(more)))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contamination_digest(decontaminate.mark_contaminated(docs, table(spark, folder, "benchmark")))


def op11_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    linked = minhash.link_documents(table(spark, folder, "documents").select("doc_id", "text"))
    return linked.select("doc_id", "n_shingles", "component_id", "kept")


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", periodic.looped(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic.runs_digest(periodic.mark_runs(docs))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    scored = resample.score(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return resample.rank(scored).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_chat_format": op9_chat_format,
    "op10_decontaminate": op10_decontaminate,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_importance_resampling": op13_importance_resampling,
}
