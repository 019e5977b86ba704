"""The training-data pipeline over documents.

Stages, each on all that the one before it kept: language ID (documents without
letters go), toxicity (toxic documents go), near-duplicates (one document of
each SimHash group stays, if its five-word shingles aren't like an earlier
one's), PII (personal data is replaced by its kind), packing (the rest, as
pieces of sequences). All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import langid, packing, pii, resemble, simhash, toxicity
from corpusmill.llm.common import cut, scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with any letter. Where lang is null it becomes the prediction; without a model it stays null."""
    model = langid.fit(docs)
    if model is None:
        return langid.lettered(docs.select(*COLUMNS))
    made = langid.identify(docs, model, COLUMNS)
    return made.where(F.col("lang_pred") != langid.UND).select(*[F.coalesce("lang", "lang_pred").alias("lang") if c == "lang" else c for c in COLUMNS])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the grammar doesn't call toxic."""
    made = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), COLUMNS)
    return made.where(F.col("predicted") == 0).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of each SimHash group that has the least doc_id; of these, in order of doc_id, those whose
    five-word shingles are less than 0.8 similar to those of every earlier one that stays.

    A row without a doc_id, or whose doc_id another row has, counts as if its doc_id and text gave it one beyond the
    others: rows that repeat a doc_id with other texts are other documents, and of rows alike in both one stays.
    """
    rows = docs.select(*COLUMNS, F.col("doc_id").cast("long").alias("__id"))
    repeated = cut(rows.groupBy("__id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("__id").isNull()).select("__id"))
    beyond = F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1))
    if repeated.isEmpty():
        named = rows
    else:
        known = repeated.where(F.col("__id").isNotNull()).withColumn("__more", F.lit(True))
        named = rows.join(known, "__id", "left").withColumn("__id", F.when(F.col("__more") | F.col("__id").isNull(), beyond).otherwise(F.col("__id"))).select(*COLUMNS, "__id")
    texts = named.select(F.col("__id").alias("doc_id"), "text")
    groups = simhash.near_duplicates(texts)
    first = cut(groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct())
    kept = cut(resemble.kept(texts, first))
    many = kept.where(F.col("n") > 1).select(F.col("doc_id").alias("__id"))
    once = named.join(kept.where(F.col("n") == 1).select(F.col("doc_id").alias("__id")), "__id", "left_semi").select(*COLUMNS)
    if many.isEmpty():
        return once
    first = named.join(many, "__id", "left_semi").groupBy("__id").agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("__text"), *COLUMNS)).alias("r"))
    return once.unionByName(first.select(*[F.col(f"r.{c}").alias(c) for c in COLUMNS]))


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data; n_chars follows the text."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact_private),
    ("packing", pack_sequences),
]

#: SQL can't express the learned stages; tests hold each stage's decisions against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
