"""From raw documents to packed training sequences: five stages, each over all its predecessor kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, near_dup, packing, secret_scan, toxicity
from millrace.session import shared_folder
from millrace.sources.tables import Tables


def rows(docs: DataFrame) -> DataFrame:
    """Each document as one value beside its text, so that no column of a table meets one of an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels, scores below 0.5. Null and empty texts stay."""
    model = toxicity.train(docs, Tables(spark, sf_dir).labels)
    # the text goes to Python once, beside the other columns as one value
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_rest")
    kept = toxicity.score(docs.select(rest, "text"), model, ("_rest", "text")).filter("score < 0.5")
    return kept.select(*[F.col("text" if c == "text" else f"_rest.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates; null and empty texts are one class."""
    return near_dup.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item; texts without words stay."""
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    found = decontamination.scan(docs.select(key.alias("_key"), "text"), Tables(spark, sf_dir).benchmark, near=0, keep=("_key",))
    hit = found.filter(F.size("hits") > 0).select("_key").distinct()
    return rows(docs).withColumn("_key", F.sha2(F.coalesce("text", F.lit("")), 256)).join(hit, "_key", "left_anti").select("_row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` brought up to date; null texts stay null."""
    found = secret_scan.scan_versions(rows(docs), secret_scan.Ledger.new(spark), keep=("_row",))
    clean = found.withColumn("_old", F.col("_row.text")).withColumn(
        "_text", F.when(F.size("spans") > 0, secret_scan.masked("_old", "spans")).otherwise(F.col("_old"))
    )
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        length = F.length("_text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size("spans") > 0, length).otherwise(F.col("_row.n_chars"))
    return clean.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

# Classifier, sketches and tokens have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read by the next."""
    docs = Tables(spark, sf_dir.rstrip("/")).documents
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
