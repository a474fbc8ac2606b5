"""The operators over the given tables; each digest is derived from what the operator returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Tables
from . import (
    decontamination,
    language,
    license_scan,
    line_dedup,
    merkle,
    near_dup,
    packing,
    quality,
    records,
    secret_scan,
    toxicity,
    url_filter,
    whitening,
)

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(Tables(spark, folder).documents)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, through a ledger that starts empty."""
    found = secret_scan.scan_versions(Tables(spark, folder).documents, secret_scan.Ledger.new(spark))
    kinds = ("assign", "access", "hex")
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("bigint").alias(f"n_{k}") for k in kinds],
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents, learned from those whose remainder is not 1."""
    documents = Tables(spark, folder).documents
    held_out = F.coalesce(language.fold("doc_id", 3) == 1, F.lit(False))
    model = language.train(documents.filter(language.fold("doc_id", 3) != 1))
    return language.predict(documents.select("doc_id", held_out.alias("held_out"), "text"), model, ("doc_id", "held_out"))


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return near_dup.classified(Tables(spark, folder).documents)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, learned from labels whose remainder is not 0."""
    tables = Tables(spark, folder)
    model = toxicity.train(tables.documents, tables.labels.filter(language.fold("doc_id", 5) != 0))
    held_out = F.coalesce(language.fold("doc_id", 5) == 0, F.lit(False))
    scored = toxicity.score(tables.documents.select("doc_id", held_out.alias("held_out"), "text"), model, ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdicts of every document."""
    judged = quality.judge(Tables(spark, folder).documents)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"),
    )


def document_paths(documents: DataFrame) -> DataFrame:
    """Files and folders from source, language and id; ids divisible by 10 stand for the licence files of folders."""
    root = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    block = (F.col("doc_id") / 500).cast("bigint").cast("string")
    number = F.col("doc_id").cast("string")
    return documents.select(
        "doc_id",
        F.when(F.col("doc_id") % 500 == 0, F.concat_ws("/", root, F.concat(F.lit("LICENSE-"), number)))
        .when(F.col("doc_id") % 10 == 0, F.concat_ws("/", root, block, F.concat(F.lit("LICENSE-"), number)))
        .otherwise(F.concat_ws("/", root, block, F.concat(number, F.lit(".txt"))))
        .alias("path"),
        "text",
    )


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Own and inherited licences of every document."""
    files = document_paths(Tables(spark, folder).documents)
    return files.select("doc_id", "path").join(license_scan.scan(files), "path")


def op8_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """Write the ids of all documents as records and read the files back."""
    place = records.new_folder(spark)
    records.write(Tables(spark, folder).documents, place)
    return records.read(spark, place).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in all documents."""
    tables = Tables(spark, folder)
    found = decontamination.scan(tables.documents, tables.benchmark)
    n_hit = F.expr("aggregate(hits, 0L, (a, h) -> a + h.stop - h.start)")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near_items"),
    )


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts of the fixed rules on every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(Tables(spark, folder).pages, rules)


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that ten of them share."""
    kept = line_dedup.drop_shared_lines(Tables(spark, folder).documents)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened coordinates of all embeddings."""
    return whitening.whiten(Tables(spark, folder).embeddings)


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, and whether a document that is tampered with still leads to the root."""
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    documents = Tables(spark, folder).documents
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = merkle.leaf_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns])
    leaves = documents.withColumn("changed", F.when(tampered, changed))
    found = merkle.manifest(leaves, columns, "lang", "doc_id", ("doc_id", "changed"))
    again = merkle.folded(F.coalesce("changed", "leaf"), F.col("siblings"), F.col("sides"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), again.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_language_id": op3_language_id,
    "op4_order_minhash": op4_order_minhash,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_scan": op7_license_scan,
    "op8_token_records": op8_token_records,
    "op9_decontamination": op9_decontamination,
    "op10_url_filter": op10_url_filter,
    "op11_line_dedup": op11_line_dedup,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_merkle_manifest": op13_merkle_manifest,
}
