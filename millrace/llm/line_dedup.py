"""Line deduplication: lines that many documents share lose all their places, everywhere.

Lines are exploded, normalised and hashed; documents are counted per hash and the places of
lines over the threshold are gathered per text. Texts themselves move once, to meet those places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized
from .schemas import passed

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULTS = ("text", "n_lines", "n_dropped")


def whole(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def line_keys(text: Column) -> Column:
    """The keys of all lines of a text: white space cut at both ends, A to Z in lower case.

    A text of plain ASCII is lowered as a whole, which is the quicker way; others letter by letter.
    """
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(F.split(lowered, "\n"), lambda line: F.btrim(line, F.lit(SPACE)))


def line_hash(key: str) -> Column:
    """128 bits of a key."""
    return F.unhex(F.md5(key))


def document_counts(documents: DataFrame, min_chars: int = 1, text: str = "text") -> DataFrame:
    """``line`` (the hash of a key) and ``n_docs``, the number of rows that hold it.

    A document sends each of its keys once and every task adds up its own, so a line of a third
    of all documents is one row per task.
    """
    keys = F.array_distinct(F.filter(line_keys(whole(text)), lambda k: F.length(k) >= min_chars))
    return documents.select(F.explode(keys).alias("_key")).groupBy(line_hash("_key").alias("line")).agg(F.count("*").alias("n_docs"))


def shared_places(documents: DataFrame, lines: DataFrame, min_chars: int = 1, text: str = "text") -> DataFrame:
    """``_text`` (the hash of a text) and the ascending places ``_cuts`` of those of its lines that are in ``lines``.

    Copies of a text give one row. ``lines`` is broadcast if it is measured to be small; else the
    places meet it by hash, where adaptive execution splits a frequent line.
    """
    places = documents.select(F.sha2(whole(text), 256).alias("_text"), F.posexplode(line_keys(whole(text))).alias("_at", "_key"))
    hashed = places.filter(F.length("_key") >= min_chars).select("_text", "_at", line_hash("_key").alias("line"))
    hits = hashed.join(sized(lines.select("line")), "line", "left_semi")
    return hits.groupBy("_text").agg(F.sort_array(F.collect_set("_at")).alias("_cuts"))


def drop_shared_lines(
    documents: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keep`` columns, the ``text`` without its shared lines, ``n_lines`` before, and ``n_dropped``.

    A line goes wherever it stands if its key has ``min_chars`` code points and at least
    ``min_docs`` documents hold it, the document itself included; the rest stay as they were,
    joined by newlines. Every row is a document, also a repeated one or one without an id. A null
    text counts as empty, that is as one empty line, and comes back empty; so does a text that
    loses all its lines. Texts of any length are taken whole; the work is linear in them. Columns
    outside ``keep`` are not read; a kept column named like a result comes back as ``in_<name>``.
    An empty table gives an empty table.
    """
    counted = document_counts(documents, min_chars, text).filter(F.col("n_docs") >= min_docs)
    found = shared_places(documents, counted, min_chars, text)
    mine = documents.select(*passed(keep, RESULTS), whole(text).alias("_body")).withColumn("_text", F.sha2("_body", 256))
    names = [c for c in mine.columns if c not in ("_body", "_text")]
    lined = mine.join(found, "_text", "left").select(
        *[F.col(f"`{c}`") for c in names], F.split("_body", "\n").alias("_lines"), F.coalesce("_cuts", F.array().cast("array<int>")).alias("_cuts")
    )
    # what lies between two cuts is copied as one stretch
    stretches = F.expr(
        "transform(sequence(0, size(_cuts)), j -> slice(_lines, coalesce(get(_cuts, j - 1) + 2, 1), "
        "coalesce(get(_cuts, j), size(_lines)) - coalesce(get(_cuts, j - 1) + 1, 0)))"
    )
    return lined.select(
        *[F.col(f"`{c}`") for c in names],
        F.array_join(F.flatten(stretches), "\n").alias("text"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size("_cuts").cast("bigint").alias("n_dropped"),
    )
