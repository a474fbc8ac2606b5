"""A linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text has an n-gram or has it not, however often. From labelled texts each n-gram gets the log
of its share among the n-grams of toxic texts over that among the others. The n-grams whose
ratios stand out most become features with that ratio as their value, and a logistic regression
weighs them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .schemas import extended

#: Bounds of what is fitted: labelled rows, hash buckets for n-grams, features, and words a task remembers.
MAX_ROWS, BUCKETS, FEATURES, REMEMBERED = 20_000, 1 << 18, 2048, 250_000
#: Words whose n-grams a task remembers while it counts them.
COUNTED = 50_000
SIZES = (3, 4, 5)
SAMPLE_PARTS = 16


def word_grams(word: str) -> set[int]:
    """Buckets of the n-grams inside a word and its spaces; very long words have as many as they have characters."""
    padded = f" {word} "
    return {
        zlib.crc32(padded[i : i + n].encode("utf-8", "replace")) % BUCKETS
        for n in SIZES
        for i in range(max(1, len(padded) - n + 1))
    }


@dataclass
class Model:
    """``features`` are buckets in ascending order, ``weights`` what their presence adds to ``bias``."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


class Reader:
    """The features of whole texts, by place in ``features``."""

    def __init__(self, features: Sequence[int]):
        self.places = {int(b): i for i, b in enumerate(features)}
        self.words: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> set[int]:
        if len(self.words) > REMEMBERED:
            self.words.clear()
        found: set[int] = set()
        for word in set((text or "").lower().split()):
            own = self.words.get(word)
            if own is None:
                own = self.words[word] = tuple(self.places[g] for g in word_grams(word) if g in self.places)
            if own:
                found.update(own)
        return found


def labelled(documents: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``text, toxic`` of at most ``max_rows`` labelled ids, those with the smallest hashes.

    An id with several labels is toxic if one of them says so; null labels are left out. The ids
    are counted before they are sent to all tasks, so the texts are not shuffled for the join.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps with conjugate gradients, until the gradient vanishes."""
    n, d = len(y), len(values)
    scaled = values[columns]
    w, b = np.zeros(d), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))

    def times(v: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=scaled * v[columns], minlength=n)

    def back(u: np.ndarray) -> np.ndarray:
        return np.bincount(columns, weights=u[rows] * scaled, minlength=d)

    def loss(w: np.ndarray, b: float) -> float:
        z = times(w) + b
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + penalty / 2 * (w @ w))

    now = loss(w, b)
    while True:
        p = 1 / (1 + np.exp(-(times(w) + b)))
        gradient = np.append(back(p - y) + penalty * w, (p - y).sum())
        if np.abs(gradient).max() < 1e-4 * n:
            return w, b
        curve = np.maximum(p * (1 - p), 1e-9)
        step, residual = np.zeros(d + 1), -gradient
        direction, norm = residual.copy(), float(residual @ residual)
        for _ in range(50):
            u = curve * (times(direction[:-1]) + direction[-1])
            product = np.append(back(u) + penalty * direction[:-1], u.sum())
            pace = norm / float(direction @ product)
            step += pace * direction
            residual -= pace * product
            after = float(residual @ residual)
            if after < 1e-6 * float(gradient @ gradient):
                break
            direction, norm = residual + after / norm * direction, after
        pace = 1.0
        while (following := loss(w + pace * step[:-1], b + pace * step[-1])) > now - 1e-4 * pace * float(-gradient @ step):
            pace /= 2
            if pace < 1e-6:
                return w, b
        w, b, now = w + pace * step[:-1], b + pace * step[-1], following


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, features: int = FEATURES) -> Model | None:
    """Fit on a bounded sample of whole labelled texts; None if it lacks one of the two labels.

    The counts of the n-grams and the features of the sample reach the driver; both are bounded
    by the parameters.
    """
    texts = cut(labelled(documents, labels, max_rows).repartition(SAMPLE_PARTS))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, BUCKETS), np.int64)
        known: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                if len(known) > COUNTED:
                    known.clear()
                words = set(text.lower().split())
                for word in words.difference(known):
                    known[word] = np.fromiter(word_grams(word), np.uint32)
                if words:
                    counts[int(toxic > 0), np.unique(np.concatenate([known[w] for w in words]))] += 1
        at = np.flatnonzero(counts.sum(axis=0))
        yield pd.DataFrame({"bucket": at, "clean": counts[0, at], "toxic": counts[1, at]})

    counted = texts.mapInPandas(count, "bucket bigint, clean bigint, toxic bigint").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    table = counted.toPandas().sort_values("bucket")
    sizes = {r[0]: r[1] for r in texts.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    if len(sizes) < 2 or table.empty:
        return None
    clean, toxic = table["clean"].to_numpy() + 1.0, table["toxic"].to_numpy() + 1.0
    ratio = np.log(toxic / toxic.sum()) - np.log(clean / clean.sum())
    clear = np.abs(ratio) / np.sqrt(1 / toxic + 1 / clean)
    chosen = np.sort(np.argsort(-clear, kind="stable")[:features])
    buckets, values = table["bucket"].to_numpy()[chosen], ratio[chosen]

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(buckets)
        for batch in batches:
            found = [np.array(sorted(reader.of(t)), "<u2").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"toxic": (batch["toxic"] > 0).astype(float), "found": found})

    rows = texts.mapInPandas(describe, "toxic double, found binary").toPandas()
    found = [np.frombuffer(f, "<u2") for f in rows["found"]]
    lengths = np.array([len(f) for f in found])
    weights, bias = logistic(
        np.repeat(np.arange(len(found)), lengths), np.concatenate(found).astype(np.int64), values, rows["toxic"].to_numpy()
    )
    return Model(buckets, weights * values, bias)


def score(documents: DataFrame, model: Model | None, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and the score of every whole text; nothing but the text is looked at.

    Null and empty texts get what the bias alone says. Without a model all scores are 0.
    Repeated rows stay, and an empty table stays empty. A text that is kept is sent once.
    """
    if model is None:
        return documents.select(*keep, F.lit(0.0).alias("score"))
    own = list(keep).index(text) if text in keep else len(keep)
    chosen = documents.select(*keep) if text in keep else documents.select(*keep, F.col(text).alias("_text"))
    fields = chosen.schema.fields[: len(keep)]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = Reader(model.features), model.weights
        for batch in batches:
            sums = np.array([model.bias + weights[sorted(reader.of(t.as_py()))].sum() for t in batch.column(own)], float)
            kept = batch.select(list(range(len(fields))))
            scores = pa.array(1 / (1 + np.exp(-np.clip(sums, -500, 500))), pa.float64())
            yield pa.RecordBatch.from_arrays([*kept.columns, scores], names=[*kept.schema.names, "score"])

    return chosen.mapInArrow(judge, extended(fields, "score double"))
