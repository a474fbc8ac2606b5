"""Whitening of embeddings: covariance by partial sums, leading eigenpairs, projection of all rows.

Entries become integers first, so that sums and means are exact however the rows are dealt out.
What reaches the driver is one d x d matrix and d sums, for vectors of d entries; what goes out
again is the projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .eigen import EPS, leading_pairs
from .schemas import extended, passed

SCALE, OFFSET = 64, 1_000_000
#: Entries from here on do not fit the integers and count as not finite.
TOO_LARGE = 2.0**56
COMPONENTS = 16
RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")
BEYOND = 2**63


class Whitening(NamedTuple):
    """``n`` fitted vectors with exact ``sums``; unit ``axes`` as columns, their falling ``values``, and all variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    total: float

    def split(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole part and remainder over ``n``."""
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums))
        return np.array(whole, np.int64), np.array(rest, np.int64)


def whole_vectors(embeddings: DataFrame, vector: str, keep: Sequence[Column] = ()) -> DataFrame:
    """``keep`` and ``_x``, the entries as integers; rows with a null vector or a null or non-finite entry are left out."""
    column = F.col(f"`{vector}`")
    numbers = F.transform(column, lambda c: c.cast("double"))
    usable = F.forall(numbers, lambda c: c.isNotNull() & (F.abs(c) < TOO_LARGE))
    valid = embeddings.filter(column.isNotNull() & usable & (F.size(column) > 0))
    return valid.select(*keep, F.transform(numbers, lambda c: F.floor(c * SCALE).cast("bigint") + OFFSET).alias("_x"))


def matrices(batches: Iterable[pa.RecordBatch], name: str = "_x") -> Iterator[np.ndarray]:
    """The vectors of each batch as rows of a matrix."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column(batch.schema.get_field_index(name))
            yield column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def summed(rows: DataFrame, work: Callable[[Iterator[np.ndarray]], np.ndarray | None], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all tasks of the matrix that ``work`` makes of a task's vectors; added up by cell on the executors."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = work(matrices(batches))
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(made)), pa.int32()), pa.array(list(made), pa.list_(pa.float64()))], ["i", "row"])

    cells = rows.select("_x").mapInArrow(task, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros(shape)
    for i, j, v in cells.groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = v
    return out


def exact_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of every dimension."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * width
        for x in matrices(batches):
            n += len(x)
            # upper and lower halves cannot overflow within a batch
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            totals = [t + (h << 32) + w for t, h, w in zip(totals, high, low)]
        if n:
            yield pa.RecordBatch.from_pydict(
                {"at": list(range(width)), "n": [n] * width, "total": [str(t) for t in totals]},
                pa.schema([("at", pa.int32()), ("n", pa.int64()), ("total", pa.string())]),
            )

    partial = rows.select("_x").mapInArrow(task, "at int, n bigint, total string")
    found = partial.groupBy("at").agg(F.sum("n"), F.sum(F.col("total").cast("decimal(38,0)"))).collect()
    return found[0][1], [int(total) for _, _, total in sorted(found)]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """The whitening of the distinct ``_x`` and these as a table, or None if there is no vector.

    Vectors must agree in length: those of the most frequent length count (of two, the longer).
    A component needs a variance beyond rounding; vectors that span fewer dimensions give fewer.
    """
    distinct = cut(vectors.select("_x").distinct())
    length = distinct.groupBy(F.size("_x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col("d").desc()).first()
    if length is None:
        return None
    width = length["d"]
    rows = distinct.filter(F.size("_x") == width)
    n, sums = exact_sums(rows, width)
    mean = Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    whole, rest = mean.split()

    def products(parts: Iterator[np.ndarray]) -> np.ndarray | None:
        total = None
        for x in parts:
            centred = (x - whole) - rest / n
            total = centred.T @ centred if total is None else total + centred.T @ centred
        return total

    covariance = summed(rows, products, (width, width)) / n
    covariance = (covariance + covariance.T) / 2
    values, axes = leading_pairs(covariance, components)
    total = float(np.trace(covariance))
    held = values > 16 * width * EPS * total
    return Whitening(n, sums, axes[:, held], values[held], total), rows


def projected(model: Whitening) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole part and remainder of the mean, and the projection that scales each component to variance 1."""
    return *model.split(), model.axes / np.sqrt(model.values)


def identity_error(model: Whitening, rows: DataFrame) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = len(model.values)
    sent = rows.sparkSession.sparkContext.broadcast((projected(model), model.n))

    def products(parts: Iterator[np.ndarray]) -> np.ndarray | None:
        (whole, rest, projection), n = sent.value
        total = None
        for x in parts:
            w = ((x - whole) - rest / n) @ projection
            made = np.vstack([w.T @ w, w.sum(axis=0)])
            total = made if total is None else total + made
        return total

    made = summed(rows, products, (k + 1, k)) / model.n
    return float(np.abs(made[:k] - np.outer(made[k], made[k]) - np.eye(k)).max(initial=0.0))


def deviations(x: np.ndarray, whole: np.ndarray, rest: np.ndarray, n: int) -> pa.Array:
    """Exact sums of (n x - S)^2; null where the sum does not fit 64 bits."""
    off = x - whole
    rough = ((np.abs(off).astype(float) + 1) ** 2).sum(axis=1) * float(n) ** 2
    if rough.max() < BEYOND / 2:
        return pa.array(((off * n - rest) ** 2).sum(axis=1), pa.int64())
    exact = ((off.astype(object) * n - rest.astype(object)) ** 2).sum(axis=1)
    return pa.array([v if v < BEYOND else None for v in exact], pa.int64())


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, keep: Sequence[str] = ("vec_id",), vector: str = "embedding"
) -> DataFrame:
    """A row per remaining vector and component: its coordinate on it, scaled to variance 1 over the fit list.

    ``keep`` columns, ``component`` from 1 by falling eigenvalue, ``n`` fitted vectors,
    ``deviation`` (sum over dimensions of (n x - S)^2, exact; null beyond 64 bits), ``whitened``,
    ``explained`` (the share of all variance) and ``identity_error``, one value for the table.

    Rows whose vector is null, empty, of another length than most, or holds a null, non-finite or
    over-large entry (2^56 and more) are left out. Repeated rows all come back but are fitted once,
    so neither copies nor a crowd on one vector shift the result. Vectors that do not vary have no component
    and so no rows; an empty table gives an empty one. Other columns are not read; a kept column
    named like a result comes back as ``in_<name>``.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings, vector, passed(keep, RESULTS))
    more = "deviation bigint, _whitened array<double>"
    fields = vectors.schema.fields[:-1]
    fitted = fit(vectors, components)
    if fitted is None:
        model, error, kept = Whitening(0, [0], np.zeros((1, 0)), np.zeros(0), 0.0), 0.0, vectors.limit(0)
    else:
        model, rows = fitted
        error, kept = identity_error(model, rows), vectors.filter(F.size("_x") == len(model.sums))
    sent = spark.sparkContext.broadcast((projected(model), model.n) if fitted else None)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (whole, rest, projection), n = sent.value
            (x,) = matrices([batch])
            w = ((x - whole) - rest / n) @ projection
            ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            columns = [*batch.columns[:-1], deviations(x, whole, rest, n), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "deviation", "_whitened"])

    shares = F.array(*[F.lit(float(v / model.total)) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    names = [F.col(f"`{f.name}`") for f in fields]
    out = kept.mapInArrow(task, extended(fields, more)).select(*names, "deviation", F.posexplode("_whitened").alias("_at", "whitened"))
    return out.select(
        *names,
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
