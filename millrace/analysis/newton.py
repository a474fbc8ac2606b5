"""Logistic regression by Newton steps over sparse rows, to convergence.

A pass over the stored rows sums loss, gradient and, while the features are few, second
derivatives inside the tasks. With many features the Newton direction comes from conjugate
gradients, whose products with the second derivatives are passes of their own. Only vectors
as long as the features reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread

#: Up to so many features the matrix of second derivatives is summed whole.
WHOLE_MATRIX = 256


class Logistic(NamedTuple):
    weights: np.ndarray
    intercept: float
    steps: int
    rows: int


def sparse(df: DataFrame, features: str = "features") -> DataFrame:
    """An array column as ``places, cells``: the places from 0 that are neither null nor zero, and what is there."""
    at = F.filter(F.sequence(F.lit(0), F.size(features) - 1), lambda i: F.coalesce(F.get(features, i), F.lit(0.0)) != 0)
    return df.withColumn("places", F.when(F.size(features) > 0, at).otherwise(F.array().cast("array<int>"))).withColumn(
        "cells", F.transform("places", lambda i: F.get(features, i).cast("double"))
    )


def _summed(rows: DataFrame, length: int, part: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``part(row, place, cell, label)``, vectors of ``length``; one is sent by each task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            places, cells, labels = (batch.column(i) for i in range(3))
            sizes = np.diff(places.offsets.to_numpy())
            total += part(
                np.repeat(np.arange(len(sizes)), sizes),
                places.flatten().to_numpy(),
                cells.flatten().to_numpy(),
                labels.to_numpy(zero_copy_only=False),
            )
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "value"])

    found = np.zeros(length)
    for r in rows.mapInArrow(add, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        found[r["at"]] = r["value"]
    return found


def fit(
    df: DataFrame, size: int, label: str = "label", penalty: float = 1.0,
    tolerance: float = 1e-9, most: int = 50, whole_matrix: int = WHOLE_MATRIX,
) -> Logistic:
    """Weights that minimise the summed log loss of the 0/1 ``label`` plus half the penalty times their squares.

    Rows have ``places, cells`` (see :func:`sparse`), places below ``size``. The intercept is not
    penalised. The fit ends when no entry of the gradient exceeds ``tolerance`` times the rows;
    more than ``most`` steps raise. Rows with a null label are left out, and a label of one value only is an error.
    """
    rows = spread(cut(df.filter(F.col(label).isNotNull()).select("places", "cells", F.col(label).cast("double").alias("y"))), stored=True)
    count, ones = rows.agg(F.count("*"), F.sum("y")).first()
    if not count or not 0 < ones < count:
        raise ValueError("a fit needs rows of both labels")
    wide = size + 1
    ridge = np.full(wide, float(penalty))
    ridge[size] = 0.0
    dense = wide <= whole_matrix

    def margins(w, row, place, cell, n):
        return np.bincount(row, cell * w[place], minlength=n)[:n] + w[size]

    def spreads(w, row, place, cell, n):
        p = 1 / (1 + np.exp(-np.clip(margins(w, row, place, cell, n), -500, 500)))
        return p, p * (1 - p)

    def back(values, row, place, cell):
        """The rows' features times ``values``, with the sum of ``values`` for the intercept."""
        return np.append(np.bincount(place, cell * values[row], minlength=size)[:size], values.sum())

    def slope(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray | None]:
        def part(row, place, cell, y):
            m = margins(w, row, place, cell, len(y))
            p, s = spreads(w, row, place, cell, len(y))
            parts = [[np.logaddexp(0, m).sum() - (y * m).sum()], back(p - y, row, place, cell)]
            if dense:
                x = np.zeros((len(y), wide))
                np.add.at(x, (row, place), cell)
                x[:, size] = 1
                parts.append((x.T @ (s[:, None] * x)).ravel())
            return np.concatenate(parts)

        found = _summed(rows, 1 + wide + (wide * wide if dense else 0), part)
        loss, gradient = found[0] + 0.5 * (ridge * w * w).sum(), found[1 : 1 + wide] + ridge * w
        return loss, gradient, found[1 + wide :].reshape(wide, wide) + np.diag(ridge) if dense else None

    def curved(w: np.ndarray, direction: np.ndarray) -> np.ndarray:
        def part(row, place, cell, y):
            along = margins(direction, row, place, cell, len(y))
            return back(spreads(w, row, place, cell, len(y))[1] * along, row, place, cell)

        return _summed(rows, wide, part) + ridge * direction

    def conjugate(w: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """A direction whose residual is small beside the gradient, the more so the smaller that is."""
        x, r = np.zeros(wide), -gradient
        p, left = r, r @ r
        enough = min(0.25, np.sqrt(np.abs(gradient).max() / count)) ** 2 * left
        for _ in range(2 * wide):
            if left <= enough:
                break
            ap = curved(w, p)
            step = left / (p @ ap)
            x, r = x + step * p, r - step * ap
            left, before = r @ r, left
            p = r + left / before * p
        return x

    w = np.zeros(wide)
    loss, gradient, matrix = slope(w)
    for step in range(most):
        if np.abs(gradient).max() <= tolerance * count:
            return Logistic(w[:size], float(w[size]), step, count)
        direction = -np.linalg.solve(matrix, gradient) if dense else conjugate(w, gradient)
        share = 1.0
        while True:
            tried = slope(w + share * direction)
            # rounding may hide the last gains
            if tried[0] <= loss + 1e-4 * share * (gradient @ direction) + 1e-12 * abs(loss) or share < 1e-6:
                break
            share /= 2
        w, (loss, gradient, matrix) = w + share * direction, tried
    raise ValueError(f"no convergence within {most} steps")
