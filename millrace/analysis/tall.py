"""Principal components of tall tables from a QR decomposition that is reduced in a tree.

Every task folds its rows into one triangle, a matrix as wide as there are columns; triangles are
then stacked and decomposed again, a few at a time, until one is left. Its singular values and
vectors are those of the whole table, and no product of columns is ever formed, so small
variances keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Triangles that one task stacks.
FAN_IN = 32


class Triangle(NamedTuple):
    """Rows that were folded, the columns' means, and the triangle of the centred columns."""

    rows: int
    means: np.ndarray
    centred: np.ndarray


def triangle(df: DataFrame, columns: Sequence[str], fan_in: int = FAN_IN) -> Triangle:
    """The triangle of all rows without a null in ``columns``.

    A column of ones comes first. Its row of the triangle holds the means, and what lies below
    it is the triangle of the centred columns.
    """
    width = len(columns) + 1
    schema = "part bigint, n bigint, r array<double>"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, n = np.zeros((0, width)), 0
        for batch in batches:
            block = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns]])
            r, n = np.linalg.qr(np.vstack([r, block]), mode="r"), n + batch.num_rows
        if n:
            part = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part, pa.array([n], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], names=["part", "n", "r"]
            )

    def stack(parts: pd.DataFrame) -> pd.DataFrame:
        blocks = [np.asarray(r).reshape(-1, width) for r in parts.sort_values("part")["r"]]
        r = np.linalg.qr(np.vstack(blocks), mode="r")
        return pd.DataFrame({"part": [parts["part"].iloc[0] // fan_in], "n": [parts["n"].sum()], "r": [r.ravel()]})

    whole = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).na.drop()
    level = cut(whole.mapInArrow(fold, schema))
    last = level.agg(F.max("part")).first()[0]
    if last is None:
        return Triangle(0, np.full(width - 1, np.nan), np.zeros((width - 1, width - 1)))
    while last > 0:
        level = cut(level.groupBy(F.floor(F.col("part") / fan_in).alias("_group")).applyInPandas(stack, schema))
        last //= fan_in
    top = level.first()
    r = np.zeros((width, width))
    found = np.asarray(top["r"]).reshape(-1, width)
    r[: len(found)] = found
    return Triangle(top["n"], r[0, 1:] / r[0, 0], r[1:, 1:])


def principal_components(df: DataFrame, columns: Sequence[str]) -> tuple[pd.DataFrame, np.ndarray]:
    """Variances with their share and running share, and the loadings, one column for each component.

    Of each component the first loading of at least half the size of its largest one is positive.
    Rows with a null are left out; fewer than two others are an error.
    """
    found = triangle(df, columns)
    if found.rows < 2:
        raise ValueError("components need two rows without nulls")
    _, singular, vectors = np.linalg.svd(found.centred)
    values, vectors = singular**2 / (found.rows - 1), vectors.T
    leading = (np.abs(vectors) >= 0.5 * np.abs(vectors).max(axis=0)).argmax(axis=0)
    vectors = vectors * np.sign(vectors[leading, range(len(columns))])
    share = values / values.sum() if values.sum() > 0 else np.zeros_like(values)
    table = pd.DataFrame({"component": range(1, len(columns) + 1), "variance": values, "share": share, "running": share.cumsum()})
    return table, vectors
