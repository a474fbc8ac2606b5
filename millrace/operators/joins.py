"""Joining large rows to one value per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, known_bytes

BROADCAST_BYTES = 32 << 20


def text_bytes(df: DataFrame) -> int:
    """Bytes of all rows written as JSON, an upper guide to what a broadcast of them holds."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0))).first()[0]


def sized(groups: DataFrame, limit: int = BROADCAST_BYTES, within: DataFrame | None = None) -> DataFrame:
    """``groups``, computed and measured; marked for broadcast if they are small.

    ``within`` is a table that :func:`cut` has stored and that has at least a row for each group:
    if half the limit holds all of it, the groups need neither be stored nor measured.
    """
    bound = known_bytes(within) if within is not None else None
    if bound is not None and bound <= limit // 2:
        return F.broadcast(groups)
    groups = cut(groups)
    size = known_bytes(groups)
    return F.broadcast(groups) if (text_bytes(groups) if size is None else size) <= limit else groups


def join_groups(
    df: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    limit: int = BROADCAST_BYTES,
    how: str = "inner",
    within: DataFrame | None = None,
) -> DataFrame:
    """Join of ``df`` with one row per ``keys``.

    The groups are computed first and measured, or known to be small as they come from a small
    table (``within``). Up to ``limit`` bytes of them are broadcast, so the large side is not
    shuffled onto a key that may hold a third of it. Larger ones are joined by key in the ordinary
    way, where adaptive execution splits skewed keys.
    """
    return df.join(sized(groups, limit, within), list(keys), how)
