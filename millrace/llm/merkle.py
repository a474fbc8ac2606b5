"""Merkle manifest of a table by time-forward processing.

Every node of the trees has a label, its level and its place. A node is made when its label comes
up in a priority queue that holds the digests its children have sent; it sends its own on to its
parent. Then the queue runs backwards: a node sends each child the proof it got itself, headed by
the child's sibling. The queue is external: within a block of consecutive nodes it is a heap in
one task, from block to block it is rows that Spark sorts by label, tier by tier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_groups
from ..operators.ordering import global_row_number
from ..session import cut
from .schemas import extended, passed

#: A block holds two to the power of this many consecutive nodes of a tier.
LEVELS = 10
DIGEST = 64
LEFT, RIGHT, ALONE = "l", "r", "-"
RESULTS = ("leaf", "subroot", "root", "siblings", "sides")


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(columns: Iterable[Column]) -> Column:
    """Digest of a row: each column as its length in bytes, a colon and its text; a null as a dash."""
    framed = []
    for c in columns:
        words = c.cast("string")
        framed.append(F.coalesce(F.concat(F.octet_length(words).cast("string"), F.lit(":"), words), F.lit("-")))
    return hashed(*framed)


def height(nodes: int) -> int:
    """Levels from so many nodes up to a single one."""
    return max(0, nodes - 1).bit_length()


def digest_of(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def forward(places: Sequence[int], digests: Sequence[str], levels: int) -> dict[tuple[int, int], str]:
    """Digests of all nodes above consecutive ones, by label, up to ``levels`` above them."""
    made = {(0, p): d for p, d in zip(places, digests)}
    queue = [(1, p >> 1, p, d) for p, d in sorted(zip(places, digests))]  # messages by receiver, then sender
    while queue and queue[0][0] <= levels:
        label, parts = queue[0][:2], []
        while queue and queue[0][:2] == label:
            parts.append(heappop(queue)[3])
        made[label] = digest = digest_of(parts)
        heappush(queue, (label[0] + 1, label[1] >> 1, label[1], digest))
    return made


def backward(made: dict[tuple[int, int], str], top: tuple[int, int], siblings: str, sides: str) -> dict[int, tuple[str, str]]:
    """Proofs of the nodes at level 0, by place: siblings from the node's own up to the root, and on which side each stands."""
    proofs = {}
    queue = [(-top[0], top[1], siblings, sides)]
    while queue:
        level, place, siblings, sides = heappop(queue)
        if not level:
            proofs[place] = siblings, sides
            continue
        left, right = (made.get((-level - 1, 2 * place + side)) for side in (0, 1))
        if right is None:
            heappush(queue, (level + 1, 2 * place, siblings, ALONE + sides))
        else:
            heappush(queue, (level + 1, 2 * place, right + siblings, RIGHT + sides))
            heappush(queue, (level + 1, 2 * place + 1, left + siblings, LEFT + sides))
    return proofs


class Trees(NamedTuple):
    """Tiers of nodes (``tree, place, total, digest``), each a block's height above the one before; the last holds the tops."""

    tiers: list[DataFrame]
    levels: int

    @property
    def tops(self) -> DataFrame:
        return self.tiers[-1]


def grow(nodes: DataFrame, levels: int = LEVELS) -> Trees:
    """Trees over ``tree, place, digest``; places count from 0 in each tree.

    Each tier is a shuffle of digests by block; a tree with a third of all leaves is many blocks.
    Every tier is checkpointed, and each is two to the power of ``levels`` times smaller than the one before.
    """

    def climb(table: pa.Table) -> pa.Table:
        total = table["total"][0].as_py()
        up = min(levels, height(total))
        place = table["place"][0].as_py() >> up
        made = forward(table["place"].to_pylist(), table["digest"].to_pylist(), up)
        return pa.table(
            {"tree": table["tree"].slice(0, 1), "place": [place], "total": [((total - 1) >> up) + 1], "digest": [made[up, place]]}
        )

    nodes = cut(nodes)
    totals = nodes.groupBy("tree").agg(F.count("*").alias("total"))
    tiers = [join_groups(nodes, totals, ["tree"])]
    while (tiers[-1].agg(F.max("total")).first()[0] or 0) > 1:
        blocks = tiers[-1].select("tree", "place", "total", "digest").groupBy("tree", F.shiftright("place", levels).alias("block"))
        tiers.append(cut(blocks.applyInArrow(climb, "tree string, place bigint, total bigint, digest string")))
    return Trees(tiers, levels)


def descent(levels: int, extra: Sequence[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The task that hands a block's proof, and the ``extra`` columns beside it, down to its nodes."""

    def descend(nodes: pa.Table, above: pa.Table) -> pa.Table:
        places = nodes["place"].to_pylist()
        up = min(levels, height(nodes["total"][0].as_py()))
        made = forward(places, nodes["digest"].to_pylist(), up)
        found = backward(made, (up, places[0] >> up), above["siblings"][0].as_py(), above["sides"][0].as_py())
        columns = {c: pa.array([above[c][0].as_py()] * len(places), above.schema.field(c).type) for c in extra}
        columns |= {c: pa.array([found[p][i] for p in places], pa.string()) for i, c in enumerate(("siblings", "sides"))}
        for name, values in columns.items():
            nodes = nodes.append_column(name, values)
        return nodes

    return descend


def prove(trees: Trees, proofs: DataFrame) -> DataFrame:
    """The first tier with ``siblings`` and ``sides``, and whatever else ``proofs`` says of a tree.

    ``proofs`` has ``tree, place, siblings, sides`` of the tops. A block's proof is sent once, to the block.
    """
    handed = ("tree", "place", "siblings", "sides")
    extra = [c for c in proofs.columns if c not in handed]
    for tier in reversed(trees.tiers[:-1]):
        more = extended([*tier.schema.fields, *(proofs.schema[c] for c in extra)], "siblings string, sides string")
        nodes = tier.groupBy("tree", F.shiftright("place", trees.levels).alias("block"))
        above = proofs.select(*handed, *extra).groupBy("tree", F.col("place").alias("block"))
        proofs = nodes.cogroup(above).applyInArrow(descent(trees.levels, extra), more)
    if len(trees.tiers) == 1:
        return trees.tiers[0].join(proofs, ["tree", "place"])
    return proofs


def folded(digest: Column, siblings: Column, sides: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    steps = F.when(F.length(sides) > 0, F.sequence(F.lit(1), F.length(sides))).otherwise(F.array().cast("array<int>"))

    def step(at: Column, i: Column) -> Column:
        side = F.substring(sides, i, F.lit(1))
        sibling = F.substring(siblings, at["used"] * DIGEST + 1, F.lit(DIGEST))
        digest = at["digest"]
        made = F.when(side == ALONE, digest).when(side == LEFT, F.concat(sibling, digest)).otherwise(F.concat(digest, sibling))
        return F.struct(F.sha2(made, 256).alias("digest"), (at["used"] + F.when(side == ALONE, 0).otherwise(1)).alias("used"))

    start = F.struct(digest.alias("digest"), F.lit(0).alias("used"))
    return F.aggregate(steps, start, step, lambda at: at["digest"])


def manifest(
    rows: DataFrame, columns: Sequence[str], group: str, order: str, keep: Sequence[str] = (), levels: int = LEVELS
) -> DataFrame:
    """``keep`` columns, ``leaf``, the ``subroot`` of its group, the ``root``, and its proof (``siblings``, ``sides``).

    Every row is a leaf, the digest of its ``columns`` in the order given. Leaves of a group ascend
    by ``order`` (null first; equal ones by digest, so that repeated rows and ties give one tree),
    pairs become nodes, an odd last one becomes a node by itself, until one is left. Groups, null
    first and then by their bytes, are joined to the root the same way. ``siblings`` are the digests
    beside the way up, put together; ``sides`` has a letter per level: sibling on the left, on the
    right, or none. Texts are hashed where they lie and never moved. An empty table has no rows and
    no root. A kept column named like a result comes back as ``in_<name>``.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    kept = F.struct(F.lit(0).alias("_"), *passed(keep, RESULTS))
    leaves = rows.select(
        tree.alias("tree"), F.col(f"`{order}`").alias("by"), leaf_digest([F.col(f"`{c}`") for c in columns]).alias("digest"), kept.alias("kept")
    )
    placed = global_row_number(cut(leaves), ["by", "digest"], ["tree"], "place").select(
        "tree", (F.col("place") - 1).alias("place"), "digest", "kept"
    )
    groups = grow(placed, levels)
    subroots = groups.tops.select(F.col("tree").alias("own"), F.col("digest"))
    listed = global_row_number(subroots, ["own"], name="place").select(
        F.lit("").alias("tree"), (F.col("place") - 1).alias("place"), "digest", "own"
    )
    whole = grow(listed, levels)
    start = whole.tops.select("tree", "place", F.lit("").alias("siblings"), F.lit("").alias("sides"), F.col("digest").alias("root"))
    above = prove(whole, start).select(
        F.col("own").alias("tree"), F.lit(0).cast("bigint").alias("place"), "siblings", "sides", F.col("digest").alias("subroot"), "root"
    )
    found = prove(groups, above)
    names = [f.name for f in kept_fields(found)]
    return found.select(*[F.col(f"kept.`{c}`") for c in names], F.col("digest").alias("leaf"), "subroot", "root", "siblings", "sides")


def kept_fields(found: DataFrame) -> list:
    return [f for f in found.schema["kept"].dataType.fields if f.name != "_"]
