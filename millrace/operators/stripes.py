"""All-pairs work where each task keeps some rows and reads all the others as a stream.

A group's rows are dealt to stripes. A task holds the rows of one stripe and whatever it has to
remember of their best partners; all rows of the group then pass by it once, sorted, a block at
a time. It ends with the complete answer for its rows, so no partial answers are shuffled, and a
row is sent once per stripe and once as one of its own, as one record that holds its entries in
arrays. The number of stripes follows what a task has to remember, not the number of blocks.

What is sent grows with the square of the rows. So beyond a bounded number of bytes the rows are
stored and the stripes take turns: those of a wave are sent, their answers stored, and the shuffle
files removed before the next wave begins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import lean_cut, shuffle_width
from .joins import join_groups

ROWS_PER_BLOCK = 512
ENTRIES_PER_BLOCK = 500_000
#: Rows of its own that a task holds at most, and numbers that it remembers about them.
ROWS_PER_STRIPE = 2048
REMEMBERED = 12_000_000
GATHERED = 2_000_000
#: Partitions for each of the session's: stripes are few and cost unequally, so a core that is done finds another one to do.
PIECES = 4
#: Bytes of numbers that are sent at a time; more of them go in several waves.
SENT = 4_000_000_000
#: Rows of a result that leave a task at a time.
ROWS_OUT = 10_000


class Work(Protocol):
    """What a task does for one stripe."""

    def start(self, own: pd.DataFrame) -> None: ...

    def step(self, block: pd.DataFrame) -> None: ...

    def finish(self) -> pd.DataFrame: ...


def stripe_counts(
    entries: DataFrame, by: Sequence[str], row: str, remembered: Column, rows_per_stripe: int = ROWS_PER_STRIPE, budget: int = REMEMBERED
) -> DataFrame:
    """``by``, ``_stripes`` and ``_entries``: as many stripes as rows and memory ask for, and one for each core if the group is large.

    ``remembered`` is an aggregate over a group's entries, the numbers that all its rows together make a task remember.
    """
    sizes = entries.groupBy(*by).agg(F.approx_count_distinct(row).alias("_rows"), remembered.cast("double").alias("_numbers"), F.count("*").alias("_entries"))
    # every stripe gets all rows, so idle cores are the only reason for more of them
    cores = min(shuffle_width(entries), entries.sparkSession.sparkContext.defaultParallelism)
    busy = F.least(F.ceil(F.col("_rows") / ROWS_PER_BLOCK), F.lit(cores))
    wanted = F.greatest(F.lit(1), busy, F.ceil(F.col("_rows") / rows_per_stripe), F.ceil(F.col("_numbers") / budget))
    return sizes.select(*by, F.least(wanted, F.greatest(F.col("_rows"), F.lit(1))).cast("int").alias("_stripes"), "_entries")


def placed(
    entries: DataFrame, stripes: DataFrame, by: Sequence[str], row: str, asked: str | None = None, within: DataFrame | None = None,
    wave: int = 0, waves: int = 1,
) -> DataFrame:
    """Every entry once for each stripe of its group, and once more, marked ``_own``, in the stripe of its row.

    ``asked`` names a flag; a row none of whose entries has it is nobody's own, and a stripe
    without own rows gets nothing. Of several ``waves`` only the stripes of one are filled.
    """
    offset = F.pmod(F.xxhash64(*by), F.lit(waves))
    now = lambda places: places if waves == 1 else F.filter(places, lambda p: (p["_stripe"] + offset) % waves == wave)
    home = F.pmod(F.xxhash64(row), F.col("_stripes")).cast("int")
    everywhere = F.transform(F.sequence(F.lit(0), F.col("_stripes") - 1), lambda s: F.struct(s.alias("_stripe"), F.lit(False).alias("_own")))
    once = F.array(F.struct(F.col("_home").alias("_stripe"), F.lit(True).alias("_own")))
    if asked is None:
        spread = join_groups(entries, stripes, by, within=within).withColumn("_home", home)
        return spread.withColumn("_at", F.explode(now(F.concat(everywhere, once)))).select(*entries.columns, "_at.*")
    rows = entries.filter(asked).select(*by, row).distinct()
    open_stripes = join_groups(rows, stripes, by, within=within).groupBy(*by).agg(F.collect_set(home).alias("_open"))
    known = join_groups(entries, stripes.join(open_stripes, list(by)), by, within=within).withColumn("_home", home)
    marked = known.join(rows.withColumn("_asked", F.lit(True)), [*by, row], "left")
    places = F.concat(
        F.transform("_open", lambda s: F.struct(s.alias("_stripe"), F.lit(False).alias("_own"))),
        F.when(F.col("_asked"), once).otherwise(F.filter(once, lambda x: F.lit(False))),
    )
    return marked.withColumn("_at", F.explode(now(places))).select(*entries.columns, "_at.*")


def for_each_stripe(
    entries: DataFrame,
    by: Sequence[str],
    row: str,
    work: Callable[[], Work],
    schema: str,
    stripes: DataFrame,
    asked: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
    entries_per_block: int = ENTRIES_PER_BLOCK,
    within: DataFrame | None = None,
    sent_bytes: int | None = None,
) -> DataFrame:
    """Run ``work`` for every stripe; ``by`` columns (never null) come before ``schema``.

    ``entries`` is long form, one record per non-empty cell; rows pass by in ascending order of ``row``.
    ``within`` is the stored table that they come from, if there is one. ``sent_bytes`` go to stripes at a time.
    """
    by, sent_bytes = list(by), SENT if sent_bytes is None else sent_bytes
    cells = [c for c in entries.columns if c not in (*by, row)]
    asks = [F.max(asked).alias("_wants")] if asked else []
    packed = entries.groupBy(*by, row).agg(F.collect_list(F.struct(*cells)).alias("_cells"), *asks)
    packed = packed.select(*by, row, *[F.col(f"_cells.`{c}`").alias(c) for c in cells], *(["_wants"] if asked else []))
    stripes = lean_cut(stripes)
    sent = stripes.agg(F.sum(F.col("_stripes") * F.col("_entries"))).first()[0] or 0 if "_entries" in stripes.columns else 0
    waves = max(1, -(-sent * 8 * len(cells) // sent_bytes))

    def dealt(rows: DataFrame, wave: int) -> DataFrame:
        spread = placed(rows, stripes, by, row, "_wants" if asked else None, within, wave, waves).drop("_wants")
        # the stage is bound by arithmetic, so keep its width even where the bytes are few
        return spread.repartition(PIECES * shuffle_width(entries), *by, "_stripe").sortWithinPartitions(*by, "_stripe", F.col("_own").desc(), row)

    keys = [*by, "_stripe"]
    order = [c for c in entries.columns if c not in by]

    def unpacked(batch: pa.RecordBatch) -> pd.DataFrame:
        """Entries in long form again."""
        columns = {c: batch.column(c).flatten() for c in cells}
        sizes = pc.list_value_length(batch.column(cells[0])).to_numpy()
        columns[row] = batch.column(row).take(pa.array(np.repeat(np.arange(len(batch)), sizes)))
        return pa.table({c: columns[c] for c in order}).to_pandas()

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
        """Stretches of one stripe and one side."""
        for batch in batches:
            if len(batch):
                marks = batch.select([*keys, "_own"]).to_pandas()
                changes = (marks.shift() != marks).any(axis=1).to_numpy()
                changes[0] = True
                starts = np.flatnonzero(changes).tolist()
                for start, stop in zip(starts, [*starts[1:], len(marks)]):
                    *key, own = marks.iloc[start].tolist()
                    yield tuple(key), bool(own), batch.slice(start, stop - start)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, held, at, started = None, [], [], None, False

        def blocks(last: bool) -> Iterator[pd.DataFrame]:
            """Rows that wait, in blocks; what does not fill one waits on unless the stripe is over."""
            nonlocal held
            together = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ends = np.cumsum(pc.list_value_length(together.column(cells[0])).to_numpy())
            start = 0
            while start < len(ends):
                before = ends[start - 1] if start else 0
                fits = int(np.searchsorted(ends, before + entries_per_block, side="right"))
                stop = min(max(fits, start + 1), start + rows_per_block, len(ends))
                if stop == len(ends) and not last:
                    break
                yield unpacked(together.slice(start, stop - start))
                start = stop
            held = [together.slice(start)] if start < len(ends) else []

        def over() -> Iterator[pa.RecordBatch]:
            if at is not None and started:
                for block in blocks(True) if held else ():
                    at.step(block)
                found = at.finish()
                if len(found):
                    for position, name in enumerate(by):
                        found.insert(position, name, key[position])
                    for start in range(0, len(found), ROWS_OUT):
                        yield pa.RecordBatch.from_pandas(found.iloc[start : start + ROWS_OUT], out, preserve_index=False)

        for now, mine, part in parts(batches):
            if now != key:
                yield from over()
                key, own, held, at, started = now, [], [], work(), False
            if mine:
                own.append(unpacked(part))
                continue
            if own:
                at.start(pd.concat(own, ignore_index=True))
                own, started = [], True
            if started:
                held.append(part)
                if sum(map(len, held)) > rows_per_block or sum(len(h.column(cells[0]).flatten()) for h in held) >= entries_per_block:
                    for block in blocks(False):
                        at.step(block)
        yield from over()

    types = {f.name: f for f in entries.schema.fields}
    result = StructType([*(types[c] for c in by), *StructType.fromDDL(schema).fields])
    out = to_arrow_schema(result)
    if waves == 1:
        return dealt(packed, 0).mapInArrow(task, result)
    stored = lean_cut(packed)
    return reduce(DataFrame.unionByName, [lean_cut(dealt(stored, wave).mapInArrow(task, result)) for wave in range(waves)])


class Best:
    """The ``k`` largest positive scores of each line, met in ascending order of partner; ties go to the earlier partner.

    ``more`` numbers go along with each score. Places keep the order in which partners came.
    """

    def __init__(self, k: int, more: int = 1):
        self.k = k
        self.scores = np.zeros((0, k))
        self.more = [np.zeros((0, k)) for _ in range(more)]

    def grow(self, lines: int) -> None:
        self.scores = np.concatenate([self.scores, np.zeros((lines, self.k))])
        self.more = [np.concatenate([m, np.zeros((lines, self.k))]) for m in self.more]

    def meet(self, lines: np.ndarray, scores: np.ndarray, more: Sequence[np.ndarray]) -> None:
        """Offer each line a row of scores, in which 0 is no partner."""
        better = scores.max(axis=1, initial=0.0) > self.scores[lines].min(axis=1)
        if not better.any():
            return
        lines, scores = lines[better], scores[better]
        scores = np.concatenate([self.scores[lines], np.maximum(scores, 0.0)], axis=1)
        more = [np.concatenate([own[lines], new[better]], axis=1) for own, new in zip(self.more, more)]
        least = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k, None]
        above, equal = scores > least, scores == least
        room = self.k - above.sum(axis=1, keepdims=True)
        rows, columns = np.nonzero(above | (equal & (np.cumsum(equal, axis=1) <= room)))
        shape = (len(lines), self.k)
        self.scores[lines] = scores[rows, columns].reshape(shape)
        for own, new in zip(self.more, more):
            own[lines] = new[rows, columns].reshape(shape)

    def offer(self, lines: np.ndarray, scores: np.ndarray, more: Sequence[np.ndarray]) -> np.ndarray:
        """Offer single scores, in order of line and, within a line, of partner; the lines that were offered something."""
        starts = np.flatnonzero(np.concatenate([[True], lines[1:] != lines[:-1]])) if len(lines) else np.empty(0, int)
        counts = np.diff(np.append(starts, len(lines)))
        # lines with about as many offers go together
        widths = 1 << np.ceil(np.log2(np.maximum(counts, 1))).astype(int)
        for width in np.unique(widths):
            own = np.flatnonzero(widths == width)
            step = max(1, GATHERED // int(width + self.k))
            for some in (own[at : at + step] for at in range(0, len(own), step)):
                at = np.minimum(starts[some, None] + np.arange(width), len(lines) - 1)
                score = np.where(np.arange(width) < counts[some, None], scores[at], 0.0)
                self.meet(lines[starts[some]], score, [m[at] for m in more])
        return lines[starts]
