"""Benchmark passages in training texts, through a positional inverted index spread over shards.

The index is stored: for every shard, a bounded run of whole documents, a row for each benchmark
term with the places where it stands, and a row that tells which places belong to which document.
A search asks the stored postings how often each term occurs at all. Each window of an item then
starts from its rarest term: its places, moved by the term's offset in the window, are the
candidates, and the next rarest terms' places, moved alike, thin them out. A shard answers alone,
so no postings of a frequent term ever meet in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..session import cut, shared_folder
from .schemas import extended
from .words import words

WINDOW = 10
WORDS_PER_SHARD = 1_000_000
#: Empty places between documents; no phrase and no proximity match reaches over them.
GAP = 16
FOUND = "hits array<struct<start:int,stop:int>>, items array<string>, near_items array<string>"
CANDIDATES_PER_STEP = 1_000_000
#: Bytes of item texts whose terms and windows are sent to all tasks at once; more are searched in blocks.
BLOCK_BYTES = 64 << 20


class Windows:
    """All different windows of the benchmark and the items that hold them."""

    def __init__(self, items: Sequence[tuple[object, str | None]], window: int):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            own = words(text)
            for i in range(max(1, len(own) - window + 1) if own else 0):
                owners.setdefault(tuple(own[i : i + window]), set()).add(str(item))
        self.terms = {t: i for i, t in enumerate(sorted({t for w in owners for t in w}))}
        self.windows = [[self.terms[t] for t in w] for w in owners]
        self.items = [sorted(o) for o in owners.values()]


def blocks(benchmark: DataFrame, item: str, text: str) -> list[DataFrame]:
    """The items, dealt by their hash to blocks of about ``BLOCK_BYTES``; items without an id or text are left out."""
    rows = benchmark.filter(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item), F.col(text))
    size = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_BYTES))
    return [rows.filter(F.pmod(F.xxhash64(item, text), F.lit(n)) == i) for i in range(n)] if n > 1 else [rows]


def collected(block: DataFrame, window: int) -> Windows:
    """Windows of the items of one block, whose size :func:`blocks` bounds."""
    return Windows([tuple(r) for r in block.collect()], window)


def index(documents: DataFrame, terms: dict[bytes, int], keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Store and return the postings of ``terms`` in all whole texts; a null text has no words.

    ``shard, term, n, places`` for each term of a shard. The row with a null term has ``docs``
    (``keep`` columns, n_words) and where each begins, as places.
    """
    spark = documents.sparkSession
    chosen = documents.select(*keep, F.col(text).alias("_text"))
    shared = spark.sparkContext.broadcast(terms)  # bounded by BLOCK_BYTES

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at = shared.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            last, first = batch.num_columns - 1, 0
            found: list[list[int]] = []
            size = 0
            for row, text in enumerate(batch.column(last)):
                found.append([known.get(w, -1) for w in words(text.as_py())])
                size += len(found[-1])
                if size >= WORDS_PER_SHARD or row == batch.num_rows - 1:
                    yield from shard(at, batch.slice(first, row + 1 - first), found)
                    at, first, found, size = at + 1, row + 1, [], 0

    def shard(number: int, batch: pa.RecordBatch, found: list[list[int]]) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(f) for f in found], np.int64)
        starts = np.cumsum(lengths + GAP) - lengths
        terms = np.concatenate([np.array(f, np.int32) for f in found])
        places = (np.arange(len(terms)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)).astype("<i4")
        places, terms = places[terms >= 0], terms[terms >= 0]
        order = np.argsort(terms, kind="stable")
        places, terms = places[order], terms[order]
        own, first, n = np.unique(terms, return_index=True, return_counts=True)
        kept = batch.select(list(range(batch.num_columns - 1)))
        docs = pa.StructArray.from_arrays([*kept.columns, pa.array(lengths)], names=[*kept.schema.names, "n_words"])
        listed = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number] * (len(own) + 1), pa.int64()),
                pa.array([None, *own.tolist()], pa.int32()),
                pa.array([len(docs), *n.tolist()], pa.int64()),
                pa.array([starts.astype("<i4").tobytes(), *[places[i : i + k].tobytes() for i, k in zip(first, n)]], pa.binary()),
                pa.concat_arrays([listed, pa.nulls(len(own), listed.type)]),
            ],
            names=["shard", "term", "n", "places", "docs"],
        )

    folder = f"{shared_folder(spark)}/postings-{uuid.uuid4().hex}"
    docs = ArrayType(extended(chosen.schema.fields[:-1], "n_words bigint"))
    schema = extended([], "shard bigint, term int, n bigint, places binary").add("docs", docs)
    chosen.mapInArrow(post, schema).write.parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def search(postings: DataFrame, benchmark: Windows, near: int = 2, placed: bool = False) -> DataFrame:
    """Every indexed document's columns with ``hits``, ``items`` and ``near_items``.

    ``hits`` are the stretches of words (start, stop; stop exclusive) covered by occurring
    windows, ``items`` the ids, as sorted text, of items with such windows. ``near_items`` are
    the items with a window whose words all stand within ``near`` words of their places around
    its rarest word, without being among ``items``. ``placed`` adds ``_shard`` and ``_row``, by
    which a document is known again in another index of the same stored documents.
    """
    if not 0 <= near <= GAP:
        raise ValueError(f"near must lie between 0 and {GAP}")
    spark = postings.sparkSession
    # at most one count for each benchmark term
    counts = dict(postings.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n")).collect())
    possible = [n for n, w in enumerate(benchmark.windows) if all(t in counts for t in w)]
    longest = max((len(benchmark.windows[n]) for n in possible), default=1)
    sizes = np.array([len(benchmark.windows[n]) for n in possible], np.int64)
    # per window its terms and their offsets, rarest first; -2 fills up shorter windows
    offsets = np.zeros((len(possible), longest), np.int64)
    terms = np.full((len(possible), longest), -2, np.int64)
    for row, number in enumerate(possible):
        own = benchmark.windows[number]
        by_rarity = sorted(range(len(own)), key=lambda i: (counts[own[i]], i))
        offsets[row, : len(own)], terms[row, : len(own)] = by_rarity, [own[i] for i in by_rarity]
    owners = [benchmark.items[n] for n in possible]
    shared = spark.sparkContext.broadcast((sizes, offsets, terms, owners))  # bounded by BLOCK_BYTES
    docs = postings.schema["docs"].dataType.elementType
    names = docs.names

    def occurrences(tokens: np.ndarray, lists: dict[int, np.ndarray], slack: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and starts of the windows whose terms all stand within ``slack`` of their places."""
        sizes, offsets, terms, _ = shared.value
        kept_windows, kept_starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        rows = iter([w for w in range(len(sizes)) if terms[w, 0] in lists])
        while True:
            chosen, starts, size = [], [], 0
            for w in rows:
                own = lists[terms[w, 0]]
                chosen.append(np.full(len(own), w))
                starts.append(own - offsets[w, 0])
                size += len(own)
                if size >= CANDIDATES_PER_STEP:
                    break
            if not size:
                return np.concatenate(kept_windows), np.concatenate(kept_starts)
            window, start = np.concatenate(chosen), np.concatenate(starts)
            for k in range(1, terms.shape[1]):
                wanted, at = terms[window, k], start + offsets[window, k]
                met = wanted == -2
                for shift in range(-slack, slack + 1):
                    met |= tokens[np.clip(at + shift, 0, len(tokens) - 1)] == wanted
                window, start = window[met], start[met]
            kept_windows.append(window)
            kept_starts.append(start)

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = shared.value[0]
        heads = rows["term"].isna()
        head = rows[heads].iloc[0]
        starts = np.frombuffer(head["places"], "<i4").astype(np.int64)
        table = pd.DataFrame(list(head["docs"]), columns=names)
        lengths = table["n_words"].to_numpy(np.int64)
        own = rows[~heads]
        lists = {int(t): np.frombuffer(p, "<i4") for t, p in zip(own["term"], own["places"])}
        tokens = np.full(int(starts[-1] + lengths[-1]) + GAP, -1, np.int32)
        for term, places in lists.items():
            tokens[places] = term
        window, start = occurrences(tokens, lists, 0)
        border = np.zeros(len(tokens) + 1, np.int64)
        np.add.at(border, start, 1)
        np.add.at(border, start + sizes[window], -1)
        covered = (np.cumsum(border) > 0).astype(np.int8)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]])))
        hits: list[list[dict]] = [[] for _ in lengths]
        for first, stop in zip(edges[::2], edges[1::2]):
            doc = int(np.searchsorted(starts, first, side="right")) - 1
            hits[doc].append({"start": int(first - starts[doc]), "stop": int(stop - starts[doc])})
        exact = held(window, start, starts, len(lengths))
        close = held(*occurrences(tokens, lists, near), starts, len(lengths)) if near else exact
        table["hits"] = hits
        table["items"] = [sorted(e) for e in exact]
        table["near_items"] = [sorted(c - e) for c, e in zip(close, exact)]
        if placed:
            table["_shard"], table["_row"] = head["shard"], range(len(table))
        return table

    def held(window: np.ndarray, start: np.ndarray, starts: np.ndarray, n: int) -> list[set[str]]:
        """Per document the items of its windows; the rarest word, always in place, tells the document."""
        _, offsets, _, owners = shared.value
        found: list[set[str]] = [set() for _ in range(n)]
        docs = np.searchsorted(starts, start + offsets[window, 0], side="right") - 1
        for w, d in set(zip(window.tolist(), docs.tolist())):
            found[d].update(owners[w])
        return found

    found = FOUND + (", _shard bigint, _row bigint" if placed else "")
    return postings.groupBy("shard").applyInPandas(answer, extended(docs.fields, found))


def united(parts: Sequence[DataFrame]) -> DataFrame:
    """Answers of several blocks of items about the same stored documents as one."""
    place = ["_shard", "_row"]
    some = [p.select(*place, "hits", "items", "near_items").filter("size(hits) + size(near_items) > 0") for p in parts]
    all_parts = some[0]
    for p in some[1:]:
        all_parts = all_parts.unionByName(p)
    lists = all_parts.groupBy(*place).agg(*[F.flatten(F.collect_list(c)).alias(f"_{c}") for c in ("hits", "items", "near_items")])
    # stretches that overlap or touch become one: a stretch opens where nothing before reaches it
    pieces = lists.select(*place, F.explode("_hits").alias("h")).select(*place, "h.start", "h.stop")
    before = Window.partitionBy(*place).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    opened = pieces.withColumn("_opens", F.coalesce(F.max("stop").over(before) < F.col("start"), F.lit(True)).cast("int"))
    numbered = opened.withColumn("_n", F.sum("_opens").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy(*place, "_n").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    hits = whole.groupBy(*place).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("_merged"))
    items = F.array_sort(F.array_distinct("_items"))
    merged = lists.join(hits, place, "left").select(
        *place, "_merged", items.alias("_exact"), F.array_sort(F.array_distinct(F.array_except("_near_items", "_items"))).alias("_close")
    )
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    return (
        parts[0].drop("hits", "items", "near_items").join(merged, place, "left")
        .withColumns({
            "hits": none(F.col("_merged"), "array<struct<start:int,stop:int>>"),
            "items": none(F.col("_exact"), "array<string>"), "near_items": none(F.col("_close"), "array<string>"),
        })
        .drop(*place, "_merged", "_exact", "_close")
    )


def scan(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    near: int = 2,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    item: str = "item_id",
) -> DataFrame:
    """Index all documents for the benchmark's terms and search every window of every item.

    A benchmark of many bytes is searched in blocks of items, and what the blocks find is united.
    Items of fewer words than ``window`` are one window; items without words have none. Repeated
    documents are searched as often as they occur; without items or documents nothing is found.
    """
    parts = blocks(benchmark, item, text)
    if len(parts) == 1:
        wanted = collected(parts[0], window)
        return search(index(documents, wanted.terms, keep, text), wanted, near)
    # stored once, so that every block meets the same shards
    stored = cut(documents.select(*keep, F.col(text)))
    answers = []
    for part in parts:
        wanted = collected(part, window)
        answers.append(cut(search(index(stored, wanted.terms, keep, text), wanted, near, placed=True)))
    return united(answers)
