"""Near-duplicate texts by Order MinHash, verified by banded alignment.

A sketch has several elements. For each, every run of five words, labelled with its occurrence so
that repeats differ, is hashed anew; the few smallest are taken and hashed together in the order
in which they stand in the text. Two texts share an element only if they share these runs in this
order, which follows edit similarity more closely than a set does. Texts with an equal element
form a bucket. Inside a bucket the shared runs of all pairs are counted in one matrix product,
and pairs with enough of them are aligned word by word in a band. Only links that join two parts
of a bucket are returned. A class is what links connect.

Exact copies meet by the digest of their text before all this. At first all members of a larger bucket
are held against one of them, its hub. A group of near copies fills many buckets, most of them with the
same hub, so that a text meets it once instead of once for each bucket; only buckets that are still in several
parts are then worked off. There each member outside the largest part is held against all others. Large
buckets are cut into chunks; a block of leaders goes to each, and further blocks follow as long as
parts stay apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, shared_folder
from .components import components
from .words import Hashes

RUN, SIMILARITY = 5, 0.8
#: Elements of a sketch and runs in each: texts that share 0.8 of their runs miss each other with 0.738 ** 28 = 0.0002.
ELEMENTS, RUNS_PER_ELEMENT = 28, 6
#: What one task gets of a bucket at most: leaders, and words of leaders and of other members each.
LEADERS, WORDS_PER_CHUNK = 1024, 1_000_000
#: Members up to which all pairs of a bucket are compared at once; larger ones begin with their hub. Either way gives the same classes.
HUB_ABOVE = 32
ENTRIES_PER_STEP = 4_000_000
# Odd multipliers of a 64-bit mixer.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX[0]
    return (values ^ (values >> np.uint64(29))) * MIX[1]


def runs(hashes: np.ndarray, size: int = RUN) -> np.ndarray:
    """A hash of every run of ``size`` words; a shorter text is one run, an empty one has none."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    joined = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        joined = mixed(joined + hashes[k : k + len(joined)])
    return joined


def sketch(hashes: np.ndarray, keys: np.ndarray, per_element: int = RUNS_PER_ELEMENT) -> np.ndarray:
    """One number for each of ``keys``: the smallest labelled runs under it, in text order."""
    found = runs(hashes)
    if not len(found):
        return np.zeros(0, np.uint64)
    order = np.argsort(found, kind="stable")
    sorted_runs = found[order]
    first = np.concatenate([[True], sorted_runs[1:] != sorted_runs[:-1]])
    nth = np.arange(len(found)) - np.maximum.accumulate(np.where(first, np.arange(len(found)), 0))
    labelled = np.empty_like(found)
    labelled[order] = mixed(sorted_runs + nth.astype(np.uint64) * MIX[0])
    elements = np.empty(len(keys), np.uint64)
    step = max(1, ENTRIES_PER_STEP // len(labelled))
    for k in range(0, len(keys), step):
        own = keys[k : k + step]
        values = mixed(labelled[None, :] ^ own[:, None])
        if len(labelled) > per_element:
            places = np.sort(np.argpartition(values, per_element - 1, axis=1)[:, :per_element], axis=1)
        else:
            places = np.tile(np.arange(len(labelled)), (len(own), 1))
        joined = mixed(own)
        for c in range(places.shape[1]):
            joined = mixed(joined * MIX[1] + labelled[places[:, c]])
        elements[k : k + step] = joined
    return elements


def edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Word edits between two texts if at most ``most``, else something larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    shorter = min(len(a), len(b))
    apart = np.flatnonzero(a[:shorter] != b[:shorter])
    head = int(apart[0]) if len(apart) else shorter
    a, b = a[head:], b[head:]
    shorter = min(len(a), len(b))
    apart = np.flatnonzero(a[::-1][:shorter] != b[::-1][:shorter])
    tail = int(apart[0]) if len(apart) else shorter
    a, b = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    return banded(*sorted((a, b), key=len, reverse=True), most)


def banded(longer: Sequence[int], shorter: Sequence[int], most: int) -> int:
    """Edit distance by a band of ``most`` cells on either side of the diagonal, exact if at most ``most``.

    A column of the band is two bit strings, for the cells that are one more and one less than the
    cell above. They move down a cell with each word (Hyyro 2003, A bit-vector algorithm for
    computing Levenshtein and Damerau edit distances). The distance is followed along the lower
    border of the band and then along the last row.
    """
    band = min(most, len(longer))
    width = 2 * band + 2
    every, lowest = (1 << width) - 1, 1 << (width - 1)
    places: dict[int, int] = {}
    for i, word in enumerate(longer):
        places[word] = places.get(word, 0) | 1 << i
    more, less = every ^ ((1 << (width - band - 1)) - 1), 0
    distance, row = band, lowest >> 1
    shift = band + 1 - width
    for column, word in enumerate(shorter):
        here = places.get(word, 0)
        here = (here >> shift if shift >= 0 else here << -shift) & every
        free = ((((here & more) + more) ^ more) | here | less) & every
        right_more = less | every & ~(free | more)
        right_less = free & more
        if column < len(longer) - band:
            distance += not free & lowest
        else:
            distance += bool(right_more & row) - bool(right_less & row)
            row >>= 1
        free >>= 1
        more = right_less | every & ~(free | right_more)
        less = free & right_more
        shift += 1
    return distance


def shared_runs(rows: Sequence[np.ndarray], leaders: np.ndarray) -> np.ndarray:
    """How many different runs each leader shares with each text, as a matrix product in steps of runs."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    _, place, n = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    common = np.flatnonzero(n > 1)
    number = np.full(len(n), -1)
    number[common] = np.arange(len(common))
    place = number[place]
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    counts = np.zeros((len(leaders), len(rows)), np.float32)
    step = max(1, ENTRIES_PER_STEP // len(rows))
    for k in range(0, len(common), step):
        low, high = np.searchsorted(place, [k, k + step])
        cells = np.zeros((len(rows), min(step, len(common) - k)), np.float32)
        cells[owner[low:high], place[low:high] - k] = 1
        counts += cells[leaders] @ cells.T
    return counts


def links_within(keys: Sequence[str], texts: Sequence[np.ndarray], leaders: np.ndarray, parts: Sequence[str], similarity: float) -> list[tuple[str, str]]:
    """Links between leaders and all texts that join different ``parts``, the most similar first."""
    own = [np.unique(runs(t)) for t in texts]
    sizes = np.array([len(r) for r in own])
    if not sizes.any():
        return []
    counts = shared_runs(own, leaders)
    ratio = counts / (sizes[leaders][:, None] + sizes[None, :] - counts)
    root = list(parts)

    def top(x: str) -> str:
        while up.get(x, x) != x:
            x = up[x]
        return x

    up: dict[str, str] = {}
    found = []
    first, second = np.nonzero(ratio >= similarity)
    for k in np.argsort(-ratio[first, second], kind="stable"):
        i, j = int(leaders[first[k]]), int(second[k])
        x, y = top(root[i]), top(root[j])
        if x == y:
            continue
        most = int((1 - similarity) * max(len(texts[i]), len(texts[j])) + 1e-9)
        if edits(texts[i], texts[j], most) <= most:
            up[max(x, y)] = min(x, y)
            found.append((keys[i], keys[j]))
    return found


def sketches(documents: DataFrame, keep: str, text: str, elements: int, per_element: int) -> DataFrame:
    """``key, doc_id, n_words, sketch`` of each different text with its smallest id; stored, without the texts."""
    rng = np.random.default_rng(2019)
    keys = rng.integers(0, 2**63, elements, dtype=np.uint64)
    chosen = documents.select(F.col(keep).cast("bigint").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            own = [hashes.of(t.as_py()) for t in batch.column(2)]
            drawn = [sketch(h, keys, per_element).astype(np.int64).tolist() for h in own]
            columns = [batch.column(0), batch.column(1), pa.array([len(h) for h in own], pa.int64()), pa.array(drawn, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "n_words", "sketch"])

    drawn = chosen.select(F.md5("text").alias("key"), "doc_id", "text").mapInArrow(
        work, "key string, doc_id bigint, n_words bigint, sketch array<bigint>"
    )
    spark, folder = documents.sparkSession, f"{shared_folder(documents.sparkSession)}/sketches-{uuid.uuid4().hex}"
    drawn.write.parquet(folder)
    stored = spark.read.schema(drawn.schema).parquet(folder)
    # copies have equal sketches; the smallest id stands for them
    return stored.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("sketch").alias("sketch"))


def find_links(documents: DataFrame, different: DataFrame, keep: str, text: str, similarity: float) -> DataFrame:
    """Verified links ``a, b`` between keys of different texts."""
    number = F.conv(F.substring("key", 1, 15), 16, 10).cast("bigint")  # of a key; a hub is the member with the smallest
    spread = different.filter("n_words > 0").select("key", "doc_id", "n_words", F.explode("sketch").alias("bucket"))
    buckets = (
        spread.groupBy("bucket")
        .agg(
            F.count("*").alias("n"), F.sum("n_words").alias("total"), F.max("n_words").alias("longest"),
            F.bit_xor(F.xxhash64("key")).alias("mark"), F.sum(F.xxhash64("key", F.lit(1)).cast("decimal(38,0)")).alias("mark2"),
            F.min(number).alias("hub"),
        )
        .filter("n > 1")
        .groupBy("n", "total", "longest", "mark", "mark2", "hub").agg(F.min("bucket").alias("bucket"))  # equal buckets once
        .withColumn("leaders", F.greatest(F.lit(1), F.least(F.lit(LEADERS), F.floor(F.lit(WORDS_PER_CHUNK) / F.col("longest")))))
        .withColumn("chunks", F.when(F.col("n") <= F.col("leaders"), 1).otherwise(F.ceil(F.col("total") / WORDS_PER_CHUNK)))
    )
    members = cut(
        spread.join(buckets.select("bucket", "n", "leaders", "chunks", "hub"), "bucket")
        .withColumn("home", F.pmod(F.xxhash64("key", "bucket"), F.col("chunks")))
    )
    wanted = members.select("key", F.col("doc_id").alias("_id")).distinct()
    every = documents.select(F.col(keep).cast("bigint").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("key", F.md5("text"))
    folder = f"{shared_folder(documents.sparkSession)}/members-{uuid.uuid4().hex}"
    # the corpus is shuffled once; all rounds read the members' texts only
    every.join(wanted, (every["key"] == wanted["key"]) & every["doc_id"].eqNullSafe(wanted["_id"])).select(every["key"], "text").write.parquet(folder)
    texts = documents.sparkSession.read.schema("key string, text string").parquet(folder)

    hashes = Hashes()  # each task gets one of its own

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("leader", ascending=False).drop_duplicates("key").sort_values("key")
        own = [hashes.of(t) for t in rows["text"]]
        leaders = np.flatnonzero(rows["leader"].to_numpy())
        found = links_within(rows["key"].tolist(), own, leaders, rows["part"].tolist(), similarity)
        return pd.DataFrame(found, columns=["a", "b"])

    def compared(placed: DataFrame) -> DataFrame:
        """``placed`` has bucket, chunk, key, leader and part."""
        with_text = placed.join(texts, "key").select("bucket", "chunk", "key", "leader", "part", "text")
        return with_text.groupBy("bucket", "chunk").applyInPandas(work, "a string, b string").distinct()

    def parted(rows: DataFrame, links: DataFrame) -> DataFrame:
        """``rows`` of the buckets that links leave in several parts, with ``part`` and the bucket's largest one as ``main``."""
        known = components(links).withColumnRenamed("id", "key")
        placed = rows.join(known, "key", "left").withColumn("part", F.coalesce("root", "key")).drop("root")
        sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("size"))
        largest = sizes.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("part", F.struct("size", "part")).alias("main"))
        return placed.join(largest.filter("parts > 1").drop("parts"), "bucket")

    whole = F.col("n") <= F.least("leaders", F.lit(HUB_ABOVE))
    crowd = members.filter(~whole)
    rays = crowd.groupBy("hub", "key").agg(F.max("n_words").alias("n_words"))
    crowded = rays.groupBy("hub").agg(F.ceil(F.sum("n_words") / WORDS_PER_CHUNK).alias("split")).filter("split > 1")
    rays = rays.join(crowded, "hub", "left").withColumn("split", F.coalesce("split", F.lit(1))).withColumn("leader", number == F.col("hub"))
    at = F.when(F.col("leader"), F.sequence(F.lit(0).cast("bigint"), F.col("split") - 1)).otherwise(F.array(F.pmod(F.xxhash64("key"), "split")))
    star = rays.select(F.col("hub").alias("bucket"), F.explode(at).alias("chunk"), "key", "leader", F.col("key").alias("part"))
    pairs = members.filter(whole).select("bucket", F.lit(-1).cast("bigint").alias("chunk"), "key", F.lit(True).alias("leader"), F.col("key").alias("part"))
    links = cut(compared(star.unionByName(pairs)))
    if crowd.isEmpty():
        return links

    left = cut(parted(crowd, links))
    small = left.filter("n <= leaders").select(
        "bucket", F.lit(0).cast("bigint").alias("chunk"), "key", (F.col("part") != F.col("main")).alias("leader"), "part"
    )
    links = cut(links.unionByName(compared(small)).distinct())
    large = left.filter("n > leaders").drop("part", "main")
    from_rank = 0
    while not large.isEmpty():
        large = cut(parted(large, links).drop("main").filter(F.col("n") > from_rank * F.col("leaders")))
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("key"))
        upto = (from_rank + 1) * LEADERS
        block = (
            large.withColumn("rank", rank).filter(F.col("rank") <= upto)
            .filter((F.col("rank") > from_rank * F.col("leaders")) & (F.col("rank") <= (from_rank + 1) * F.col("leaders")))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks").cast("bigint") - 1)))
        )
        placed = block.select("bucket", "chunk", "key", F.lit(True).alias("leader"), "part").unionByName(
            large.select("bucket", F.col("home").cast("bigint").alias("chunk"), "key", F.lit(False).alias("leader"), "part")
        )
        links = cut(links.unionByName(compared(placed)).distinct())
        large = large.drop("part")
        from_rank += 1
    return links


def classes(
    documents: DataFrame,
    similarity: float = SIMILARITY,
    keep: str = "doc_id",
    text: str = "text",
    elements: int = ELEMENTS,
    per_element: int = RUNS_PER_ELEMENT,
) -> DataFrame:
    """``key, class_id, class_key`` of each different text: the smallest id in its class, and that document's text.

    ``key`` is the digest of the text. Two texts are linked if they share at least ``similarity``
    of their different five-word runs and an alignment needs word edits for at most the rest of
    the longer text. Null counts as empty; texts without words are linked to equal texts only. A
    null id stands for its class only where no other id does.
    """
    different = sketches(documents, keep, text, elements, per_element)
    links = find_links(documents, different, keep, text, similarity)
    found = components(links)
    placed = (
        different.select("key", "doc_id")
        .join(found.withColumnRenamed("id", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    least = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "key")).alias("first"))
    return placed.join(least, "root").select("key", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("class_key"))


def classified(documents: DataFrame, keep: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``keep`` and ``class_id`` of every row. Repeated rows stay, and an empty table stays empty."""
    named = documents.select(keep, F.md5(F.coalesce(text, F.lit(""))).alias("key"))
    return named.join(classes(documents, keep=keep, text=text, **options).select("key", "class_id"), "key").select(keep, "class_id")


def representatives(documents: DataFrame, keep: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One whole row of each class: the one with the smallest id; of rows alike in id and text, one stays."""
    found = classes(documents, keep=keep, text=text, **options).filter("key = class_key").select("key", "class_id")
    found = found.select(F.col("key").alias("_class_key"), F.col("class_id").alias("_class_id"))
    named = documents.withColumn("_text_key", F.md5(F.coalesce(text, F.lit(""))))
    kept = named.join(found, (named["_text_key"] == found["_class_key"]) & named[keep].eqNullSafe(found["_class_id"]))
    return kept.dropDuplicates(["_class_key"]).select(*[F.col(f"`{c}`") for c in documents.columns])
