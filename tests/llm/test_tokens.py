"""Packing, token records and the word encoder: exact round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import packing, records, tokens

from .brute import table, vocabulary_words

ODD = [
    None, "", " ", "\x1c", "a\x1fb \x1d c", "it's don't we're I'LL x'd", "<|endoftext|> Hi<|startoftext|>", "ÀÉÎ straße. İstanbul ΣΑΣ ς",
    "é ́a a b c　d\x85e\x0bf\x0cg", "漢字かな 12ab34 $$$,,, ...a", "a​b ᠎ x﻿y z", "ª º µ ŉ ǅ ﬁ Å", "🤦🏼‍♂️ ok", "\x00 \x01a", "a,.b .c", "Word, word. WORD,,",
]


@pytest.fixture(scope="module")
def encoder():
    return tokens.WordEncoder(tokens.vocabulary())


def test_encoder_equals_the_library(encoder):
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x1680, 0x180E, 0x3000, 0x301, 0x3A3, 0x130, 0xFEFF]]
    texts = [t or "" for t in ODD] + ["".join(rng.choice(pool) for _ in range(14)) for _ in range(1500)]
    for text in texts * 2:
        assert encoder.of(text) == encoder.whole(text), repr(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    small = tokens.WordEncoder(tokens.vocabulary())
    for text in ("one two three four five", "one two", "six one, two. seven"):
        assert small.of(text) == small.whole(text)


def fill(counts, capacity):
    """Sequences of a plan as lists of (offset, size)."""
    table = packing.plan(counts, capacity)
    found = defaultdict(list)
    for size, n in counts.items():
        own = table[table["size"] == size]
        for rank in range(n):
            row = own.iloc[int(np.searchsorted(own["low"], rank, side="right")) - 1]
            nth = rank - row["low"]
            found[int(row["first"] + nth // row["each"])].append((int(row["offset"] + nth % row["each"] * size), size))
    return found


def least_bins(sizes, capacity):
    """The true optimum of a small instance, by trying every placement."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for room in {r for r in bins if r >= sizes[i]}:
            at = bins.index(room)
            go(i + 1, [*bins[:at], room - sizes[i], *bins[at + 1 :]])
        go(i + 1, [*bins, capacity - sizes[i]])

    go(0, [])
    return best[0]


def test_plans_are_gapless_and_the_reduction_keeps_the_optimum():
    rng = random.Random(5)
    for _ in range(150):
        capacity = rng.choice([10, 13, 20, 30])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        sequences = fill(Counter(sizes), capacity)
        assert sorted(s for v in sequences.values() for _, s in v) == sorted(sizes)
        for own in sequences.values():
            at = 0
            for offset, size in sorted(own):
                assert offset == at
                at += size
            assert at <= capacity
        stock = packing.Stock(Counter(sizes))
        fixed = sum(times for times, _ in packing.reduced(stock, capacity))
        rest = [s for s, n in stock.left.items() for _ in range(n)]
        assert fixed + (least_bins(rest, capacity) if rest else 0) == least_bins(sizes, capacity), sizes


def test_pack(spark, encoder):
    texts = [*ODD, *ODD[7:9], "a, b. " * 3000, "long " * 2047, "long " * 2048, *[" ".join(vocabulary_words(n, n)) for n in range(1, 200, 3)]]
    frame = table(spark, *texts)
    frame = frame.unionByName(frame.filter("doc_id < 3")).unionByName(table(spark, "no id").withColumn("doc_id", F.lit(None).cast("bigint")))
    found = packing.pack(frame).collect()
    pieces = Counter()
    for i, text in [*enumerate(texts), *enumerate(texts[:3]), (None, "no id")]:
        ids = encoder.whole(text or "") + bytes(4)
        for k in range(0, len(ids), 8192):
            pieces[i, k // 8192, k // 4, len(ids[k : k + 8192]) // 4, zlib.crc32(ids[k : k + 8192])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == pieces
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == -(-sum(r["length"] for r in found) // 2048)
    assert packing.pack(frame.limit(0)).count() == 0


def test_sequences_hold_the_ids(spark, encoder):
    frame = table(spark, *[" ".join(vocabulary_words(n, n)) for n in (5, 40, 90)])
    cutting = packing.pieces(frame, capacity=32)
    places = packing.pack(frame, capacity=32)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(cutting, places).collect()}
    pieces = {(r["doc_id"], r["piece"]): bytes(r["ids"]) for r in cutting.collect()}
    for r in places.collect():
        at = 4 * r["offset"]
        assert whole[r["sequence_id"]][at : at + 4 * r["length"]] == pieces[r["doc_id"], r["piece"]]


def test_records_round_trip(spark, encoder):
    texts = [*ODD, "again " * 5000, *[f"text {i}" for i in range(300)]]
    frame = table(spark, *texts).unionByName(table(spark, "x", "y").withColumn("doc_id", F.lit(5).cast("bigint")))
    frame = frame.unionByName(table(spark, "no id", None).withColumn("doc_id", F.lit(None).cast("bigint"))).repartition(7)
    folder = records.new_folder(spark)
    records.write(frame, folder)
    found = records.read(spark, folder).orderBy("start").collect()
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert order == sorted(order) and len(found) == len(texts) + 4
    at, known = 0, Counter()
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
        known[r["doc_id"], bytes(r["ids"])] += 1
    end = (2).to_bytes(4, "little")
    wanted = [*enumerate(texts), (5, "x"), (5, "y"), (None, "no id"), (None, "")]
    assert known == Counter((i, encoder.whole(t or "") + end) for i, t in wanted)
    index = spark.read.parquet(f"{folder}/index")
    some = index.filter("doc_id % 3 = 0 OR doc_id IS NULL").orderBy(F.rand(1))
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in records.fetch(some, folder).collect()) == Counter(
        {k: n for k, n in known.items() if k[0] is None or k[0] % 3 == 0}
    )


def test_records_of_nothing_and_damage(spark, tmp_path):
    folder = records.new_folder(spark)
    records.write(table(spark, "a").limit(0), folder)
    assert records.read(spark, folder).count() == 0
    import io

    for ids in (b"", np.array([1, 65535], "<u4").tobytes(), np.array([1, 65536], "<u4").tobytes()):
        assert records.parsed(records.serialized(None, ids)) == (None, ids)
    good = records.framed(records.serialized(7, b"\x01\0\0\0"))
    assert records.parsed(records.unframed(io.BytesIO(good))) == (7, b"\x01\0\0\0")
    for at in range(len(good)):
        with pytest.raises(ValueError):
            records.unframed(io.BytesIO(good[:at] + bytes([good[at] ^ 1]) + good[at + 1 :]))
