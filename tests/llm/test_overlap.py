"""Decontamination, near duplicates and the pipeline against brute force."""

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import components, decontamination, near_dup
from millrace.llm.words import Hashes, words

from .brute import DOCUMENTS, five_word_runs, levenshtein, plain_words, rows, table, vocabulary_words


def test_words_follow_the_pattern():
    rng = random.Random(0)
    pool = [chr(c) for c in [*range(0x180), 0x3000, 0x2028, 0x1F600]]
    for _ in range(500):
        text = "".join(rng.choice(pool) for _ in range(40))
        assert [w.decode() for w in words(text)] == plain_words(text)


def expected_hits(text, items, window=10):
    own, hit, found = plain_words(text), set(), set()
    for item, passage in items:
        other = plain_words(passage)
        for k in range(max(1, len(other) - window + 1) if other else 0):
            part = other[k : k + window]
            for i in range(len(own) - len(part) + 1):
                if own[i : i + len(part)] == part:
                    hit |= set(range(i, i + len(part)))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_decontamination(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "WORDS_PER_SHARD", 300)
    monkeypatch.setattr(decontamination, "CANDIDATES_PER_STEP", 50)
    vocabulary = vocabulary_words(60, 4)
    rng = random.Random(8)
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [make(n) for n in (10, 14, 30, 60, 3, 1, 9)]
    items = [*enumerate(passages), (7, passages[0]), (8, None), (9, "..."), (10, " ".join(passages[1].split()[:11]) + " other end")]
    texts = [None, "", "..", passages[0], passages[0].upper() + "!", make(40) + " " + passages[3][:150] + " " + make(5), passages[2] + ", " + passages[2]]
    texts += [make(n) for n in (5, 50, 200, 900)] + [" ".join([passages[1]] * 20)] + [passages[0]] * 30
    near = passages[2].split()
    texts.append(" ".join([*near[:4], "xyzzy", *near[4:10]]))
    frame = table(spark, *texts)
    benchmark = spark.createDataFrame([(i, p, "q") for i, p in [*items, (None, passages[3])]], "item_id bigint, text string, doc_id string")
    found = decontamination.scan(frame, benchmark, keep=("doc_id", "spans")).collect()
    assert len(found) == len(texts)
    for r in found:
        hits = [(h["start"], h["stop"]) for h in r["hits"]]
        assert (r["n_words"], sum(b - a for a, b in hits), r["items"]) == expected_hits(texts[r["doc_id"]], items), r
        assert hits == sorted(hits) and not set(r["items"]) & set(r["near_items"])
    last = [r for r in found if r["doc_id"] == len(texts) - 1][0]
    assert last["near_items"] == ["2"] or "2" in last["near_items"]
    # the same in blocks of items
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    assert len(decontamination.blocks(benchmark, "item_id", "text")) > 3
    in_blocks = decontamination.scan(frame, benchmark, keep=("doc_id", "spans"))
    assert in_blocks.columns == decontamination.scan(frame, benchmark.limit(1), keep=("doc_id", "spans")).columns
    by_id = lambda rows: sorted((r.asDict(recursive=True) for r in rows), key=lambda r: r["doc_id"])
    assert by_id(in_blocks.collect()) == by_id(found)
    for documents, against in ((frame.limit(0), benchmark), (frame, benchmark.limit(0))):
        assert all(not r["hits"] and not r["items"] for r in decontamination.scan(documents, against).collect())


def near_classes(texts):
    runs, n = [five_word_runs(t) for t in texts], len(texts)
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if not same and runs[i] and runs[j]:
                shared = len(runs[i] & runs[j])
                a, b = plain_words(texts[i]), plain_words(texts[j])
                same = shared >= 0.8 * (len(runs[i]) + len(runs[j]) - shared) and levenshtein(a, b) <= int(0.2 * max(len(a), len(b)))
            if same:
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return [top(i) for i in range(n)]


def copies(seed=1):
    rng, vocabulary, texts = random.Random(seed), vocabulary_words(500, seed), [None, "", " ", "one", "one", "a b c", "A, b. c!", "...", "a b c d"]
    shared = " ".join(rng.choice(vocabulary) for _ in range(40))
    for g in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 40, 120]))] + (shared.split() if g % 2 else [])
        for _ in range(rng.choice([1, 2, 9])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 50))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    texts += [texts[-1]] * 30
    rng.shuffle(texts)
    return texts


def test_near_duplicates(spark):
    texts = copies()
    found = {r["doc_id"]: r["class_id"] for r in near_dup.classified(table(spark, *texts)).collect()}
    assert [found[i] for i in range(len(texts))] == near_classes(texts)
    kept = near_dup.representatives(table(spark, *texts)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(near_classes(texts)))
    empty = table(spark, "a").limit(0)
    assert near_dup.classified(empty).count() == 0 and near_dup.representatives(empty).count() == 0


def test_large_buckets_are_worked_off_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "LEADERS", 2)
    monkeypatch.setattr(near_dup, "WORDS_PER_CHUNK", 600)
    monkeypatch.setattr(near_dup, "HUB_ABOVE", 2)
    texts = copies(3)
    found = {r["doc_id"]: r["class_id"] for r in near_dup.classified(table(spark, *texts)).collect()}
    assert [found[i] for i in range(len(texts))] == near_classes(texts)


def test_buckets_with_hubs_give_the_same_classes(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "HUB_ABOVE", 2)
    texts = copies(5)
    found = {r["doc_id"]: r["class_id"] for r in near_dup.classified(table(spark, *texts)).collect()}
    assert [found[i] for i in range(len(texts))] == near_classes(texts)


def test_repeated_rows_and_null_ids(spark):
    frame = table(spark, "same text here", "same text here").unionByName(table(spark, "same text here", "other words").withColumn("doc_id", F.lit(None).cast("bigint")))
    frame = frame.unionByName(frame)
    found = sorted(((r["doc_id"], r["class_id"]) for r in near_dup.classified(frame).collect()), key=str)
    assert found == sorted([(0, 0), (1, 0), (None, 0), (None, None)] * 2, key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in near_dup.representatives(frame).collect()), key=str) == [(0, "same text here"), (None, "other words")]


def test_alignment_and_sketches():
    rng = np.random.default_rng(4)
    for _ in range(1500):
        a = rng.integers(0, 5, rng.integers(0, 40)).astype(np.uint64)
        b = a.copy()
        for _ in range(rng.integers(0, 12)):
            if len(b) and rng.random() < 0.5:
                b = np.delete(b, rng.integers(len(b)))
            else:
                b = np.insert(b, rng.integers(len(b) + 1), rng.integers(0, 5))
        true, most = levenshtein(a.tolist(), b.tolist()), int(rng.integers(0, 15))
        found = near_dup.edits(a, b, most)
        assert found == true if true <= most else found > most
        assert near_dup.edits(a, b, 60) == near_dup.edits(b, a, 60) == true
    keys = rng.integers(0, 2**63, 28, dtype=np.uint64)
    hashes = Hashes()
    text = [str(i) for i in range(300)]
    turned = text[150:] + text[:150]
    one, other = (near_dup.sketch(hashes.of(" ".join(t)), keys) for t in (text, turned))
    assert (one == near_dup.sketch(hashes.of(" ".join(text).upper()), keys)).all()
    # nearly the same set of runs, but seldom in the same order
    assert (one == other).sum() < 8


def test_components(spark):
    rng = random.Random(6)
    pairs = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(70)] + [("hub", f"leaf{i}") for i in range(200)]
    pairs += [(f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(40)] + [("self", "self")]
    found = {r["id"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    up = {x: x for p in pairs for x in p}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    assert found == {x: top(x) for x in up if x != "self"}
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_pipeline(spark, tmp_path):
    """Each stage against what it must keep; all columns stay until the last."""
    rng, vocabulary = random.Random(11), vocabulary_words(400, 11)
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = make(30)
    clean = [make(rng.choice([20, 90])) for _ in range(120)]
    toxic = [make(30) + " grubnix vexhorst " + make(5) for _ in range(30)]
    special = [None, "", clean[0], clean[1] + " tail", "x " + passage, make(20) + " password=abcdefabcdef99 " + make(20)]
    frame = spark.createDataFrame(rows(*clean, *toxic, *special), DOCUMENTS)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(120 <= i < 150)) for i in range(0, 150, 2)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        if name != "packing":
            assert docs.columns == frame.columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    all_ids, texts = set(range(156)), [*clean, *toxic, *special]
    assert set(kept["toxicity"]) == all_ids - set(range(120, 150))
    by_class = defaultdict(list)
    ids = sorted(kept["toxicity"])
    for i, c in zip(ids, near_classes([texts[i] for i in ids])):
        by_class[c].append(i)
    assert set(kept["near_duplicates"]) == {min(v) for v in by_class.values()}
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - {154}
    assert set(kept["secrets"]) == set(kept["decontamination"])
    changed = {i for i in kept["secrets"] if kept["secrets"][i] != kept["decontamination"][i]}
    assert changed == {155} and "[secret]" in kept["secrets"][155] and "abcdefabcdef99" not in kept["secrets"][155]
    assert {r["doc_id"] for r in docs.collect()} == set(kept["secrets"])
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    documents.write.parquet(f"{tmp_path}/plain/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").write.parquet(f"{tmp_path}/plain/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/plain").select("doc_id").distinct().count() == len(kept["secrets"])


def test_components_work_in_as_few_pieces_as_links_ask_for(spark, monkeypatch):
    """Few links do not lie in as many files as there are shuffle partitions, however many these are."""
    stored = []
    cut = components.cut

    def counted(df):
        found = cut(df)
        stored.append(found.rdd.getNumPartitions())
        return found

    monkeypatch.setattr(components, "cut", counted)
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101)], "a bigint, b bigint")
    width = spark.conf.get("spark.sql.shuffle.partitions")
    names = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        found = {r["id"]: r["root"] for r in components.components(links).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {i: 0 for i in range(31)} | {100: 100, 101: 100}
    assert max(stored[1:]) <= spark.sparkContext.defaultParallelism
