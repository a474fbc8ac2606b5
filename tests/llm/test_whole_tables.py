"""Line deduplication, whitening and Merkle manifests against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import eigen, line_dedup, merkle, queries, sql, whitening

from .brute import DOCUMENTS, rows, table


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def without_shared(texts, min_docs, min_chars):
    keys = [[lowered(x.strip(" \t\n\x0b\f\r")) for x in (t or "").split("\n")] for t in texts]
    seen = Counter(k for own in keys for k in set(own))
    out = []
    for t, own in zip(texts, keys):
        kept = [x for x, k in zip((t or "").split("\n"), own) if len(k) < min_chars or seen[k] < min_docs]
        out.append(("\n".join(kept), len(own), len(own) - len(kept)))
    return out


LINES = ["Shared LINE", " shared line\t", "ÉTÉ", "été", "x", "", " ", "\x85", "only", "a\x0b", "tail\r", "🤦🏼‍♂️ z", "ÀB", "Àb"]


@pytest.mark.parametrize("min_docs,min_chars", [(3, 1), (2, 0), (1, 1), (10, 2)])
def test_line_dedup(spark, min_docs, min_chars):
    rng = random.Random(min_docs)
    texts = [None, "", "\n", " \n\n", "Shared LINE", "x\nx\nx", "only me", *(["copy\nshared line"] * 12)]
    texts += ["\n".join(rng.choice(LINES) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts += ["\n".join(f"line {i % 7000}" for i in range(20_000)), "\n".join(f"Line {i}" for i in range(9000)) + "\n" + "w " * 50_000]
    frame = table(spark, *texts)
    frame = frame.unionByName(frame.filter("doc_id = 6"))  # a repeated row is a document
    wanted = without_shared([*texts, texts[6]], min_docs, min_chars)
    found = line_dedup.drop_shared_lines(frame, min_docs, min_chars, keep=("doc_id", "text")).collect()
    assert len(found) == len(wanted)
    by_id = defaultdict(list)
    for i, w in enumerate(wanted):
        by_id[i if i < len(texts) else 6].append(w)
    for r in found:
        assert (r["text"], r["n_lines"], r["n_dropped"]) in by_id[r["doc_id"]], r["doc_id"]
        assert r["in_text"] == texts[r["doc_id"]]


def test_line_dedup_without_broadcast_and_empty(spark, monkeypatch):
    texts = ["a\nb\nc", "a\nB ", "b\nd", None]
    plain = sorted(line_dedup.drop_shared_lines(table(spark, *texts), 2).collect())
    monkeypatch.setattr(line_dedup, "sized", lambda lines: lines)
    assert sorted(line_dedup.drop_shared_lines(table(spark, *texts), 2).collect()) == plain
    assert [(r["doc_id"], r["text"], r["n_dropped"]) for r in plain] == [(0, "c", 2), (1, "", 2), (2, "d", 1), (3, "", 0)]
    empty = line_dedup.drop_shared_lines(table(spark, "a").limit(0))
    assert empty.columns == ["doc_id", "text", "n_lines", "n_dropped"] and empty.count() == 0


def against_sql(spark, tmp_path, name, frame):
    frame.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = duck.execute(sql.SQL[name])
    names = [d[0] for d in cursor.description]
    found = queries.QUERIES[name](spark, str(tmp_path))
    assert sorted(found.columns) == sorted(names)
    assert Counter(map(tuple, found.select(*names).collect())) == Counter(cursor.fetchall())


def mixed(spark, n=60):
    rng = random.Random(n)
    texts = ["\n".join(rng.choice(LINES) for _ in range(rng.randint(1, 6))) for _ in range(n)]
    made = [list(r[:5]) for r in rows(None, "", *texts)]
    for i, r in enumerate(made):
        r[2] = rng.choice([None, "", "en", "de", "é", "🤦", "en"])
        r[3] = rng.choice([None, "src", ""])
        if i % 9 == 0:
            r[0] = None
        if i % 11 == 0:
            r[0] = 5
        if i % 5 == 0:
            r[4] = None
    return spark.createDataFrame([*made, made[7], made[7]], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.mark.parametrize("name", ["op11_line_dedup", "op13_merkle_manifest"])
def test_sql_of_mixed_rows(spark, tmp_path, name):
    against_sql(spark, tmp_path, name, mixed(spark))


# ---- eigenpairs and whitening


def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


MATRICES = {
    "one": np.array([[3.0]]),
    "two": np.array([[2.0, 1.0], [1.0, 2.0]]),
    "zero": np.zeros((5, 5)),
    "identity": np.eye(20),
    "diagonal": np.diag(np.arange(30.0)),
    "random": spectrum(np.random.default_rng(3).exponential(size=40)),
    "cluster": spectrum([5.0] * 4 + [5 + 1e-9] * 4 + [4.999] * 3 + [1.0] * 20),
    "rank two": spectrum([3.0, 1.0] + [0.0] * 20),
    "graded": spectrum(np.logspace(0, -18, 30)),
    "blocks": np.kron(np.eye(4), np.ones((5, 5))),
    "tiny": spectrum([1.0, 2.0, 3.0]) * 1e-200,
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_pairs(name):
    a = MATRICES[name]
    values, vectors = eigen.leading_pairs(a, 12)
    k = min(12, len(a))
    size = max(np.abs(a).max(), 1e-300)
    assert values.shape == (k,) and vectors.shape == (len(a), k)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-13 * size * len(a)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * size * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


EMBEDDINGS = "vec_id bigint, embedding array<float>, label int, n int, _x string"


def whitened_by_hand(vectors, k):
    """x of every usable vector; n, sums, axes, values and the trace over the distinct ones."""
    x = {i: [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for i, v in vectors.items()}
    fit = np.array(sorted(set(map(tuple, x.values()))), object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit * n - s).astype(float) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    return x, n, s, axes[:, ::-1][:, :k], values[::-1][:k], np.trace(covariance)


def test_whitening(spark):
    rng = np.random.default_rng(5)
    mixing = rng.standard_normal((20, 20))
    good = {i: (rng.standard_normal(20) @ mixing).tolist() for i in range(150)}
    good |= {1000 + i: good[0] for i in range(200)}  # a crowd on one vector
    bad = [None, [], [None] * 20, [1.0] * 19 + [None], [float("nan")] * 20, [float("inf")] + [0.0] * 19, [1e30] + [0.0] * 19, [1.0, 2.0]]
    made = [(i, v, 1, 2, "y") for i, v in good.items()] + [(-1 - i, v, 1, 2, "y") for i, v in enumerate(bad)]
    made += [made[3], (None, good[7], None, None, None)]
    frame = spark.createDataFrame(made, EMBEDDINGS).repartition(5)
    found = whitening.whiten(frame, keep=("vec_id", "n")).collect()
    x, n, s, axes, values, trace = whitened_by_hand(good, 16)
    assert n == 150 and len(found) == (len(good) + 2) * 16
    flips = {}
    fitted = {}
    for r in found:
        own = x[7 if r["vec_id"] is None else r["vec_id"]]
        j = r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(own, s))
        wanted = sum((n * a - b) / n * c for a, b, c in zip(own, s, axes[:, j])) / np.sqrt(values[j])
        sign = flips.setdefault(j, np.sign(wanted * r["whitened"]))
        assert abs(sign * wanted - r["whitened"]) < 1e-9
        assert abs(r["explained"] - values[j] / trace) < 1e-12 and r["identity_error"] < 1e-9
        fitted[tuple(own), j] = r["whitened"]
    w = np.array([[fitted[v, j] for j in range(16)] for v in sorted({k[0] for k in fitted})])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(16)).max() < 1e-9


def test_whitening_of_little(spark):
    def of(*vectors):
        return whitening.whiten(spark.createDataFrame([(i, v, 1, 1, "y") for i, v in enumerate(vectors)], EMBEDDINGS)).collect()

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(spark.createDataFrame([], EMBEDDINGS)).columns == names
    assert of() == [] and of(None, []) == [] and of([1.0, 2.0], [1.0, 2.0]) == []
    line = of([0.0, 0.0], [1.0, 1.0], [2.0, 2.0], [2.0, 2.0])
    assert {r["component"] for r in line} == {1} and len(line) == 4 and all(abs(r["explained"] - 1) < 1e-12 for r in line)
    assert whitening.deviations(np.array([[2**61, 5]]), np.array([0, 0]), np.array([1, 1]), 7).to_pylist() == [None]
    assert whitening.deviations(np.array([[2**31, 5]]), np.array([0, 0]), np.array([1, 1]), 1).to_pylist() == [(2**31 - 1) ** 2 + 16]


def test_exact_sums(spark):
    big = 2**56 * 64 - 3
    frame = spark.createDataFrame([([big - i, -i],) for i in range(300)], "_x array<bigint>")
    assert whitening.exact_sums(frame, 2) == (300, [big * 300 - sum(range(300)), -sum(range(300))])


# ---- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climbed(digests):
    """The last digest and, for each start, its siblings and sides."""
    paths = [([], []) for _ in digests]
    spots = list(range(len(digests)))
    while len(digests) > 1:
        for path, at in zip(paths, spots):
            other = at ^ 1
            path[1].append("-" if other >= len(digests) else "l" if other < at else "r")
            if other < len(digests):
                path[0].append(digests[other])
        digests = [h(*digests[i : i + 2]) for i in range(0, len(digests), 2)]
        spots = [s // 2 for s in spots]
    return digests[0], paths


def manifest_by_hand(documents):
    framed = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for d in documents:
        groups[d["lang"]].append((d["doc_id"] is not None, d["doc_id"] or 0, h(*[framed(d[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = [climbed([leaf for *_, leaf in sorted(groups[g])]) for g in names]
    root, above = climbed([top for top, _ in tops])
    out = Counter()
    for name, (subroot, paths), (siblings, sides) in zip(names, tops, above):
        for (known, number, leaf), path in zip(sorted(groups[name]), paths):
            out[number if known else None, leaf, subroot, root, "".join(path[0] + siblings), "".join(path[1] + sides)] += 1
    return out


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest(spark, levels):
    frame = mixed(spark, 100)
    found = merkle.manifest(frame, ("doc_id", "source", "lang", "n_chars", "text"), "lang", "doc_id", ("doc_id",), levels)
    got = found.collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "siblings", "sides")) for r in got) == manifest_by_hand(
        frame.collect()
    )
    again = found.select(merkle.folded(F.col("leaf"), F.col("siblings"), F.col("sides")).alias("a"), "root")
    assert again.filter("a <> root").count() == 0


def test_small_manifests(spark):
    columns = ("doc_id", "text")
    frame = spark.createDataFrame(rows("a", "b"), DOCUMENTS)
    assert merkle.manifest(frame.limit(0), columns, "lang", "doc_id", ("doc_id",)).collect() == []
    (one,) = merkle.manifest(frame.filter("doc_id = 0"), columns, "lang", "doc_id", ("doc_id", "key")).collect()
    assert one["root"] == one["subroot"] == one["leaf"] == h("1:0", "1:a") and (one["siblings"], one["sides"], one["key"]) == ("", "", "k")
    both = merkle.manifest(frame.withColumn("lang", F.col("text")), columns, "lang", "doc_id").collect()
    assert {r["root"] for r in both} == {h(h("1:0", "1:a"), h("1:1", "1:b"))} and sorted(r["sides"] for r in both) == ["l", "r"]


def test_tampering(spark, tmp_path):
    frame = table(spark, *[f"text {i}" if i % 4 else None for i in range(100)])
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect():
        i = r["doc_id"]
        assert r["verified"] == (r["folded_root"] == r["root"]) == (zlib.crc32(str(i).encode()) % 7 != 0 or i % 4 == 0)
