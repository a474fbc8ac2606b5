"""Language identification and toxicity: held-out accuracy, hand-made cases, code lengths."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.llm import language, toxicity

from .brute import DOCUMENTS, rows, vocabulary_words

SYLLABLES = {"xx": ["ba", "lo", "min", "tur"], "yy": ["ská", "vrt", "žen", "oli"], "zz": ["quin", "oux", "eau", "del"]}


def speech(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


def corpus(spark):
    data = []
    for i in range(240):
        lang = sorted(SYLLABLES)[i % 3]
        data.append((i, speech(lang, 3 + i % 40, i), lang if i % 7 else None, "s", 1, 1, "k", 0.0, "b"))
    data += [(240, None, "xx", "s", 1, 1, "k", 0.0, "b"), (241, "", "xx", "s", 1, 1, "k", 0.0, "b"), (242, "12 3.4 !?", "yy", "s", 1, 1, "k", 0.0, "b")]
    data += [(243, speech("zz", 40_000, 1), "zz", "s", 1, 1, "k", 0.0, "b"), (244, "ská" * 90_000, "yy", "s", 1, 1, "k", 0.0, "b")]
    data += [data[0], data[0]]
    return spark.createDataFrame(data, DOCUMENTS)


def test_language(spark):
    frame = corpus(spark)
    model = language.train(frame.filter(language.fold("doc_id", 3) != 1), rows_per_language=40)
    assert model.languages == ["xx", "yy", "zz"]
    found = language.predict(frame, model, ("doc_id", "lang")).collect()
    assert len(found) == frame.count()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert by[240] == by[241] == by[242] == ("und", 0.0)
    right = [by[i][0] == sorted(SYLLABLES)[i % 3] for i in range(240)]
    assert sum(right) >= 238 and by[243][0] == "zz" and by[244][0] == "yy"
    assert all(0 <= s <= 1 for _, s in by.values())
    nothing = language.train(frame.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.predict(frame, nothing).collect()} == {"und"}
    assert language.predict(frame.limit(0), model).count() == 0


def test_code_lengths_by_hand():
    counts = Counter(g for w in (b"ab", b"ab", b"ac") for g in language.grams(w, 1))
    tree = language.Tree.frozen(counts)
    # b follows a twice and c once; a follows the space three times
    assert math.isclose(tree.bits(b"ab", 1), -sum(map(math.log2, [3 / 4, 2 / 5, 2 / 3])))
    # z was never seen: escapes from a and from the empty context, then 8 bits; z has no context; the space without one
    empty = 3 + 2 + 1 + 3, 4
    escape = -math.log2(empty[1] / (empty[0] + empty[1]))
    expected = -math.log2(3 / 4) - math.log2(2 / 5) + escape + 8 - math.log2(3 / 13)
    assert abs(tree.bits(b"az", 1) - expected) < 1e-9


def labelled(spark, n=400):
    rng, plain = random.Random(2), vocabulary_words(300, 9)
    data, labels = [], []
    for i in range(n):
        own = [rng.choice(plain) for _ in range(rng.choice([5, 60, 400]))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(1 + len(own) // 40):
                own.insert(rng.randrange(len(own)), rng.choice(["grubnix", "Zworple,", "vexhorst"]))
        data.append(" ".join(own))
        labels.append((i, 1, int(toxic)))
    labels += [(0, 1, None), (None, 1, 1), (8, 0, 0), (99_999, 1, 1)]
    return spark.createDataFrame(rows(*data), DOCUMENTS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity(spark):
    documents, labels = labelled(spark)
    held_out = language.fold("doc_id", 5) == 0
    model = toxicity.train(documents, labels.filter(~held_out))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(documents, model, ("doc_id", "lang")).collect()}
    wrong = sum((scored[i] >= 0.5) != (i % 8 == 0) for i in range(400))
    assert wrong <= 2
    odd = spark.createDataFrame(rows(None, "", " ", "\x00", "grubnix " * 50_000, "grubnix", "grubnix"), DOCUMENTS)
    odd_scores = [r["score"] for r in toxicity.score(odd, model).orderBy("doc_id").collect()]
    assert len(odd_scores) == 7 and odd_scores[0] == odd_scores[1] == odd_scores[2] < 0.5 and odd_scores[4] == odd_scores[5] > 0.5
    assert toxicity.score(documents.limit(0), model).count() == 0
    assert len(model.features) <= toxicity.FEATURES


def test_toxicity_needs_both_labels(spark):
    documents, labels = labelled(spark, 20)
    assert toxicity.train(documents, labels.filter("toxic = 0")) is None
    assert toxicity.train(documents.limit(0), labels) is None
    assert {r["score"] for r in toxicity.score(documents, None).collect()} == {0.0}


def test_bounded_sample(spark):
    documents, labels = labelled(spark, 60)
    assert toxicity.labelled(documents, labels, 10).count() == 10


def test_logistic_gradient_vanishes():
    rng = np.random.default_rng(0)
    rows_, columns = np.repeat(np.arange(200), 3), rng.integers(0, 20, 600)
    y, values = (rng.random(200) < 0.3).astype(float), rng.normal(size=20)
    w, b = toxicity.logistic(rows_, columns, values, y)
    dense = np.zeros((200, 20))
    np.add.at(dense, (rows_, columns), values[columns])
    p = 1 / (1 + np.exp(-(dense @ w + b)))
    assert np.abs(dense.T @ (p - y) + w).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_counting_n_grams_remembers_a_bounded_number_of_words(monkeypatch):
    """One word and its n-grams are held at a time, and the counts are those of all words."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(60)]
    alive, most = [0], [0]

    class Grams(set):
        def __init__(self, grams):
            super().__init__(grams)
            alive[0] += 1
            most[0] = max(most[0], alive[0])

        def __del__(self):
            alive[0] -= 1

    grams = toxicity.word_grams
    expected = Counter(g for t in texts for g in set().union(*[grams(w) for w in t.split()]))

    class Texts:
        def repartition(self, parts):
            return self

        def mapInPandas(self, count, schema):
            found = pd.concat(count(iter([pd.DataFrame({"text": texts, "toxic": [i % 2 for i in range(60)]})])))
            assert dict(zip(found["bucket"].tolist(), (found["clean"] + found["toxic"]).tolist())) == expected
            raise InterruptedError

    monkeypatch.setattr(toxicity, "word_grams", lambda word: Grams(grams(word)))
    monkeypatch.setattr(toxicity, "labelled", lambda *_: Texts())
    monkeypatch.setattr(toxicity, "cut", lambda rows: rows)
    monkeypatch.setattr(toxicity, "COUNTED", 50, raising=False)
    with pytest.raises(InterruptedError):
        toxicity.train(None, None)
    assert most[0] <= 2
