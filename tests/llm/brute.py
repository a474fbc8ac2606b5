"""Brute-force versions and small tables that the tests of the llm operators share."""

from __future__ import annotations

import re

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans int, key string, score double, blob string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows(*texts, start=0):
    """Documents with extra columns whose names the operators use themselves."""
    return [(start + i, t, "en", "src0", None if t is None else len(t), 7, "k", 0.5, "b") for i, t in enumerate(texts)]


def table(spark, *texts, start=0):
    return spark.createDataFrame(rows(*texts, start=start), DOCUMENTS)


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def five_word_runs(text):
    own = plain_words(text)
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def levenshtein(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def vocabulary_words(n, seed=0):
    import random

    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]
