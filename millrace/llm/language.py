"""Language identification by prediction with partial matching over bytes.

For each language a tree of byte contexts of up to ``order`` bytes is counted once and then
frozen. A byte costs -log2 of its share in the longest known context; where that context has
never been followed by it, the cost of the escape is added and the next shorter context is
asked, down to all 256 bytes alike. Escapes are weighted by the number of different followers.
Words in lower case are coded one by one, with a space before and after them: contexts never reach
over it, so a word costs the same wherever it stands, and repeated words are coded once. What has
no letter is not coded.
The language with the shortest code for the whole text wins.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .schemas import extended
from .words import words

ROWS_PER_LANGUAGE = 500
ORDER = 4
#: Words whose costs a worker remembers; all are forgotten at once when there are more.
REMEMBERED = 800_000
LONGEST_REMEMBERED = 64


def grams(word: bytes, order: int) -> Iterator[bytes]:
    """Every byte of the word and the space after it, each with up to ``order`` bytes before it."""
    coded = b" " + word + b" "
    for i in range(1, len(coded)):
        for k in range(max(0, i - order), i + 1):
            yield coded[k : i + 1]


@dataclass
class Tree:
    """Costs in bits of one language: of a byte after a context, and of escaping from a context."""

    symbols: dict[bytes, float] = field(default_factory=dict)
    escapes: dict[bytes, float] = field(default_factory=dict)

    @classmethod
    def frozen(cls, counts: dict[bytes, int]) -> Tree:
        total, kinds = defaultdict(int), defaultdict(int)
        for gram, n in counts.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        weight = {c: total[c] + kinds[c] for c in total}
        return cls(
            {g: -math.log2(n / weight[g[:-1]]) for g, n in counts.items()},
            {c: -math.log2(kinds[c] / weight[c]) for c in total},
        )

    def after(self, gram: bytes) -> float:
        """Bits of the last byte after the others."""
        cost = 0.0
        for k in range(len(gram)):
            known = self.symbols.get(gram[k:])
            if known is not None:
                return cost + known
            cost += self.escapes.get(gram[k:-1], 0.0)
        return cost + 8.0

    def bits(self, word: bytes, order: int) -> float:
        coded = b" " + word + b" "
        return sum(self.after(coded[max(0, i - order) : i + 1]) for i in range(1, len(coded)))


@dataclass
class Model:
    """All trees in one: rows of ``costs`` hold the bits in every language.

    ``symbols`` has the row of every run of bytes that some language knows, with all escapes down
    to the context that knows its last byte; ``escapes`` that of leaving a context. The last row
    is the cost of a byte that no language knows.
    """

    languages: list[str]
    symbols: dict[bytes, int]
    escapes: dict[bytes, int]
    costs: np.ndarray
    order: int

    @classmethod
    def merged(cls, trees: dict[str, Tree], order: int) -> Model:
        own = list(trees.values())
        known = sorted({g for t in own for g in t.symbols})
        contexts = sorted({c for t in own for c in t.escapes})
        rows = [[t.after(g) for t in own] for g in known]
        rows += [[t.escapes.get(c, 0.0) for t in own] for c in contexts] + [[8.0] * len(own)]
        places = {c: len(known) + i for i, c in enumerate(contexts)}
        return cls(list(trees), {g: i for i, g in enumerate(known)}, places, np.array(rows).reshape(len(rows), len(own)), order)


class Coder(dict):
    """Code lengths of whole texts in all languages; knows the row in ``lengths`` of each word, -1 without a letter."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.lengths, self.used = np.zeros((1024, len(self.model.languages))), 0

    def steps(self, word: bytes) -> list[int]:
        """Rows of ``costs`` that coding a word adds up."""
        symbols, escapes, order = self.model.symbols, self.model.escapes, self.model.order
        coded, found = b" " + word + b" ", []
        for i in range(1, len(coded)):
            gram = coded[i - order if i > order else 0 : i + 1]
            row = symbols.get(gram)
            while row is None:
                out = escapes.get(gram[:-1])
                if out is not None:
                    found.append(out)
                gram = gram[1:]
                row = symbols.get(gram) if gram else -1
            found.append(row)
        return found

    def learn(self, new: Iterable[bytes]) -> None:
        """Remember new words, but for very long ones."""
        steps, starts = [], []
        for word in new:
            if not any(map(str.isalpha, word.decode("utf-8", "replace"))):
                self[word] = -1
                continue
            if len(word) <= LONGEST_REMEMBERED:
                self[word] = self.used + len(starts)
                starts.append(len(steps))
                steps += self.steps(word)
        if starts:
            while self.used + len(starts) > len(self.lengths):
                self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.lengths[self.used : self.used + len(starts)] = np.add.reduceat(self.model.costs[steps], starts)
            self.used += len(starts)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the likelihood, all languages alike at first; ``und, 0`` without a letter."""
        own = words((text or "").lower())
        if len(self) > REMEMBERED:
            self.forget()
        self.learn([w for w in set(own) if w not in self])
        total = np.zeros(len(self.model.languages))
        long = [w for w in own if len(w) > LONGEST_REMEMBERED and w not in self]
        for word in long:
            total += self.model.costs[self.steps(word)].sum(axis=0)
        rows = np.array([self.get(w, -1) for w in own] if long else [self[w] for w in own], np.int64)
        rows = rows[rows >= 0]
        if not self.model.languages or not len(rows) + len(long):
            return "und", 0.0
        total += self.lengths[rows].sum(axis=0)
        best = int(total.argmin())
        return self.model.languages[best], float(1 / np.exp2(np.maximum(total[best] - total, -1000)).sum())


def sample(documents: DataFrame, lang: str, text: str, rows_per_language: int) -> DataFrame:
    """Up to ``rows_per_language`` different texts of each language, those with the smallest hashes."""
    known = documents.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("hash")
    )
    smallest = Window.partitionBy("lang").orderBy("hash")
    bounds = (
        known.select("lang", "hash").distinct()
        .withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= rows_per_language)
        .groupBy("lang").agg(F.max("hash").alias("last"))
    )
    # one row for each language
    return known.join(F.broadcast(bounds), "lang").filter("hash <= last").dropDuplicates(["lang", "hash"]).select("lang", "text")


def train(
    documents: DataFrame,
    lang: str = "lang",
    text: str = "text",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    order: int = ORDER,
) -> Model:
    """Count the contexts of a bounded sample of labelled whole texts and freeze them.

    Rows with a null language or text teach nothing; without any others the model knows no
    language and predicts ``und``. Copies count once.
    """
    spoken = (
        sample(documents, lang, text, rows_per_language)
        .select("lang", F.explode(F.split(F.lower("text"), r"\s+")).alias("word"))
        .filter(F.col("word").rlike(r"\p{L}"))
        .groupBy("lang", "word").agg(F.count("*").alias("n"))
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple[str, bytes], int] = defaultdict(int)
        for batch in batches:
            for language, word, n in batch.itertuples(index=False):
                for part in words(word):
                    for gram in grams(part, order):
                        counts[language, gram] += n
        rows = [(language, gram, n) for (language, gram), n in counts.items()]
        yield pd.DataFrame(rows, columns=["lang", "gram", "n"])

    counted = spoken.mapInPandas(count, "lang string, gram binary, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_language: dict[str, dict[bytes, int]] = defaultdict(dict)
    # as many contexts as the bounded sample has
    for language, gram, n in counted.collect():
        by_language[language][bytes(gram)] = n
    return Model.merged({x: Tree.frozen(by_language[x]) for x in sorted(by_language)}, order)


def predict(documents: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred and score of every whole text; nothing but the text is looked at.

    Null texts and texts without a letter are ``und`` with score 0. Ties go to the first
    language by name. Repeated rows stay, and an empty table stays empty.
    """
    spark = documents.sparkSession
    chosen = documents.select(*keep, F.col(text).alias("_text"))
    # plain values, bounded like the sample; a worker keeps its coder beside them for its next tasks
    shared = spark.sparkContext.broadcast({"model": (model.languages, model.symbols, model.escapes, model.costs, model.order)})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        coder = own["coder"] if "coder" in own else own.setdefault("coder", Coder(Model(*own["model"])))
        for batch in batches:
            last = batch.num_columns - 1
            found = [coder.predict(t.as_py()) for t in batch.column(last)]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            kept = batch.select(list(range(last)))
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, "lang_pred", "score"])

    return chosen.mapInArrow(judge, extended(chosen.schema.fields[:-1], "lang_pred string, score double"))


def fold(doc_id: str, folds: int) -> Column:
    """The remainder of the checksum of the id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
