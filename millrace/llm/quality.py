"""Quality rules: a table of thresholds, compiled into column expressions over one scan.

Everything is measured inside the row, so no text is shuffled; repeated word windows are
found by sorting the windows of a text against each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is was for that on with as at by be or an this from are it his her not have has "
    "der die das und ist von den mit des dem ein eine zu im auf nicht sich als auch für er sie es "
    "le la les des et est de du un une dans que qui pour pas sur avec au ce il "
    "el los las y del se por con una no su para como lo más o pero"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low <= measure <= high``; a side that is None is open, and so is a missing measure."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def passed(self) -> Column:
        value = F.expr(self.measure)
        sides = [value >= self.low] if self.low is not None else []
        sides += [value <= self.high] if self.high is not None else []
        result = F.lit(True)
        for side in sides:
            result = result & side
        return F.coalesce(result, F.lit(True))


#: Measures are SQL over the counts of :func:`measured`; a division by zero words or lines gives no measure.
RULES = (
    Rule("mean_word_length", "try_divide(word_chars, n_words)", 2.0, 15.0),
    Rule("symbols_per_word", "try_divide(n_symbols, n_words)", None, 0.25),
    Rule("stop_word_ratio", "try_divide(n_stop_words, n_words)", 0.02, None),
    Rule("duplicate_line_ratio", "try_divide(n_dup_lines, n_lines)", None, 0.5),
    Rule("bullet_line_ratio", "try_divide(n_bullet_lines, n_lines)", None, 0.9),
    Rule("ellipsis_line_ratio", "try_divide(n_ellipsis_lines, n_lines)", None, 0.5),
)


def measured(documents: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and the counts of each whole text; null counts as empty, and an empty text has zeros."""
    stop_words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    split = documents.select(*keep, F.coalesce(text, F.lit("")).alias("_text")).select(
        *keep,
        "_text",
        F.filter(F.split("_text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.translate(x, SPACE, "") != "").alias("_lines"),
    )
    windows = split.withColumn(
        "_windows",
        F.expr(
            "if(size(_words) < 3, array(), sort_array(transform(sequence(0, size(_words) - 3), i -> "
            "struct(concat_ws(' ', _words[i], _words[i + 1], _words[i + 2]) AS w, i))))"
        ),
    )
    repeated = windows.withColumn(
        "_repeats",
        F.expr(
            "array_sort(transform(filter(transform(_windows, (x, k) -> struct(x.i AS i, "
            "coalesce(x.w = get(_windows, k - 1).w, false) OR coalesce(x.w = get(_windows, k + 1).w, false) AS twice)), "
            "x -> x.twice), x -> x.i))"
        ),
    )
    return repeated.select(
        *keep,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.translate("_text", SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(
            "aggregate(transform(_repeats, (p, k) -> least(3, coalesce(get(_repeats, k + 1) - p, 3))), 0L, (a, x) -> a + x)"
        ).alias("n_repeat_words"),
        F.expr(f"size(filter(_words, w -> lower(w) IN ({stop_words})))").cast("bigint").alias("n_stop_words"),
        F.expr(r"size(filter(_lines, x -> x RLIKE '^[ \\t]*[-*•]'))").cast("bigint").alias("n_bullet_lines"),
        F.expr(r"size(filter(_lines, x -> x RLIKE '(…|\\.\\.\\.)[ \\t\\r]*$'))").cast("bigint").alias("n_ellipsis_lines"),
    )


def judge(
    documents: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Counts, ``base_failed``, the names of the rules each text breaks, and ``kept``.

    A text fails the base below 50 words or if more than half of its words lie in repeated
    three-word windows. Repeated rows are judged one by one; other columns are not read.
    """
    counts = measured(documents, keep, text)
    broken = F.filter(
        F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules], F.lit(None).cast("string")), lambda x: x.isNotNull()
    )
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return counts.select(
        *keep, *[c for c in counts.columns if c not in keep],
        failed.alias("base_failed"), broken.alias("broken_rules"), (~failed & (F.size(broken) == 0)).alias("kept"),
    )
