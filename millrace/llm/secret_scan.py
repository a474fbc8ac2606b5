"""Secret scans over a ledger of blobs.

Every version of a text is addressed by the hash of its content. The ledger remembers which
version of which rule has read which blob and what it found, so that a scan reads a blob only
for the rules that have not seen it, however many paths and revisions hold it. Findings go
back to all paths by the address.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules. A run of 16 hex digits or of 14 after AKIA is the whole
# of the longer run that the unbounded pattern takes, so the length can stand in the pattern.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# A private key reaches to its end mark; without one, as far as words of 16 or more base64 characters follow.
# The repetitions are bounded for the matcher's stack: marks within a key's head, and lines of a key.
PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+){0,64}-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:[\x09-\x0D\x20]+[A-Za-z0-9+/=]{16,}){0,512})"
)
RULES = (
    Rule("assign", 1, ASSIGN, 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
    Rule("pem", 2, PEM),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("prefixed", 1, r"gh[opsru]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"),
    Rule("login", 1, r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20:/@]+:[^\x00-\x20:/@]+@"),
)
SPANS = "array<struct<start:int,stop:int>>"
SCANS = f"array<struct<rule:string,spans:{SPANS}>>"


@dataclass(frozen=True)
class Ledger:
    """A parquet table ``blob, scans``: what each rule version found in each blob; a blob may have several rows."""

    spark: SparkSession
    folder: str

    @classmethod
    def new(cls, spark: SparkSession, folder: str | None = None) -> Ledger:
        """Open the ledger in ``folder``, or start an empty one below the shared folder."""
        ledger = cls(spark, folder or f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
        empty = spark.createDataFrame([], f"blob string, scans {SCANS}")
        empty.write.mode("ignore").parquet(ledger.folder)
        return ledger

    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"blob string, scans {SCANS}").parquet(self.folder)

    def seen(self) -> DataFrame:
        """Per blob the rule versions that have read it."""
        return self.rows().groupBy("blob").agg(
            F.flatten(F.collect_list(F.transform("scans", lambda s: s["rule"]))).alias("seen")
        )

    def found(self, rules: Sequence[Rule]) -> DataFrame:
        """Per blob with findings: ``spans`` of these rule versions by start, then in the order of the rules.

        A scan that was written twice, by two runs at once, counts once.
        """
        names = [r.name for r in rules]
        scans = self.rows().select(
            "blob", F.filter("scans", lambda s: s["rule"].isin(names) & (F.size(s["spans"]) > 0)).alias("scans")
        )
        return (
            scans.filter(F.size("scans") > 0)
            .groupBy("blob")
            .agg(F.array_distinct(F.flatten(F.collect_list("scans"))).alias("scans"))
            .select("blob", F.flatten(F.transform("scans", lambda s: _placed(s, names))).alias("spans"))
            .select("blob", F.sort_array("spans").alias("spans"))
        )


def _placed(scan: Column, names: Sequence[str]) -> Column:
    place = F.coalesce(*[F.when(scan["rule"] == n, F.lit(i)) for i, n in enumerate(names)])
    kind = F.substring_index(scan["rule"], "@", 1)
    return F.transform(
        scan["spans"],
        lambda s: F.struct(s["start"].alias("start"), place.alias("place"), kind.alias("kind"), s["stop"].alias("stop")),
    )


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Read ``_text`` of each blob for the rules named in its ``todo``; ``scans`` has an entry for each of them, found or not.

    ``split`` gives what lies between the matches, so the lengths of both add up to the places of
    the matches in code points. A text without a match costs one pass of the pattern.
    """
    cut = blobs
    for i, rule in enumerate(rules):
        asked = F.array_contains("todo", rule.name) & F.col("_text").rlike(rule.pattern)
        pattern = F.lit(rule.pattern)
        cut = cut.withColumn(f"_all{i}", F.when(asked, F.regexp_extract_all("_text", pattern, F.lit(0))))
        cut = cut.withColumn(f"_part{i}", F.when(asked, F.regexp_extract_all("_text", pattern, F.lit(rule.group))))
        cut = cut.withColumn(f"_gaps{i}", F.when(asked, F.split("_text", rule.pattern)))
    done = cut.drop("_text")
    for i, rule in enumerate(rules):
        step = (
            f"aggregate(sequence(0, size(_all{i}) - 1), struct(0 AS at, CAST(array() AS {SPANS}) AS spans), (a, k) -> struct("
            f"a.at + length(_gaps{i}[k]) + length(_all{i}[k]) AS at, if(length(_part{i}[k]) >= {rule.least}, array_append(a.spans, "
            f"struct(a.at + length(_gaps{i}[k]) AS start, a.at + length(_gaps{i}[k]) + length(_all{i}[k]) AS stop)), a.spans) AS spans"
            f"), a -> a.spans)"
        )
        spans = F.expr(f"if(_all{i} IS NULL, CAST(array() AS {SPANS}), {step})")
        done = done.withColumn(
            f"_scan{i}",
            F.when(F.array_contains("todo", rule.name), F.struct(F.lit(rule.name).alias("rule"), spans.alias("spans"))),
        )
    scans = F.filter(F.array(*[F.col(f"_scan{i}") for i in range(len(rules))]), lambda s: s.isNotNull())
    return done.select("blob", scans.cast(SCANS).alias("scans"))


def scan_versions(
    versions: DataFrame,
    ledger: Ledger,
    rules: Sequence[Rule] = RULES,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """``keep`` columns, ``blob`` and ``spans`` (start, place, kind, stop; code points, stop exclusive) of every row.

    Null texts count as empty; texts without findings have an empty array. Equal rows stay
    separate rows. One text for each blob crosses the shuffle: copies meet in the map tasks
    first. Blobs and pairs already in the ledger are not read again; new ones are added to it.
    """
    addressed = versions.select(*keep, F.coalesce(text, F.lit("")).alias("_text")).withColumn("blob", F.sha2("_text", 256))
    names = F.array(*[F.lit(r.name) for r in rules])
    blobs = addressed.groupBy("blob").agg(F.first("_text").alias("_text"))
    unseen = (
        blobs.join(ledger.seen(), "blob", "left")
        .withColumn("todo", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
        .filter(F.size("todo") > 0)
    )
    scan(unseen.select("blob", "_text", "todo"), rules).write.mode("append").parquet(ledger.folder)
    return (
        addressed.select(*keep, "blob")
        .join(ledger.found(rules), "blob", "left")
        .withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:int,place:int,kind:string,stop:int>>")))
    )


def span_text(spans: Column) -> Column:
    """``kind:start:stop``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def masked(text: str, spans: str, mark: str = "[secret]") -> Column:
    """``text`` with every span replaced by ``mark``; spans that overlap become one."""
    return F.expr(
        f"aggregate({spans}, struct('' AS done, 0 AS at), (a, s) -> if(s.stop <= a.at, a, struct("
        f"if(s.start < a.at, a.done, concat(a.done, substring({text}, a.at + 1, s.start - a.at), '{mark}')) AS done, s.stop AS at)), "
        f"a -> concat(a.done, substring({text}, a.at + 1, length({text}) - a.at)))"
    )
