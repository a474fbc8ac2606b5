"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import threading
import uuid
from typing import NamedTuple
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# tables that were cut, as long as somebody holds them, and their bytes once these are asked for
_BYTES: WeakKeyDictionary[DataFrame, int | None] = WeakKeyDictionary()
_SETTING = threading.Lock()

ROWS_PER_BUCKET = 500_000


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def released(df: DataFrame) -> DataFrame:
    """``df`` for one action, after which the shuffle files that it has made are removed."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with _SETTING:  # a plan keeps the setting under which it was made
        before = conf.get(name, None)
        conf.set(name, "true")
        try:
            return df.select("*")
        finally:
            conf.unset(name) if before is None else conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget how it was made.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; a temporary
    one is set only where neither that setting nor the context has any. What is stored
    can be measured cheaply (:func:`known_bytes`).
    """
    shared_folder(df.sparkSession)
    stored = df.checkpoint(eager=True)
    _BYTES[stored] = None
    return stored


def lean_cut(df: DataFrame) -> DataFrame:
    """:func:`cut`, after which the shuffle files that led to ``df`` are removed."""
    return cut(released(df))


def _row_bytes(df: DataFrame) -> Column | None:
    """Bytes of a row's numbers and strings; None if it has other columns."""
    fixed, text = 8, []
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            text.append(F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)))
        elif kind.startswith(("array", "map", "struct", "variant")):
            return None
        fixed += 8
    return sum((t.cast("bigint") for t in text), F.lit(fixed).cast("bigint"))


def known_bytes(df: DataFrame) -> int | None:
    """Bytes of all rows, if ``df`` is a table of plain columns that :func:`cut` has stored; measured once.

    An observation while the table is stored would save the job, but a session that has observed
    something can no longer be sent along with MLlib's summaries.
    """
    if df not in _BYTES:
        return None
    width = _row_bytes(df)
    if _BYTES[df] is None and width is not None:
        _BYTES[df] = df.agg(F.sum(width)).first()[0] or 0
    return _BYTES[df]


def spread(df: DataFrame, stored: bool = False) -> DataFrame:
    """``df``, dealt out anew if it lies in fewer pieces than there are cores; for heavy work on each row of a small file.

    ``stored`` keeps what was dealt out, for several passes over it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return cut(df.repartition(cores)) if stored else df.repartition(cores)


def shuffle_width(df: DataFrame) -> int:
    """Task count for stages that are bound by computation rather than by bytes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach: the checkpoint folder of this application."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()


class Bucketed(NamedTuple):
    """Rows that lie in hash buckets, under a name in the session's catalog."""

    rows: DataFrame
    name: str

    def release(self) -> None:
        """Take the name out of the catalog once nothing will read the rows again; the files stay in the shared folder."""
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def bucketed(df: DataFrame, keys: list[str]) -> Bucketed:
    """Write ``df`` to the shared folder in hash buckets of ``keys``.

    Joins and groupings on the same keys then read it in place, as often as they like.
    The number of buckets follows the rows, so their size does not grow.
    """
    spark = df.sparkSession
    name = f"millrace_{uuid.uuid4().hex}"
    width = max(1, -(-df.count() // ROWS_PER_BUCKET))
    (
        df.repartition(width, *keys)
        .write.format("parquet")
        .option("path", f"{shared_folder(spark)}/{name}")
        .bucketBy(width, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    return Bucketed(spark.table(name), name)
