"""URL rules as nested key intervals, met with the urls in one sorted sweep.

A host is written backwards, ``tionsh.example.net`` as ``net.example.tionsh.``. All hosts a
rule covers then start with the rule's own key, so they lie in one interval of the sorted
keys: from ``net.example.`` up to ``net.example/``, as ``/`` follows ``.``. Two such
intervals are nested or apart. At every border between intervals the rules in force are
known: the stack of the hosts that contain the place. Urls and borders are range-partitioned
together by key; each url takes the stack of the last border before it, and each partition
starts with the stack that the partitions before it have left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE = "struct<host:string,path:string,verdict:string,key:string>"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both are empty for null and where ``://`` is missing."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    """The labels from right to left, each closed by a point."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def borders(rules: DataFrame) -> DataFrame:
    """Every place where the rules in force change: ``key`` and ``stack``, outermost host first.

    ``rules`` has host, path and verdict. The rules of one host travel as one array, so a
    stack is as long as the rules on a host and the hosts above it. Rows without a host or
    verdict are void; a missing path covers the whole host.
    """
    hosts = (
        rules.filter(F.col("host").isNotNull() & F.col("verdict").isNotNull())
        .select(
            F.translate("host", UPPER, LOWER).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "verdict",
        )
        .distinct()
        .withColumn("key", host_key(F.col("host")))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("host", "path", "verdict", "key"))).alias("own"))
    )
    labels = F.split(F.col("key"), r"\.")
    above = hosts.select(
        "key",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels) - 1),
                lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")),
            )
        ).alias("outer"),
    )
    stacks = (
        above.join(hosts.select(F.col("key").alias("outer"), "own"), "outer")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("outer", "own"))).alias("nested"))
        .select("key", F.flatten(F.col("nested.own")).alias("stack"))
    )
    ends = stacks.select(
        F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/")).alias("key"),
        F.expr("filter(stack, r -> r.key != key)").alias("stack"),
    )
    return stacks.unionByName(ends)


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",), default: str = "allow"
) -> DataFrame:
    """``keep`` columns with host, path, the rule that decides and its verdict.

    Of the rules that fit host and path the longest text ``host`` + ``path`` wins, then the
    longer host, then ``block``. Urls without a fitting rule get a null rule and ``default``.
    Null urls, urls without ``://`` and empty hosts fit no rule. Repeated rows stay repeated,
    an empty table gives an empty result, and other columns of ``pages`` are not read. Many
    urls of one host share a key; a hash of the row spreads them over several partitions.
    """
    host, path = url_parts(F.col(url))
    urls = pages.select(F.struct(*keep).alias("page"), host.alias("host"), path.alias("path"), F.xxhash64(*keep, url).alias("spread"))
    least = F.lit(-(2**63)).cast("bigint")
    events = urls.select(
        host_key(F.col("host")).alias("key"), "spread", "page", "host", "path",
        F.lit(None).cast(f"array<{RULE}>").alias("stack"), F.lit(True).alias("is_url"),
    ).unionByName(
        borders(rules).select("key", least.alias("spread"), "stack", F.lit(False).alias("is_url")),
        allowMissingColumns=True,
    )
    ranged = cut(events.repartitionByRange("key", "spread", "is_url").withColumn("slice", F.spark_partition_id()))

    # one row for each range partition
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy("slice")
        .agg(F.max(F.when(~F.col("is_url"), F.struct("key", "stack"))).alias("end"))
        .select("slice", F.last("end.stack", ignorenulls=True).over(earlier).alias("carried"))
    )
    sweep = Window.partitionBy("slice").orderBy("key", "spread", "is_url").rowsBetween(Window.unboundedPreceding, 0)
    active = (
        ranged.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
        .filter("is_url")
        .join(carried, "slice", "left")
        .withColumn("stack", F.coalesce("stack", "carried", F.array().cast(f"array<{RULE}>")))
    )
    best = F.array_max(
        F.transform(
            F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"])),
            lambda r: F.struct(
                F.length(F.concat(r["host"], r["path"])).alias("size"),
                F.length(r["host"]).alias("depth"),
                r["verdict"].alias("verdict"),
                F.concat(r["host"], r["path"]).alias("rule"),
            ),
        )
    )
    return active.withColumn("best", best).select(
        "page.*", "host", "path",
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
