"""Views over the driver tables that play the recommender's inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread
from .tables import Tables


def _action_name() -> Column:
    kind, event = F.col("event_type"), F.col("event_id")

    def pick(values: list[Column | str]) -> Column:
        names = F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values])
        return F.element_at(names, (event % len(values) + 1).cast("int"))

    return (
        F.when(
            kind == "view",
            pick(["ENTERCAMPAIGNOVERVIEW", "ENTERCAMPAIGNSTAB", "RETURNCAMPAIGNOVERVIEW", "ENTERPRODUCT"]),
        )
        .when(kind == "click", pick(["OPENASSETPREVIEW", "CAMPAIGNSTATUS"]))
        .when(kind == "purchase", pick(["ACTIVATECAMPAIGN", "DOWNLOADCAMPAIGN"]))
        .when(kind == "signup", F.lit("SETUPASSETS"))
        .when(
            kind == "error",
            pick(
                [
                    "CLOSEASSETPREVIEW",
                    "CLOSESETUPASSETS",
                    "ENTERCAMPAIGNSTARTMARKETING",
                    F.concat(F.lit("DOWNLOAD_"), F.col("item_id").cast("string")),
                    "VIDEO_GETDEFAULTEMBEDCODE",
                    "OTHERACTION",
                ]
            ),
        )
    )


def activity(t: Tables) -> DataFrame:
    """One row per user action: user, item, action, time, portal, session, test flag."""
    portals = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("portal"))
    )
    return (
        spread(t.events).withColumn("item_id", F.get_json_object("props", "$.k").cast("bigint"))
        .join(portals, "user_id")
        .select(
            "user_id",
            "item_id",
            _action_name().alias("action"),
            "ts",
            "portal",
            (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("session_id"),
            (F.col("user_id") % 2).cast("int").alias("is_test_user"),
        )
    )


def job_runs(t: Tables) -> DataFrame:
    """A run ledger: one run per week of events, the second of every four failed."""
    week = F.date_trunc("week", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz")
    weeks = t.events.select(week.alias("week")).distinct()
    # one row per week of history, so this window stays as small as the ledger
    return weeks.select(
        F.row_number().over(Window.orderBy("week")).cast("bigint").alias("run_id"),
        (F.col("week") + F.expr("INTERVAL '60' HOUR")).alias("start_time"),
    ).withColumn("status", F.when(F.col("run_id") % 4 == 2, "Failed").otherwise("Completed"))


def item_bags(t: Tables) -> DataFrame:
    """item_id and upper-cased bag of words."""
    words = F.concat_ws(" ", "p_name", F.regexp_replace("p_brand", "#", ""), "p_type")
    return t.part.select(F.col("p_partkey").alias("item_id"), F.upper(words).alias("bag_of_words"))


def order_ratings(t: Tables) -> DataFrame:
    """Product ratings in long form: customers rating the parts they bought, one row per pair."""
    rating = 1 + (F.col("l_quantity") - 1) % 5
    return (
        t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.avg(rating).alias("rating"))
        .withColumn("portal", F.lit("ALL"))
    )


# The same views as common table expressions for the SQL side of each check.
ACTIVITY_SQL = """
activity AS (
  SELECT e.user_id, e.item_id,
    CASE e.event_type
      WHEN 'view' THEN CASE e.event_id % 4 WHEN 0 THEN 'ENTERCAMPAIGNOVERVIEW' WHEN 1 THEN 'ENTERCAMPAIGNSTAB'
                            WHEN 2 THEN 'RETURNCAMPAIGNOVERVIEW' ELSE 'ENTERPRODUCT' END
      WHEN 'click' THEN CASE e.event_id % 2 WHEN 0 THEN 'OPENASSETPREVIEW' ELSE 'CAMPAIGNSTATUS' END
      WHEN 'purchase' THEN CASE e.event_id % 2 WHEN 0 THEN 'ACTIVATECAMPAIGN' ELSE 'DOWNLOADCAMPAIGN' END
      WHEN 'signup' THEN 'SETUPASSETS'
      WHEN 'error' THEN CASE e.event_id % 6 WHEN 0 THEN 'CLOSEASSETPREVIEW' WHEN 1 THEN 'CLOSESETUPASSETS'
                             WHEN 2 THEN 'ENTERCAMPAIGNSTARTMARKETING'
                             WHEN 3 THEN 'DOWNLOAD_' || CAST(e.item_id AS VARCHAR)
                             WHEN 4 THEN 'VIDEO_GETDEFAULTEMBEDCODE' ELSE 'OTHERACTION' END
    END AS action,
    e.ts, r_name AS portal, e.user_id * 100 + day(e.ts) AS session_id,
    CAST(e.user_id % 2 AS INTEGER) AS is_test_user
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events) e
  JOIN customer ON c_custkey = e.user_id
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""

JOB_RUNS_SQL = """
job_runs AS (
  SELECT run_id, week + INTERVAL 60 HOUR AS start_time,
         CASE WHEN run_id % 4 = 2 THEN 'Failed' ELSE 'Completed' END AS status
  FROM (SELECT week, CAST(row_number() OVER (ORDER BY week) AS BIGINT) AS run_id
        FROM (SELECT DISTINCT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week FROM events)))"""

ORDER_RATINGS_SQL = """
order_ratings AS (
  SELECT 'ALL' AS portal, o_custkey AS user_id, l_partkey AS item_id, avg(1 + (l_quantity - 1) % 5) AS rating
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"""
