"""From raw actions to one rating per portal, user and item.

``by`` names the columns inside which everything is computed: the portal, or the run
and the portal when several runs are rated at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_groups
from ..session import lean_cut

PORTAL = ("portal",)

# Raw action names, the groups they fall into, and the weighted actions.
PULL_ACTIONS = ["VIDEO_GETDEFAULTEMBEDCODE", "DOWNLOAD"]
ENTER_ACTIONS = ["ENTERCAMPAIGNSTAB", "RETURNCAMPAIGNOVERVIEW", "ENTERPRODUCT"]
NOISE_ACTIONS = ["ENTERCAMPAIGNSTARTMARKETING", "CLOSEASSETPREVIEW", "CLOSESETUPASSETS"]
WEIGHTED_ACTIONS = [
    "PULL",
    "SETUPASSETS",
    "OPENASSETPREVIEW",
    "ENTERCAMPAIGNOVERVIEW",
    "CAMPAIGNSTATUS",
    "ACTIVATECAMPAIGN",
]


def normalized_action(action: Column) -> Column:
    """Common name of an action. Campaign downloads are activations, so they are named first."""
    return (
        F.when(action == "DOWNLOADCAMPAIGN", "ACTIVATECAMPAIGN")
        .when(action.contains("DOWNLOAD") | action.isin(PULL_ACTIONS), "PULL")
        .when(action.isin(ENTER_ACTIONS), "ENTERCAMPAIGNOVERVIEW")
        .otherwise(action)
    )


def normalize_actions(activity: DataFrame) -> DataFrame:
    """Drop rows without portal or action and noise actions; give the rest common names."""
    known = activity.filter(F.col("portal").isNotNull() & F.col("action").isNotNull())
    return known.filter(~F.col("action").isin(NOISE_ACTIONS)).withColumn(
        "action", normalized_action(F.col("action"))
    )


def count_actions(actions: DataFrame, by: Sequence[str] = PORTAL) -> DataFrame:
    """Collapse repeated actions to counts, map-side, before anything else shuffles."""
    return actions.groupBy(*by, "user_id", "item_id", "action").agg(F.count("*").alias("n"))


def sum_counts(counted: DataFrame, by: Sequence[str] = PORTAL) -> DataFrame:
    """Counts of several parts, such as stretches of time, as one."""
    return counted.groupBy(*by, "user_id", "item_id", "action").agg(F.sum("n").alias("n"))


def action_weights(counted: DataFrame, by: Sequence[str] = PORTAL) -> DataFrame:
    """All actions of the portal divided by the actions of a listed type; other types weigh 0."""
    per_type = counted.groupBy(*by, "action").agg(F.sum("n").alias("actions"))
    totals = per_type.groupBy(*by).agg(F.sum("actions").alias("total"))
    weight = F.when(F.col("action").isin(WEIGHTED_ACTIONS), F.col("total") / F.col("actions")).otherwise(0.0)
    return per_type.join(totals, list(by)).select(*by, "action", "actions", weight.alias("weight"))


def user_item_rating(counted: DataFrame, by: Sequence[str] = PORTAL, low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Mean weight of the user's actions on the item, rescaled to [low, high] inside ``by``."""
    weights = action_weights(counted, by).select(*by, "action", "weight")
    scored = (
        join_groups(counted, weights, [*by, "action"], within=counted)
        .groupBy(*by, "user_id", "item_id")
        .agg((F.sum(F.col("weight") * F.col("n")) / F.sum("n")).alias("score"))
    )
    # rounding keeps equal scores equal whatever the summation order; the cut keeps the
    # spans below from scoring everything again
    scored = lean_cut(scored.withColumn("score", F.round("score", 10)))
    spans = scored.groupBy(*by).agg(F.min("score").alias("_min"), F.max("score").alias("_max"))
    share = F.coalesce(
        F.try_divide(F.col("score") - F.col("_min"), F.col("_max") - F.col("_min")), F.lit(0.0)
    )
    return join_groups(scored, spans, by, within=scored).select(
        *by, "user_id", "item_id", F.round(low + (high - low) * share, 10).alias("rating")
    )


def rate(activity: DataFrame, by: Sequence[str] = PORTAL) -> DataFrame:
    """Activity straight to ratings; the activity is read once, for its counts."""
    return user_item_rating(lean_cut(count_actions(normalize_actions(activity), by)), by)
