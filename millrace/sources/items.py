"""Item texts and the items each portal offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attribute_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """(item_id, attribute, value) rows to one column per attribute, the largest value of each."""
    return rows.groupBy("item_id").pivot("attribute", names).agg(F.max("value"))


def joined_names(pairs: DataFrame) -> DataFrame:
    """Distinct names per item in one sorted, |-separated text."""
    distinct = pairs.select("item_id", "name").distinct()
    return distinct.groupBy("item_id").agg(F.array_join(F.sort_array(F.collect_list("name")), "|").alias("marketplaces"))


def bag_of_words(items: DataFrame, attributes: DataFrame, marketplaces: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Upper-cased text of an item: name, attributes, marketplaces.

    Items without attributes get the defaults; items without a marketplace are left out.
    """
    wide = attribute_columns(attributes, list(defaults))
    filled = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default)) for c, default in defaults.items()]
    places = F.replace(F.replace(F.col("marketplaces"), F.lit(" "), F.lit("")), F.lit("|"), F.lit(" "))
    words = F.concat_ws(" ", F.trim(F.coalesce(F.nullif("display_name", F.lit("")), F.col("name"))), *filled, places)
    return (
        items.join(wide, "item_id", "left")
        .join(joined_names(marketplaces), "item_id")
        .select("item_id", F.upper(words).alias("bag_of_words"))
        .distinct()
    )


def portal_items(pairs: DataFrame) -> DataFrame:
    """Upper-cased portal name and item, each pair once."""
    return pairs.select(F.upper("portal").alias("portal"), "item_id").distinct()
