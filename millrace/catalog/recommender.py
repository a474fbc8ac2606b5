"""Recommender queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ordering
from ..operators.ordering import hash_unit
from ..plans import collaborative, content, lists, ratings
from ..session import cut
from ..sources import items, standins
from ..sources.tables import Tables
from . import recommender_sql as q
from .registry import query

ACTIVITY = standins.ACTIVITY_SQL
RATED = (ACTIVITY, q.normalized(), q.rated())
SIMILAR = (*RATED, q.baselines(), q.similarity())
PREDICTED = (*SIMILAR, q.predicted())


def rated(t: Tables) -> DataFrame:
    return ratings.rate(standins.activity(t))


@query(
    "normalize_actions",
    q.chain(
        ACTIVITY,
        q.normalized(),
        select="SELECT portal, action, is_test_user, count(*) AS actions, count(DISTINCT item_id) AS items FROM normalized GROUP BY ALL",
    ),
)
def normalize_actions(t: Tables) -> DataFrame:
    return (
        ratings.normalize_actions(standins.activity(t))
        .groupBy("portal", "action", "is_test_user")
        .agg(F.count("*").alias("actions"), F.countDistinct("item_id").alias("items"))
    )


@query(
    "action_weights",
    q.chain(*RATED, select="SELECT portal, action, actions, round(CAST(weight AS DOUBLE), 6) AS weight FROM weights"),
)
def action_weights(t: Tables) -> DataFrame:
    counted = ratings.count_actions(ratings.normalize_actions(standins.activity(t)))
    return ratings.action_weights(counted).withColumn("weight", F.round("weight", 6))


@query(
    "user_item_rating",
    q.chain(*RATED, select="SELECT portal, user_id, item_id, round(rating, 6) AS rating FROM ratings"),
)
def user_item_rating(t: Tables) -> DataFrame:
    return rated(t).withColumn("rating", F.round("rating", 6))


@query(
    "trending_top20",
    q.chain(*RATED, q.trending(), select="SELECT portal, item_id, round(rating, 6) AS rating, rank FROM trend"),
)
def trending_top20(t: Tables) -> DataFrame:
    return lists.trending(rated(t)).withColumn("rating", F.round("rating", 6))


@query(
    "own_past_top20",
    q.chain(*RATED, q.own_past(), select="SELECT portal, user_id, item_id, round(rating, 6) AS rating, rank FROM past"),
)
def own_past_top20(t: Tables) -> DataFrame:
    return lists.own_past_top(rated(t)).withColumn("rating", F.round("rating", 6))


@query(
    "rating_baselines",
    q.chain(
        *RATED,
        q.baselines(),
        select="""SELECT 'user' AS side, portal, user_id AS id, round(bu, 6) AS b FROM bu10
UNION ALL SELECT 'item', portal, item_id, round(bi, 6) FROM bi10""",
    ),
)
def rating_baselines(t: Tables) -> DataFrame:
    marked = collaborative.offsets(cut(rated(t)))
    sides = [
        marked.groupBy("portal", F.col(f"{side}_id").alias("id")).agg(F.round(F.max(f"{side}_offset"), 6).alias("b")).withColumn("side", F.lit(side))
        for side in ("user", "item")
    ]
    return sides[0].unionByName(sides[1])


@query(
    "user_similarity",
    q.chain(
        *SIMILAR,
        select="""SELECT portal, user_id, neighbour_id, round(s, 6) AS similarity,
  CAST(row_number() OVER (PARTITION BY portal, user_id ORDER BY s DESC, neighbour_id) AS INTEGER) AS rank
FROM sims QUALIFY rank <= 20""",
    ),
)
def user_similarity(t: Tables) -> DataFrame:
    nearest = collaborative.nearest_users(collaborative.residuals(cut(rated(t))))
    return nearest.withColumn("similarity", F.round("similarity", 6))


@query(
    "knn_predict",
    q.chain(
        *PREDICTED,
        select="SELECT portal, user_id, item_id, round(rating, 5) AS rating, neighbours FROM predicted",
    ),
)
def knn_predict(t: Tables) -> DataFrame:
    predicted = collaborative.knn_predict(collaborative.residuals(cut(rated(t))))
    return predicted.withColumn("rating", F.round("rating", 5))


@query(
    "top_neighbours",
    q.chain(
        *PREDICTED,
        select="""SELECT portal, user_id, string_agg(CAST(neighbour_id AS VARCHAR), ',' ORDER BY s DESC, neighbour_id) AS neighbours
FROM (SELECT *, row_number() OVER (PARTITION BY portal, user_id ORDER BY s DESC, neighbour_id) AS place FROM sims)
JOIN (SELECT portal, user_id, arg_min(neighbours, item_id) AS wanted FROM predicted GROUP BY ALL) USING (portal, user_id)
WHERE place <= wanted GROUP BY portal, user_id""",
    ),
)
def top_neighbours(t: Tables) -> DataFrame:
    marked = collaborative.residuals(cut(rated(t)))
    found = collaborative.top_neighbours(marked)
    return found.withColumn("neighbours", F.array_join("neighbours", ","))


@query(
    "cf_top20",
    q.chain(*PREDICTED, q.cf_top(), select="SELECT portal, user_id, item_id, round(rating, 5) AS rating, rank FROM cf"),
)
def cf_top20(t: Tables) -> DataFrame:
    return collaborative.recommend(collaborative.residuals(cut(rated(t)))).withColumn("rating", F.round("rating", 5))


@query(
    "hybrid_top20",
    q.chain(
        *PREDICTED,
        q.cf_top(),
        q.own_past(),
        q.trending(),
        q.hybrid(),
        select="SELECT portal, user_id, item_id, sort_order, model_type FROM hybrid",
    ),
)
def hybrid_top20(t: Tables) -> DataFrame:
    rating = cut(rated(t))
    found = collaborative.recommend(collaborative.residuals(rating))
    return lists.hybrid(lists.own_past_top(rating), found, lists.trending(rating), within=rating)


# ---- ratings in long form, held-out error, one user's suggestions

SPLIT_SQL = """
split_ratings AS (
  SELECT *, CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.3 AS held
  FROM order_ratings WHERE user_id IN (SELECT user_id FROM order_ratings GROUP BY user_id HAVING count(*) >= 50)),
train AS MATERIALIZED (SELECT portal, user_id, item_id, rating FROM split_ratings WHERE NOT held),
test AS MATERIALIZED (SELECT portal, user_id, item_id, rating AS actual FROM split_ratings WHERE held)"""


@query(
    "cf_rmse",
    q.chain(
        standins.ORDER_RATINGS_SQL,
        SPLIT_SQL,
        q.baselines("portal", "train"),
        q.similarity(),
        q.predicted(k=50, min_k=1, cells="SELECT portal, user_id, item_id FROM test").replace("HAVING count(*) >= 2", ""),
        """estimates AS (
  SELECT test.*, CASE WHEN m.user_id IS NULL OR i.item_id IS NULL THEN mu ELSE coalesce(p.rating, m.user_mean) END AS estimate
  FROM test LEFT JOIN predicted p USING (portal, user_id, item_id) LEFT JOIN means m USING (portal, user_id)
  LEFT JOIN (SELECT DISTINCT portal, item_id FROM train) i USING (portal, item_id) JOIN mu USING (portal))""",
        select="SELECT count(*) AS cells, round(sqrt(avg((actual - estimate) ** 2)), 4) AS rmse FROM estimates",
    ),
)
def cf_rmse(t: Tables) -> DataFrame:
    """Root mean squared error on 30 % of the ratings of users with at least 50 of them."""
    everything = standins.order_ratings(t)
    active = everything.groupBy("user_id").agg(F.count("*").alias("n")).filter("n >= 50")
    split = cut(everything.join(active, "user_id", "left_semi").withColumn("held", hash_unit("user_id", "item_id") < 0.3))
    columns = ["portal", "user_id", "item_id"]
    train = split.filter("NOT held").select(*columns, "rating")
    test = split.filter("held").select(*columns, F.col("rating").alias("actual"))
    error = F.col("actual") - F.col("estimate")
    return collaborative.predict_cells(train, test).agg(
        F.count("*").alias("cells"), F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse")
    )


@query(
    "user_unrated_top10",
    q.chain(
        *RATED,
        q.baselines(),
        q.similarity(),
        """chosen AS (SELECT portal, user_id FROM ratings GROUP BY portal, user_id QUALIFY row_number() OVER (PARTITION BY portal ORDER BY count(*), user_id) = 1),
wanted AS (SELECT portal, user_id, item_id FROM chosen JOIN (SELECT DISTINCT portal, item_id FROM ratings) USING (portal))""",
        q.predicted(k=50, min_k=1, cells="SELECT * FROM wanted").replace("HAVING count(*) >= 2", ""),
        select="""SELECT portal, user_id, item_id, round(estimate, 5) AS estimate,
  CAST(row_number() OVER (PARTITION BY portal, user_id ORDER BY round(estimate, 8) DESC, item_id) AS INTEGER) AS rank
FROM (SELECT o.*, coalesce(p.rating, m.user_mean) AS estimate FROM open_cells o
      LEFT JOIN predicted p USING (portal, user_id, item_id) JOIN means m USING (portal, user_id))
QUALIFY rank <= 10""",
    ),
)
def user_unrated_top10(t: Tables) -> DataFrame:
    """Ten best unrated items for the user of each portal who has rated least."""
    rating = cut(rated(t))
    counts = rating.groupBy("portal", "user_id").agg(F.count("*").alias("n"))
    chosen = ordering.top_n(counts, ["portal"], [F.col("n"), F.col("user_id")], 1).select("portal", "user_id")
    everything = rating.select("portal", "item_id").distinct()
    unrated = chosen.join(everything, "portal").join(rating, ["portal", "user_id", "item_id"], "left_anti")
    found = collaborative.predict_cells(rating, cut(unrated)).withColumnRenamed("estimate", "rating")
    best = ordering.top_n(found.drop("neighbours"), ["portal", "user_id"], lists.by_rating(), 10)
    return best.select("portal", "user_id", "item_id", F.round("rating", 5).alias("estimate"), "rank")


GAPS_SQL = """
gaps AS (SELECT l_partkey AS item_id, CASE WHEN l_quantity > 45 THEN 0.0 ELSE l_quantity % 11 END AS rating FROM lineitem)"""


@query(
    "popularity_scaled",
    q.chain(
        GAPS_SQL,
        select="""SELECT item_id, round(avg(z), 6) + 0.0 AS scaled_mean, round(max(m), 6) AS raw_mean,
  CAST(row_number() OVER (ORDER BY round(max(m), 8) DESC, item_id) AS INTEGER) AS rank
FROM (SELECT item_id, m, coalesce((rating - m) / nullif(s, 0), 0) AS z
      FROM gaps JOIN (SELECT item_id, avg(rating) AS m, stddev_pop(rating) AS s FROM gaps GROUP BY item_id) USING (item_id))
GROUP BY item_id QUALIFY rank <= 10""",
    ),
)
def popularity_scaled(t: Tables) -> DataFrame:
    """Ratings with 99 for none, read as 0; the means of standardised columns are all 0, so raw means rank."""
    given = F.when(F.col("l_quantity") > 45, 99.0).otherwise(F.col("l_quantity") % 11)
    raw = t.lineitem.select(F.col("l_partkey").alias("item_id"), given.alias("rating"))
    ratings_0 = raw.withColumn("rating", F.when(F.col("rating") == 99, 0.0).otherwise(F.col("rating")))
    moments = ratings_0.groupBy("item_id").agg(F.avg("rating").alias("m"), F.stddev_pop("rating").alias("s"))
    z = F.coalesce(F.try_divide(F.col("rating") - F.col("m"), F.col("s")), F.lit(0.0))
    scaled = ratings_0.join(moments, "item_id").groupBy("item_id").agg(
        (F.round(F.avg(z), 6) + 0.0).alias("scaled_mean"), F.max("m").alias("raw_mean")
    )
    best = scaled.orderBy(F.round("raw_mean", 8).desc(), "item_id").limit(10)
    # ten rows
    place = F.row_number().over(Window.orderBy(F.round("raw_mean", 8).desc(), "item_id"))
    return best.select("item_id", "scaled_mean", F.round("raw_mean", 6).alias("raw_mean"), place.alias("rank"))


ITEM_BAG_SQL = """
SELECT p_partkey AS item_id, upper(concat_ws(' ', trim(p_name), coalesce(p_brand, 'All'), coalesce(p_type, 'All'), CAST(p_size AS VARCHAR), replace(replace(places, ' ', ''), '|', ' '))) AS bag_of_words
FROM part JOIN (
  SELECT l_partkey, string_agg(n_name, '|' ORDER BY n_name) AS places FROM (
    SELECT DISTINCT l_partkey, n_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
  GROUP BY l_partkey) ON l_partkey = p_partkey
"""


def sold_places(t: Tables) -> DataFrame:
    """Item and the nation and region of each supplier that sold it."""
    sellers = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("n_name").alias("name"), F.col("r_name").alias("portal"))
    )
    sold = t.lineitem.select(F.col("l_partkey").alias("item_id"), "l_suppkey").distinct()
    return sold.join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).select("item_id", "name", "portal")


@query("item_bag_of_words", ITEM_BAG_SQL)
def item_bag_of_words(t: Tables) -> DataFrame:
    listed = t.part.select(F.col("p_partkey").alias("item_id"), F.lit("").alias("display_name"), F.col("p_name").alias("name"))
    attributes = t.part.select(
        F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_size").cast("string").alias("size")
    ).unpivot("item_id", ["brand", "kind", "size"], "attribute", "value")
    return items.bag_of_words(listed, attributes, sold_places(t), {"brand": "All", "kind": "All", "size": "All"})


@query(
    "portal_items",
    """SELECT DISTINCT upper(r_name) AS portal, l_partkey AS item_id FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def portal_items(t: Tables) -> DataFrame:
    return items.portal_items(sold_places(t))


@query(
    "content_top10",
    """WITH words AS (
  SELECT p_partkey AS item_id, unnest(list_distinct(regexp_extract_all(lower(p_name || ' ' || replace(p_brand, '#', '') || ' ' || p_type), '[\\p{L}\\p{N}_]{2,}'))) AS term
  FROM part),
sizes AS (SELECT item_id, count(*) AS n FROM words GROUP BY item_id),
pairs AS (
  SELECT a.item_id, b.item_id AS recommended_item_id, count(*) AS shared FROM words a JOIN words b ON a.term = b.term AND a.item_id <> b.item_id GROUP BY ALL)
SELECT p.item_id, recommended_item_id, round(shared / sqrt(x.n * y.n), 6) AS score,
  CAST(row_number() OVER (PARTITION BY p.item_id ORDER BY round(shared / sqrt(x.n * y.n), 10) DESC, recommended_item_id) AS INTEGER) AS rank
FROM pairs p JOIN sizes x ON x.item_id = p.item_id JOIN sizes y ON y.item_id = recommended_item_id QUALIFY rank <= 10""",
)
def content_top10(t: Tables) -> DataFrame:
    return content.content_similar(standins.item_bags(t)).withColumn("score", F.round("score", 6))
