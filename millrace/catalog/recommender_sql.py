"""SQL for the recommender, written as chained common table expressions.

``keys`` is the list of grouping columns, ``portal`` or ``run_id, portal``.
"""

from __future__ import annotations


def using(keys: str, *more: str) -> str:
    return ", ".join([keys, *more])


def normalized(source: str = "activity") -> str:
    return f"""
normalized AS (
  SELECT * EXCLUDE (action),
    CASE WHEN action = 'DOWNLOADCAMPAIGN' THEN 'ACTIVATECAMPAIGN'
         WHEN action LIKE '%DOWNLOAD%' OR action = 'VIDEO_GETDEFAULTEMBEDCODE' THEN 'PULL'
         WHEN action IN ('ENTERCAMPAIGNSTAB', 'RETURNCAMPAIGNOVERVIEW', 'ENTERPRODUCT') THEN 'ENTERCAMPAIGNOVERVIEW'
         ELSE action END AS action
  FROM {source}
  WHERE portal IS NOT NULL AND action IS NOT NULL
    AND action NOT IN ('ENTERCAMPAIGNSTARTMARKETING', 'CLOSEASSETPREVIEW', 'CLOSESETUPASSETS'))"""


def rated(keys: str = "portal", source: str = "normalized") -> str:
    return f"""
weights AS (
  SELECT {keys}, action, count(*) AS actions,
    CASE WHEN action IN ('PULL', 'SETUPASSETS', 'OPENASSETPREVIEW', 'ENTERCAMPAIGNOVERVIEW', 'CAMPAIGNSTATUS', 'ACTIVATECAMPAIGN')
         THEN sum(count(*)) OVER (PARTITION BY {keys}) / count(*) ELSE 0.0 END AS weight
  FROM {source} GROUP BY {keys}, action),
scores AS (
  SELECT {keys}, user_id, item_id, round(avg(CAST(weight AS DOUBLE)), 10) AS score
  FROM {source} JOIN weights USING ({keys}, action) GROUP BY {keys}, user_id, item_id),
ratings AS (
  SELECT {keys}, user_id, item_id,
    round(CASE WHEN hi = lo THEN 1.0 ELSE 1 + 4 * ((score - lo) / (hi - lo)) END, 10) AS rating
  FROM (SELECT *, min(score) OVER (PARTITION BY {keys}) AS lo, max(score) OVER (PARTITION BY {keys}) AS hi FROM scores))"""


def trending(keys: str = "portal", n: int = 20) -> str:
    return f"""
portal_users AS (SELECT {keys}, count(DISTINCT user_id) AS users FROM ratings GROUP BY {keys}),
item_means AS (SELECT {keys}, item_id, avg(rating) AS rating, count(*) AS raters FROM ratings GROUP BY {keys}, item_id),
trend AS (
  SELECT {keys}, item_id, rating, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY round(rating, 8) DESC, item_id) AS INTEGER) AS rank
  FROM item_means JOIN portal_users USING ({keys})
  WHERE raters >= CASE WHEN users > 1000 THEN 20 WHEN users > 500 THEN 10 ELSE 5 END
  QUALIFY rank <= {n})"""


def own_past(keys: str = "portal", n: int = 20) -> str:
    return f"""
past AS (
  SELECT {keys}, user_id, item_id, rating,
    CAST(row_number() OVER (PARTITION BY {keys}, user_id ORDER BY round(rating, 8) DESC, item_id) AS INTEGER) AS rank
  FROM ratings QUALIFY rank <= {n})"""


def baselines(keys: str = "portal", source: str = "ratings", sweeps: int = 10) -> str:
    parts = [
        f"mu AS MATERIALIZED (SELECT {keys}, avg(rating) AS mu FROM {source} GROUP BY {keys})",
        f"cells AS MATERIALIZED (SELECT {keys}, user_id, item_id, rating, rating - mu AS d FROM {source} JOIN mu USING ({keys}))",
        f"bu0 AS MATERIALIZED (SELECT {keys}, user_id, 0.0::DOUBLE AS bu FROM cells GROUP BY {keys}, user_id)",
    ]
    for i in range(1, sweeps + 1):
        parts.append(
            f"bi{i} AS MATERIALIZED (SELECT {keys}, item_id, sum(d - bu) / (10 + count(*)) AS bi "
            f"FROM cells JOIN bu{i - 1} USING ({keys}, user_id) GROUP BY {keys}, item_id)"
        )
        parts.append(
            f"bu{i} AS MATERIALIZED (SELECT {keys}, user_id, sum(d - bi) / (15 + count(*)) AS bu "
            f"FROM cells JOIN bi{i} USING ({keys}, item_id) GROUP BY {keys}, user_id)"
        )
    return "\n" + ",\n".join(parts)


def similarity(keys: str = "portal", sweeps: int = 10) -> str:
    same = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    named = ", ".join(f"a.{k.strip()} AS {k.strip()}" for k in keys.split(","))
    return f"""
residuals AS MATERIALIZED (
  SELECT {keys}, user_id, item_id, rating, d - bu - bi AS e
  FROM cells JOIN bu{sweeps} USING ({keys}, user_id) JOIN bi{sweeps} USING ({keys}, item_id)),
sims AS MATERIALIZED (
  SELECT * FROM (
    SELECT {named}, a.user_id AS user_id, b.user_id AS neighbour_id, count(*) AS common,
      round(CASE WHEN count(*) < 2 OR sum(a.e * a.e) * sum(b.e * b.e) = 0 THEN 0.0
        ELSE sum(a.e * b.e) / sqrt(sum(a.e * a.e) * sum(b.e * b.e)) * (count(*) - 1) / (count(*) - 1 + 100) END, 10) AS s
    FROM residuals a JOIN residuals b ON {same} AND a.item_id = b.item_id AND a.user_id <> b.user_id
    GROUP BY ALL)
  WHERE s > 0)"""


def predicted(keys: str = "portal", k: int = 20, min_k: int = 4, cells: str | None = None) -> str:
    """Predictions for unrated cells; ``cells`` is SQL giving the wanted (keys, user, item) cells."""
    cells = cells or f"SELECT DISTINCT {keys}, user_id, item_id FROM raters"
    return f"""
means AS MATERIALIZED (SELECT {keys}, user_id, avg(rating) AS user_mean FROM residuals GROUP BY {keys}, user_id),
centred AS MATERIALIZED (
  SELECT {keys}, user_id AS neighbour_id, item_id, rating - user_mean AS c FROM residuals JOIN means USING ({keys}, user_id)),
raters AS (SELECT {keys}, user_id, item_id, neighbour_id, s, c FROM sims JOIN centred USING ({keys}, neighbour_id)),
open_cells AS (
  SELECT * FROM ({cells}) w ANTI JOIN residuals r USING ({keys}, user_id, item_id)),
nearest AS (
  SELECT {keys}, user_id, item_id, s, c,
    row_number() OVER (PARTITION BY {keys}, user_id, item_id ORDER BY s DESC, neighbour_id) AS place
  FROM raters JOIN open_cells USING ({keys}, user_id, item_id) QUALIFY place <= {k}),
predicted AS MATERIALIZED (
  SELECT {keys}, user_id, item_id, neighbours,
    least(greatest(CASE WHEN neighbours >= {min_k} THEN user_mean + pull / weight ELSE user_mean END, 1.0), 5.0) AS rating
  FROM (SELECT {keys}, user_id, item_id, count(*) AS neighbours, sum(s * c) AS pull, sum(s) AS weight
        FROM nearest GROUP BY {keys}, user_id, item_id HAVING count(*) >= 2)
  JOIN means USING ({keys}, user_id))"""


def cf_top(keys: str = "portal", n: int = 20) -> str:
    return f"""
cf AS (
  SELECT {keys}, user_id, item_id, rating,
    CAST(row_number() OVER (PARTITION BY {keys}, user_id ORDER BY round(rating, 8) DESC, item_id) AS INTEGER) AS rank
  FROM (SELECT {keys}, user_id, item_id, rating FROM ratings
        UNION ALL SELECT {keys}, user_id, item_id, rating FROM predicted)
  QUALIFY rank <= {n})"""


def hybrid(keys: str = "portal", n: int = 20, past_n: int = 3) -> str:
    return f"""
candidates AS (
  SELECT {keys}, user_id, item_id, 1 AS source, rank FROM past WHERE rank <= {past_n}
  UNION ALL SELECT {keys}, user_id, item_id, 2, rank FROM cf WHERE round(rating, 8) > 1
  UNION ALL SELECT {keys}, user_id, item_id, 3, trend.rank
            FROM (SELECT {keys}, user_id FROM past WHERE rank = 1) JOIN trend USING ({keys})),
hybrid AS (
  SELECT {keys}, user_id, item_id,
    CAST(row_number() OVER (PARTITION BY {keys}, user_id ORDER BY source, rank) AS INTEGER) AS sort_order,
    CASE source WHEN 1 THEN 'PAST' WHEN 2 THEN 'COLREC' ELSE 'TREND' END AS model_type
  FROM (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY {keys}, user_id, item_id ORDER BY source) = 1)
  QUALIFY sort_order <= {n})"""


def chain(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select
