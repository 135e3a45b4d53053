"""Queries of the time-series operators: p1 (regular grid) and p3 (rolling totals)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.operators.grid import one_per, regular_grid, usable, with_previous
from grainloom.operators.rolling import rolling_totals
from grainloom.session import table

AS_OF = "2025-06-30"


def _days(d: str | None = None):
    return F.unix_date(F.col("date") if d is None else F.lit(d).cast("date")).cast("bigint")


def _readings(spark: SparkSession, sf: str) -> DataFrame:
    """Usable readings of both tables, one per series, project and day."""
    sp = table(spark, sf, "star_points").where(usable(F.col("date"), F.col("stars")))
    sp = one_per(sp.select("project_id", _days().alias("d"), "observed_at", "stars"), ["project_id", "d"], [F.col("observed_at")], ["stars"])
    pm = table(spark, sf, "project_metrics_daily").where(usable(F.col("date"), F.col("stars")))
    pm = one_per(pm.select("project_id", _days().alias("d"), "ingested_at", "id", "stars"), ["project_id", "d"], [F.col("ingested_at"), F.col("id")], ["stars"])
    return sp.withColumn("series", F.lit("star_points")).unionByName(pm.withColumn("series", F.lit("project_metrics_daily")))


def p1_grid(spark: SparkSession, sf: str) -> DataFrame:
    g = regular_grid(_readings(spark, sf), ["series", "project_id"], "d", "stars")
    return g.select(
        "series", "project_id", F.date_format(F.date_from_unix_date(F.col("cell").cast("int")), "yyyy-MM-dd").alias("day"),
        F.round("value", 4).alias("stars"), F.round("increment", 4).alias("gained"), "resets", "mark",
    )


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_grid(spark, sf).where(F.col("mark") != "observed").select("series", "project_id", "day")


def _gains(spark: SparkSession, sf: str) -> DataFrame:
    pm = table(spark, sf, "project_metrics_daily").where(usable(F.col("date"), F.col("stars"), last=AS_OF))
    pm = one_per(pm.select("project_id", _days().alias("d"), "ingested_at", "id", "stars"), ["project_id", "d"], [F.col("ingested_at"), F.col("id")], ["stars"])
    p = with_previous(pm, ["project_id"], "d", ["stars"], 1024)
    return p.select("project_id", "d", (F.col("stars") - F.coalesce(F.col("_prev.stars"), F.col("stars"))).alias("gain"))


def p3_rolling(spark: SparkSession, sf: str) -> DataFrame:
    r = rolling_totals(_gains(spark, sf), "project_id", "d", "gain")
    return r.select(
        "project_id", F.date_format(F.date_from_unix_date(F.col("day").cast("int")), "yyyy-MM-dd").alias("day"), "active",
        F.col("sum_7").cast("bigint").alias("gained_7"), F.round("avg_7", 4).alias("daily_7"),
        F.col("sum_30").cast("bigint").alias("gained_30"), F.round("avg_30", 4).alias("daily_30"), F.col("max_30").cast("bigint").alias("best_day_30"),
    )


def _epoch_day(d: str) -> int:
    import datetime

    return (datetime.date.fromisoformat(d) - datetime.date(1970, 1, 1)).days


def p3_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The correct stars_week_delta beside the stored one, for every judged project."""
    gains = _gains(spark, sf)
    end = _epoch_day(AS_OF)
    r = rolling_totals(gains, "project_id", "d", "gain", (7,), until=end).where(F.col("day") == end)
    judged = gains.groupBy("project_id").agg(F.min("d").alias("first")).where(F.col("first") <= end - 7)
    r = r.join(judged, "project_id", "left_semi").select("project_id", F.col("sum_7").cast("bigint").alias("right_delta"))
    pr = table(spark, sf, "projects").select(F.col("id").alias("project_id"), F.col("stars_week_delta").cast("bigint").alias("stored_delta"))
    return pr.join(r, "project_id")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_delta(spark, sf).where(~F.col("stored_delta").eqNullSafe(F.col("right_delta"))).select("project_id")


_USABLE = "date IS NOT NULL AND stars IS NOT NULL AND stars >= 0 AND date BETWEEN DATE '2015-01-01' AND DATE '2025-06-30'"

_PICKED = f"""
picked AS (
  SELECT project_id, date AS d, stars FROM (
    SELECT *, row_number() OVER (PARTITION BY project_id, date ORDER BY ingested_at DESC NULLS LAST, id DESC) AS rn
    FROM project_metrics_daily WHERE {_USABLE}) WHERE rn = 1)"""

ORACLE = {
    "p1_found": f"""
WITH r AS (
  SELECT DISTINCT 'star_points' AS series, project_id, date AS d FROM star_points WHERE {_USABLE}
  UNION ALL SELECT DISTINCT 'project_metrics_daily', project_id, date FROM project_metrics_daily WHERE {_USABLE}),
g AS (SELECT series, project_id, d, lead(d) OVER (PARTITION BY series, project_id ORDER BY d) AS nxt FROM r),
h AS (SELECT series, project_id, unnest(generate_series(d + INTERVAL 1 DAY, nxt - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS t FROM g WHERE nxt > d + INTERVAL 1 DAY)
SELECT series, project_id, strftime(t, '%Y-%m-%d') AS day FROM h""",
    "p1_grid": f"""
WITH r AS (
  SELECT 'star_points' AS series, project_id, date AS d, stars FROM (
    SELECT *, row_number() OVER (PARTITION BY project_id, date ORDER BY observed_at DESC NULLS LAST, stars DESC) AS rn FROM star_points WHERE {_USABLE}) WHERE rn = 1
  UNION ALL
  SELECT 'project_metrics_daily', project_id, date, stars FROM (
    SELECT *, row_number() OVER (PARTITION BY project_id, date ORDER BY ingested_at DESC NULLS LAST, id DESC) AS rn FROM project_metrics_daily WHERE {_USABLE}) WHERE rn = 1),
g AS (SELECT *, lag(d) OVER w AS pd, lag(stars) OVER w AS ps FROM r WINDOW w AS (PARTITION BY series, project_id ORDER BY d)),
x AS (SELECT *, coalesce(stars < ps * 0.5, false) AS reset, CAST(CASE WHEN ps IS NULL THEN 0 WHEN stars < ps * 0.5 THEN stars ELSE stars - ps END AS DOUBLE) AS inc FROM g),
c AS (SELECT *, CAST(unnest(generate_series(CAST(coalesce(pd + INTERVAL 1 DAY, d) AS TIMESTAMP), CAST(d AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS t FROM x)
SELECT series, project_id, strftime(t, '%Y-%m-%d') AS day,
  round(CASE WHEN t = d THEN CAST(stars AS DOUBLE) ELSE (CASE WHEN reset THEN 0.0 ELSE CAST(ps AS DOUBLE) END) + inc * date_diff('day', pd, t) / date_diff('day', pd, d) END, 4) AS stars,
  round(CASE WHEN pd IS NULL THEN 0.0 ELSE inc / date_diff('day', pd, d) END, 4) AS gained,
  CAST(CASE WHEN t = d AND reset THEN 1 ELSE 0 END AS BIGINT) AS resets, CASE WHEN t = d THEN 'observed' ELSE 'filled' END AS mark FROM c""",
    "p3_found": f"""
WITH {_PICKED},
e AS (SELECT project_id, max_by(stars, d) AS s FROM picked GROUP BY 1),
b AS (SELECT project_id, max_by(stars, d) AS s FROM picked WHERE d <= DATE '2025-06-23' GROUP BY 1)
SELECT p.id AS project_id FROM projects p JOIN e ON e.project_id = p.id JOIN b ON b.project_id = p.id
WHERE p.stars_week_delta IS NULL OR p.stars_week_delta <> e.s - b.s""",
    "p3_delta": f"""
WITH {_PICKED},
e AS (SELECT project_id, max_by(stars, d) AS s FROM picked GROUP BY 1),
b AS (SELECT project_id, max_by(stars, d) AS s FROM picked WHERE d <= DATE '2025-06-23' GROUP BY 1)
SELECT p.id AS project_id, CAST(p.stars_week_delta AS BIGINT) AS stored_delta, CAST(e.s - b.s AS BIGINT) AS right_delta
FROM projects p JOIN e ON e.project_id = p.id JOIN b ON b.project_id = p.id""",
    "p3_rolling": f"""
WITH {_PICKED},
inc AS (SELECT project_id, d, stars - coalesce(lag(stars) OVER (PARTITION BY project_id ORDER BY d), stars) AS gain FROM picked),
ends AS (SELECT project_id, min(d) AS a, max(d) AS b FROM inc GROUP BY 1),
days AS (SELECT project_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM ends),
f AS (SELECT days.project_id, days.d, coalesce(gain, 0) AS gain, gain IS NOT NULL AS active FROM days LEFT JOIN inc ON inc.project_id = days.project_id AND inc.d = days.d),
w AS (SELECT *, sum(gain) OVER a AS s7, sum(gain) OVER b AS s30, max(gain) OVER b AS m30 FROM f
  WINDOW a AS (PARTITION BY project_id ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), b AS (PARTITION BY project_id ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
SELECT project_id, strftime(d, '%Y-%m-%d') AS day, active, CAST(s7 AS BIGINT) AS gained_7, round(s7 / 7.0, 4) AS daily_7,
  CAST(s30 AS BIGINT) AS gained_30, round(s30 / 30.0, 4) AS daily_30, CAST(m30 AS BIGINT) AS best_day_30 FROM w""",
}

QUERIES = {"p1_found": p1_found, "p1_grid": p1_grid, "p3_found": p3_found, "p3_delta": p3_delta, "p3_rolling": p3_rolling}
