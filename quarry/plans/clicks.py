"""Web-shop click-stream analyses (6.1-6.5) on the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import clicks as C
from quarry.operators.ordered import stitched
from quarry.operators.totals import avg_children_per_parent, distinct_per_day, roll_up_distinct, totals_by
from quarry.plans.registry import register
from quarry.sources.io import Tables
from quarry.sources.shared import shared_folder


def _e(spark, d):
    return C.visits(Tables(spark, d).events, "user_id", "ts")


@register("distinct_users", """
SELECT COUNT(DISTINCT user_id) AS n_users FROM events""")
def distinct_users(spark, d):
    return totals_by(_e(spark, d), None, distinct={"n_users": "user_id"}, rows=None)


@register("avg_visits_per_user", """
SELECT CAST(SUM(n) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_children,
       COUNT(*) AS n_parents
FROM (SELECT user_id, COUNT(DISTINCT CAST(ts AS DATE)) AS n FROM events GROUP BY 1)""")
def avg_visits_per_user(spark, d):
    return avg_children_per_parent(_e(spark, d), "user_id", "visit_date")


@register("distinct_visits_per_month", """
SELECT CAST(date_trunc('month', ts) AS DATE) AS period_start,
       COUNT(DISTINCT (user_id, CAST(ts AS DATE))) AS n_visits
FROM events GROUP BY 1""")
def distinct_visits_per_month(spark, d):
    return C.distinct_visits_per_period(_e(spark, d), "user_id", "visit_date", "ts", "month")


# Names of the event types; a type without a name stays, unnamed.
TYPE_NAMES = [("view", "Page View"), ("click", "Ad Click"), ("purchase", "Purchase"), ("signup", "Sign-up")]


@register("events_per_type", f"""
SELECT e.event_type, n.event_name, COUNT(e.event_id) AS n_events
FROM events e LEFT JOIN (VALUES {", ".join(map(str, TYPE_NAMES))}) n(event_type, event_name)
  ON e.event_type = n.event_type GROUP BY 1, 2""")
def events_per_type(spark, d):
    per = totals_by(_e(spark, d), "event_type", counts={"n_events": "event_id"}, rows=None)
    names = spark.createDataFrame(TYPE_NAMES, "event_type string, event_name string")
    return per.join(names, "event_type", "left")


@register("visit_conversion", """
SELECT COUNT(*) AS n_visits, COUNT(*) FILTER (WHERE hit = 1) AS n_converted,
       CAST(COUNT(*) FILTER (WHERE hit = 1) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS conversion
FROM (SELECT user_id, CAST(ts AS DATE) AS d,
             MAX(CAST(event_type = 'purchase' AS INTEGER)) AS hit
      FROM events GROUP BY 1, 2)""")
def visit_conversion(spark, d):
    return C.visit_conversion(_e(spark, d), ["user_id", "visit_date"],
                              F.col("event_type") == "purchase")


@register("distinct_users_rolled_up", """
SELECT 'day' AS grain, CAST(ts AS DATE) AS period_start, event_type, COUNT(DISTINCT user_id) AS n_users FROM events
WHERE ts IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'month', CAST(date_trunc('month', ts) AS DATE), event_type, COUNT(DISTINCT user_id) FROM events
WHERE ts IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'year', CAST(date_trunc('year', ts) AS DATE), event_type, COUNT(DISTINCT user_id) FROM events
WHERE ts IS NOT NULL GROUP BY ALL""")
def distinct_users_rolled_up(spark, d):
    """Distinct users per day, month and year (D4, D5): events are read once into a
    kept table of day bitmaps, from which each longer period is made."""
    path = shared_folder(spark, "users-per-day")
    distinct_per_day(Tables(spark, d).events, "ts", "user_id", "event_type").write.parquet(path)
    days = spark.read.parquet(path)
    parts = [roll_up_distinct(days, grain, "event_type", "n_users").select(F.lit(grain).alias("grain"), "*")
             for grain in ("day", "month", "year")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("event_sequence", """
SELECT event_id, user_id, ROW_NUMBER() OVER w AS seq, LAG(event_type) OVER w AS prev_event_type,
       LEAD(event_id) OVER w AS next_event_id
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)""")
def event_sequence(spark, d):
    """Place, predecessor and successor of each event of a user (E1, E7), with cells
    cut at measured quantiles: a user with all events on one day is no single task."""
    e = Tables(spark, d).events.select("event_id", "user_id", "ts", "event_type")
    x = stitched(e, "user_id", ["ts", "event_id"], prev=["event_type"], nxt=["event_id"], seq="seq", granularity="range")
    return x.select("event_id", "user_id", "seq", "prev_event_type", "next_event_id")
