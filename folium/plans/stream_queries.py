"""The batch side of the stream operators, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.session import table
from folium.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]


def events_windowed(spark: SparkSession, d: str) -> DataFrame:
    """Events and their value by hour and type."""
    return feeds.windowed(table(spark, d, "events")).withColumn("total", F.round("total", 4))


def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Runs of each user's events."""
    return feeds.sessions(table(spark, d, "events"))


SQL = {
    "events_windowed": "SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "events_sessions": """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 minutes THEN 0 ELSE 1 END AS new FROM events WHERE ts IS NOT NULL),
        b AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM a)
        SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 minutes AS "end", count(*) AS n FROM b GROUP BY user_id, s""",
}


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (events_windowed, events_sessions)}
