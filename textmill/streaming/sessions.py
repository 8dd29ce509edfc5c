"""Sessions on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill import constants as K

# each task merges the sessions it holds before the shuffle
LOCAL_MERGE = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def stream_sessions(events: DataFrame, key: str, delay: str, gap_minutes: int = K.IDLE_MINUTES) -> DataFrame:
    """Closed sessions ``(key, session_start, last_event, n_events)``.

    A silence of exactly the gap starts a new session, as in ``idle_sessions``.
    Spark would still join there, so its gap is a microsecond shorter.
    """
    gap = f"{gap_minutes * 60 - 1} seconds 999999 microseconds"
    window = F.session_window("ts", gap).alias("w")
    rows = (
        events.withWatermark("ts", delay)
        .groupBy(key, window)
        .agg(F.max("ts").alias("last_event"), F.count(F.lit(1)).alias("n_events"))
    )
    return rows.select(key, F.col("w.start").alias("session_start"), "last_event", "n_events")
