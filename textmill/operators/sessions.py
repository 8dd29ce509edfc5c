"""Activity sessions and idleness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill import constants as K
from textmill.functions.numbers import idle_minutes


def idle_sessions(events: DataFrame, key: str, ts: str = "ts", gap_minutes: int = K.IDLE_MINUTES) -> DataFrame:
    """Sessions cut where nothing happens for ``gap_minutes`` or longer.

    Events first shrink to cells a third of the gap wide.  Two events of one
    cell can never be a gap apart, so a cell belongs to one session and its
    first and last instant say all about it.  The window then sees the cells of
    the calendar per key, not the events.  ``idle_minutes`` is the time to the
    next session, null after the last.
    """
    gap_us = gap_minutes * 60_000_000
    width = gap_us // 3
    us = F.unix_micros(ts)
    cells = events.groupBy(key, (us - F.pmod(us, F.lit(width))).alias("_cell")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    line = Window.partitionBy(key).orderBy("_cell")
    silence = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(line))
    opens = F.coalesce((silence >= gap_us).cast("int"), F.lit(1))
    numbered = cells.withColumn("_opens", opens).withColumn("_session", F.sum("_opens").over(line))
    sessions = numbered.groupBy(key, "_session").agg(
        F.min("_first").alias("session_start"), F.max("_last").alias("last_event"), F.sum("_n").alias("n_events")
    )
    following = F.lead("session_start").over(Window.partitionBy(key).orderBy("_session"))
    return sessions.withColumn("idle_minutes", idle_minutes(F.col("last_event"), following)).drop("_session")
