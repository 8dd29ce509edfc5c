"""Silence raises a row: idle keys by timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from textmill import constants as K


def _silence(name: str, gap_us: int) -> StatefulProcessor:
    """State per key: the stretches of activity that may still grow, with a timer at the end of the first plus the gap.

    The class is made here so that it travels to the workers by value.
    """

    class Silence(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._handle = handle
            fields = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("first", "last", "n")]
            self._state = handle.getValueState("stretches", T.StructType(fields))

        def _held(self) -> list[tuple[int, int, int]]:
            return list(zip(*self._state.get())) if self._state.exists() else []

        def _keep(self, stretches: list[tuple[int, int, int]]) -> None:
            if stretches:
                self._state.update(tuple(list(c) for c in zip(*stretches)))
            elif self._state.exists():
                self._state.clear()

        def _wake(self, before: list[tuple[int, int, int]], after: list[tuple[int, int, int]], rung: bool) -> None:
            # one timer a key, for the stretch that ends first: all that is over by then goes with it
            old, new = (min((_due(last) for _, last, _ in held), default=None) for held in (before, after))
            if old is not None and old != new and not rung:
                self._handle.deleteTimer(old)
            if new is not None and (old != new or rung):
                self._handle.registerTimer(new)

        def handleInputRows(self, key, rows, timerValues):
            before = self._held()
            stretches = list(before)
            for frame in rows:
                stretches += list(zip(frame["first"].tolist(), frame["last"].tolist(), frame["n"].tolist()))
            joined: list[tuple[int, int, int]] = []
            for first, last, n in sorted(stretches):
                if joined and first - joined[-1][1] < gap_us:
                    a, b, k = joined.pop()
                    first, last, n = a, max(b, last), k + n
                joined.append((first, last, n))
            self._wake(before, joined, False)
            self._keep(joined)
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
            stretches = self._held()
            over = [s for s in stretches if _due(s[1]) <= now]
            rest = [s for s in stretches if _due(s[1]) > now]
            self._wake(stretches, rest, True)
            self._keep(rest)
            if over:
                yield pd.DataFrame(
                    {
                        name: [key[0]] * len(over),
                        "first": [s[0] for s in over],
                        "last": [s[1] for s in over],
                        "n_events": [s[2] for s in over],
                    }
                )

        def close(self) -> None:
            pass

    def _due(last: int) -> int:
        # timers know milliseconds: never before the gap is over
        return -((last + gap_us) // -1000)

    return Silence()


def stream_idle(events: DataFrame, key: str, delay: str, gap_minutes: int = K.IDLE_MINUTES) -> DataFrame:
    """A row when a key has been silent for ``gap_minutes``: ``(key, active_since, last_event, idle_since, n_events)``.

    The row comes from a timer, as soon as the watermark has passed the last event by the gap; no event of the key
    need follow.  ``idle_since`` is that instant.  Each task first merges its events to cells a third of the gap wide, which
    cannot hide a gap, so a busy key sends few rows.
    """
    gap_us = gap_minutes * 60_000_000
    kind = events.schema[key].dataType.simpleString()

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = gap_us // 3
        for frame in frames:
            frame = frame.assign(cell=frame["us"] // width)
            grouped = frame.groupby([key, "cell"], dropna=False)["us"].agg(["min", "max", "size"]).reset_index()
            yield pd.DataFrame(
                {
                    key: grouped[key].astype(frame[key].dtype),
                    "first": grouped["min"],
                    "last": grouped["max"],
                    "n": grouped["size"].astype("int64"),
                }
            )

    marked = events.withWatermark("ts", delay).select(key, F.unix_micros("ts").alias("us"))
    merged = marked.mapInPandas(cells, f"`{key}` {kind}, first long, last long, n long")
    raised = merged.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_silence(key, gap_us),
        outputStructType=f"`{key}` {kind}, first long, last long, n_events long",
        outputMode="Append",
        timeMode="EventTime",
    )
    return raised.select(
        key,
        F.timestamp_micros("first").alias("active_since"),
        F.timestamp_micros("last").alias("last_event"),
        F.timestamp_micros(F.col("last") + gap_us).alias("idle_since"),
        "n_events",
    )
