"""Streams of turns and events: sessions, windows, duplicates and running interaction metrics.

Each equals its batch twin once the stream has ended. Event times must be
TIMESTAMP (the reader's TIMESTAMP_NTZ is cast), in UTC.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def timed(events: DataFrame, column: str = "ts", late: str = "1 hour") -> DataFrame:
    return events.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, late)


def sessions(events: DataFrame, key: str = "user_id", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Each key's events in sessions parted by a gap: key, first and last time, n."""
    s = timed(events, late=late).groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    return s.select(key, "first", "last", "n")


def windowed_counts(events: DataFrame, key: str = "event_type", width: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Events by key in tumbling or sliding windows."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return timed(events, late=late).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def distinct_rows(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first row of each key, as long as copies come within the watermark."""
    return timed(events, late=late).dropDuplicatesWithinWatermark(keys)


METRICS = "session_id long, turns long, switches long, latency_sum_ms long, latencies long"
STATE = METRICS.replace("session_id long, ", "") + ", last_speaker string, last_end_ms long, last_start_ms long"


def running_metrics(turns: DataFrame) -> DataFrame:
    """Turns, speaker switches and response latencies so far of each session, after every batch. turns: session_id, s_ms, e_ms, speaker, in order of arrival between batches."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, switches, total, count, speaker, end, start = state.get if state.exists else (0, 0, 0, 0, None, 0, 0)
        rows = pd.concat(list(batches)).sort_values(["s_ms", "e_ms"])
        for s, e, who in zip(rows.s_ms.tolist(), rows.e_ms.tolist(), rows.speaker.tolist(), strict=True):
            if speaker is not None and who != speaker:
                switches += 1
                if s >= end:
                    total += s - end
                    count += 1
            n, speaker, end, start = n + 1, who, e, s
        state.update((n, switches, total, count, speaker, end, start))
        yield pd.DataFrame({"session_id": [key[0]], "turns": [n], "switches": [switches], "latency_sum_ms": [total], "latencies": [count]})

    return turns.groupBy("session_id").applyInPandasWithState(update, METRICS, STATE, "update", GroupStateTimeout.NoTimeout)
