"""Windowed aggregates: one function for batch and for streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def events_in_utc(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Time stamps without a zone can't carry a watermark; they are UTC."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def windowed(events: DataFrame, size: str, slide: str | None = None, late: str | None = None, ts: str = "ts", key: str = "event_type", value: str = "value") -> DataFrame:
    """(window_start, key, n, total). late: how long to wait for late rows; a
    stream in append mode needs it, a batch ignores it."""
    if late:
        events = events.withWatermark(ts, late)
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    out = events.groupBy(w.alias("w"), key).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), key, "n", "total")


def sessions(events: DataFrame, gap: str, late: str | None = None, ts: str = "ts", key: str = "user_id") -> DataFrame:
    """(key, session_start, session_end, n) of rows less than ``gap`` apart."""
    if late:
        events = events.withWatermark(ts, late)
    out = events.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n"), F.max(ts).alias("last"))
    return out.select(key, F.col("w.start").alias("session_start"), F.col("last").alias("session_end"), "n")


def deduplicated(events: DataFrame, late: str, ts: str = "ts", key: str = "event_id") -> DataFrame:
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def bursts(events: DataFrame, n: int, within: str, late: str = "1 hour", ts: str = "ts", key: str = "user_id") -> DataFrame:
    """(key, first, last, n): whenever a key has had ``n`` events no more than
    ``within`` apart from first to last; then it starts anew.

    Custom state of a stream: a key's last ``n`` - 1 time stamps, in order of
    arrival by batch and of time inside one, forgotten ``within`` after the
    watermark has passed them. Rows without a key or a time are left out.
    """
    kind = events.schema[key].dataType.simpleString()
    gap = pd.Timedelta(within)

    def run(name, frames, state: GroupState):
        held = [pd.Timestamp(x, unit="us", tz="UTC") for x in (state.get[0] if state.exists else [])]
        out = []
        if state.hasTimedOut:
            state.remove()
            return
        for f in frames:
            for at in sorted(f[ts].dt.tz_localize("UTC") if f[ts].dt.tz is None else f[ts]):
                held = [h for h in held if at - h <= gap] + [at]
                if len(held) >= n:
                    out.append((name[0], held[0], held[-1], len(held)))
                    held = []
        if held:
            state.update(([int(h.value // 1000) for h in held],))
            state.setTimeoutTimestamp(max(int((held[-1] + gap).value // 1_000_000), state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=[key, "first", "last", "n"])

    kept = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, late).select(key, ts)
    return kept.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, first timestamp, last timestamp, n int", "held array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def resume_index(spark, chunks_path: str, schema: str, embed, out_path: str, checkpoint: str):
    """Index new chunk files only: a file stream that stops when it has caught
    up; what was embedded is known from the checkpoint."""
    new = spark.readStream.schema(schema).json(chunks_path)
    return embed(new).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_path)
