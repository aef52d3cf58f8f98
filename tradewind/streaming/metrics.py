"""Windowed metrics, running stock, and the comparison with a batch run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tradewind.functions import in_chunks, maxima_in_chunks, totals_in_chunks
from tradewind.operators.inventory import STOCK_KEY, on_hand_effect
from tradewind.streaming.run import drain_parts


def windowed_metrics(events: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """Count and value per type and time window of a table or of one batch."""
    window = F.window("event_time", length, slide) if slide else F.window("event_time", length)
    return events.groupBy(window.alias("w"), "event_type").agg(
        F.count("*").alias("events"), F.sum("value").alias("value")
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "events", "value"
    )


def running_windows(events: DataFrame, path: str, length: str, slide: str | None = None) -> DataFrame:
    """The windows of a stream run: each batch adds its part, so a late event corrects the window that it belongs to."""
    parts = drain_parts(events, path, lambda batch: windowed_metrics(batch, length, slide))
    return parts.groupBy("window_start", "window_end", "event_type").agg(F.sum("events").alias("events"), F.sum("value").alias("value"))


def session_parts(events: DataFrame, gap: str, key: str) -> DataFrame:
    """Sessions per key among the given events: they end after `gap` without an event."""
    return events.groupBy(F.session_window("event_time", gap).alias("w"), key).agg(
        F.count("*").alias("events"), F.sum("value").alias("value")
    ).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events", "value")


def running_sessions(events: DataFrame, path: str, gap: str, key: str) -> DataFrame:
    """The sessions of a stream run: parts of one session from different batches are joined, at any distance of arrival.

    `is_open`: an event newer than all seen so far may still belong to the session.
    """
    parts = drain_parts(events, path, lambda batch: session_parts(batch, gap, key))
    # a user with very many sessions is dealt over many tasks
    order = ["session_start", "session_end", "__tie"]
    chunked = in_chunks(parts.withColumn("__tie", F.monotonically_increasing_id()), [key, *order])
    known = maxima_in_chunks(chunked, [key], order, F.col("session_end"), "__before")
    opens = F.coalesce(F.col("session_start") >= F.col("__before"), F.lit(True))
    marked = known.withColumn("__opens", opens.cast("int"))
    numbered = totals_in_chunks(marked, [key], order, {"__earlier": F.col("__opens")}).withColumn("__session", F.col("__earlier") + F.col("__opens"))
    merged = numbered.groupBy(key, "__session").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        F.sum("events").alias("events"), F.sum("value").alias("value"),
    )
    # a session ends a gap after its last event, so the newest end stands for the newest event
    newest = parts.agg((F.max("session_end") - F.expr(f"INTERVAL {gap}")).alias("newest")).first()["newest"]
    return merged.drop("__session").withColumn("is_open", F.col("session_end") > F.lit(newest))


def running_stock(moves: DataFrame) -> DataFrame:
    """On-hand change per (warehouse, product) from movement events, kept up to date by each batch."""
    return moves.groupBy(*STOCK_KEY).agg(
        F.sum(on_hand_effect()).alias("on_hand_change"), F.count("*").alias("moves")
    )


def parity(batch: DataFrame, stream: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The same metric from a batch and a stream run, side by side."""
    keys = list(keys)
    a = batch.select(*keys, F.col(value).alias("batch_value"))
    b = stream.select(*keys, F.col(value).alias("stream_value"))
    same = F.col("batch_value").eqNullSafe(F.col("stream_value"))
    return a.join(b, keys, "full").select(*keys, "batch_value", "stream_value", same.alias("is_equal"))
