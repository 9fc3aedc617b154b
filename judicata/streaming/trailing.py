"""Trailing request rate over a stream (STR-2): event-time sliding windows
with a watermark, so state for closed windows is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_counts(events: DataFrame, key: str = "user_id", ts: str = "ts", width: str = "60 seconds",
                   slide: str = "10 seconds", watermark: str = "2 minutes") -> DataFrame:
    """Counts per key and sliding window; late rows beyond the watermark are dropped."""
    return (events.withWatermark(ts, watermark)
                  .groupBy(F.window(ts, width, slide), F.col(key))
                  .agg(F.count(F.lit(1)).alias("n")))
