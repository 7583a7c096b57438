"""Structured Streaming around the batch update: each micro-batch is one run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlode.functions.text import activity
from gridlode.plans.update import run_update
from gridlode.sources.store import Store


def update_stream(raw: DataFrame, store: Store, source: str, checkpoint: str, as_of=None, **trigger) -> StreamingQuery:
    """Run the update on each micro-batch of a stream of raw records. Keys make a repeated batch harmless."""

    def run(batch: DataFrame, _: int) -> None:
        run_update(batch.sparkSession, batch, store, source, as_of)

    return raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def event_windows(events: DataFrame, time: str, by: Column, value: Column, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Event-time counts and sums by a class, as `kind`, `rows` and `total`.

    The watermark trails the latest time by `late`: in append mode a window is given out
    once, when the watermark has passed its end, and rows that come after that are left out.
    """
    rows = events.withWatermark(time, late).groupBy(F.window(time, window), by.alias("kind"))
    return rows.agg(F.count("*").alias("rows"), F.sum(value.cast("decimal(28,6)")).cast("double").alias("total"))


def activity_windows(raw: DataFrame, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """event_windows() of raw records: number and capacity by activity and time of collection."""
    found = event_windows(raw, "fetched_at", activity(F.col("installation_type")), F.col("requested_power_kw"), window, late)
    return found.withColumnsRenamed({"kind": "activity_type", "rows": "records", "total": "power_kw"})
