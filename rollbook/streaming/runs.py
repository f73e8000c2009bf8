"""Runs as micro-batches of a stream, and streams of events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rollbook.operators.history import ChainStore
from rollbook.operators.inventory import InventoryStore
from rollbook.plans.pipeline import run


def stream_runs(
    observations: DataFrame,
    store: InventoryStore,
    targets: DataFrame,
    checkpoint: str,
    now: str | Callable[[int], str],
    mode: str = "exact",
    once: bool = True,
    outcomes: Callable[[int], DataFrame] | None = None,
) -> StreamingQuery:
    """Each micro-batch of raw observations is one run.

    The run id comes from the batch's number, and rows without ``seq`` get one from
    their content, so a replayed batch changes nothing; equal rows of a batch are
    one observation. ``now`` may depend on the batch's number; ``outcomes`` gives a
    batch's ``authority, had_error``, without it no source failed.
    """

    def batch(rows: DataFrame, number: int) -> None:
        none = rows.sparkSession.createDataFrame([], "authority string, had_error boolean")
        if "seq" not in rows.columns:
            rows = rows.distinct().withColumn("seq", F.xxhash64(*rows.columns))
        when = now if isinstance(now, str) else now(number)
        run(store, rows, targets, outcomes(number) if outcomes else none, f"B{number:014d}", when, mode=mode)

    writer = observations.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_chains(readings: DataFrame, raw_path: str, store: ChainStore, checkpoint: str) -> StreamingQuery:
    """Readings (shape of ``history.readings``) keep attribute histories up to date: each batch rebuilds the chains it touches.

    Readings are appended to ``raw_path`` by batch number first; a replayed batch overwrites its own.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(f"{raw_path}/batch={number}")
        raw = spark.read.parquet(raw_path).where(F.col("batch") < number).drop("batch")
        new = spark.read.parquet(f"{raw_path}/batch={number}")
        store.apply(raw, new)

    return (
        readings.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def windowed_counts(events: DataFrame, time: str, late: str = "1 day", width: str = "1 day", by: str = "event_type") -> DataFrame:
    """Events of each time window and kind, with a watermark for late ones; for streams and tables alike."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), by, "n"
    )


def stale_sources(events: DataFrame, key: str, time: str, quiet: str = "7 days") -> DataFrame:
    """``key, last_seen, stale``: a row whenever a key is seen, and one more when it stays quiet for longer than ``quiet`` in event time."""
    span = pd.Timedelta(quiet)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            yield pd.DataFrame({"key": [str(k[0])], "last_seen": [pd.Timestamp(last, unit="us")], "stale": [True]})
            return
        last = state.get[0] if state.exists else 0
        for pdf in batches:
            last = max(last, int(pdf["time"].max().value // 1000))
        state.update((last,))
        state.setTimeoutTimestamp(last // 1000 + int(span.total_seconds() * 1000))
        yield pd.DataFrame({"key": [str(k[0])], "last_seen": [pd.Timestamp(last, unit="us")], "stale": [False]})

    rows = events.select(F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").alias("time")).withWatermark("time", "1 hour")
    return rows.groupBy("key").applyInPandasWithState(
        step, "key string, last_seen timestamp, stale boolean", "last long", "append", GroupStateTimeout.EventTimeTimeout
    )
