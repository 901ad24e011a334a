"""Streams of requests: each key once within a period, and requests spaced for each host."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def fresh_requests(stream: DataFrame, key: str, at: str, days: int) -> DataFrame:
    """The first request of each key; repeats within ``days`` of it are dropped, and its state is forgotten after that."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, f"{days} days").dropDuplicatesWithinWatermark([key])


def event_windows(stream: DataFrame, at: str, key: str, width: str, late: str) -> DataFrame:
    """Rows of each closed window and key: ``start, key, n``."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, width).alias("w"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "key", "n")


def spaced_starts(stream: DataFrame, host: str, at: str, interval: float, forget_after_ms: int = 3_600_000) -> DataFrame:
    """``host, at, start``: seconds at which requests may start, at least ``interval`` apart for a host over all batches.

    Of a host only the last start is kept, and forgotten once no request came
    for ``forget_after_ms`` (of processing time, which should be well over the
    interval), so states don't pile up. A batch's requests of a host are sorted as numbers.
    """

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else float("-inf")
        times = np.sort(np.concatenate([b["at"].to_numpy(dtype="float64") for b in batches]))
        steps = np.arange(len(times)) * interval
        # start(i) = max(at(i), start(i-1) + interval), as a running maximum
        starts = np.maximum(np.maximum.accumulate(times - steps), last + interval) + steps
        if len(starts):
            state.update((float(starts[-1]),))
            state.setTimeoutDuration(forget_after_ms)
        yield pd.DataFrame({"host": [key[0]] * len(times), "at": times, "start": starts})

    rows = stream.select(F.col(host).cast("string").alias("host"), F.col(at).cast("double").alias("at")).filter("at is not null")
    return rows.groupBy("host").applyInPandasWithState(run, "host string, at double, start double", "last double", "append", GroupStateTimeout.ProcessingTimeTimeout)


def in_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Works off what has come since the last time, once, as a scheduled tick does: ``write`` gets each batch and its number, and what it has seen is kept in ``checkpoint``."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
