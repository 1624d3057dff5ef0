"""Transactions that arrive as a stream, each consumed once, by state that is kept for each key.

The keys that were seen are state of the stream, in its checkpoint; the target is never read again.
Without a bound the state keeps every key for ever. With one, a key is forgotten so long after it was
consumed, and state stays as small as what arrives within that time. Neither drops late rows: what
counts is when a row arrives, not which time it bears."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def once(stream: DataFrame, key: str = "pos_id", seconds: int | None = None) -> DataFrame:
    """The first row of each key to arrive; rows with a null key are left out. Of rows that arrive in one
    micro-batch any may be the first; with `seconds`, after which keys are forgotten, it is the smallest
    by all columns in their order, nulls first."""
    rows = stream.where(F.col(key).isNotNull())
    if seconds is None:
        return rows.dropDuplicates([key])
    if seconds < 1:
        raise ValueError("a bound must be a second at least")
    names = rows.columns

    def first(_, parts: Iterator, state) -> Iterator:
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        seen, best = state.exists, None
        for p in parts:
            if not seen:
                both = p if best is None else pd.concat([best, p])
                best = both.sort_values(names, na_position="first").head(1)
        if not seen:
            state.update((1,))
            state.setTimeoutDuration(seconds * 1000)
            yield best

    return rows.groupBy(key).applyInPandasWithState(first, rows.schema, "seen int", "append", "ProcessingTimeTimeout")


def consume(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType, key: str = "pos_id", seconds: int | None = None) -> StreamingQuery:
    """Appends the first row of each key of new Parquet files under source to target; started, for
    what is there now. A batch that failed is written once: the target keeps a log of its batches."""
    # with timeouts, batches without data would follow each other without end; keys are forgotten as data comes
    own = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {c: spark.conf.get(c) for c in own}
    rows = once(spark.readStream.schema(schema).parquet(source), key, seconds)
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    try:
        for c, value in own.items():
            spark.conf.set(c, value)
        return writer.start()  # which keeps the settings of its start
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys that the stream holds, read from its state."""
    return spark.read.format("statestore").load(checkpoint)
