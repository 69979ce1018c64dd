"""Keyed state and stream-stream joins.

``latest_row_stream`` is the streaming form of latest-row-per-group (A6,
C2-C4): a keyed processor holds the winning row of each group in the state
store and gives it out only when it changes, so a micro-batch writes the groups
that new rows have changed and nothing else.  ``interval_join_stream`` joins
two streams on keys and a bounded distance in time; watermarks on both sides
let Spark drop rows from the state that no later row can meet.

Changes go to a folder per batch below one path, written over on a retry, so a
restarted query repeats its last batch without doubling rows; ``latest_rows``
reads the newest change of each group.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


class LatestRow(StatefulProcessor):
    """Holds the row that is greatest by the ``order`` columns, in that order.

    A row that is equal in all of them does not replace the one held, so give
    an order that is total.  NULL comes before every value.  With ``ttl_ms`` a
    group that gets no better row for that long leaves the state; a later row
    of the group then starts afresh.
    """

    def __init__(self, columns: Sequence[str], order: Sequence[str], state: T.StructType, ttl_ms: int | None):
        self.columns, self.order, self.state, self.ttl_ms = list(columns), list(order), state, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", self.state, self.ttl_ms)

    def rank(self, row: Row) -> tuple:
        values = [row[self.columns.index(c)] for c in self.order]
        return tuple((v is not None, v if v is not None else 0) for v in values)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.best.get() if self.best.exists() else None
        best = max(rows, key=self.rank, default=None)
        if best is not None and (held is None or self.rank(best) > self.rank(held)):
            self.best.update(tuple(best))
            yield Row(**dict(zip(self.columns, best)))

    def close(self) -> None:
        pass


def latest_row_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[str], ttl_ms: int | None = None) -> DataFrame:
    """Changed winners of each group, as a stream in update mode.

    ``keys`` and ``order`` name columns; a NULL key is a group of its own.  The
    session needs the RocksDB state store (``rocksdb_state``)."""
    state = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema.fields])
    processor = LatestRow(stream.columns, order, state, ttl_ms)
    return stream.groupBy(*keys).transformWithState(processor, state, "Update", "ProcessingTime" if ttl_ms else "None")


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Settings for the queries started inside: state in RocksDB, which keyed
    processors need, and no batches without rows, which a time to live would
    ask for without end (``availableNow`` would never stop)."""
    wanted = {PROVIDER: ROCKSDB, EMPTY_BATCHES: "false"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def interval_join_stream(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[tuple[str, str]],
    on: tuple[str, str],
    within: str,
    delay: str = "0 seconds",
    extra: Callable[[DataFrame, DataFrame], Column] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Left rows with the right rows of equal keys that lie at most ``within``
    before them: ``right time <= left time <= right time + within``.

    ``delay`` is how late rows may come on either side.  A row leaves the state
    once the other side's watermark has passed its interval, so the state holds
    about ``within + delay`` of rows however long the streams run.  ``how`` is
    inner or left (unmatched left rows come out when their interval has
    passed)."""
    if how not in ("inner", "left"):
        raise ValueError("interval_join_stream is inner or left")
    a, b = left.withWatermark(on[0], delay), right.withWatermark(on[1], delay)
    cond = (a[on[0]] >= b[on[1]]) & (a[on[0]] <= b[on[1]] + F.expr(f"INTERVAL {within}"))
    for x, y in by:
        cond = cond & (a[x] == b[y])
    if extra is not None:
        cond = cond & extra(a, b)
    return a.join(b, cond, "left_outer" if how == "left" else "inner")


def write_changes(stream: DataFrame, path: str, checkpoint_location: str, mode: str = "update", available_now: bool = True):
    """Write each micro-batch's rows to its own folder ``batch=<id>`` below
    ``path``; a batch that is run again replaces its folder.  Returns the
    started query."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint_location).foreachBatch(write_batch)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def finished(query) -> list[dict]:
    """Wait for an ``availableNow`` query; its progress reports."""
    query.awaitTermination()
    error = query.exception()
    if error is not None:
        raise RuntimeError(f"streaming query failed: {error}")
    return [p.jsonValue if hasattr(p, "jsonValue") else p for p in query.recentProgress]


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The newest change of each group below ``path``: one row per group."""
    changes = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).option("basePath", path).parquet(f"{path}/batch=*")
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(schema.fieldNames())])
    newest = changes.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, "batch").alias("row"))
    return newest.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(schema.fieldNames())])
