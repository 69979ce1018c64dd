"""Structured Streaming forms of the catalog scan, grouped max and sinks.

New files landing in a table's folder are read as a stream with the table's
own schema; the per-group max/count aggregate (the latest fill date per
member and drug class, A3/C2) is kept in Spark's state store, so each
micro-batch only touches new rows.  Results go to shared storage through
``foreachBatch`` with the stream's checkpoint next to them, so a restarted
job (or a lost executor) resumes from the last committed batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.session import shared_path
from cataloom.sources.catalog import TableDoc
from cataloom.sources.files import table_location


def read_table_stream(
    spark: SparkSession,
    doc: TableDoc | None = None,
    folder: str | None = None,
    fmt: str = "parquet",
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A catalogued table (or a folder) as a file stream.

    The schema comes from the files already there (streams do not infer),
    so new files must share it.
    """
    location = folder or table_location(doc)
    fmt = doc.format if doc is not None else fmt
    reader = spark.read.format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    schema = reader.load(location).schema
    stream = spark.readStream.format(fmt).schema(schema)
    if file_glob:
        stream = stream.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    return stream.load(location)


def incremental_max(
    stream: DataFrame,
    keys: Sequence[str],
    value: str,
    window: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Running max of ``value`` and row count per group, kept in state.

    State grows with the number of groups.  With ``window=(event_time, width,
    delay)`` groups are also split by event-time window (column ``window``),
    and windows older than the delay leave the state; write these in append or
    update mode, since complete mode keeps all of them.
    """
    groups = list(keys)
    if window:
        event_time, width, delay = window
        stream = stream.withWatermark(event_time, delay)
        groups.append(F.window(event_time, width).alias("window"))
    return stream.groupBy(*groups).agg(
        F.max(value).alias(f"max_{value}"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def write_stream_snapshots(
    aggregated: DataFrame,
    path: str,
    checkpoint_location: str,
    fmt: str = "parquet",
    available_now: bool = True,
):
    """Write the full aggregate state at every micro-batch (complete mode).

    Each batch overwrites ``path`` with the current result: read it between
    batches, an overwrite deletes first.  The checkpoint records offsets and
    state.
    Returns the started query.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(path)

    writer = (
        aggregated.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_location)
        .foreachBatch(write_batch)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_stream_files(
    stream: DataFrame,
    path: str,
    checkpoint_location: str,
    fmt: str = "orc",
    available_now: bool = True,
):
    """Append a stateless stream to files (the streaming form of the ORC
    sink); the file sink's log makes output exactly-once."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint_location).option("path", path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_latest_stream(
    spark: SparkSession,
    folder: str,
    keys: Sequence[str],
    value: str,
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Process everything in ``folder`` as a stream and return the result.

    ``max_files_per_trigger`` bounds a micro-batch; each one writes the result.

    Uses ``availableNow`` (all current files, in as many batches as needed,
    then stop) and reads the written snapshot back as a batch DataFrame.
    """
    out = shared_path(spark, "stream_out")
    ckpt = shared_path(spark, "stream_checkpoint")
    stream = read_table_stream(spark, folder=folder, file_glob=file_glob, max_files_per_trigger=max_files_per_trigger)
    query = write_stream_snapshots(incremental_max(stream, keys, value), out, ckpt)
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return spark.read.parquet(out)
