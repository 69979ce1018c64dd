import os

from pyspark.sql import functions as F

from cataloom.streaming import incremental as S


def test_stream_max_over_growing_folder(spark, scratch_dir):
    src = os.path.join(scratch_dir, "stream_src")
    spark.createDataFrame([(1, 5), (2, 3)], "k int, v int").write.mode("append").parquet(src)
    spark.createDataFrame([(1, 9), (3, 1)], "k int, v int").write.mode("append").parquet(src)
    out = S.run_latest_stream(spark, src, ["k"], "v")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 9, 2), (2, 3, 1), (3, 1, 1)]


def test_stream_resumes_from_checkpoint(spark, scratch_dir):
    src = os.path.join(scratch_dir, "stream_src2")
    out = os.path.join(scratch_dir, "stream_out2")
    ckpt = os.path.join(scratch_dir, "stream_ckpt2")
    spark.createDataFrame([(1, 5)], "k int, v int").write.mode("append").parquet(src)

    def run():
        stream = S.read_table_stream(spark, folder=src)
        S.write_stream_snapshots(S.incremental_max(stream, ["k"], "v"), out, ckpt).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    assert run() == [(1, 5, 1)]
    spark.createDataFrame([(1, 7), (2, 2)], "k int, v int").write.mode("append").parquet(src)
    # the second run reads only the new file and merges it into the saved state
    assert run() == [(1, 7, 2), (2, 2, 1)]


def test_stream_file_sink(spark, scratch_dir):
    src = os.path.join(scratch_dir, "stream_src3")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string").write.parquet(src)
    stream = S.read_table_stream(spark, folder=src).filter(F.col("k") > 1)
    q = S.write_stream_files(stream, os.path.join(scratch_dir, "orc_sink"), os.path.join(scratch_dir, "orc_ckpt"))
    q.awaitTermination()
    assert [tuple(r) for r in spark.read.orc(os.path.join(scratch_dir, "orc_sink")).collect()] == [(2, "b")]


def test_windows_leave_the_state(spark, scratch_dir):
    src, out = os.path.join(scratch_dir, "stream_src4"), os.path.join(scratch_dir, "stream_out4")
    for day, v in (("2024-01-01", 1), ("2024-01-01", 4), ("2024-02-01", 2), ("2024-03-01", 3)):
        spark.sql(f"SELECT 1 AS k, {v} AS v, TIMESTAMP '{day} 10:00:00' AS ts").write.mode("append").parquet(src)
    stream = S.read_table_stream(spark, folder=src, max_files_per_trigger=1)
    per_day = S.incremental_max(stream, ["k"], "v", window=("ts", "1 day", "2 days"))
    S.write_stream_files(per_day, out, os.path.join(scratch_dir, "stream_ckpt4"), fmt="parquet").awaitTermination()
    done = sorted((r.window.start.isoformat()[:10], r.max_v, r.n_rows) for r in spark.read.parquet(out).collect())
    assert done == [("2024-01-01", 4, 2), ("2024-02-01", 2, 1)]  # the last window is still open
