import datetime as dt
import json
import os

from cataloom.streaming import stateful as S
from cataloom.streaming.incremental import read_table_stream

SCHEMA = "k string, day date, id int, note string"


def put(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def day(n):
    return dt.date(2001, 1, 1) + dt.timedelta(days=n)


def test_latest_row_restarts_and_writes_changed_groups_only(spark, scratch_dir):
    src, out, log = (os.path.join(scratch_dir, f"latest_{n}") for n in ("src", "out", "log"))

    def run():
        with S.rocksdb_state(spark):
            stream = S.latest_row_stream(read_table_stream(spark, folder=src), ["k"], ["day", "id"])
            S.finished(S.write_changes(stream, out, log))
        return sorted((tuple(r) for r in S.latest_rows(spark, out, ["k"], stream.schema).collect()), key=repr)

    put(spark, src, [("a", day(1), 1, "x"), ("a", day(3), 2, "y"), ("b", day(2), 3, None), (None, day(1), 4, "n")])
    first = run()
    assert first == sorted([("a", day(3), 2, "y"), ("b", day(2), 3, None), (None, day(1), 4, "n")], key=repr)
    put(spark, src, [("a", day(2), 9, "older"), ("b", day(2), 5, "same day, greater id"), ("b", None, 99, "no day")])
    assert run() == sorted([("a", day(3), 2, "y"), ("b", day(2), 5, "same day, greater id"), (None, day(1), 4, "n")], key=repr)
    # the second run read the new file only and wrote the one group that changed
    batches = sorted(int(n.split("=")[1]) for n in os.listdir(out) if n.startswith("batch="))
    assert len(batches) == 2
    changed = spark.read.parquet(f"{out}/batch={batches[-1]}").collect()
    assert [r["k"] for r in changed] == ["b"]
    assert spark.conf.get(S.PROVIDER) != S.ROCKSDB


def test_latest_row_with_time_to_live(spark, scratch_dir):
    src, out, log = (os.path.join(scratch_dir, f"ttl_{n}") for n in ("src", "out", "log"))
    for rows in ([("a", day(5), 1, "x")], [("a", day(1), 2, "older")]):
        put(spark, src, rows)
        with S.rocksdb_state(spark):
            stream = S.latest_row_stream(read_table_stream(spark, folder=src), ["k"], ["day", "id"], ttl_ms=1)
            S.finished(S.write_changes(stream, out, log))
    # the held row had left the state, so the older row won in its batch
    newest = S.latest_rows(spark, out, ["k"], stream.schema).collect()
    assert [(r["id"], r["note"]) for r in newest] == [(2, "older")]


def interval_run(spark, scratch_dir, name, how="inner"):
    claims, changes, out, log = (os.path.join(scratch_dir, f"{name}_{n}") for n in ("claims", "changes", "out", "log"))
    for start in range(0, 400, 40):
        at = lambda n: dt.datetime(2001, 1, 1) + dt.timedelta(days=n)
        put(spark, claims, [(f"m{i % 3}", at(start + i), start + i) for i in range(40)], "k string, ts timestamp, id int")
        put(spark, changes, [(f"m{i % 3}", at(start + i), 1000 + start + i) for i in range(0, 40, 5)], "k2 string, at timestamp, rid int")
    left = read_table_stream(spark, folder=claims, max_files_per_trigger=1)
    right = read_table_stream(spark, folder=changes, max_files_per_trigger=1)
    joined = S.interval_join_stream(left, right, [("k", "k2")], ("ts", "at"), "10 days", delay="1 day", how=how)
    progress = S.finished(S.write_changes(joined.select("id", "rid"), out, log, mode="append"))
    rows = spark.read.schema("id int, rid int").parquet(f"{out}/batch=*").collect()
    return progress, [(r["id"], r["rid"]) for r in rows]


def test_interval_join_and_bounded_state(spark, scratch_dir):
    progress, got = interval_run(spark, scratch_dir, "interval")
    want = [(i, 1000 + j) for i in range(400) for j in range(0, 400, 5) if (i % 40) % 3 == (j % 40) % 3 and j <= i <= j + 10]
    assert sorted(got) == sorted(want)
    held = [op["numRowsTotal"] for p in progress for op in _parsed(p)["stateOperators"]]
    gone = sum(op["numRowsRemoved"] for p in progress for op in _parsed(p)["stateOperators"])
    assert gone > 300  # most of the 480 rows have left the state
    assert max(held) < 200 and held[-1] < 100


def _parsed(progress):
    return json.loads(progress.json) if hasattr(progress, "json") else progress


def test_interval_join_left_rows_without_a_partner(spark, scratch_dir):
    _, got = interval_run(spark, scratch_dir, "interval_left", how="left")
    lonely = {i for i, r in got if r is None}
    matched = {i for i, r in got if r is not None}
    assert lonely and not lonely & matched
    for i in lonely:
        assert not any((i % 40) % 3 == (j % 40) % 3 and j <= i <= j + 10 for j in range(0, 400, 5))


def test_state_settings_are_put_back(spark):
    spark.conf.set(S.PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    with S.rocksdb_state(spark):
        assert spark.conf.get(S.PROVIDER) == S.ROCKSDB
    assert spark.conf.get(S.PROVIDER).endswith("HDFSBackedStateStoreProvider")
    spark.conf.unset(S.PROVIDER)
