import zlib
from collections import Counter

from pyspark.sql import functions as F

from cataloom.llm import sharding
from cataloom.llm.queries import op8_rendezvous


def test_query_table(spark, sf, documents):
    rows = op8_rendezvous(spark, sf).collect()
    texts = dict(documents)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots = Counter()
    for r in rows:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 1, zlib.crc32(body), "key")
        assert r["grown_shard"] in (r["shard"], 16)
        slots[r["shard"]] += 1
    for s, n in slots.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))


def test_weights_and_growth(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"))
    share = {r["s"]: r["count"] for r in keys.groupBy(sharding.rendezvous(F.col("doc_id"), [1.0, 1.0, 2.0]).alias("s")).count().collect()}
    assert abs(share[2] / 20_000 - 0.5) < 0.02 and abs(share[0] / 20_000 - 0.25) < 0.02
    moved = keys.select(sharding.rendezvous(F.col("doc_id"), [1.0] * 16).alias("a"), sharding.rendezvous(F.col("doc_id"), [1.0] * 17).alias("b")).where("a <> b")
    assert moved.where("b <> 16").count() == 0
    assert abs(moved.count() / 20_000 - 1 / 17) < 0.01


def test_edge_cases(make, edge, monkeypatch):
    rows = sharding.shard_documents(make(edge), [1.0, 3.0]).collect()
    assert len(rows) == len(edge)
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    by_key = {}
    for r in rows:
        assert by_key.setdefault(r["doc_id"], r["shard"]) == r["shard"]
    assert sharding.shard_documents(make([]), [1.0]).collect() == []


def test_slots_over_many_blocks(spark):
    from cataloom.llm.common import checkpoint, gapless

    df = checkpoint(spark.range(5000).selectExpr("id", "cast(id % 3 > 0 as int) as g", "id as _row"))
    rows = gapless(df, ["g"], ["id"], "id", "slot", rows_per_block=100).collect()
    for g in (0, 1):
        assert sorted(r["slot"] for r in rows if r["g"] == g) == list(range(sum(r["g"] == g for r in rows)))


def test_shards_by_an_independent_formula(spark, sf):
    """Every row's shard and grown shard from the hash library and math.log."""
    import math
    import struct

    from xxhash import xxh64_intdigest

    from cataloom.llm.queries import op8_rendezvous

    def best(key, n):
        seed = xxh64_intdigest(str(key).encode(), 42)
        u = [((xxh64_intdigest(struct.pack("<i", s), seed) >> 12) + 0.5) / 2**52 for s in range(n)]
        return max(range(n), key=lambda s: (-1.0 / math.log(u[s]), -s))

    rows = op8_rendezvous(spark, sf).collect()
    assert len(rows) == 200
    for r in rows:
        assert (r["shard"], r["grown_shard"]) == (best(r["doc_id"], 16), best(r["doc_id"], 17))
