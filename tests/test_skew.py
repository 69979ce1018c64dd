"""A key holding a third of all rows is split across tasks, never one task."""

from pyspark.sql import functions as F

from cataloom.operators import aggregate as A
from cataloom.operators import join as J
from cataloom.session import cluster_conf


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def skewed(spark, n=30000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("v"),
    )


def test_join_back_on_hot_key_is_split(spark):
    df = skewed(spark)

    def run():
        out = J.join_back_aggregate(df, ["k"], [F.count(F.lit(1)).alias("n")])
        rows = out.filter("k = 0").select("n").distinct().collect()
        return out._jdf.queryExecution().executedPlan().toString(), rows

    plan, rows = _with_conf(spark, SKEW_CONF, run)
    assert [r.n for r in rows] == [10000]
    assert "SortMergeJoin" in plan


def test_skew_join_operator_reported(spark):
    df = skewed(spark)

    def run():
        out = J.join_back_aggregate(df, ["k"], [F.count(F.lit(1)).alias("n")])
        out.collect()
        return out._jdf.queryExecution().executedPlan().toString()

    plan = _with_conf(spark, SKEW_CONF, run)
    assert "SortMergeJoin(skew=true)" in plan


def test_latest_semi_join_on_hot_ties_is_split(spark):
    # a third of all rows tie on one group's winning (d, v) tuple
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(9)).otherwise(F.col("id") % 7).alias("d"),
        F.lit(1).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),  # shuffle bytes AQE can measure
    )

    def run():
        out = A.latest_per_group(df, ["k"], ["d", "v"], split_ties=16)
        n = out.filter("k = 0").count()
        out.collect()
        return n, out._jdf.queryExecution().executedPlan().toString()

    n, plan = _with_conf(spark, SKEW_CONF, run)
    assert n == 10000
    assert "SortMergeJoin(skew=true)" in plan


def test_latest_limits_a_hot_group_before_the_exchange(spark):
    df = skewed(spark).withColumn("d", F.col("v"))
    out = A.latest_per_group(df, ["k"], ["d", "v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    winners = df.groupBy("k").agg(F.max("d").alias("d"))
    assert out.count() == df.join(winners, ["k", "d"]).count()
    assert out.filter("k = 0").count() == df.filter("k = 0 AND d = 6").count()


def test_latest_split_ties_with_identical_hot_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("d"))
    for method, ties in (("window", None), ("window", 8), ("join_back", None)):
        out = A.latest_per_group(df, ["k"], ["d"], method=method, split_ties=ties)
        assert out.count() == 9000 and out.filter("k = 0").count() == df.filter("k = 0").count(), (method, ties)


def test_cluster_conf_sizes():
    conf = cluster_conf(1000)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 4000
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_fk_join_on_hot_parent_is_split(spark, tmp_path):
    from cataloom.sources.catalog import Catalog

    root = str(tmp_path)
    spark.range(30000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("o_custkey"),
        F.sha2(F.col("id").cast("string"), 256).alias("o_comment"),
    ).write.parquet(f"{root}/orders.parquet")
    spark.range(5000).select(F.col("id").alias("c_custkey"), F.col("id").cast("string").alias("c_name")) \
        .write.parquet(f"{root}/customer.parquet")
    cat = Catalog.from_files(spark, "s", root, ["orders", "customer"], [("orders.o_custkey", "customer.c_custkey")])

    def run():
        df = J.auto_join(cat, "s.orders", "s.customer").df
        n = df.filter("customer__c_custkey = 7").count()
        df.collect()
        return n, df._jdf.queryExecution().executedPlan().toString()

    n, plan = _with_conf(spark, SKEW_CONF, run)
    assert n == sum(1 for i in range(30000) if (7 if i % 3 == 0 else i % 5000) == 7)
    assert "SortMergeJoin(skew=true)" in plan
