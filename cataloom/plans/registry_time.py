"""Registered queries about order and time: inequality and range joins, as-of
joins, keyed streams and versioned tables; plus local rows (S8)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cataloom.operators import asof
from cataloom.operators import join as joins
from cataloom.plans import campaign as C
from cataloom.plans.campaign_analog import ANALOG_SQL, analog_tables, analog_view
from cataloom.plans.registry import ORACLE, T, _opts, register
from cataloom.session import shared_path
from cataloom.sources import files
from cataloom.sources.snapshots import SnapshotTable
from cataloom.streaming import stateful
from cataloom.streaming.incremental import read_table_stream

# Stand-in inputs as portable SQL, run by Spark and the oracle.
CHANGES_SQL = (
    "SELECT o_custkey AS MBR_ACCT_GID, CAST(o_orderdate AS DATE) AS CVRG_EFF_DT, o_orderkey AS CVRG_GID, "
    "o_orderpriority AS PLAN_CD FROM {orders}"
)
PERIODS_SQL = (
    "SELECT n_nationkey, CAST(DATE'1995-01-01' + CAST(n_nationkey * 97 AS INT) AS DATE) AS PERIOD_EFF_DT, "
    "CAST(DATE'1995-01-01' + CAST(n_nationkey * 97 + 30 + n_nationkey AS INT) AS DATE) AS PERIOD_EXPRN_DT FROM {nation}"
)
#: Days after a coverage change in which a claim counts for it.
COVERAGE_DAYS = 60


def _claims_and(sql: str, view: str, table: str) -> str:
    claims = ANALOG_SQL["V_PHMCY_CLM"].format(lineitem="lineitem", orders="orders")
    return f"WITH CLM AS ({claims}), {view} AS ({sql.format(**{table: table})}) "


# ====================================================================== inequalities
@register(
    "join_inequality",
    "SELECT p_partkey, p_retailprice, s_suppkey, s_acctbal FROM part JOIN supplier ON p_retailprice > s_acctbal AND p_partkey < s_suppkey * 2",
)
def join_inequality(spark, d):
    part, supplier = T(spark, d, "part"), T(spark, d, "supplier")
    return joins.join_tables(
        part, supplier, "p_retailprice > s_acctbal AND p_partkey < s_suppkey * 2",
        select_cols=["p_partkey", "p_retailprice", "s_suppkey", "s_acctbal"],
    )


@register(
    "join_inequality_full",
    "SELECT s_suppkey, s_acctbal, n_nationkey, n_name FROM supplier FULL JOIN nation "
    "ON s_acctbal < n_nationkey * 300 AND s_suppkey >= n_nationkey * n_nationkey AND s_nationkey <> n_nationkey",
)
def join_inequality_full(spark, d):
    """Two inequalities, a further condition, and rows without a partner on both sides."""
    return joins.join_tables(
        T(spark, d, "supplier"), T(spark, d, "nation"),
        "s_acctbal < n_nationkey * 300 AND s_suppkey >= n_nationkey * n_nationkey AND s_nationkey <> n_nationkey",
        "outer", select_cols=["s_suppkey", "s_acctbal", "n_nationkey", "n_name"],
    )


@register(
    "range_join_dates",
    "WITH P AS (" + PERIODS_SQL.format(nation="nation") + ") SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_dt, n_nationkey, PERIOD_EFF_DT "
    "FROM orders LEFT JOIN P ON CAST(o_orderdate AS DATE) BETWEEN PERIOD_EFF_DT AND PERIOD_EXPRN_DT",
)
def range_join_dates(spark, d):
    """Orders with the periods that cover their day; ``join_tables`` finds the range."""
    orders = T(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_dt"))
    periods = spark.sql(PERIODS_SQL, nation=T(spark, d, "nation"))
    return joins.join_tables(
        orders, periods, "order_dt BETWEEN PERIOD_EFF_DT AND PERIOD_EXPRN_DT", "left",
        select_cols=["o_orderkey", "order_dt", "n_nationkey", "PERIOD_EFF_DT"],
    )


# ====================================================================== as of
@register(
    "asof_coverage",
    _claims_and(CHANGES_SQL, "CHG", "orders")
    + ", LASTCHG AS (SELECT * FROM CHG QUALIFY row_number() OVER (PARTITION BY MBR_ACCT_GID, CVRG_EFF_DT ORDER BY CVRG_GID DESC) = 1) "
    "SELECT CLM.CLM_EVNT_GID, CLM.MBR_ACCT_GID, CLM.FILL_DT, L.CVRG_EFF_DT, L.CVRG_GID, L.PLAN_CD "
    "FROM CLM ASOF LEFT JOIN LASTCHG L ON CLM.MBR_ACCT_GID = L.MBR_ACCT_GID AND CLM.FILL_DT >= L.CVRG_EFF_DT",
)
def asof_coverage(spark, d):
    """Each claim with the plan and coverage row in force at its fill date."""
    claims = analog_view(spark, d, "V_PHMCY_CLM").select("CLM_EVNT_GID", "MBR_ACCT_GID", "FILL_DT")
    changes = spark.sql(CHANGES_SQL, orders=T(spark, d, "orders")).withColumnRenamed("MBR_ACCT_GID", "MBR")
    joined = asof.asof_join(claims, changes, [("MBR_ACCT_GID", "MBR")], ("FILL_DT", "CVRG_EFF_DT"), tie_break=["CVRG_GID"])
    return joined.drop("MBR")


# ====================================================================== keyed streams
@register(
    "stream_latest_claims",
    ORACLE["campaign_latest"].replace("SELECT * FROM LATEST", "SELECT " + ", ".join([*C.LATEST_KEYS, *C.LATEST_ORDER, "PHMCY_MBR_ACCT_GID"]) + " FROM LATEST"),
)
def stream_latest_claims(spark, d):
    """The latest claim per member link and drug class (C2-C4), kept in state:
    claims arrive as a stream, members and drugs are tables."""
    tables = analog_tables(spark, d)
    lines = read_table_stream(spark, folder=d, file_glob="lineitem.parquet")
    tables = replace(tables, claims=spark.sql(ANALOG_SQL["V_PHMCY_CLM"], lineitem=lines, orders=T(spark, d, "orders")))
    columns = [*C.LATEST_KEYS, *C.LATEST_ORDER, "PHMCY_MBR_ACCT_GID"]
    base = C.claim_base(tables, _opts()).select(*columns).where(" AND ".join(f"{k} IS NOT NULL" for k in C.LATEST_KEYS))
    out, log = shared_path(spark, "latest_claims"), shared_path(spark, "latest_claims_log")
    with stateful.rocksdb_state(spark):
        stream = stateful.latest_row_stream(base, C.LATEST_KEYS, C.LATEST_ORDER)
        stateful.finished(stateful.write_changes(stream, out, log))
    return stateful.latest_rows(spark, out, C.LATEST_KEYS, stream.schema)


@register(
    "stream_claims_in_coverage",
    _claims_and(CHANGES_SQL, "CHG", "orders")
    + f"SELECT CLM_EVNT_GID, FILL_DT, CVRG_GID, CVRG_EFF_DT, PLAN_CD FROM CLM JOIN CHG ON CLM.MBR_ACCT_GID = CHG.MBR_ACCT_GID "
    f"AND FILL_DT BETWEEN CVRG_EFF_DT AND CAST(CVRG_EFF_DT + {COVERAGE_DAYS} AS DATE)",
)
def stream_claims_in_coverage(spark, d):
    """Claims with the member's coverage changes of the days before, both as streams."""
    lines = read_table_stream(spark, folder=d, file_glob="lineitem.parquet")
    claims = spark.sql(ANALOG_SQL["V_PHMCY_CLM"], lineitem=lines, orders=T(spark, d, "orders"))
    changes = spark.sql(CHANGES_SQL, orders=read_table_stream(spark, folder=d, file_glob="orders.parquet"))
    claims = claims.select("CLM_EVNT_GID", "MBR_ACCT_GID", "FILL_DT", F.col("FILL_DT").cast("timestamp").alias("FILL_TS"))
    changes = changes.withColumnRenamed("MBR_ACCT_GID", "MBR").withColumn("CVRG_TS", F.col("CVRG_EFF_DT").cast("timestamp"))
    joined = stateful.interval_join_stream(claims, changes, [("MBR_ACCT_GID", "MBR")], ("FILL_TS", "CVRG_TS"), f"{COVERAGE_DAYS} DAYS", delay="180 days")
    out, log = shared_path(spark, "claims_in_coverage"), shared_path(spark, "claims_in_coverage_log")
    rows = joined.select("CLM_EVNT_GID", "FILL_DT", "CVRG_GID", "CVRG_EFF_DT", "PLAN_CD")
    stateful.finished(stateful.write_changes(rows, out, log, mode="append"))
    return spark.read.schema(rows.schema).parquet(f"{out}/batch=*")


# ====================================================================== versions
@register(
    "derived_snapshot",
    "SELECT c_custkey, c_mktsegment, c_mktsegment = 'BUILDING' AS in_first, c_acctbal > 0 AS in_credit FROM customer",
)
def derived_snapshot(spark, d):
    """A table saved twice, with other columns the second time; both versions are read."""
    customer = T(spark, d, "customer")
    table = SnapshotTable(spark, shared_path(spark, "snapshots", "customer"))
    first = table.save(customer.where("c_mktsegment = 'BUILDING'").select("c_custkey"))
    table.save(customer.select("c_custkey", "c_mktsegment", (F.col("c_acctbal") > 0).alias("in_credit")), fmt="parquet", expected=first.version)
    old = table.read(first.version).select(F.col("c_custkey").alias("old"))
    joined = table.read().join(old, F.col("c_custkey") == F.col("old"), "left")
    return joined.select("c_custkey", "c_mktsegment", F.col("old").isNotNull().alias("in_first"), "in_credit")


# ====================================================================== S8
@register(
    "local_rows",
    "SELECT r_name AS region_name, n_name FROM region JOIN nation ON r_regionkey = n_regionkey",
)
def local_rows(spark, d):
    """A small table collected to the driver (five regions) as a frame again."""
    rows = [tuple(r) for r in T(spark, d, "region").select("r_regionkey", "r_name").collect()]
    regions = files.from_local(spark, rows, "region_key int, region_name string")
    nation = T(spark, d, "nation")
    return joins.equi_join(regions, nation, [("region_key", "n_regionkey")]).select("region_name", "n_name")
