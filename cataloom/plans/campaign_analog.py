"""Campaign input tables derived from the driver's TPC-H-like tables.

The campaign's ten inputs do not exist in the test data, so each is a view
over whole driver tables (claims = every lineitem joined to its order).  The
SQL below is portable: Spark runs it with DataFrame parameters and the DuckDB
oracle runs the same text as CTEs.  Arithmetic on keys only derives synthetic
attribute values (link ids, codes, dates) and keys: every row of its input is in
a view, and where a view is to be sparse the other rows get a key (negative)
that finds no partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cataloom.plans.campaign import VIEW_FOR, CampaignTables

# Analog definitions of the ten campaign inputs.
ANALOG_SQL = {
    "V_PHMCY_CLM": (
        "SELECT l_orderkey*10+l_linenumber AS CLM_EVNT_GID, o_custkey AS MBR_ACCT_GID, "
        "l_partkey AS DRUG_PROD_GID, o_custkey%5 AS LVL1_ACCT_GID, o_custkey%3 AS LVL3_ACCT_GID, "
        "l_suppkey AS PHMCY_PTY_GID, l_suppkey AS PRSCBR_PTY_GID, CAST(l_shipdate AS DATE) AS FILL_DT, "
        "CASE WHEN o_orderstatus='P' THEN 'SCNDRY' ELSE 'PRMRY' END AS COB_CD, "
        "CASE WHEN l_returnflag='R' THEN 'R' WHEN l_returnflag='A' THEN 'M' ELSE 'X' END AS DLVRY_SYSTM_CD, "
        "CAST(l_quantity*2 AS INT) AS DAY_SPLY_QTY, l_linestatus AS ADJD_FRMLY_CD, "
        "l_linestatus AS MEDD_CLM_IND, o_orderstatus AS SRC_CD, 'N' AS PHMCY_LTC_IND, "
        "l_orderkey*10+l_linenumber AS ZIW_ROW_ID "
        "FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey"
    ),
    "V_MBR_ACCT_HIST": (
        "SELECT c_custkey AS MBR_ACCT_GID, "
        "CASE WHEN c_custkey%11=0 THEN NULL WHEN c_custkey%13=0 THEN 0 ELSE c_custkey%500+1 END AS EPH_LINK_ID, "
        "CASE WHEN c_mktsegment='MACHINERY' THEN 'N' ELSE 'Y' END AS REC_SRC_FLG, "
        "CASE WHEN c_custkey%29=0 THEN NULL ELSE DATE'1940-01-05'+CAST((c_custkey*37)%21900 AS INT) END AS MBR_BRTH_DT, "
        "CASE WHEN c_custkey%2=0 THEN 'F' ELSE 'M' END AS GNDR_CD "
        "FROM {customer}"
    ),
    "V_DRUG_DENORM": (
        "SELECT p_partkey AS DRUG_PROD_GID, CASE WHEN p_size%17=0 THEN NULL ELSE p_type END AS GPI4_CD, "
        "CASE WHEN p_size%4=0 THEN '0' WHEN p_size%4=1 THEN ' ' WHEN p_size%4=2 THEN '2' END AS DEA_CLS_CD, "
        "CASE WHEN p_size%2=0 THEN 'Y' ELSE 'N' END AS BUS_MAINT_IND, "
        "CASE WHEN p_size%5=0 THEN 'Y' ELSE 'N' END AS SPCLT_DRUG_IND "
        "FROM {part}"
    ),
    "V_MBR_ACCT_CVRG": (
        "SELECT c_custkey AS MBR_ACCT_GID, DATE'2000-01-01' AS CVRG_EFF_DT, "
        "DATE'2001-06-01'+CAST(c_custkey%365 AS INT) AS CVRG_EXPRN_DT FROM {customer}"
    ),
    "V_MBR_ACCT_CONT_CVRG": (
        "SELECT CASE WHEN c_custkey%3=0 THEN c_custkey ELSE -c_custkey END AS MBR_ACCT_GID, DATE'2000-01-01' AS ELIG_CC_EFF_DT, "
        "DATE'2002-01-01' AS ELIG_CC_EXPRN_DT FROM {customer}"
    ),
    "V_CLNT_ACCT_DENORM": (
        "SELECT CAST(n_nationkey%5 AS BIGINT) AS LVL1_ACCT_GID, CAST(n_nationkey%3 AS BIGINT) AS LVL3_ACCT_GID, "
        "CAST(n_regionkey AS STRING) AS LVL0_ACCT_ID, n_name AS LVL0_ACCT_NM, DATE'1990-01-01' AS LVL0_EFF_DT, "
        "DATE'2099-12-31' AS LVL0_EXPRN_DT, CAST(n_nationkey AS STRING) AS LVL1_ACCT_ID, n_name AS LVL1_ACCT_NM, "
        "DATE'1990-01-01' AS LVL1_EFF_DT, DATE'2099-12-31' AS LVL1_EXPRN_DT, 'T1' AS NON_PBM_CLNT_TYP_CD, "
        "'L1' AS NON_PBM_LOB_CD FROM {nation}"
    ),
    "V_PHMCY_DENORM": (
        "SELECT s_suppkey AS PHMCY_PTY_GID, CASE WHEN s_nationkey%2=0 THEN 'Y' ELSE 'N' END AS CVS_MAIL_IND, "
        "CASE WHEN s_nationkey%3=0 THEN 'Y' ELSE 'N' END AS CVS_RTL_IND FROM {supplier}"
    ),
    "V_BNFT_PLAN_RXC_CAG_PLAN_OPTNS": (
        "SELECT CAST(n_nationkey%5 AS BIGINT) AS LVL1_ACCT_GID, CAST(n_nationkey%3 AS BIGINT) AS LVL3_ACCT_GID, "
        "CASE WHEN n_nationkey=14 THEN 'I' ELSE 'A' END AS STUS_CD, "
        "CASE WHEN n_nationkey%2=0 THEN 'Y' ELSE 'N' END AS MAIL_IND, "
        "CASE WHEN n_nationkey%3<2 THEN 'MV' ELSE 'NA' END AS MAINT_CHOICE_TYP_CD "
        "FROM {nation}"
    ),
    "V_MBR_ACCT_HRCHY": (
        "SELECT CASE WHEN c_custkey%4<>0 THEN c_custkey ELSE -c_custkey END AS MBR_ACCT_GID, CASE WHEN c_custkey%5<>0 THEN 'Q' ELSE 'R' END AS SRC_CD "
        "FROM {customer}"
    ),
    "V_MBR_PGM_RX_SCHD_HIST": (
        "SELECT CASE WHEN c_custkey%2=0 THEN c_custkey ELSE -c_custkey END AS SCHD_ENRL_BNFCY_ID, CAST(5383+c_custkey%3 AS INT) AS SCH_PGM_ID, "
        "CASE WHEN c_custkey%5<4 THEN 'PTL' ELSE 'XXX' END AS SCHD_OPT_IN_PRCS_SRC_CD, "
        "CASE WHEN c_custkey%7=0 THEN '2001-01-01' WHEN c_custkey%7=1 THEN '' END AS SCHD_OPT_OUT_DT "
        "FROM {customer} "
        "UNION ALL SELECT CASE WHEN c_custkey%14=0 THEN c_custkey ELSE -c_custkey END, 5384, 'CPT', NULL FROM {customer}"
    ),
}

DRIVER_TABLES = ["lineitem", "orders", "customer", "part", "nation", "supplier"]


def analog_view(spark: SparkSession, sf_dir: str, view: str, frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """One analog view; ``frames`` caches the driver-table readers."""
    frames = {} if frames is None else frames
    sql = ANALOG_SQL[view]
    used = {}
    for t in DRIVER_TABLES:
        if "{" + t + "}" in sql:
            if t not in frames:
                frames[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
            used[t] = frames[t]
    return spark.sql(sql, **used)


def analog_tables(spark: SparkSession, sf_dir: str) -> CampaignTables:
    frames: dict[str, DataFrame] = {}
    return CampaignTables(**{field: analog_view(spark, sf_dir, view, frames) for field, view in VIEW_FOR.items()})


def oracle_ctes() -> str:
    """``WITH`` clause defining all analog views over the oracle's tables."""
    parts = [f"{v} AS ({ANALOG_SQL[v].format(**{t: t for t in DRIVER_TABLES})})" for v in ANALOG_SQL]
    return "WITH " + ",\n".join(parts)
