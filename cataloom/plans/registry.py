"""Registered queries over the driver tables, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is
the same result in portable SQL over the driver's table names.  Where rows
are free to differ (samples, previews, clustering) a query returns what has to
hold for them, checked over all rows.  Every query reads whole driver tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.functions import rules
from cataloom.operators import aggregate as agg
from cataloom.operators import fkgraph, learn, profile
from cataloom.operators import join as joins
from cataloom.operators import project as proj
from cataloom.operators.tracked import Tracked
from cataloom.plans import campaign as C
from cataloom.plans import tpch
from cataloom.plans.campaign_analog import VIEW_FOR, analog_tables, oracle_ctes
from cataloom.plans.campaign_analog_columns import ANALOG_COLUMNS
from cataloom.session import materialize, shared_path
from cataloom.sources import derived, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters of the registered queries.
CAMPAIGN_AS_OF = dt.date(2001, 11, 29)
AGE_AS_OF = dt.date(2024, 6, 15)
RECENT_AS_OF = dt.date(2001, 12, 31)
KDE_POINTS = [1.0, 5.5, 10.0, 17.5, 25.0, 32.5, 40.0, 45.5, 50.0]
HIST_BINS = 10
CATEGORICAL_MAX_LEVELS = 20
JSON_ARRAY_KEYS = 1000

# Driver table columns, in file order.
COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "labels": ["doc_id", "quality", "toxic"],
}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tpch.table(spark, sf_dir, name)


sig = learn.significant


def sql_sig(expr: str, digits: int = 7) -> str:
    return f"CAST(printf('%.{digits - 1}e', {expr}) AS DOUBLE)"


def qualified_select(*tables: str) -> str:
    return ", ".join(f"{t}.{c} AS {t}__{c}" for t in tables for c in COLUMNS[t])


# ====================================================================== J1
@register(
    "auto_join_3",
    f"SELECT {qualified_select('lineitem', 'orders', 'customer')} FROM lineitem, orders, customer "
    "WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey",
)
def auto_join_3(spark, d):
    cat = tpch.catalog(spark, d, ["lineitem", "orders", "customer"])
    return joins.auto_join(cat, tpch.q("lineitem"), tpch.q("orders"), tpch.q("customer")).df


@register(
    "auto_join_diamond",
    f"SELECT {qualified_select('lineitem', 'orders', 'customer', 'supplier', 'nation')} "
    "FROM lineitem, orders, customer, supplier, nation WHERE l_orderkey = o_orderkey "
    "AND l_suppkey = s_suppkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey "
    "AND s_nationkey = n_nationkey",
)
def auto_join_diamond(spark, d):
    names = ["lineitem", "orders", "customer", "supplier", "nation"]
    cat = tpch.catalog(spark, d, names)
    return joins.auto_join(cat, *[tpch.q(n) for n in names]).df


@register(
    "auto_join_labels",
    f"SELECT {qualified_select('labels', 'documents')} FROM labels, documents WHERE labels.doc_id = documents.doc_id",
)
def auto_join_labels(spark, d):
    cat = tpch.catalog(spark, d, ["labels", "documents"])
    return joins.auto_join(cat, tpch.q("labels"), tpch.q("documents")).df


# ====================================================================== J2 / J3 / J6
# the predicates are part of the condition: both tables flow whole, and rows of
# either side that meet no partner are there for the outer joins
JOIN_CONDITION = (
    "o_custkey = c_custkey AND c_mktsegment = 'BUILDING' "
    "AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'"
)
JOIN_COLS = ["o_orderkey", "o_custkey", "o_orderdate", "c_custkey", "c_name", "c_mktsegment"]
SEMI_COLS = ["o_orderkey", "o_custkey", "o_orderdate"]


def _join_inputs(spark, d):
    return T(spark, d, "orders"), T(spark, d, "customer")


def _join_sql(kind: str, cols) -> str:
    return f"SELECT {', '.join(cols)} FROM orders {kind} JOIN customer ON {JOIN_CONDITION}"


for _name, _how, _sqlkind in [
    ("join_inner", "inner", "INNER"),
    ("join_full", "outer", "FULL OUTER"),
    ("join_right", "right_outer", "RIGHT OUTER"),
]:
    def _fn(spark, d, _how=_how):
        o, c = _join_inputs(spark, d)
        return joins.join_tables(o, c, JOIN_CONDITION, _how, select_cols=JOIN_COLS)

    register(_name, _join_sql(_sqlkind, JOIN_COLS))(_fn)


@register("join_left", _join_sql("LEFT OUTER", JOIN_COLS))
def join_left(spark, d):
    o, c = _join_inputs(spark, d)
    return joins.left_outer_join_tables(o, c, JOIN_CONDITION, select_cols=JOIN_COLS)


@register("join_semi", f"SELECT {', '.join(SEMI_COLS)} FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE {JOIN_CONDITION})")
def join_semi(spark, d):
    o, c = _join_inputs(spark, d)
    return joins.join_tables(o, c, JOIN_CONDITION, "semijoin", select_cols=SEMI_COLS)


@register(
    "join_theta",
    "SELECT p_partkey, p_size, r_regionkey, r_name FROM part JOIN region "
    "ON p_size BETWEEN r_regionkey * 10 + 1 AND r_regionkey * 10 + 10",
)
def join_theta(spark, d):
    part = T(spark, d, "part").select("p_partkey", "p_size")
    region = T(spark, d, "region")
    return joins.range_join(
        part, region, "p_size", "r_regionkey * 10 + 1", "r_regionkey * 10 + 10", bin_width=10
    ).select("p_partkey", "p_size", "r_regionkey", "r_name")


@register(
    "range_join_full",
    "SELECT p_partkey, p_size, r_regionkey FROM part FULL JOIN region "
    "ON p_size BETWEEN r_regionkey * 11 + 1 AND r_regionkey * r_regionkey * 9",
)
def range_join_full(spark, d):
    """Ranges of growing length, one of them inverted; both sides keep rows
    without a partner."""
    part = T(spark, d, "part").select("p_partkey", "p_size")
    region = T(spark, d, "region").select("r_regionkey")
    return joins.range_join(part, region, "p_size", "r_regionkey * 11 + 1", "r_regionkey * r_regionkey * 9", how="full")


@register(
    "join_filter_select_prefix",
    "SELECT o_orderkey AS OC_O_ORDERKEY, o_totalprice AS OC_O_TOTALPRICE, c_name AS OC_C_NAME, "
    "c_mktsegment AS OC_C_MKTSEGMENT FROM orders JOIN customer ON o_custkey = c_custkey "
    "WHERE c_mktsegment = 'BUILDING'",
)
def join_filter_select_prefix(spark, d):
    return joins.join_tables(
        T(spark, d, "orders"), T(spark, d, "customer"), "o_custkey = c_custkey",
        filter_condition="c_mktsegment = 'BUILDING'",
        select_cols=["o_orderkey", "o_totalprice", "c_name", "c_mktsegment"],
        out_col_prefix="oc",
    )


@register(
    "join_composite",
    "SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, a.qty_per_part, a.lines_per_part "
    "FROM lineitem l JOIN (SELECT l_orderkey AS k_order, l_partkey AS k_part, sum(l_quantity) AS qty_per_part, "
    "count(*) AS lines_per_part FROM lineitem GROUP BY l_orderkey, l_partkey) a "
    "ON l.l_orderkey = a.k_order AND l.l_partkey = a.k_part",
)
def join_composite(spark, d):
    """Composite-key (order, part) join of lineitem to its own aggregate; the
    aggregate is materialized so AQE can split a hot (order, part) pair."""
    li = T(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return joins.join_back_aggregate(
        li, ["l_orderkey", "l_partkey"],
        [F.sum("l_quantity").alias("qty_per_part"), F.count(F.lit(1)).alias("lines_per_part")],
    )


@register(
    "equi_join_pairs",
    "SELECT l_orderkey, l_linenumber, l_linestatus, o_orderkey, o_orderstatus, o_totalprice FROM lineitem "
    "LEFT JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus",
)
def equi_join_pairs(spark, d):
    """Two tables on two keys; lines of partly shipped orders find no partner."""
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    o = T(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return joins.equi_join(li, o, [("l_orderkey", "o_orderkey"), ("l_linestatus", "o_orderstatus")], "left")


@register(
    "post_join_subset",
    "SELECT lineitem.* FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def post_join_subset(spark, d):
    li = T(spark, d, "lineitem")
    joined = joins.join_tables(li, T(spark, d, "orders"), "l_orderkey = o_orderkey")
    return proj.subset(joined, li.columns)


# ====================================================================== P
@register(
    "select_keep",
    "SELECT *, concat_ws('::', c_mktsegment, c_name) AS location FROM customer",
)
def select_keep(spark, d):
    return proj.select(T(spark, d, "customer"), "concat_ws('::', c_mktsegment, c_name) AS location")


@register(
    "select_expr",
    "SELECT l_orderkey, l_quantity * l_extendedprice AS total_sales_amount FROM lineitem",
)
def select_expr(spark, d):
    return proj.select(T(spark, d, "lineitem"), "l_orderkey", "l_quantity * l_extendedprice AS total_sales_amount",
                       keep_original=False)


@register(
    "select_expr_plain",
    "SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice / 100 AS price_hundreds FROM orders",
)
def select_expr_plain(spark, d):
    return proj.select_expr(T(spark, d, "orders"), "o_orderkey", "upper(o_orderpriority) AS priority",
                            "o_totalprice / 100 AS price_hundreds")


@register(
    "scan_filter_prefix",
    "SELECT " + ", ".join(f"{c} AS ORD_{c.upper()}" for c in COLUMNS["orders"])
    + " FROM orders WHERE o_orderstatus = 'F'",
)
def scan_filter_prefix(spark, d):
    return files.select_table(T(spark, d, "orders"), "o_orderstatus = 'F'", "ord")


@register(
    "rename_mapping",
    "SELECT l_orderkey AS ORDER_ID, l_linenumber AS LINE_NO, l_returnflag AS RETURN_FLAG FROM lineitem",
)
def rename_mapping(spark, d):
    return proj.project_mapping(
        T(spark, d, "lineitem"),
        [("l_orderkey", "ORDER_ID"), ("l_linenumber", "LINE_NO"), ("l_returnflag", "RETURN_FLAG")],
    )


def beyond_source(source: DataFrame, picked: DataFrame) -> DataFrame:
    """One row: how many rows were picked, and how many of them are not in the
    source or more often than there."""
    names = source.columns
    both = source.select(*names, F.lit(1).alias("__s"), F.lit(0).alias("__p"))
    both = both.unionAll(materialize(picked).select(*names, F.lit(0), F.lit(1)))
    each = both.groupBy(*names).agg(F.sum("__s").alias("__s"), F.sum("__p").alias("__p"))
    return each.agg(F.sum("__p").alias("picked"), F.sum(F.greatest(F.col("__p") - F.col("__s"), F.lit(0))).alias("beyond_source"))


@register("preview_limit", "SELECT CAST(least(20, count(*)) AS BIGINT) AS picked, CAST(0 AS BIGINT) AS beyond_source FROM lineitem")
def preview_limit(spark, d):
    """Which 20 rows is unspecified: their number, and that all are the table's."""
    li = T(spark, d, "lineitem")
    return beyond_source(li, proj.preview(li, 20))


# ====================================================================== A
@register(
    "agg_single",
    "SELECT c_nationkey, count(c_custkey) AS n_customers FROM customer GROUP BY c_nationkey",
)
def agg_single(spark, d):
    return agg.aggregate(T(spark, d, "customer"), "c_nationkey", n_customers=("n", "c_custkey"))


@register(
    "agg_multi",
    "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(avg(l_extendedprice), 6) AS avg_price, "
    "count(l_orderkey) AS n_lines, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def agg_multi(spark, d):
    return agg.aggregate(
        T(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"],
        sum_qty=("sum", "l_quantity"),
        avg_price=F.round(F.avg("l_extendedprice"), 6),
        n_lines=("n", "l_orderkey"),
        last_ship=("max", "l_shipdate"),
    )


@register(
    "agg_having",
    "SELECT c_nationkey, count(c_custkey) AS n_customers, round(avg(c_acctbal), 6) AS avg_acctbal "
    "FROM customer GROUP BY c_nationkey HAVING avg(c_acctbal) > 4500",
)
def agg_having(spark, d):
    grouped = agg.aggregate(
        T(spark, d, "customer"), "c_nationkey",
        n_customers=("n", "c_custkey"), __avg=("avg", "c_acctbal"),
    )
    return proj.filter_rows(grouped, "__avg > 4500").select(
        "c_nationkey", "n_customers", F.round("__avg", 6).alias("avg_acctbal")
    )


@register(
    "agg_sql_prefix",
    "SELECT o_orderpriority AS GRP_O_ORDERPRIORITY, o_orderstatus AS GRP_O_ORDERSTATUS, count(*) AS GRP_N_ORDERS, "
    "max(o_totalprice) AS GRP_MAX_PRICE FROM orders GROUP BY o_orderpriority, o_orderstatus",
)
def agg_sql_prefix(spark, d):
    return agg.group_by_sql(
        T(spark, d, "orders"), "o_orderpriority, o_orderstatus",
        "count(*) AS n_orders", "max(o_totalprice) AS max_price", out_col_prefix="grp",
    )


@register(
    "agg_sql_expression_key",
    "SELECT coalesce(o_orderstatus, ',') AS status, substr(o_orderpriority, 1, 1) AS level, count(*) AS n_orders "
    "FROM orders GROUP BY 1, 2",
)
def agg_sql_expression_key(spark, d):
    return agg.group_by_sql(
        T(spark, d, "orders"), "coalesce(o_orderstatus, ',') AS status, substr(o_orderpriority, 1, 1) AS level",
        "count(*) AS n_orders",
    )


@register(
    "agg_conditional",
    "SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_lines, "
    "count(*) AS n_lines FROM lineitem GROUP BY l_suppkey",
)
def agg_conditional(spark, d):
    return agg.aggregate(
        T(spark, d, "lineitem"), "l_suppkey",
        returned_lines=agg.count_if("l_returnflag = 'R'"),
        n_lines=F.count(F.lit(1)),
    )


LATEST_SQL = (
    "WITH t1 AS (SELECT o_custkey AS k1, o_orderpriority AS k2, max(o_orderdate) AS md FROM orders GROUP BY 1, 2), "
    "t2 AS (SELECT o.o_custkey AS k1, o.o_orderpriority AS k2, o.o_orderdate AS md, max(o.o_orderkey) AS mk "
    "FROM orders o JOIN t1 ON o.o_custkey = t1.k1 AND o.o_orderpriority = t1.k2 AND o.o_orderdate = t1.md "
    "GROUP BY 1, 2, 3) "
    "SELECT o.* FROM orders o JOIN t2 ON o.o_custkey = t2.k1 AND o.o_orderpriority = t2.k2 "
    "AND o.o_orderdate = t2.md AND o.o_orderkey = t2.mk"
)


@register("latest_per_group", LATEST_SQL)
def latest_per_group(spark, d):
    return agg.latest_per_group(T(spark, d, "orders"), ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@register("latest_per_group_window", LATEST_SQL)
def latest_per_group_window(spark, d):
    """The default form with full ties dealt to several tasks."""
    return agg.latest_per_group(
        T(spark, d, "orders"), ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], method="window", split_ties=8
    )


@register("latest_per_group_join_back", LATEST_SQL)
def latest_per_group_join_back(spark, d):
    return agg.latest_per_group(
        T(spark, d, "orders"), ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], method="join_back"
    )


@register("latest_per_group_struct", LATEST_SQL)
def latest_per_group_struct(spark, d):
    return agg.latest_per_group(
        T(spark, d, "orders"), ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], method="struct_max"
    )


@register(
    "agg_join_back",
    "SELECT l_orderkey, l_linenumber, l_returnflag, g.returned_in_order, g.lines_in_order FROM lineitem "
    "JOIN (SELECT l_orderkey AS k, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) "
    "AS returned_in_order, count(*) AS lines_in_order FROM lineitem GROUP BY l_orderkey) g ON l_orderkey = g.k",
)
def agg_join_back(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return joins.join_back_aggregate(
        li, ["l_orderkey"],
        [agg.count_if("l_returnflag = 'R'").alias("returned_in_order"), F.count(F.lit(1)).alias("lines_in_order")],
    )


@register("agg_join_back_window", ORACLE["agg_join_back"])
def agg_join_back_window(spark, d):
    """Window form of ``agg_join_back`` (for comparison; one shuffle, but a
    whole order per task)."""
    from pyspark.sql import Window

    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    w = Window.partitionBy("l_orderkey")
    return li.select(
        "*",
        agg.count_if("l_returnflag = 'R'").over(w).alias("returned_in_order"),
        F.count(F.lit(1)).over(w).alias("lines_in_order"),
    )


# ====================================================================== J8
def _linked_sql(child: str, parent: str) -> str:
    """Rows of the child table that have a parent row."""
    ct, cc = child.split(".")
    pt, pc = parent.split(".")
    return f"(SELECT count(*) FROM {ct} x WHERE EXISTS (SELECT 1 FROM {pt} y WHERE y.{pc} = x.{cc}))"


def _fk_edges_sql() -> str:
    parts = []
    for child, parent in tpch.FOREIGN_KEYS:
        ct, cc = child.split(".")
        pt, pc = parent.split(".")
        parts.append(
            f"SELECT 'tpch.{ct}' AS child_table, 'tpch.{pt}' AS parent_table, '{cc}' AS child_column, "
            f"'{pc}' AS parent_column, (SELECT count(*) FROM {ct}) AS child_rows, "
            f"(SELECT count(*) FROM {ct} x WHERE x.{cc} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {pt} y WHERE y.{pc} = x.{cc})) AS orphan_rows, {_linked_sql(child, parent)} AS linked_rows"
        )
    return " UNION ALL ".join(parts)


def _fk_adjacency_sql() -> str:
    names = sorted(tpch.TABLES)
    rows = []
    for t in tpch.TABLES:
        cells = []
        for n in names:
            links = [_linked_sql(c, p) for c, p in tpch.FOREIGN_KEYS if (c.split(".")[0], p.split(".")[0]) == (t, n)]
            cells.append(f"CAST({' + '.join(links) or 0} AS BIGINT) AS {n}")
        rows.append(f"SELECT 'tpch.{t}' AS table_name, {', '.join(cells)}")
    return " UNION ALL ".join(rows)


def _lonely_sql(table: str) -> str:
    links = [_linked_sql(c, p) for c, p in tpch.FOREIGN_KEYS if c.split(".")[0] == table]
    return f"SELECT 'tpch.{table}' AS table_name WHERE {' + '.join(links) or 0} = 0"


@register("fk_edges", _fk_edges_sql())
def fk_edges(spark, d):
    return fkgraph.fk_edges(tpch.catalog(spark, d))


@register("fk_adjacency", _fk_adjacency_sql())
def fk_adjacency(spark, d):
    """Cells hold the number of linked rows."""
    return fkgraph.fk_adjacency(tpch.catalog(spark, d), counts=True)


@register("tables_without_fks", " UNION ALL ".join(_lonely_sql(t) for t in tpch.TABLES))
def tables_without_fks(spark, d):
    cat = tpch.catalog(spark, d)
    return fkgraph.tables_without_foreign_keys(cat, fkgraph.fk_edges(cat))


# ====================================================================== D
@register(
    "find_duplicates",
    "SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows "
    "FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)",
)
def find_duplicates(spark, d):
    return profile.find_duplicates(T(spark, d, "documents").select("text"))


@register(
    "find_duplicates_rows",
    "SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n "
    f"FROM lineitem GROUP BY {', '.join(COLUMNS['lineitem'])} HAVING count(*) > 1)",
)
def find_duplicates_rows(spark, d):
    return profile.find_duplicates(T(spark, d, "lineitem"))


@register(
    "find_duplicates_pages",
    "SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows "
    "FROM (SELECT count(*) AS n FROM pages GROUP BY html HAVING count(*) > 1)",
)
def find_duplicates_pages(spark, d):
    return profile.find_duplicates(T(spark, d, "pages").select("html"))


@register(
    "find_duplicates_events",
    "SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n "
    f"FROM events GROUP BY {', '.join(COLUMNS['events'])} HAVING count(*) > 1)",
)
def find_duplicates_events(spark, d):
    return profile.find_duplicates(T(spark, d, "events"))


@register("row_count", "SELECT count(*) AS rowcount FROM lineitem")
def row_count(spark, d):
    return profile.row_count(T(spark, d, "lineitem"))


def _sampled(spark, d, expected, **how):
    li = T(spark, d, "lineitem")
    n = li.count()
    mean = expected(n)
    band = 5 * (mean * (1 - mean / max(n, 1))) ** 0.5 + 1
    return beyond_source(li, profile.sample(li, seed=7, **how)).select("beyond_source", F.col("picked").between(mean - band, mean + band).alias("size_in_band"))


@register("sample_percent", "SELECT CAST(0 AS BIGINT) AS beyond_source, true AS size_in_band")
def sample_percent(spark, d):
    """Bernoulli sample: every row is the table's, and its size is within five
    standard deviations of a tenth."""
    return _sampled(spark, d, lambda n: n / 10, percent=10)


@register("sample_count", "SELECT CAST(0 AS BIGINT) AS beyond_source, true AS size_in_band")
def sample_count(spark, d):
    """The same with about 100 rows expected."""
    return _sampled(spark, d, lambda n: min(n, 100), count=100)


def _categorical_sql(table: str) -> str:
    parts = []
    for c in COLUMNS[table]:
        levels = f"count(DISTINCT {c})"
        small = f"{levels} <= {CATEGORICAL_MAX_LEVELS}"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS non_null, "
            f"{levels} AS distinct_levels, CASE WHEN count({c}) > 0 THEN {levels} / count({c}) END AS distinct_ratio, "
            f"{small} AS is_categorical FROM {table}"
        )
    return " UNION ALL ".join(parts)


@register("categorical_columns", _categorical_sql("events"))
def categorical_columns(spark, d):
    return profile.categorical_columns(T(spark, d, "events"), max_levels=CATEGORICAL_MAX_LEVELS).drop("approx_levels")


@register("categorical_columns_documents", _categorical_sql("documents"))
def categorical_columns_documents(spark, d):
    return profile.categorical_columns(T(spark, d, "documents"), max_levels=CATEGORICAL_MAX_LEVELS).drop("approx_levels")


@register(
    "density_bins",
    f"WITH b AS (SELECT min(l_quantity) AS lo, (max(l_quantity) - min(l_quantity)) / {HIST_BINS} AS w FROM lineitem), "
    f"x AS (SELECT CAST(least(floor((l_quantity - lo) / w), {HIST_BINS - 1}) AS BIGINT) AS bin "
    "FROM lineitem, b WHERE l_quantity IS NOT NULL), c AS (SELECT bin, count(*) AS n FROM x GROUP BY bin) "
    f"SELECT i AS bin, round(lo + i * w, 6) AS bin_low, round(lo + (i + 1) * w, 6) AS bin_high, coalesce(n, 0) AS n "
    f"FROM range({HIST_BINS}) r(i) CROSS JOIN b LEFT JOIN c ON c.bin = r.i",
)
def density_bins(spark, d):
    return profile.histogram(T(spark, d, "lineitem"), "l_quantity", HIST_BINS)


@register(
    "density_kde",
    "WITH s AS (SELECT count(l_quantity) AS n, 0.9 * least(stddev_samp(l_quantity), (quantile_cont(l_quantity, 0.75) "
    "- quantile_cont(l_quantity, 0.25)) / 1.34) * pow(count(l_quantity), -0.2) AS h "
    f"FROM lineitem), p(x) AS (VALUES {', '.join(f'({v})' for v in KDE_POINTS)}) "
    "SELECT CAST(p.x AS DOUBLE) AS x, round(sum(exp(-0.5 * ((p.x - l_quantity) / h) * ((p.x - l_quantity) / h))) "
    "/ (n * h * sqrt(2 * pi())), 6) AS density FROM lineitem, p, s WHERE l_quantity IS NOT NULL GROUP BY p.x, n, h",
)
def density_kde(spark, d):
    return profile.kernel_density(T(spark, d, "lineitem"), "l_quantity", KDE_POINTS)


# ====================================================================== C7-C8, C1 filter
@register(
    "normalized_day_supply",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity * 2 AS INT) AS DAY_SPLY_QTY, "
    "CASE WHEN CAST(l_quantity * 2 AS INT) BETWEEN 1 AND 33 THEN 30 WHEN CAST(l_quantity * 2 AS INT) BETWEEN 34 AND 83 "
    "THEN 60 WHEN CAST(l_quantity * 2 AS INT) >= 84 THEN 90 END AS NORMALIZED_DAY_SPLY_QTY FROM lineitem",
)
def normalized_day_supply(spark, d):
    li = T(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * 2).cast("int").alias("DAY_SPLY_QTY")
    )
    return li.withColumn("NORMALIZED_DAY_SPLY_QTY", rules.normalized_day_supply("DAY_SPLY_QTY"))


@register(
    "age_months",
    f"SELECT o_orderkey, date_sub('year', CAST(o_orderdate AS DATE), DATE '{AGE_AS_OF}') AS MBR_CURR_AGE FROM orders",
)
def age_months(spark, d):
    return T(spark, d, "orders").select(
        "o_orderkey", rules.member_age("o_orderdate", AGE_AS_OF, "months").alias("MBR_CURR_AGE")
    )


@register(
    "age_365",
    f"SELECT o_orderkey, CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AGE_AS_OF}') / 365) AS BIGINT) "
    "AS MBR_CURR_AGE FROM orders",
)
def age_365(spark, d):
    return T(spark, d, "orders").select(
        "o_orderkey", rules.member_age("o_orderdate", AGE_AS_OF, "days365").alias("MBR_CURR_AGE")
    )


@register(
    "recent_180d",
    f"SELECT * FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), DATE '{RECENT_AS_OF}') < 180",
)
def recent_180d(spark, d):
    return T(spark, d, "orders").filter(rules.recent_fill("o_orderdate", RECENT_AS_OF, 180))


# ====================================================================== campaign
def _prefixed(view: str, prefix: str, where: str | None = None) -> str:
    cols = ", ".join(f"{c} AS {prefix}_{c}" for c in ANALOG_COLUMNS[view])
    return f"SELECT {cols} FROM {view}" + (f" WHERE {where}" if where else "")


def _campaign_sql(final: str) -> str:
    a = CAMPAIGN_AS_OF.isoformat()
    v = VIEW_FOR
    p = C.PREFIX
    claim_filter = f"COB_CD = 'PRMRY' AND date_diff('day', FILL_DT, DATE '{a}') < 180"
    member_filter = "COALESCE(TRY_CAST(EPH_LINK_ID AS BIGINT), 0) <> 0 AND REC_SRC_FLG = 'Y'"
    plan_filter, hierarchy_filter = "STUS_CD = 'A'", "SRC_CD = 'Q'"
    ctes = [
        f"CLM AS ({_prefixed(v['claims'], p['claims'], claim_filter)})",
        f"MBR AS ({_prefixed(v['members'], p['members'], member_filter)})",
        f"DRG AS ({_prefixed(v['drugs'], p['drugs'])})",
        "BASE AS (SELECT * FROM CLM JOIN MBR ON PHMCY_MBR_ACCT_GID = MBR_ACC_MBR_ACCT_GID "
        "JOIN DRG ON PHMCY_DRUG_PROD_GID = DRUG_DRUG_PROD_GID)",
        "T1 AS (SELECT MBR_ACC_EPH_LINK_ID AS K1, DRUG_GPI4_CD AS K2, max(PHMCY_FILL_DT) AS MD FROM BASE GROUP BY 1, 2)",
        "T2 AS (SELECT b.MBR_ACC_EPH_LINK_ID AS K1, b.DRUG_GPI4_CD AS K2, b.PHMCY_FILL_DT AS MD, "
        "max(b.PHMCY_CLM_EVNT_GID) AS MC FROM BASE b JOIN T1 ON b.MBR_ACC_EPH_LINK_ID = T1.K1 "
        "AND b.DRUG_GPI4_CD = T1.K2 AND b.PHMCY_FILL_DT = T1.MD GROUP BY 1, 2, 3)",
        "LATEST AS (SELECT b.* FROM BASE b JOIN T2 ON b.MBR_ACC_EPH_LINK_ID = T2.K1 AND b.DRUG_GPI4_CD = T2.K2 "
        "AND b.PHMCY_FILL_DT = T2.MD AND b.PHMCY_CLM_EVNT_GID = T2.MC)",
        f"CV AS ({_prefixed(v['coverage'], p['coverage'])})",
        f"CC AS ({_prefixed(v['cont_coverage'], p['cont_coverage'])})",
        f"CL AS ({_prefixed(v['client_accounts'], p['client_accounts'])})",
        f"PD AS ({_prefixed(v['pharmacies'], p['pharmacies'])})",
        f"BP AS ({_prefixed(v['plan_options'], p['plan_options'], plan_filter)})",
        f"HR AS ({_prefixed(v['hierarchy'], p['hierarchy'], hierarchy_filter)})",
        f"PG AS ({_prefixed(v['programs'], p['programs'])})",
        "ENRICHED AS (SELECT * FROM LATEST JOIN CV ON MBR_ACC_MBR_ACCT_GID = MBR_ACC_CVRG_MBR_ACCT_GID "
        "LEFT JOIN CC ON MBR_ACC_MBR_ACCT_GID = MBR_ACC_CONT_CVRG_MBR_ACCT_GID "
        "JOIN CL ON PHMCY_LVL1_ACCT_GID = CLNT_ACCT_DENORM_LVL1_ACCT_GID AND PHMCY_LVL3_ACCT_GID = CLNT_ACCT_DENORM_LVL3_ACCT_GID "
        "JOIN PD ON PHMCY_PHMCY_PTY_GID = PHMCY_DENORM_PHMCY_PTY_GID "
        "JOIN BP ON PHMCY_LVL1_ACCT_GID = BNFT_PLAN_RCP_OPTNS_LVL1_ACCT_GID AND PHMCY_LVL3_ACCT_GID = BNFT_PLAN_RCP_OPTNS_LVL3_ACCT_GID "
        "LEFT JOIN HR ON MBR_ACC_MBR_ACCT_GID = MBR_ACCT_HRCHY_MBR_ACCT_GID "
        "LEFT JOIN PG ON MBR_ACCT_HRCHY_MBR_ACCT_GID = MBR_PGM_RX_SCHD_HIST_SCHD_ENRL_BNFCY_ID)",
        "FFMC AS (SELECT MBR_ACC_EPH_LINK_ID AS EPH_KEY, CAST(sum(CASE WHEN PHMCY_DLVRY_SYSTM_CD = 'M' THEN 1 ELSE 0 END) "
        f"AS BIGINT) AS {C.MAIL_COUNT} FROM ENRICHED GROUP BY 1)",
        "FLAGGED AS (SELECT e.*, f." + C.MAIL_COUNT + ", "
        f"CASE WHEN BNFT_PLAN_RCP_OPTNS_MAIL_IND = 'Y' AND PHMCY_DLVRY_SYSTM_CD = 'M' AND f.{C.MAIL_COUNT} = 1 "
        "THEN 'Y' ELSE 'N' END AS FFM_IND, "
        "CASE WHEN PHMCY_DAY_SPLY_QTY BETWEEN 1 AND 33 THEN 30 WHEN PHMCY_DAY_SPLY_QTY BETWEEN 34 AND 83 THEN 60 "
        "WHEN PHMCY_DAY_SPLY_QTY >= 84 THEN 90 END AS NORMALIZED_DAY_SPLY_QTY, "
        f"date_sub('year', MBR_ACC_MBR_BRTH_DT, DATE '{a}') AS MBR_CURR_AGE, "
        f"CASE WHEN date_sub('year', MBR_ACC_MBR_BRTH_DT, DATE '{a}') < 18 THEN 'Y' ELSE 'N' END AS MINOR_IND, "
        f"CASE WHEN DATE '{a}' BETWEEN MBR_ACC_CVRG_CVRG_EFF_DT AND MBR_ACC_CVRG_CVRG_EXPRN_DT THEN 'Y' ELSE 'N' END "
        "AS MBR_CURR_ELIG_IND, "
        "CASE WHEN BNFT_PLAN_RCP_OPTNS_MAIL_IND = 'Y' AND PHMCY_DLVRY_SYSTM_CD = 'R' THEN 'Y' ELSE 'N' END AS RTM_IND, "
        "CASE WHEN (BNFT_PLAN_RCP_OPTNS_MAINT_CHOICE_TYP_CD = 'MV' AND PHMCY_DAY_SPLY_QTY BETWEEN 21 AND 33 "
        "AND PHMCY_DLVRY_SYSTM_CD = 'R') OR (BNFT_PLAN_RCP_OPTNS_MAINT_CHOICE_TYP_CD = 'MV' AND PHMCY_DAY_SPLY_QTY >= 84 "
        "AND PHMCY_DENORM_CVS_RTL_IND = 'N' AND PHMCY_DENORM_CVS_MAIL_IND = 'N') THEN 'Y' ELSE 'N' END AS MCV_IND, "
        "CASE WHEN MBR_PGM_RX_SCHD_HIST_SCH_PGM_ID IN (5383, 5384) AND MBR_PGM_RX_SCHD_HIST_SCHD_OPT_IN_PRCS_SRC_CD "
        "IN ('PTL', 'CPT', 'PSV', 'CPV') AND (MBR_PGM_RX_SCHD_HIST_SCHD_OPT_OUT_DT IS NULL OR "
        "CAST(MBR_PGM_RX_SCHD_HIST_SCHD_OPT_OUT_DT AS VARCHAR) = '') THEN 'Y' ELSE 'N' END AS RFM_IND, "
        "CASE WHEN DRUG_DEA_CLS_CD IN ('0', ' ') THEN 'N' ELSE 'Y' END AS CONTROLLED_SUBSTANCE_IND "
        "FROM ENRICHED e JOIN FFMC f ON e.MBR_ACC_EPH_LINK_ID = f.EPH_KEY)",
        "TARGET AS (SELECT " + ", ".join(f"{s} AS {n}" for s, n in C.TARGET_LAYOUT)
        + f", TIMESTAMP '{a} 00:00:00' AS CREATE_TMS FROM FLAGGED)",
    ]
    return oracle_ctes() + ",\n" + ",\n".join(ctes) + "\n" + final


def _opts() -> C.CampaignOptions:
    return C.CampaignOptions(as_of=CAMPAIGN_AS_OF)


@register("campaign_base", _campaign_sql("SELECT * FROM BASE"))
def campaign_base(spark, d):
    return C.claim_base(analog_tables(spark, d), _opts())


@register("campaign_latest", _campaign_sql("SELECT * FROM LATEST"))
def campaign_latest(spark, d):
    return C.latest_claims(C.claim_base(analog_tables(spark, d), _opts()))


@register("campaign_enriched", _campaign_sql("SELECT * FROM ENRICHED"))
def campaign_enriched(spark, d):
    t, o = analog_tables(spark, d), _opts()
    return C.enrich(C.latest_claims(C.claim_base(t, o)), t, o)


@register("campaign_full", _campaign_sql("SELECT * FROM TARGET"))
def campaign_full(spark, d):
    return C.run_campaign(analog_tables(spark, d), _opts())


@register("campaign_written", ORACLE["campaign_full"])
def campaign_written(spark, d):
    """The ORC output, read back."""
    path = C.write_campaign(C.run_campaign(analog_tables(spark, d), _opts()), shared_path(spark, "campaign"))
    return spark.read.orc(path)


FLAG_QUERIES = {
    "flag_ffm": ["DLVRY_SYSTM_CD", "FFM_IND"],
    "flag_minor": ["MBR_CURR_AGE", "MINOR_IND"],
    "flag_eligible": ["CVRG_EFF_DT", "CVRG_EXPRN_DT", "MBR_CURR_ELIG_IND"],
    "flag_rtm": ["DLVRY_SYSTM_CD", "RTM_IND"],
    "flag_mcv": ["DAY_SPLY_QTY", "NORMALIZED_DAY_SPLY_QTY", "MCV_IND"],
    "flag_rfm": ["RFM_IND"],
    "flag_controlled": ["CONTROLLED_SUBSTANCE_IND"],
}

for _name, _cols in FLAG_QUERIES.items():
    _keys = ["MBR_OPPTY_GID", "MBR_ACCT_GID"] + _cols

    def _flag(spark, d, _keys=_keys):
        return C.run_campaign(analog_tables(spark, d), _opts(), _keys).select(*_keys)

    register(_name, _campaign_sql(f"SELECT {', '.join(_keys)} FROM TARGET"))(_flag)


# ====================================================================== S7, X15
@register(
    "json_nested",
    "SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract(props, '$.k') AS BIGINT) AS k "
    "FROM events",
)
def json_nested(spark, d):
    ev = T(spark, d, "events")
    return ev.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.from_json("props", "k BIGINT").getField("k").alias("k"),
    )


@register("json_lines_roundtrip", "SELECT event_id, user_id, event_type, value FROM events")
def json_lines_roundtrip(spark, d):
    path = shared_path(spark, "json_lines")
    nested = T(spark, d, "events").select(
        F.struct("event_id", "user_id", "event_type", "value").alias("rx_fill")
    )
    nested.write.mode("overwrite").json(path)
    schema = "rx_fill struct<event_id:bigint, user_id:bigint, event_type:string, value:double>"
    return files.read_json_lines(spark, path, schema=schema, nested="rx_fill")


# ====================================================================== S3, K1-K5
@register("orc_roundtrip", "SELECT * FROM customer")
def orc_roundtrip(spark, d):
    """Write in the ingestion layout (partitioned ORC), read back through a
    catalog document that has only a source folder and a table id."""
    from cataloom.sources.catalog import TableDoc

    root = shared_path(spark, "orc_source")
    data_dir = f"{root}/customer_t1/merged/orc"
    customer = T(spark, d, "customer")
    customer.write.mode("overwrite").partitionBy("c_mktsegment").orc(data_dir)
    doc = TableDoc(source="ingested", table="customer", id="customer_t1", format="orc", source_path=root)
    return files.read_table(spark, doc)


@register("orc_append", "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def orc_append(spark, d):
    """ORC written anew, then appended to."""
    path = shared_path(spark, "orc_append")
    derived.write_orc(T(spark, d, "customer").selectExpr("c_custkey AS k", "c_name AS name"), path)
    derived.write_orc_new(T(spark, d, "supplier").selectExpr("s_suppkey AS k", "s_name AS name"), path, mode="append")
    return files.to_df(path, spark=spark)


@register("orc_layout_three_levels", "SELECT * FROM orders")
def orc_layout_three_levels(spark, d):
    """The ingestion layout with plain folders below it: <part>/<batch>/<file>."""
    from cataloom.sources.catalog import TableDoc

    root = shared_path(spark, "orc_levels")
    orders = T(spark, d, "orders")
    for part in range(3):
        rows = orders.where(F.coalesce(F.pmod("o_orderkey", F.lit(3)), F.lit(0)) == part)
        derived.write_orc(rows, f"{root}/orders_t1/merged/orc/part{part}/batch")
    return files.read_table(spark, TableDoc(source="ingested", table="orders", id="orders_t1", format="orc", source_path=root))


@register("json_array_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_array_roundtrip(spark, d):
    """Files that each hold one JSON array, of the customers of a key range."""
    path = shared_path(spark, "json_arrays")
    rows = T(spark, d, "customer").withColumn("part", F.floor(F.col("c_custkey") / JSON_ARRAY_KEYS))
    arrays = rows.groupBy("part").agg(F.to_json(F.collect_list(F.struct(*COLUMNS["customer"]))).alias("value"))
    arrays.repartition("part").write.partitionBy("part").text(path)
    schema = "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string"
    return files.read_json_array(spark, path, schema=schema).select(*COLUMNS["customer"])


@register(
    "to_df_name_and_path",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def to_df_name_and_path(spark, d):
    """One side by catalogued name, one by path."""
    orders = files.to_df(tpch.q("orders"), catalog=tpch.catalog(spark, d, ["orders"]))
    customer = files.to_df(f"{d}/customer.parquet", spark=spark, fmt="parquet")
    return joins.equi_join(orders, customer, [("o_custkey", "c_custkey")]).select("o_orderkey", "c_name")


def _stored_catalog(spark, d):
    """A source and a data model of one name, saved as documents and loaded."""
    from cataloom.sources.catalog import Catalog, write_catalog_json

    source = tpch.catalog(spark, d, ["orders"])
    model = Catalog.from_files(spark, tpch.SOURCE, d, ["customer"], kind="datamodel")
    paths = shared_path(spark, "catalog", "sources"), shared_path(spark, "catalog", "tables")
    write_catalog_json(source.union(model), *paths)
    return Catalog.from_json(spark, *paths)


@register("load_sources_scan", "SELECT 'tpch.orders' AS table_name, * FROM orders")
def load_sources_scan(spark, d):
    cat = _stored_catalog(spark, d).load_sources(tpch.SOURCE)
    (name,) = cat.docs()
    return cat.read(name).select(F.lit(name).alias("table_name"), "*")


@register("load_datamodel_scan", "SELECT 'tpch.customer' AS table_name, * FROM customer")
def load_datamodel_scan(spark, d):
    cat = _stored_catalog(spark, d).load_datamodels(tpch.SOURCE)
    (name,) = cat.docs()
    return cat.read(name).select(F.lit(name).alias("table_name"), "*")


@register("derived_reload", "SELECT o_custkey, count(o_orderkey) AS n_orders FROM orders GROUP BY o_custkey")
def derived_reload(spark, d):
    """A derived table found again through the saved catalog documents."""
    from cataloom.sources.catalog import Catalog, write_catalog_json

    cat = tpch.catalog(spark, d, ["orders"])
    grouped = agg.aggregate(Tracked(T(spark, d, "orders"), (tpch.q("orders"),)), "o_custkey", n_orders=("n", "o_orderkey"))
    cat = derived.save_derived_table(grouped, cat, "derived_src", "orders_per_customer")
    paths = shared_path(spark, "catalog", "sources"), shared_path(spark, "catalog", "tables")
    write_catalog_json(cat, *paths)
    back = Catalog.from_json(spark, *paths).load_sources("derived_src")
    return back.read("derived_src.orders_per_customer")


@register(
    "derived_table_roundtrip",
    "SELECT s_nationkey, count(s_suppkey) AS n_suppliers FROM supplier GROUP BY s_nationkey",
)
def derived_table_roundtrip(spark, d):
    cat = tpch.catalog(spark, d, ["supplier"])
    grouped = agg.aggregate(Tracked(T(spark, d, "supplier"), (tpch.q("supplier"),)),
                            "s_nationkey", n_suppliers=("n", "s_suppkey"))
    cat = derived.save_derived_table(grouped, cat, "derived_src", "suppliers_per_nation")
    return cat.read("derived_src.suppliers_per_nation")


@register(
    "derived_save_drop",
    "SELECT s_nationkey, count(s_suppkey) AS n_suppliers FROM supplier GROUP BY s_nationkey",
)
def derived_save_drop(spark, d):
    """Save a derived table, read it back, then drop its schema and data.
    The read-back is checkpointed first, so the result outlives the drop."""
    cat = tpch.catalog(spark, d, ["supplier"])
    grouped = agg.aggregate(Tracked(T(spark, d, "supplier"), (tpch.q("supplier"),)),
                            "s_nationkey", n_suppliers=("n", "s_suppkey"))
    name = "derived_src.save_drop"
    cat = derived.save_derived_table(grouped, cat, "derived_src", "save_drop")
    back = materialize(cat.read(name))
    cat = derived.drop_derived_table(cat, name)
    if name in cat.docs() or spark.catalog.tableExists(name):
        raise RuntimeError(f"{name} was not dropped")
    return back


@register(
    "fk_carry_over",
    "SELECT 'derived_src.orders_customers' AS child_table, 'tpch.customer' AS parent_table, "
    "'orders__o_custkey' AS child_column, 'c_custkey' AS parent_column, "
    "(SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS derived_rows "
    "UNION ALL SELECT 'derived_src.orders_customers', 'tpch.nation', 'customer__c_nationkey', 'n_nationkey', "
    "(SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey)",
)
def fk_carry_over(spark, d):
    cat = tpch.catalog(spark, d, ["orders", "customer", "nation"])
    joined = joins.auto_join(cat, tpch.q("orders"), tpch.q("customer"))
    kept = joined.with_df(joined.df.select("orders__o_orderkey", "orders__o_custkey", "customer__c_nationkey"))
    cat = derived.save_derived_table(kept, cat, "derived_src", "orders_customers")
    derived_rows = cat.read("derived_src.orders_customers").count()
    fks = cat.foreign_keys().filter(F.col("child_table") == "derived_src.orders_customers")
    return fks.select(
        "child_table", "parent_table", "child_column", "parent_column",
        F.lit(derived_rows).cast("bigint").alias("derived_rows"),
    )


# ====================================================================== L
LM_DATA_SQL = "SELECT l_extendedprice AS y, l_returnflag AS g FROM lineitem"
LM_GROUPS_SQL = (
    f"WITH d AS ({LM_DATA_SQL}), m AS (SELECT {', '.join(f'avg(y) FILTER (WHERE g = {chr(39)}{g}{chr(39)}) AS m{g}, count(*) FILTER (WHERE g = {chr(39)}{g}{chr(39)}) AS n{g}' for g in 'ANR')}, "
    "avg(y) AS mall FROM d), s AS (SELECT sum((y - CASE g WHEN 'A' THEN mA WHEN 'N' THEN mN ELSE mR END) ^ 2) AS sse, "
    "sum((y - mall) ^ 2) AS sst, count(*) AS n FROM d, m) "
)
LM_FIT_SQL = LM_GROUPS_SQL + f"SELECT {sql_sig('mA')} AS intercept, {sql_sig('mN - mA')} AS slope_n, {sql_sig('mR - mA')} AS slope_r, {sql_sig('1 - sse / sst')} AS r2 FROM m, s"
LM_FIT = "intercept double, slope_n double, slope_r double, r2 double"


def _lm_data(spark, d):
    return T(spark, d, "lineitem")


@register("lm_group", LM_FIT_SQL)
def lm_group(spark, d):
    data = _lm_data(spark, d)
    fit = learn.fit_group_model(data, "l_extendedprice", "l_returnflag")
    slope = dict(zip(learn.feature_levels(fit.model, data, "l_returnflag"), fit.coefficients))
    return spark.createDataFrame([(sig(fit.intercept), sig(slope["N"]), sig(slope["R"]), sig(fit.r2))], LM_FIT)


@register(
    "lm_group_no_intercept",
    f"SELECT g AS level, {sql_sig('avg(y)')} AS coefficient FROM ({LM_DATA_SQL}) GROUP BY g",
)
def lm_group_no_intercept(spark, d):
    data = _lm_data(spark, d)
    fit = learn.fit_group_model(data, "l_extendedprice", "l_returnflag", intercept=False)
    levels = learn.feature_levels(fit.model, data, "l_returnflag")
    return spark.createDataFrame(
        [(lv, sig(c)) for lv, c in zip(levels, fit.coefficients)], "level string, coefficient double"
    )


@register("lm_save_load", LM_FIT_SQL)
def lm_save_load(spark, d):
    data = _lm_data(spark, d)
    fit = learn.fit_group_model(data, "l_extendedprice", "l_returnflag")
    path = learn.save_model(fit, shared_path(spark, "models", "lm_group"))
    model = learn.load_model(path)
    intercept, coefs = learn.model_coefficients(model)
    slope = dict(zip(learn.feature_levels(model, data, "l_returnflag"), coefs))
    scored = model.transform(data.select("l_extendedprice", "l_returnflag"))
    r2 = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="r2").evaluate(scored)
    return spark.createDataFrame([(sig(intercept), sig(slope["N"]), sig(slope["R"]), sig(r2))], LM_FIT)


def _term_sql(term: str, estimate: str, error: str) -> str:
    return f"SELECT '{term}' AS term, {sql_sig(estimate)} AS estimate, {sql_sig(error)} AS std_error, {sql_sig(f'({estimate}) / {error}')} AS t_value FROM m, s"


@register(
    "lm_summary",
    LM_GROUPS_SQL + " UNION ALL ".join([
        _term_sql("(Intercept)", "mA", "sqrt(sse / (n - 3) / nA)"),
        *[_term_sql(g, f"m{g} - mA", f"sqrt(sse / (n - 3) * (1.0 / nA + 1.0 / n{g}))") for g in "NR"],
    ]),
)
def lm_summary(spark, d):
    data = _lm_data(spark, d)
    fit = learn.fit_group_model(data, "l_extendedprice", "l_returnflag")
    levels = learn.feature_levels(fit.model, data, "l_returnflag")
    rows = learn.coefficient_table(fit, levels, with_p_value=False)
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, t_value double")


@register(
    "lm_summary_no_intercept",
    LM_GROUPS_SQL + " UNION ALL ".join(_term_sql(g, f"m{g}", f"sqrt(sse / (n - 3) / n{g})") for g in "ANR"),
)
def lm_summary_no_intercept(spark, d):
    data = _lm_data(spark, d)
    fit = learn.fit_group_model(data, "l_extendedprice", "l_returnflag", intercept=False)
    rows = learn.coefficient_table(fit, learn.feature_levels(fit.model, data, "l_returnflag"), with_p_value=False)
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, t_value double")


@register(
    "lm_anova",
    f"WITH d AS ({LM_DATA_SQL}), gs AS (SELECT g, count(*) AS n, avg(y) AS m, var_pop(y) * count(*) AS ss FROM d GROUP BY g), "
    "t AS (SELECT sum(n) AS n, sum(n * m) / sum(n) AS gm, count(*) AS k, sum(ss) AS ssw FROM gs), "
    "b AS (SELECT sum(gs.n * (gs.m - t.gm) ^ 2) AS ssb FROM gs, t) "
    f"SELECT 'l_returnflag' AS term, CAST(k - 1 AS BIGINT) AS df, {sql_sig('ssb')} AS sum_sq, "
    f"{sql_sig('ssb / (k - 1)')} AS mean_sq, {sql_sig('(ssb / (k - 1)) / (ssw / (n - k))')} AS f_value FROM t, b "
    f"UNION ALL SELECT 'Residuals', CAST(n - k AS BIGINT), {sql_sig('ssw')}, {sql_sig('ssw / (n - k)')}, NULL FROM t",
)
def lm_anova(spark, d):
    return learn.one_way_anova(_lm_data(spark, d), "l_extendedprice", "l_returnflag", digits=7, with_p_value=False)


def _kmeans_sql(table: str, k: int) -> str:
    return f"SELECT count(*) AS n_rows, {k} AS n_clusters, true AS nearest, true AS better_than_one FROM {table}"


def _kmeans_checked(model, assigned: DataFrame, features) -> DataFrame:
    """What has to hold for a clustering, over every assigned row: each sits
    with its nearest centre, and the total cost is not above that of one cluster."""
    centers = [[float(v) for v in c] for c in model.clusterCenters()]
    value = F.transform(features, lambda x: x.cast("double"))

    def cost(center):
        return F.aggregate(F.zip_with("f", F.array(*[F.lit(v) for v in center]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)

    costs = assigned.select("cluster", value.alias("f")).withColumn("costs", F.array(*[cost(c) for c in centers]))
    own = F.col("costs")[F.col("cluster")]
    apart = [F.var_pop(F.col("f")[i]) for i in range(len(centers[0]))]
    alone = sum(apart[1:], apart[0]) * F.count(F.lit(1))
    return costs.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("cluster").cast("int").alias("n_clusters"),
        F.bool_and(own <= F.array_min("costs") * (1 + 1e-9) + 1e-9).alias("nearest"),
        (F.sum(own) <= alone * (1 + 1e-9)).alias("better_than_one"),
    )


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("kmeans_k3", _kmeans_sql("lineitem", 3))
def kmeans_k3(spark, d):
    model, assigned = learn.kmeans(
        T(spark, d, "lineitem"), LINE_FEATURES, k=3, max_iter=50,
        id_cols=["l_orderkey", "l_linenumber", *LINE_FEATURES],
    )
    return _kmeans_checked(model, assigned, F.array(*LINE_FEATURES))


@register("kmeans_nested", _kmeans_sql("events", 3))
def kmeans_nested(spark, d):
    """Nested struct fields, from JSON."""
    ev = T(spark, d, "events").select(
        "event_id",
        F.struct(
            F.col("value").alias("value"),
            F.col("user_id").cast("double").alias("user"),
            F.from_json("props", "k DOUBLE").getField("k").alias("k"),
            F.hour("ts").cast("double").alias("hour"),
        ).alias("rx_fill"),
    )
    flat = ev.select("event_id", "rx_fill.*")
    fields = ["value", "user", "k", "hour"]
    model, assigned = learn.kmeans(flat, fields, k=3, max_iter=50, id_cols=["event_id", *fields])
    return _kmeans_checked(model, assigned, F.array(*fields))


@register("kmeans_k5", _kmeans_sql("embeddings", 5))
def kmeans_k5(spark, d):
    """Embedding vectors."""
    model, assigned = learn.kmeans(T(spark, d, "embeddings"), "embedding", k=5, max_iter=15, id_cols=["vec_id", "embedding"])
    return _kmeans_checked(model, assigned, F.col("embedding"))


@register("kmeans_centers", "SELECT 3 AS n_centers, count(*) AS n_rows, 4 AS center_size FROM lineitem")
def kmeans_centers(spark, d):
    model, assigned = learn.kmeans(
        T(spark, d, "lineitem"), LINE_FEATURES, k=3, max_iter=50, id_cols=["l_orderkey", "l_linenumber"],
    )
    return learn.cluster_centers(model, assigned).agg(
        F.count_distinct("cluster").cast("int").alias("n_centers"), F.sum("size").alias("n_rows"), F.max(F.size("center")).alias("center_size")
    )


# ====================================================================== streaming (A3 kept in state)
@register(
    "stream_latest_ship",
    "SELECT l_suppkey, max(l_shipdate) AS max_l_shipdate, count(*) AS n_rows FROM lineitem GROUP BY l_suppkey",
)
def stream_latest_ship(spark, d):
    from cataloom.streaming.incremental import run_latest_stream

    return run_latest_stream(spark, d, ["l_suppkey"], "l_shipdate", file_glob="lineitem.parquet")


# further queries register themselves
from cataloom.plans import registry_profile, registry_time  # noqa: E402, F401
