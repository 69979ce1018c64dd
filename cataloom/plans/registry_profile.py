"""Registered queries about profiles and models that one pass of small state
answers: levels by sketch, density on a grid, exact-size samples, level models."""

from __future__ import annotations

from pyspark.sql import functions as F

from cataloom.operators import learn, profile
from cataloom.plans.registry import CATEGORICAL_MAX_LEVELS, COLUMNS, T, beyond_source, register, sql_sig

# Evaluation points and bandwidth of the price density; sample sizes.
PRICE_POINTS = [1000.0, 5000.0, 12500.0, 25000.0, 40000.0, 60000.0, 90000.0]
PRICE_BANDWIDTH = 1500.0
SAMPLE_ROWS, STRATUM_ROWS = 100, 7


# ====================================================================== D4
def _levels_sql(table: str) -> str:
    parts = []
    for c in COLUMNS[table]:
        levels, few = f"count(DISTINCT {c})", f"count(DISTINCT {c}) <= {CATEGORICAL_MAX_LEVELS}"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS non_null, CASE WHEN {few} THEN {levels} END AS distinct_levels, "
            f"CASE WHEN {few} AND count({c}) > 0 THEN {levels} / count({c}) END AS distinct_ratio, {few} AS is_categorical FROM {table}"
        )
    return " UNION ALL ".join(parts)


@register("categorical_sketch", _levels_sql("lineitem"))
def categorical_sketch(spark, d):
    """Every column of the largest table, without a row per row and column."""
    return profile.column_levels(T(spark, d, "lineitem"), CATEGORICAL_MAX_LEVELS).drop("approx_levels")


@register("categorical_sketch_documents", _levels_sql("documents"))
def categorical_sketch_documents(spark, d):
    return profile.column_levels(T(spark, d, "documents"), CATEGORICAL_MAX_LEVELS).drop("approx_levels")


# ====================================================================== D5
@register(
    "density_continuous",
    f"WITH p(x) AS (VALUES {', '.join(f'({v})' for v in PRICE_POINTS)}), s AS (SELECT count(l_extendedprice) AS n FROM lineitem) "
    f"SELECT CAST(p.x AS DOUBLE) AS x, round(sum(exp(-0.5 * pow((p.x - l_extendedprice) / {PRICE_BANDWIDTH}, 2))) "
    f"/ (n * {PRICE_BANDWIDTH} * sqrt(2 * pi())), 9) AS density FROM lineitem, p, s WHERE l_extendedprice IS NOT NULL GROUP BY p.x, n",
)
def density_continuous(spark, d):
    return profile.kernel_density_grid(T(spark, d, "lineitem"), "l_extendedprice", PRICE_POINTS, PRICE_BANDWIDTH, digits=9)


# ====================================================================== D3
@register("sample_rows", f"SELECT CAST(0 AS BIGINT) AS beyond_source, least(count(*), {SAMPLE_ROWS}) AS picked FROM lineitem")
def sample_rows(spark, d):
    """Exactly so many rows, each the table's."""
    lines = T(spark, d, "lineitem")
    return beyond_source(lines, profile.sample_rows(lines, SAMPLE_ROWS, seed=7)).select("beyond_source", "picked")


@register("sample_strata", f"SELECT l_returnflag, l_linestatus, least(count(*), {STRATUM_ROWS}) AS picked FROM lineitem GROUP BY ALL")
def sample_strata(spark, d):
    strata = ["l_returnflag", "l_linestatus"]
    return profile.sample_rows(T(spark, d, "lineitem"), STRATUM_ROWS, seed=7, strata=strata).groupBy(*strata).agg(F.count("*").alias("picked"))


# ====================================================================== L5, L7
def _level_model_sql(intercept: bool) -> str:
    data = (
        "WITH g AS (SELECT CAST(l_suppkey AS VARCHAR) AS term, count(*) AS n, avg(l_extendedprice) AS m, var_pop(l_extendedprice) * count(*) AS ss "
        "FROM lineitem GROUP BY 1), t AS (SELECT sum(ss) / (sum(n) - count(*)) AS v FROM g), r AS (SELECT n AS rn, m AS rm, term AS ref FROM g ORDER BY term LIMIT 1) "
    )
    if not intercept:
        return data + (
            f"SELECT term, {sql_sig('m')} AS estimate, {sql_sig('sqrt(v / n)')} AS std_error, {sql_sig('m / sqrt(v / n)')} AS t_value, n FROM g, t"
        )
    estimate, error = "CASE WHEN term = ref THEN m ELSE m - rm END", "sqrt(CASE WHEN term = ref THEN v / n ELSE v / n + v / rn END)"
    return data + (
        f"SELECT CASE WHEN term = ref THEN '(Intercept)' ELSE term END AS term, {sql_sig(estimate)} AS estimate, "
        f"{sql_sig(error)} AS std_error, {sql_sig(f'({estimate}) / {error}')} AS t_value, n FROM g, t, r"
    )


@register("lm_levels", _level_model_sql(True))
def lm_levels(spark, d):
    """A factor of many levels: one row of coefficients for each."""
    return learn.group_coefficients(T(spark, d, "lineitem"), "l_extendedprice", "l_suppkey")


@register("lm_levels_no_intercept", _level_model_sql(False))
def lm_levels_no_intercept(spark, d):
    return learn.group_coefficients(T(spark, d, "lineitem"), "l_extendedprice", "l_suppkey", intercept=False)
