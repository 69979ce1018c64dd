"""Clustering and linear models on Spark ML.

Fitting is distributed: a k-means round sums points per centre in the tasks,
the normal-equation solver aggregates X'X in one pass, and a factor of many
levels needs one grouped pass (``group_coefficients``).  Only fitted parameters
-- a handful of numbers -- come back to the driver; coefficients of many levels
stay a table.
"""

from __future__ import annotations

import math
import random
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import RFormula
from pyspark.ml.regression import LinearRegression
from pyspark.mllib.clustering import KMeans as SparkKMeans
from pyspark.mllib.clustering import KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

FEATURES = "features"


@dataclass(frozen=True)
class Centers:
    """A fitted clustering: its centres and the rows' total squared distance from them."""

    centers: list[list[float]]
    trainingCost: float = 0.0

    @property
    def summary(self) -> "Centers":
        return self

    def clusterCenters(self) -> list[list[float]]:
        return self.centers


def _points(column: pa.Array) -> np.ndarray:
    """Rows of an array column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance and index of the nearest centre; of equal ones the first."""
    away, place = np.full(len(points), np.inf), np.zeros(len(points), dtype=np.int64)
    for i, center in enumerate(centers):
        d = np.square(points - center).sum(axis=1)
        closer = d < away
        away[closer], place[closer] = d[closer], i
    return away, place


def _with_nearest(data: DataFrame, centers: list[list[float]]) -> DataFrame:
    """``data`` (first column ``point``) with distance ``d`` and index ``i`` of
    the nearest centre."""
    fixed = np.array(centers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away, place = _nearest(_points(batch.column(0)), fixed) if batch.num_rows else (np.zeros(0), np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(away), pa.array(place.astype(np.int32))], names=[*batch.schema.names, "d", "i"])

    return data.mapInArrow(run, T.StructType([*data.schema.fields, T.StructField("d", T.DoubleType()), T.StructField("i", T.IntegerType())]))


def _row_draw(seed: int, turn: int, draw: Column) -> Column:
    """A number in [0, 1) from the seed, the turn and the row's own hash."""
    top = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(turn), draw), 11)
    return top.cast("double") / F.lit(float(1 << 53))


def seed_centers(data: DataFrame, k: int, seed: int, turns: int = 2, oversample: float = 2.0) -> list[list[float]]:
    """Start centres for ``data`` (array ``point``, long ``draw``).

    Oversampled seeding: in each turn a row becomes a candidate with a
    probability in proportion to its squared distance from the candidates so
    far, about ``oversample * k`` of them.  A row's luck is a hash of its own
    ``draw``, so that the candidates do not depend on how rows lie in
    partitions.  Each candidate is weighted by the rows nearest to it, and
    weighted k-means++ picks k of these few on the driver.
    """
    first = data.orderBy(_row_draw(seed, 0, F.col("draw")), "point").limit(1).collect()
    if not first:
        return []
    candidates = [list(first[0]["point"])]
    for turn in range(1, turns + 1):
        away = _with_nearest(data, candidates)
        total = away.agg(F.sum("d")).first()[0]
        if not total:
            break
        lucky = _row_draw(seed, turn, F.col("draw")) < F.lit(oversample * k / total) * F.col("d")
        more = away.where(lucky).select("point").distinct().collect()  # about oversample * k rows
        candidates += sorted(list(r["point"]) for r in more)
    weight = [0] * len(candidates)
    for r in _with_nearest(data, candidates).groupBy("i").count().collect():
        weight[r["i"]] = r["count"]
    rng, chosen = random.Random(seed), []
    gap = [math.inf] * len(candidates)
    for _ in range(min(k, len(candidates))):
        odds = [w * (g if g < math.inf else 1.0) for w, g in zip(weight, gap)]
        if not sum(odds):
            break
        pick = rng.choices(range(len(candidates)), odds)[0]
        chosen.append(candidates[pick])
        gap = [min(g, sum((a - b) ** 2 for a, b in zip(c, candidates[pick]))) for g, c in zip(gap, candidates)]
    return chosen


#: A centre that moves no further than this stands still; coordinates of all
#: centres up to which a round is written as column expressions.
CENTER_MOVE, NARROW = 1e-4, 64


def _center_sums(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """Per centre the sum and number of the points nearest to it, and their squared
    distance from it; by column expressions, so that no row leaves the JVM."""
    axes = range(centers.shape[1])
    away = [reduce(Column.__add__, [(F.col("point")[j] - F.lit(float(c[j]))) * (F.col("point")[j] - F.lit(float(c[j]))) for j in axes]) for c in centers]
    met = points.select("point", *[a.alias(f"d{i}") for i, a in enumerate(away)])
    met = met.withColumn("d", F.least(*[f"d{i}" for i in range(len(away))]) if len(away) > 1 else F.col("d0"))
    place = F.lit(len(away) - 1)
    for i in reversed(range(len(away) - 1)):
        place = F.when(F.col(f"d{i}") <= F.col("d"), F.lit(i)).otherwise(place)
    sums = met.groupBy(place.alias("i")).agg(F.count("*").alias("n"), F.sum("d").alias("cost"), *[F.sum(F.col("point")[j]).alias(f"s{j}") for j in axes])
    return sums.select("i", F.array(*[f"s{j}" for j in axes]).alias("sum"), "n", "cost")


def fit_from(data: DataFrame, centers: list[list[float]], max_iter: int) -> Centers:
    """Lloyd's rounds from the given start centres.

    For points of a few coordinates a round is one grouped pass over the kept
    points, of which a sum and a count per centre come back.  It ends when no centre
    moves further than ``CENTER_MOVE``; a centre without points stays where it is.
    Wide points go to Spark's k-means (its RDD form takes a start model).
    """
    points, now = data.select("point"), np.array(centers, dtype=np.float64)
    if now.size > NARROW:
        model = SparkKMeans.train(points.rdd.map(lambda r: r[0]), len(centers), maxIterations=max_iter, initialModel=KMeansModel(centers))
        found = [[float(v) for v in c] for c in model.clusterCenters]
        return Centers(found, _with_nearest(points, found).agg(F.sum("d")).first()[0] or 0.0)
    for _ in range(max_iter):
        last, now = now, now.copy()
        for r in _center_sums(points, last).collect():  # one row per centre
            now[r["i"]] = np.array(r["sum"]) / r["n"]
        if np.square(now - last).sum(axis=1).max() <= CENTER_MOVE**2:
            break
    return Centers(now.tolist(), float(sum(r["cost"] for r in _center_sums(points, now).collect())))


#: Rows of a partition of clustered points.
POINT_ROWS = 1_000_000


def kmeans(
    df: DataFrame,
    feature_cols: Sequence[str] | str,
    k: int,
    max_iter: int,
    seed: int = 1,
    id_cols: Sequence[str] = (),
    partitions: int | None = None,
):
    """k-means on numeric columns, or on one array column (L1-L3).

    Returns ``(model, assignments)``; assignments keep ``id_cols`` and add
    ``cluster`` (L4).  Rows with a NULL (or NaN) feature are skipped, as the
    reference's numeric matrices had none.  Seeding draws are hashes of
    ``id_cols`` (of the features without them), so the centres are the same
    however the rows lie in files and partitions; the points are read once and
    kept for the rounds, in ``partitions`` or a number that follows from the
    row count.
    """
    if isinstance(feature_cols, str):
        point = F.transform(F.col(f"`{feature_cols}`"), lambda v: v.cast("double"))
    else:
        point = F.array(*[F.col(f"`{c}`").cast("double") for c in feature_cols])
    whole = point.isNotNull() & ~F.exists(point, lambda v: v.isNull() | F.isnan(v))
    names = [F.col(f"`{c}`") for c in id_cols]
    data = df.where(whole).select(*names, point.alias("point"), F.xxhash64(*(names or [point])).alias("draw"))
    if partitions is None:
        partitions = max(df.sparkSession.sparkContext.defaultParallelism, 1 + df.count() // POINT_ROWS)
    points = data.select("point", "draw").repartition(partitions).persist()
    try:
        centers = seed_centers(points, k, seed)
        model = fit_from(points, centers, max_iter) if centers else Centers([])
    finally:
        points.unpersist()
    if not model.centers:
        return model, data.select(*names, F.lit(None).cast("int").alias("cluster"))
    assigned = _with_nearest(data.select("point", *names), model.centers)
    return model, assigned.select(*names, F.col("i").alias("cluster"))


def cluster_centers(model, assignments: DataFrame) -> DataFrame:
    """Center coordinates and sizes per cluster (L4)."""
    spark = assignments.sparkSession
    centers = spark.createDataFrame(
        [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())],
        "cluster int, center array<double>",
    )
    sizes = assignments.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return centers.join(sizes, "cluster", "left").fillna(0, ["size"])


@dataclass(frozen=True)
class GroupFit:
    model: PipelineModel
    coefficients: list[float]
    intercept: float
    r2: float


def fit_group_model(df: DataFrame, response: str, factor: str, intercept: bool = True) -> GroupFit:
    """``response ~ factor`` (or ``- 1``) by least squares.

    Levels are ordered so that the alphabetically first is the reference
    level, as R's treatment contrasts do.  Without an intercept every level
    gets its own coefficient (the group means).
    """
    formula = f"{response} ~ {factor}" + ("" if intercept else " - 1")
    rf = RFormula(formula=formula, featuresCol=FEATURES, labelCol="label", stringIndexerOrderType="alphabetDesc")
    lr = LinearRegression(featuresCol=FEATURES, labelCol="label", solver="normal", fitIntercept=intercept, regParam=0.0)
    model = Pipeline(stages=[rf, lr]).fit(df.select(response, factor).dropna())
    lrm = model.stages[-1]
    return GroupFit(model, [float(v) for v in lrm.coefficients], float(lrm.intercept), float(lrm.summary.r2))


def coefficient_table(fit: GroupFit, levels: list[str], digits: int = 7, with_p_value: bool = True) -> list[tuple]:
    """Rows ``(term, estimate, std_error, t_value[, p_value])`` of a fit.

    Spark lists the intercept last in the summary arrays; it comes first here.
    """
    summary = fit.model.stages[-1].summary
    se, tv, pv = summary.coefficientStandardErrors, summary.tValues, summary.pValues
    terms = list(levels) + (["(Intercept)"] if len(se) > len(levels) else [])
    estimates = list(fit.coefficients) + ([fit.intercept] if len(se) > len(levels) else [])
    rows = []
    for i, term in enumerate(terms):
        row = (term, significant(estimates[i], digits), significant(se[i], digits), significant(tv[i], digits))
        rows.append(row + ((float(pv[i]),) if with_p_value else ()))
    return rows[-1:] + rows[:-1] if len(se) > len(levels) else rows


def level_statistics(df: DataFrame, response: str, factor: str) -> DataFrame:
    """Per level of ``factor``: n, mean m and within-level sum of squares ss of
    ``response``, from one grouped pass; rows with a NULL are left out."""
    data = df.select(F.col(f"`{factor}`").alias("level"), F.col(f"`{response}`").cast("double").alias("y")).dropna()
    return data.groupBy("level").agg(F.count("*").alias("n"), F.avg("y").alias("m"), (F.var_pop("y") * F.count("*")).alias("ss"))


def group_coefficients(df: DataFrame, response: str, factor: str, intercept: bool = True, digits: int = 7) -> DataFrame:
    """Coefficient table of ``response ~ factor`` (or ``- 1``) for a factor of
    any number of levels (L5, L7).

    With one factor the least-squares fit has a closed form per level, so no
    dummy columns and no matrix are needed: the estimates are the levels' means
    (less that of the alphabetically first level, the reference, when there is
    an intercept), the residual variance is the pooled one, and standard errors
    follow from the counts.  Columns: ``term``, ``estimate``, ``std_error``,
    ``t_value``, ``n``; one row per level, the reference as ``(Intercept)``,
    rounded to ``digits`` significant digits.  Errors are NULL when every level
    has one row.
    """
    levels = materialize(level_statistics(df, response, factor))
    total = levels.agg(F.sum("n").alias("n"), F.count("*").alias("g"), F.sum("ss").alias("ss"), F.min_by(F.struct("level", "n", "m"), F.col("level").cast("string")).alias("ref")).first()
    schema = "term string, estimate double, std_error double, t_value double, n bigint"
    if not total["n"]:
        return df.sparkSession.createDataFrame([], schema)
    free = total["n"] - total["g"]
    variance = F.lit(total["ss"] / free if free else None).cast("double")
    name = F.col("level").cast("string")
    estimate, share = F.col("m"), F.lit(1.0) / F.col("n")
    if intercept:
        ref = total["ref"]
        own = name == F.lit(str(ref["level"])) if not isinstance(ref["level"], str) else F.col("level") == F.lit(ref["level"])
        estimate = F.when(own, estimate).otherwise(estimate - F.lit(ref["m"]))
        share = F.when(own, share).otherwise(share + F.lit(1.0 / ref["n"]))
        name = F.when(own, F.lit("(Intercept)")).otherwise(name)
    error = F.sqrt(variance * share)
    out = levels.select(name.alias("term"), estimate.alias("estimate"), error.alias("std_error"), F.when(error > 0, estimate / error).alias("t_value"), "n")
    return out.select("term", *[significant_column(F.col(c), digits).alias(c) for c in ("estimate", "std_error", "t_value")], "n")


def significant_column(value: Column, digits: int = 7) -> Column:
    """``significant`` as a column expression."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits - 1}e", value).cast("double"))


def save_model(fit: GroupFit, path: str) -> str:
    fit.model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_coefficients(model: PipelineModel) -> tuple[float, list[float]]:
    lrm = model.stages[-1]
    return float(lrm.intercept), [float(v) for v in lrm.coefficients]


def significant(value: float | None, digits: int = 7) -> float | None:
    """Round to ``digits`` significant digits (as ``printf('%.{digits-1}e')``)."""
    if value is None or math.isnan(value):
        return value
    return float(f"{value:.{digits - 1}e}")


def one_way_anova(df: DataFrame, response: str, factor: str, digits: int = 7, with_p_value: bool = True) -> DataFrame:
    """ANOVA table of ``response ~ factor``.

    Per-level count, mean and within-level sum of squares come from a
    grouped pass; totals are aggregated from that table (a few scalars reach
    the driver) and rounded to ``digits`` significant digits.
    """
    per_level = (
        df.select(response, factor).dropna()
        .groupBy(factor)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(response).alias("m"),
            (F.var_pop(response) * F.count(F.lit(1))).alias("ss"),
        )
    )
    # the data is read once, for the per-level table; two one-row aggregates
    # over that follow, so that nothing per level reaches the driver
    per_level = materialize(per_level)
    tot = per_level.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("g"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"), F.sum("ss").alias("ssw"),
    ).first()
    n, g, grand, ss_within = int(tot["n"]), int(tot["g"]), float(tot["grand"]), float(tot["ssw"])
    ss_between = float(
        per_level.agg(F.sum(F.col("n") * (F.col("m") - F.lit(grand)) ** 2)).first()[0]
    )
    df_b, df_w = g - 1, n - g
    ms_b = ss_between / df_b if df_b else float("nan")
    ms_w = ss_within / df_w if df_w else float("nan")
    f_value = ms_b / ms_w if ms_w else float("nan")
    rows = [
        (factor, df_b, significant(ss_between, digits), significant(ms_b, digits), significant(f_value, digits)),
        ("Residuals", df_w, significant(ss_within, digits), significant(ms_w, digits), None),
    ]
    schema = "term string, df bigint, sum_sq double, mean_sq double, f_value double"
    if with_p_value:
        p = f_survival(f_value, df_b, df_w)
        rows = [rows[0] + (p,), rows[1] + (None,)]
        schema += ", p_value double"
    return df.sparkSession.createDataFrame(rows, schema)


# ---------------------------------------------------------------- F tail
def f_survival(f: float, d1: float, d2: float) -> float:
    """P(F > f) for an F(d1, d2) variable, via the regularized incomplete beta."""
    if not (f > 0) or math.isnan(f):
        return 1.0
    x, y = d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f)
    if y == 0.0:
        return 1.0
    if x == 0.0:
        return 0.0
    a, b = d2 / 2.0, d1 / 2.0
    log_x = -math.log1p(d1 * f / d2)
    front = math.exp(a * log_x + b * math.log(y) - _log_beta(a, b))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, y) / b


def _log_beta(a: float, b: float) -> float:
    """ln B(a, b); a large argument enters by its Stirling series, since the
    difference of two large ``lgamma`` values keeps few digits."""
    small, large = min(a, b), max(a, b)
    if large < 1000.0:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    total = small + large
    ratio = (large - 0.5) * math.log1p(small / large) + small * math.log(total) - small
    ratio += _stirling_rest(total) - _stirling_rest(large)  # ln(gamma(total) / gamma(large))
    if small < 1000.0:
        return math.lgamma(small) - ratio
    own = (small - 0.5) * math.log(small) - small + 0.5 * math.log(2 * math.pi) + _stirling_rest(small)
    return own - ratio


def _stirling_rest(x: float) -> float:
    return 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def _betacf(a: float, b: float, x: float, iters: int = 20_000, eps: float = 1e-14) -> float:
    """Continued fraction for the incomplete beta (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, iters + 1):
        m2 = 2 * m
        for num in (m * (b - m) * x / ((a + m2 - 1) * (a + m2)),
                    -(a + m) * (a + b + m) * x / ((a + m2) * (a + m2 + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < eps:
            return h
    raise ArithmeticError(f"incomplete beta fraction did not converge for a={a}, b={b}, x={x}")


def feature_levels(model: PipelineModel, df: DataFrame, factor: str) -> list[str]:
    """Factor level of each coefficient, read from the feature metadata."""
    meta = model.stages[0].transform(df.limit(0)).schema[FEATURES].metadata
    attrs = sorted((a for group in meta["ml_attr"]["attrs"].values() for a in group), key=lambda a: a["idx"])
    return [a["name"].removeprefix(f"{factor}_") for a in attrs]
