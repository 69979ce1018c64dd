"""Profiling: duplicates, row count, sampling, categorical columns, density."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.operators.tracked import unwrap
from cataloom.session import materialize


def group_key(field: T.StructField):
    """A column to group by that is equal exactly when the value is: long
    values travel as digest and length, maps as sorted entries."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.struct(F.sha2(value.cast("binary"), 256), F.octet_length(value))
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(value))
    return value


def duplicate_groups(x, columns: Sequence[str] | None = None, catalog=None) -> DataFrame:
    """Distinct row values that occur more than once: a key per column (text
    and binary columns as digest and length) and ``occurrences``.  NULLs are
    equal to each other, as in GROUP BY."""
    df, _ = unwrap(x, catalog)
    fields = [df.schema[c] for c in (columns or df.columns)]
    keyed = df.select(*[group_key(f).alias(f"k{i}") for i, f in enumerate(fields)])
    return (
        keyed.groupBy(*keyed.columns)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def find_duplicates(x, columns: Sequence[str] | None = None, catalog=None) -> DataFrame:
    """Number of distinct row values occurring more than once.

    Only rows that may repeat are grouped by their columns: a first pass counts
    rows per 64-bit hash, map-side combined, so that a unique row costs the
    shuffle one hash and a count, and a hot duplicate group one entry per task.
    Rows whose hash occurs once are unique; the rest, few unless the table is
    full of repeats, go through ``duplicate_groups``, which is exact.  One row:
    ``duplicate_groups``, ``duplicate_rows`` (rows inside those groups); both
    are 0 without duplicates.
    """
    df, _ = unwrap(x, catalog)
    df = df.select(*[F.col(f"`{c}`") for c in (columns or df.columns)])
    keyed = df.withColumn("__hash", F.xxhash64(*[hash_key(f) for f in df.schema.fields]))
    again = materialize(keyed.groupBy("__hash").count().where("count > 1").select("__hash"))
    if not again.take(1):
        return df.sparkSession.createDataFrame([(0, 0)], "duplicate_groups bigint, duplicate_rows bigint")
    return duplicate_groups(keyed.join(again, "__hash", "left_semi").drop("__hash")).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("duplicate_rows"),
    )


def hash_key(field: T.StructField):
    """A column to hash: values that GROUP BY takes as equal give equal hashes."""
    value = F.col(f"`{field.name}`")
    return F.array_sort(F.map_entries(value)) if isinstance(field.dataType, T.MapType) else value


def row_count(x, catalog=None) -> DataFrame:
    """``rowcount`` of a frame or catalogued table."""
    df, _ = unwrap(x, catalog)
    return df.agg(F.count(F.lit(1)).alias("rowcount"))


# Fixed value: sample size default.
DEFAULT_SAMPLE_ROWS = 100


def sample(x, percent: float | None = None, count: int | None = None, seed: int | None = None,
           catalog=None) -> DataFrame:
    """Bernoulli sample without replacement (D3).

    ``percent`` gives the fraction directly; otherwise ``count`` (default
    100) rows are expected, i.e. fraction = count / rows.
    The fraction is clamped to 1.
    """
    df, _ = unwrap(x, catalog)
    if percent is not None:
        fraction = percent / 100.0
    else:
        wanted = count if count is not None else DEFAULT_SAMPLE_ROWS
        total = df.count()
        fraction = wanted / total if total else 1.0
    return df.sample(withReplacement=False, fraction=min(max(fraction, 0.0), 1.0), seed=seed)


def sample_rows(x, count: int = DEFAULT_SAMPLE_ROWS, seed: int = 0, strata: Sequence[str] = (), catalog=None) -> DataFrame:
    """Exactly ``count`` rows, or all of a smaller table (D3).

    Each row draws its key by hashing the seed and its values; the rows with
    the least keys are the sample.  Every task keeps ``count`` rows at most, so
    one pass finds them, without a count before, and the sample depends on the
    rows and the seed only, not on files or partitions.  Rows that are equal in
    all columns draw the same key and come in together.  With ``strata`` there
    are ``count`` rows of each group of these columns (NULL is a group).
    """
    if count < 0:
        raise ValueError("count is not negative")
    df, _ = unwrap(x, catalog)
    draw = F.xxhash64(F.lit(seed), *[hash_key(f) for f in df.schema.fields])
    keyed = df.withColumn("__draw", draw)
    if not strata:
        return keyed.orderBy("__draw").limit(count).drop("__draw")
    place = F.row_number().over(Window.partitionBy(*[F.col(f"`{c}`") for c in strata]).orderBy("__draw"))
    return keyed.withColumn("__place", place).where(F.col("__place") <= count).drop("__draw", "__place")


def categorical_columns(x, max_levels: int = 20, rsd: float = 0.05, exact: Sequence[str] | None = None,
                        catalog=None) -> DataFrame:
    """One row per column, of any type: non-NULL count, levels, flag.

    ``approx_levels`` is a HyperLogLog++ estimate for every column, from one
    pass.  ``distinct_levels`` counts exactly the columns that the caller names
    in ``exact`` (all by default; name the few of interest on a large table):
    values meet by digest, one row per task and level.  ``is_categorical``
    (at most ``max_levels`` levels) and ``distinct_ratio`` use the exact count
    and are NULL where none was asked for.
    """
    df, _ = unwrap(x, catalog)
    spark = df.sparkSession
    fields = df.schema.fields
    plain = [F.array_sort(F.map_entries(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in fields]
    first = df.agg(
        *[F.approx_count_distinct(c, rsd).alias(f"c{i}") for i, c in enumerate(plain)],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(plain)],
    ).first()
    names = spark.createDataFrame(
        [(f.name, int(first[f"n{i}"]), int(first[f"c{i}"])) for i, f in enumerate(fields)],
        "column_name string, non_null bigint, approx_levels bigint",
    )
    wanted = [f.name for f in fields if exact is None or f.name in exact]
    pairs = [
        F.struct(F.lit(f.name).alias("column_name"), F.sha2((c if isinstance(f.dataType, T.BinaryType) else c.cast("string")).cast("binary"), 256).alias("value"))
        for f, c in zip(fields, plain) if f.name in wanted
    ]
    if pairs:
        values = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter(F.col("value").isNotNull())
        counted = values.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("levels"))
        names = names.join(counted, "column_name", "left")
        names = names.withColumn("levels", F.when(F.col("column_name").isin(wanted), F.coalesce("levels", F.lit(0))))
    else:
        names = names.withColumn("levels", F.lit(None).cast("bigint"))
    return names.select(
        "column_name",
        "non_null",
        "approx_levels",
        F.col("levels").alias("distinct_levels"),
        F.when(F.col("non_null") > 0, F.col("levels") / F.col("non_null")).alias("distinct_ratio"),
        (F.col("levels") <= max_levels).alias("is_categorical"),
    )


#: Values that a level sketch follows: a column of fewer values is counted exactly.
TRACKED_LEVELS = 2_000
_SKETCHED = (T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _level(field: T.StructField):
    """A value that is equal exactly when the column is: itself, or a digest."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _SKETCHED):
        return value
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return value + F.lit(0.0)
    if isinstance(field.dataType, T.MapType):
        value = F.array_sort(F.map_entries(value))
    return F.sha2((value if isinstance(field.dataType, T.BinaryType) else value.cast("string")).cast("binary"), 256)


def column_levels(x, max_levels: int = 20, rsd: float = 0.05, catalog=None) -> DataFrame:
    """``categorical_columns`` at a cost that does not grow with rows x columns.

    One pass keeps, for every column, a HyperLogLog++ estimate
    (``approx_levels``), a mergeable sketch of its most frequent values and a
    bitmap of its values' hashes.  More than ``max_levels`` values in the sketch
    or bits in the bitmap are as many levels at least, so such a column is not
    categorical (a sketch holds nothing of a large column whose values all occur
    rarely); for the others a second pass counts the rows
    that hold one of the few values, and when these are all, the levels are
    exactly these.  ``is_categorical`` (at most ``max_levels`` levels) is
    therefore exact, as are ``distinct_levels`` and ``distinct_ratio`` of
    categorical columns; they are NULL for the rest.  Should a sketch have
    dropped values of a column of few levels, that column is counted exactly.
    """
    df, _ = unwrap(x, catalog)
    spark = df.sparkSession
    fields = df.schema.fields
    plain = [F.array_sort(F.map_entries(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in fields]
    values = df.select(*[c.alias(f"p{i}") for i, c in enumerate(plain)], *[_level(f).alias(f"v{i}") for i, f in enumerate(fields)])
    bit = lambda v: F.bitmap_bit_position(F.when(F.col(v).isNotNull(), F.xxhash64(v)))
    first = values.agg(
        *[F.approx_count_distinct(f"p{i}", rsd).alias(f"c{i}") for i in range(len(fields))],
        *[F.count(f"p{i}").alias(f"n{i}") for i in range(len(fields))],
        *[F.call_function("approx_top_k", F.col(f"v{i}"), F.lit(max_levels + 2), F.lit(max(TRACKED_LEVELS, 2 * max_levels + 4))).alias(f"t{i}") for i in range(len(fields))],
        *[F.bitmap_count(F.bitmap_construct_agg(bit(f"v{i}"))).alias(f"b{i}") for i in range(len(fields))],
    ).first()
    held = {i: [r["item"] for r in first[f"t{i}"] or [] if r["item"] is not None] for i in range(len(fields))}
    few = [i for i in range(len(fields)) if len(held[i]) <= max_levels and first[f"b{i}"] <= max_levels]
    levels = {i: 0 for i in few if not held[i] and not first[f"n{i}"]}
    open_ = [i for i in few if i not in levels]
    if open_:
        covered = df.agg(*[F.count_if(_level(fields[i]).isin(held[i])).alias(f"h{i}") for i in open_]).first()
        levels |= {i: len(held[i]) for i in open_ if covered[f"h{i}"] == first[f"n{i}"]}
        dropped = [fields[i].name for i in open_ if i not in levels]
        if dropped:
            exact = {r["column_name"]: r["distinct_levels"] for r in categorical_columns(df, max_levels, rsd, dropped).collect()}
            levels |= {i: exact[fields[i].name] for i in open_ if i not in levels and exact[fields[i].name] <= max_levels}
    names = spark.createDataFrame(
        [(f.name, int(first[f"n{i}"]), int(first[f"c{i}"]), levels.get(i)) for i, f in enumerate(fields)],
        "column_name string, non_null bigint, approx_levels bigint, levels bigint",
    )
    return names.select(
        "column_name",
        "non_null",
        "approx_levels",
        F.col("levels").alias("distinct_levels"),
        F.when(F.col("non_null") > 0, F.col("levels") / F.col("non_null")).alias("distinct_ratio"),
        F.coalesce(F.col("levels") <= max_levels, F.lit(False)).alias("is_categorical"),
    )


def histogram(x, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max] of a numeric column (D5, binned).

    One pass for the bounds (one row to the driver), one grouped pass for
    the counts.  Columns: ``bin``, ``bin_low``, ``bin_high``, ``n``; every bin
    is there, also an empty one.  A constant column has bins of width 1, a
    column without values has no bins.
    """
    df, _ = unwrap(x)
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin bigint, bin_low double, bin_high double, n bigint")
    width = (float(hi) - float(lo)) / bins or 1.0
    v = F.col(column).cast("double")
    b = F.least(F.floor((v - F.lit(float(lo))) / F.lit(width)), F.lit(bins - 1))
    counted = df.filter(F.col(column).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counted, "bin", "left").select(
        "bin",
        F.round(F.lit(float(lo)) + F.col("bin") * F.lit(width), 6).alias("bin_low"),
        F.round(F.lit(float(lo)) + (F.col("bin") + 1) * F.lit(width), 6).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


#: Intervals that one pass of ``value_at`` tells apart.
QUANTILE_INTERVALS = 1024


def value_at(counted: DataFrame, rank: int) -> float:
    """The value at ``rank`` (from 0) of the sorted rows that ``counted``
    (v, count; one row per distinct value) stands for.  Exact; each pass counts
    the rows of equal intervals and goes on inside the one that holds the rank."""
    lo, hi = counted.agg(F.min("v"), F.max("v")).first()
    while lo < hi:
        width = (hi - lo) / QUANTILE_INTERVALS
        place = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(QUANTILE_INTERVALS - 1))
        inside = counted.where(F.col("v").between(lo, hi)).groupBy(place.alias("place"))
        parts = inside.agg(F.sum("count").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for part in sorted(parts.collect(), key=lambda r: r["place"]):  # at most QUANTILE_INTERVALS rows
            if rank < part["n"]:
                lo, hi = part["lo"], part["hi"]
                break
            rank -= part["n"]
        else:  # no row there (NaN)
            break
    return lo


def exact_quantile(counted: DataFrame, n: int, p: float) -> float:
    """Quantile ``p`` of ``n`` rows, between two rows by linear interpolation."""
    place = (n - 1) * p
    low = math.floor(place)
    first = value_at(counted, low)
    return first if place == low else first + (place - low) * (value_at(counted, low + 1) - first)


def default_bandwidth(counted: DataFrame, n: int, sd: float | None) -> float:
    """``0.9 * min(sd, IQR / 1.34) * n^(-1/5)``; where that spread is 0, the
    standard deviation, the size of the least value or 1 takes its place."""
    sd = sd or 0.0
    spread = min(sd, (exact_quantile(counted, n, 0.75) - exact_quantile(counted, n, 0.25)) / 1.34)
    return 0.9 * (spread or sd or abs(value_at(counted, 0)) or 1.0) * n ** (-0.2)


def kernel_density(x, column: str, points: Sequence[float], bandwidth: float | None = None, digits: int = 6) -> DataFrame:
    """Gaussian kernel density of a numeric column at given points.

    Values are first counted per distinct value (map-side combined, and
    checkpointed for the passes that follow), then each distinct value
    contributes to every evaluation point through a generator over the (small,
    fixed) point list, and contributions are summed per point.  Columns: ``x``,
    ``density``, which is NULL for a column without values.
    """
    df, _ = unwrap(x)
    points = [float(p) for p in points]
    counted = materialize(df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).count())
    n, sd = df.agg(F.count(column), F.stddev_samp(column)).first()
    if not n:
        return df.sparkSession.createDataFrame([(p, None) for p in points], "x double, density double")
    h = bandwidth if bandwidth is not None else default_bandwidth(counted, n, sd)
    pts = F.array(*[F.lit(p) for p in points])
    z = (F.col("x") - F.col("v")) / F.lit(h)
    norm = n * h * math.sqrt(2 * math.pi)
    return (
        counted.select("v", "count", F.explode(pts).alias("x"))
        .groupBy("x")
        .agg(F.sum(F.col("count") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
        .select("x", F.round(F.col("s") / F.lit(norm), digits).alias("density"))
    )


#: Grid cells per bandwidth, and bandwidths after which the kernel is cut off.
GRID_CELLS, KERNEL_REACH = 512, 8.0


def grid_error(bandwidth: float, cells: int = GRID_CELLS) -> float:
    """Bound of ``kernel_density_grid``'s error at any point: what a linear
    piece over one cell can miss of the kernel, and its tail beyond the reach."""
    peak = 1 / (bandwidth * math.sqrt(2 * math.pi))
    return peak / (8 * cells**2) + peak * math.exp(-(KERNEL_REACH**2) / 2)


def kernel_density_grid(x, column: str, points: Sequence[float], bandwidth: float | None = None, digits: int = 6,
                        cells: int = GRID_CELLS) -> DataFrame:
    """Gaussian kernel density of a continuous column at given points.

    Values are binned linearly onto a grid of ``cells`` cells per bandwidth: a
    value's weight goes to the two grid places beside it, in proportion to its
    distance.  This is one pass with map-side combining, and what remains is
    the grid, not the values; each point then sums the kernel over the places
    within ``KERNEL_REACH`` bandwidths.  The error is at most
    ``grid_error(bandwidth, cells)``, and 0 for values on the grid.  The default
    bandwidth takes its quartiles from Spark's quantile sketch.  Columns and
    empty input as in ``kernel_density``; NaN and infinite values are left out.
    """
    df, _ = unwrap(x)
    points = [float(p) for p in points]
    v = F.col(column).cast("double")
    data = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != math.inf))
    stats = [F.count("v").alias("n"), F.min("v").alias("lo")]
    if bandwidth is None:
        stats += [F.stddev_samp("v").alias("sd"), F.percentile_approx("v", [0.25, 0.75], 100_000).alias("q")]
    found = data.agg(*stats).first()
    n, lo = found["n"], found["lo"]
    if not n:
        return df.sparkSession.createDataFrame([(p, None) for p in points], "x double, density double")
    if bandwidth is None:
        sd = found["sd"] or 0.0
        spread = min(sd, (found["q"][1] - found["q"][0]) / 1.34)
        bandwidth = 0.9 * (spread or sd or abs(lo) or 1.0) * n ** (-0.2)
    h = float(bandwidth)
    step = h / cells
    at = (F.col("v") - F.lit(lo)) / F.lit(step)
    cell = F.floor(at)
    share = at - cell
    # a count and the weight that goes to the right: combined in each task before the shuffle
    grid = data.groupBy(cell.alias("cell")).agg(F.count("v").alias("n"), F.sum(share).alias("right"))
    both = F.array(F.struct(F.col("cell"), (F.col("n") - F.col("right")).alias("w")), F.struct((F.col("cell") + 1).alias("cell"), F.col("right").alias("w")))
    places = grid.select(F.explode(both).alias("g")).groupBy((F.lit(lo) + F.col("g.cell") * F.lit(step)).alias("v")).agg(F.sum("g.w").alias("w"))
    near = F.filter(F.array(*[F.lit(p) for p in points]), lambda p: F.abs(p - F.col("v")) <= F.lit(KERNEL_REACH * h))
    z = (F.col("x") - F.col("v")) / F.lit(h)
    sums = places.select("v", "w", F.explode(near).alias("x")).groupBy("x").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    every = df.sparkSession.createDataFrame([(p,) for p in points], "x double")
    norm = n * h * math.sqrt(2 * math.pi)
    return every.join(sums, "x", "left").select("x", F.round(F.coalesce("s", F.lit(0.0)) / F.lit(norm), digits).alias("density"))
