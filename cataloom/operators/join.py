"""Joins: FK-discovered N-way joins, condition joins, equi/range joins.

Nothing here forces a broadcast: Spark chooses one from byte statistics, AQE
from measured sizes at run time, and skewed partitions are split
(``forceOptimizeSkewedJoin`` also where joins on one key follow each other).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.column import Column

from cataloom.operators.inequality import inequalities_of, inequality_join, ordered_long
from cataloom.operators.project import check_unique, prefix_columns, qualified_name, qualify_columns
from cataloom.operators.tracked import Tracked, unwrap
from cataloom.sources.catalog import Catalog

JOIN_TYPES = {
    "inner": "inner",
    "outer": "full",
    "full": "full",
    "full_outer": "full",
    "left": "left",
    "left_outer": "left",
    "right": "right",
    "right_outer": "right",
    "semijoin": "left_semi",
    "semi": "left_semi",
    "left_semi": "left_semi",
    "anti": "left_anti",
    "left_anti": "left_anti",
}


def join_type(name: str) -> str:
    try:
        return JOIN_TYPES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown join type {name!r}; use one of {sorted(JOIN_TYPES)}") from None


# ---------------------------------------------------------------- J1
@dataclass(frozen=True)
class JoinEdge:
    child: str  # qualified table holding the FK
    parent: str  # qualified referenced table
    pairs: tuple[tuple[str, str], ...]  # (fk column, referenced column), dotted names


def discover_join_keys(catalog: Catalog, tables: Sequence[str]) -> list[JoinEdge]:
    """For each ordered pair (i, j), the first FK of i that references j.

    All column pairs of that FK are used, so composite keys join on every
    column.  Names are compared in full (``source.table``).
    """
    edges = []
    for i, child in enumerate(tables):
        doc = catalog.doc(child)
        for j, parent in enumerate(tables):
            if i == j:
                continue
            for fk in doc.fk:
                if fk and fk[0].t == parent:
                    edges.append(JoinEdge(child, parent, tuple((r.f_by, r.by) for r in fk)))
                    break
    return edges


def auto_join(
    catalog: Catalog,
    *tables: str,
    on: Sequence[JoinEdge] | None = None,
    return_edges: bool = False,
):
    """N-way inner join whose conditions come from the catalog's FKs.

    Columns of original tables are renamed ``table__column``; derived tables
    keep their names.  Tables are folded in an order where each newly joined
    table is linked to the ones before it, and every edge among the joined
    tables becomes part of the condition; the fold starts from a table no
    other listed table references and adds parents (N:1) before children
    (1:N).  A table with no link raises.
    With ``return_edges`` the join steps are returned as well, as
    ``[(table, [edges used to join it]), ...]`` after the starting table,
    so an ambiguous choice (several FK paths) is visible to the caller.
    """
    if len(tables) < 2:
        raise ValueError("auto_join needs at least two tables")
    docs = {t: catalog.doc(t) for t in tables}
    edges = list(on) if on is not None else discover_join_keys(catalog, tables)

    def column(dotted: str) -> str:
        source, table, col = dotted.split(".", 2)
        owner = docs.get(f"{source}.{table}")
        if owner is None:
            raise ValueError(f"foreign key column {dotted!r} belongs to no joined table")
        return col if owner.derived else qualified_name(table, col)

    frames = {}
    for t, doc in docs.items():
        df = catalog.read(t)
        frames[t] = df if doc.derived else qualify_columns(df, doc.table)
    check_unique([c for f in frames.values() for c in f.columns])

    # Start from a table no other listed table references (the fact side),
    # then prefer N:1 lookups of parents over 1:N expansions to children, so
    # intermediate results never pair up the children of a shared parent.
    referenced = {e.parent for e in edges if e.child != e.parent}
    start = next((t for t in tables if t not in referenced), tables[0])
    joined = [start]
    used: list[tuple[str, list[JoinEdge]]] = []
    result = frames[start]
    pending = [t for t in tables if t != start]
    while pending:
        def links_of(cand):
            return [
                e for e in edges
                if (e.child == cand and e.parent in joined) or (e.parent == cand and e.child in joined)
            ]

        lookups = [c for c in pending if any(e.parent == c and e.child in joined for e in links_of(c))]
        linked = lookups or [c for c in pending if links_of(c)]
        if not linked:
            raise ValueError(
                f"no foreign key links {pending} to {joined}; pass on=[JoinEdge(...)] "
                "to give the join condition (no cross join is made)"
            )
        cand = linked[0]
        links = links_of(cand)
        cond = None
        for e in links:
            for a, b in e.pairs:
                term = F.col(column(a)) == F.col(column(b))
                cond = term if cond is None else cond & term
        result = result.join(frames[cand], cond, "inner")
        used.append((cand, links))
        joined.append(cand)
        pending.remove(cand)
    # columns in the order the tables were listed, whatever the join order
    result = result.select(*[F.col(f"`{c}`") for t in tables for c in frames[t].columns])
    out = Tracked(result, tuple(tables))
    return (out, used) if return_edges else out


# ---------------------------------------------------------------- J2, J3
def join_tables(
    left,
    right,
    join_condition: str | Column,
    join_type_name: str = "inner",
    filter_condition: str | Column | None = None,
    select_cols: Sequence[str] | None = None,
    out_col_prefix: str | None = None,
) -> DataFrame:
    """Join on any boolean SQL condition, then filter, select, prefix.

    Equality conjuncts in the condition become hash/sort-merge join keys;
    the rest stays a join filter.  Without one, inequalities between the two
    sides are found and joined by sorting (``theta_join``), not by a nested
    loop.
    """
    ldf, _ = unwrap(left)
    rdf, _ = unwrap(right)
    cond = F.expr(join_condition) if isinstance(join_condition, str) else join_condition
    out = theta_join(ldf, rdf, cond, join_type(join_type_name), filter_condition, select_cols if filter_condition is None else None)
    if out is None:
        out = ldf.join(rdf, cond, join_type(join_type_name))
    if filter_condition is not None:
        out = out.filter(filter_condition)
    if select_cols:
        out = out.select(*[F.col(f"`{c}`") for c in select_cols])
    if out_col_prefix is not None:
        out = prefix_columns(out, out_col_prefix, uppercase=True)
    return out


def left_outer_join_tables(left, right, join_condition, filter_condition=None, select_cols=None, out_col_prefix=None) -> DataFrame:
    """Left outer join with all arguments honoured."""
    return join_tables(left, right, join_condition, "left_outer", filter_condition, select_cols, out_col_prefix)


# ---------------------------------------------------------------- salting
SALT = "__salt"


def salted(left: DataFrame, right: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Spread each key of ``left`` over ``buckets`` join partitions.

    Left rows get a salt from their place in their input partition, so equal
    rows spread too -- the place stays the same when a scan or a checkpoint is
    read again (lost executor) -- and every right row is repeated once per salt value.  Join on
    the keys plus ``__salt``; a hot key is then split across ``buckets``
    tasks at the cost of ``buckets`` copies of the (smaller) right side.
    """
    left = left.withColumn(SALT, F.pmod(F.monotonically_increasing_id(), F.lit(buckets)))
    right = right.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))))
    return left, right


# ---------------------------------------------------------------- J4-J6
def equi_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "inner",
    salt_buckets: int | None = None,
) -> DataFrame:
    """Join on one or more column pairs (single and composite keys).

    Whether a side is broadcast is left to Spark's byte statistics.  With
    ``salt_buckets`` every ``right`` row is repeated once per salt so hot keys
    of ``left`` spread over several tasks (inner and left joins).
    """
    if not pairs:
        raise ValueError("equi_join needs at least one column pair")
    salt = bool(salt_buckets and salt_buckets > 1)
    if salt:
        if join_type(how) not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError("salting repeats the right side; use it with inner/left/semi/anti joins")
        left, right = salted(left, right, salt_buckets)
    cond = None
    for a, b in pairs:
        term = left[a] == right[b]
        cond = term if cond is None else cond & term
    if salt:
        cond = cond & (left[SALT] == right[SALT])
    out = left.join(right, cond, join_type(how))
    if salt:
        out = out.drop(left[SALT])
        if SALT in out.columns:
            out = out.drop(right[SALT])
    return out


# ---------------------------------------------------------------- J7
def join_back_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    how: str = "inner",
    salt_buckets: int | None = None,
    materialize_aggregate: bool = True,
) -> DataFrame:
    """Join a frame to its own GROUP BY result on the group keys.

    The aggregate is combined map-side before its shuffle, so a hot key
    costs one partial row per task.  It is then materialized (one row per
    group, checkpointed to shared storage), which makes the join back a
    plain shuffle join: AQE splits the partition of a key holding a third
    of all rows into many tasks (a join straight onto an aggregate is not
    split).  Alternative: ``salt_buckets`` for an explicitly salted join.  NULL keys find no
    partner, as in an equality join.
    """
    agg = df.groupBy(*keys).agg(*aggs)
    if materialize_aggregate and not salt_buckets:
        from cataloom.session import materialize

        agg = materialize(agg)
    renamed = agg.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                         *[c for c in agg.columns if c not in keys])
    left, right = df, renamed
    if salt_buckets and salt_buckets > 1:
        left, right = salted(left, renamed, salt_buckets)
    cond = None
    for i, k in enumerate(keys):
        term = left[k] == right[f"__k{i}"]
        cond = term if cond is None else cond & term
    if salt_buckets and salt_buckets > 1:
        cond = cond & (left[SALT] == right[SALT])
    out = left.join(right, cond, join_type(how))
    if salt_buckets and salt_buckets > 1:
        out = out.drop(left[SALT]).drop(right[SALT])
    return out.drop(*[f"__k{i}" for i in range(len(keys))])


# ---------------------------------------------------------------- theta
def theta_join(left: DataFrame, right: DataFrame, cond: Column, how: str, filter_condition: str | Column | None = None, keep: Sequence[str] | None = None) -> DataFrame | None:
    """A join without equality: a value between two bounds becomes a
    ``range_join``, other inequalities an ``inequality_join``.  None when the
    condition has no such part, or when a later filter names columns in a way
    (by table alias) that only Spark's own join keeps; Spark plans these.
    ``keep`` names the columns that are wanted; others may be left out."""
    if how not in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        return None
    found = inequalities_of(left, right, cond)
    if found is None:
        return None
    conditions, whole = found
    if filter_condition is not None:
        fields = left.schema.fields + ([] if how in ("left_semi", "left_anti") else right.schema.fields)
        try:
            left.sparkSession.createDataFrame([], T.StructType(fields)).filter(filter_condition)
        except AnalysisException:
            return None
    if whole and len(conditions) == 2:
        bounds = {c.op: c for c in conditions}
        kinds = [d.select(F.expr(x)).schema[0].dataType for c in conditions for d, x in ((left, c.left), (right, c.right))]
        floats = any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds)  # may be infinite: no bins
        if set(bounds) == {">=", "<="} and not floats:
            low, high = bounds[">="], bounds["<="]
            if low.left == high.left:
                return range_join(left, right, low.left, low.right, high.right, how=how)
            if low.right == high.right and how in ("inner", "left", "right", "full"):
                flipped = {"left": "right", "right": "left"}.get(how, how)
                out = range_join(right, left, low.right, high.left, low.left, how=flipped)
                names = [f"c{i}" for i in range(len(out.columns))]
                back = names[len(right.columns) :] + names[: len(right.columns)]
                return out.toDF(*names).select(*back).toDF(*left.columns, *right.columns)
    residual = None if whole and len(conditions) <= 2 else cond
    return inequality_join(left, right, conditions[:2], residual, how, keep=keep or None)


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    value: str | Column,
    low: str | Column,
    high: str | Column,
    bin_width: float | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join rows whose ``value`` lies in ``[low, high]`` without a nested loop.

    Bins have widths w, 2w, 4w, ...: a range is placed at the level whose bins
    are about its own length, so it overlaps at most three of them however
    long it is, and a point has one bin at each level that some range uses.
    The equi-join on (level, bin) is a normal shuffle or broadcast join and the
    BETWEEN filter keeps the exact semantics; a pair meets in one bin only.
    ``w`` defaults to the median range length.  Ranges with a NULL bound or
    ``low > high`` match nothing.  ``how`` is inner, left, right, full,
    left_semi or left_anti; unmatched rows are found by an anti join of
    checkpointed, numbered rows, so each comes out once.  Dates and timestamps
    are joined as days and microseconds (the unit of ``bin_width`` then).
    """
    from cataloom.session import materialize

    kind = join_type(how)
    if kind not in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        raise ValueError(f"range_join does not support how={how!r}")
    as_column = lambda x: F.expr(x) if isinstance(x, str) else x
    pts = points.withColumn("__v", as_column(value))
    rng = ranges.withColumns({"__lo": as_column(low), "__hi": as_column(high)})
    kinds = {c: d.schema[c].dataType for c, d in (("__v", pts), ("__lo", rng), ("__hi", rng))}
    if any(isinstance(k, (T.DateType, T.TimestampType, T.TimestampNTZType)) for k in kinds.values()):
        widest = next((k for k in kinds.values() if not isinstance(k, T.DateType)), T.DateType())
        longs = {c: ordered_long(F.col(c), k, widest) for c, k in kinds.items()}
        if any(x is None for x in longs.values()):
            raise ValueError("range_join cannot compare " + ", ".join(k.simpleString() for k in kinds.values()))
        pts, rng = pts.withColumn("__v", longs["__v"]), rng.withColumns({c: longs[c] for c in ("__lo", "__hi")})
    if kind != "inner":
        pts = materialize(pts.withColumn("__pid", F.monotonically_increasing_id()))
        rng = materialize(rng.withColumn("__rid", F.monotonically_increasing_id()))
    valid = rng.where("__lo <= __hi")
    length = (F.col("__hi") - F.col("__lo")).cast("double")
    if bin_width is None:
        median = valid.select(F.percentile_approx(length, 0.5).alias("w")).first()["w"]
        bin_width = float(median) if median and median > 0 else 1.0
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length / bin_width, F.lit(1.0))))).cast("int")
    valid = valid.withColumn("__level", level)
    levels = sorted(r[0] for r in valid.select("__level").distinct().collect())  # at most one per power of two
    bin_of = lambda c: F.floor(F.col(c) / (F.lit(bin_width) * F.pow(F.lit(2.0), F.col("__level"))))
    valid = valid.withColumn("__bin", F.explode(F.sequence(bin_of("__lo"), bin_of("__hi"))))
    placed = pts.withColumn("__level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>"))).withColumn("__bin", bin_of("__v"))
    pairs = placed.join(valid, ["__level", "__bin"]).where("__v between __lo and __hi")
    own, other = list(points.columns), list(ranges.columns)
    if kind == "inner":
        return pairs.select(*[placed[c] for c in own], *[valid[c] for c in other])
    seen_points = pairs.select("__pid").distinct()
    if kind in ("left_semi", "left_anti"):
        return pts.join(seen_points, "__pid", kind).select(*own)
    out = pairs.select(*[placed[c] for c in own], *[valid[c] for c in other])
    if kind in ("left", "full"):
        alone = pts.join(seen_points, "__pid", "left_anti")
        out = out.union(alone.select(*own, *[F.lit(None).cast(f.dataType) for f in ranges.schema.fields]))
    if kind in ("right", "full"):
        alone = rng.join(pairs.select("__rid").distinct(), "__rid", "left_anti")
        out = out.union(alone.select(*[F.lit(None).cast(f.dataType) for f in points.schema.fields], *other))
    return out
