"""Joins on inequalities: ``a.x < b.y AND a.u > b.v`` without a nested loop.

Both sides are cut into cells: slabs of about equal row count by the first
value, and each slab by the second.  Two cells meet only if their bounds allow
both conditions; the others are never paired.  Cells with more than
``block_rows`` rows are dealt over several blocks, so a value that holds a
third of all rows spreads too.  A pair of blocks is joined in one task by the
sort-based algorithm: both sides in the order of the first value, a
permutation to the order of the second, and a bit array over it.  Going through
the left rows, the right rows that meet the first condition set their bits;
the set bits on the right side of the row's place meet the second as well.

Only the values' order matters, so they become 64-bit integers first: whole
numbers, decimals of up to 18 digits, dates, timestamps and booleans as they
are, floating-point numbers by their bit pattern (NaN above all others and
equal to itself, as in Spark).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}
#: Rows of a block at most on average, and slabs (and cells of a slab) at most.
BLOCK_ROWS, GRID = 20_000, 32
OUT_ROWS = 1 << 16


@dataclass(frozen=True)
class Inequality:
    """``left op right``: an expression over each side, as SQL text or Column."""

    left: str | Column
    op: str
    right: str | Column


def ordered_long(value: Column, kind: T.DataType, other: T.DataType) -> Column | None:
    """A value as a long with the same order as Spark compares it with a value
    of the ``other`` type; None where there is no such form."""
    kinds = (kind, other)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if all(isinstance(k, whole) for k in kinds) or all(isinstance(k, T.BooleanType) for k in kinds):
        return value.cast("long")
    if all(isinstance(k, T.DateType) for k in kinds):
        return F.unix_date(value).cast("long")
    if all(isinstance(k, (T.TimestampType, T.DateType)) for k in kinds):
        return F.unix_micros(value.cast("timestamp"))
    if all(isinstance(k, T.TimestampNTZType) for k in kinds):
        seconds = F.unix_date(value.cast("date")).cast("long") * 86_400 + F.hour(value) * 3600 + F.minute(value) * 60
        return seconds * 1_000_000 + (F.date_part(F.lit("SECONDS"), value) * 1_000_000).cast("long")
    exact = (T.DecimalType, *whole)
    if all(isinstance(k, exact) for k in kinds):
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
        scales = [k.scale if isinstance(k, T.DecimalType) else 0 for k in kinds]
        fronts = [k.precision - k.scale if isinstance(k, T.DecimalType) else digits[type(k)] for k in kinds]
        scale, front = max(scales), max(fronts)
        if scale + front > 18:
            return None
        return (value.cast(T.DecimalType(18, scale)) * F.lit(10**scale).cast(T.DecimalType(19, 0))).cast("long")
    if all(isinstance(k, T.NumericType) for k in kinds) and any(isinstance(k, T.DoubleType) for k in kinds):
        return value.cast("double")
    return None


def as_order(values: pa.Array) -> np.ndarray:
    """Longs as they are, doubles as integers in the same order."""
    raw = values.to_numpy(zero_copy_only=False)
    if raw.dtype != np.float64:
        return raw.astype(np.int64)
    bits = np.where(np.isnan(raw), np.nan, raw + 0.0).view(np.int64)  # one NaN, one zero
    bits = np.where(np.isnan(raw), np.int64(0x7FF8 << 48), bits)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def sorted_matches(x: np.ndarray, u: np.ndarray, y: np.ndarray, v: np.ndarray, first: str, second: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left, right) places with ``x first y`` and ``u second v``, in parts."""
    if first in (">", ">="):  # one direction is enough: negate the order of both sides
        x, y, first = ~x, ~y, FLIPPED[first]
    if second in (">", ">="):
        u, v, second = ~u, ~v, FLIPPED[second]
    # left rows from the greatest x down: ever more right rows have x < y
    order_x, order_y, order_v = np.argsort(x)[::-1], np.argsort(y)[::-1], np.argsort(v)
    place = np.empty(len(v), dtype=np.int64)
    place[order_v] = np.arange(len(v))  # permutation from right rows to their place by v
    falling = y[order_y][::-1]
    upto = len(y) - np.searchsorted(falling, x[order_x], side="right" if first == "<" else "left")
    start = np.searchsorted(v[order_v], u[order_x], side="right" if second == "<" else "left") if second else np.zeros(len(x), dtype=np.int64)
    bits, done = np.zeros(len(y), dtype=bool), 0
    left, right, held = [], [], 0
    for i, to, at in zip(order_x, upto, start):
        if to > done:
            bits[place[order_y[done:to]]] = True
            done = to
        hits = np.flatnonzero(bits[at:])
        if len(hits):
            left.append(np.full(len(hits), i))
            right.append(order_v[at + hits])
            held += len(hits)
            if held >= OUT_ROWS:
                yield np.concatenate(left), np.concatenate(right)
                left, right, held = [], [], 0
    if held:
        yield np.concatenate(left), np.concatenate(right)


def join_blocks(first: str, second: str | None):
    """Rows sorted by (pair, s, t), each with a side, two order values and the
    side's columns -> the joined rows of every block pair."""

    def joined(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        side = rows.column("side").to_numpy()
        a, b = (rows.filter(pa.array(side == s)).combine_chunks() for s in (0, 1))
        if not (a.num_rows and b.num_rows):
            return
        one, two = ([as_order(t.column(c).combine_chunks()) for c in ("k1", "k2")] for t in (a, b))
        l, r = (t.column(c).combine_chunks() for t, c in ((a, "l"), (b, "r")))
        for i, j in sorted_matches(one[0], one[1], two[0], two[1], first, second):
            for at in range(0, len(i), OUT_ROWS):
                yield pa.RecordBatch.from_arrays([l.take(pa.array(i[at : at + OUT_ROWS])), r.take(pa.array(j[at : at + OUT_ROWS]))], names=["l", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            key = [batch.column(c).to_numpy() for c in ("pair", "s", "t")]
            new = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in key], axis=0)]) if batch.num_rows else []
            for start, end in zip(new, [*new[1:], batch.num_rows]):
                name = tuple(int(k[start]) for k in key)
                if name != now and held:
                    yield from joined(pa.Table.from_batches(held))
                    held = []
                now = name
                held.append(batch.slice(start, end - start))
        if held:
            yield from joined(pa.Table.from_batches(held))

    return run


def _cuts(df: DataFrame, column: str, n: int, by: str | None = None) -> dict:
    """n - 1 values that cut the rows (of each ``by``) into about equal parts."""
    if n < 2:
        return {}
    grouped = df.groupBy(by) if by else df.groupBy(F.lit(0).alias("all"))
    rows = grouped.agg(F.percentile_approx(F.col(column).cast("double"), [i / n for i in range(1, n)]).alias("cuts")).collect()
    return {r[0]: sorted(set(r["cuts"])) for r in rows}  # at most n rows


def _placed(df: DataFrame, value: str, cuts: dict, name: str, by: str | None = None) -> DataFrame:
    """``df`` with ``name``, how many of the cuts (of its ``by``) are at most ``value``."""
    below = lambda c: c <= F.col(value).cast("double")
    if len(cuts) < 2:
        mine = F.array(*[F.lit(c) for c in next(iter(cuts.values()), [])]).cast("array<double>")
        return df.withColumn(name, F.size(F.filter(mine, below)))
    table = df.sparkSession.createDataFrame([(int(k), v) for k, v in cuts.items()], f"{by} int, __cuts array<double>")
    joined = df.join(F.broadcast(table), by)  # at most GRID rows of GRID numbers
    return joined.withColumn(name, F.size(F.filter("__cuts", below))).drop("__cuts")


def _given(df: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """``df`` joined to a few known rows by their first column, ``cell``; a
    frame with one cell takes them as literals (an equality with a constant
    would leave a nested loop)."""
    if len({r[0] for r in rows}) == 1:
        listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names[1:], r[1:])]) for r in rows])
        return df.withColumn("__given", F.explode(listed)).select(*df.columns, *[F.col(f"__given.{n}") for n in names[1:]])
    table = df.sparkSession.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    return df.join(F.broadcast(table), names[0])  # at most GRID**4 rows of a few numbers


def _cells(df: DataFrame, rows: int, block_rows: int, two: bool) -> tuple[DataFrame, list]:
    """``df`` with ``cell`` and ``block``, and the bounds and blocks of each cell."""
    grid = max(1, min(GRID, int(np.ceil(np.sqrt(rows / block_rows)))))
    df = _placed(df, "k1", _cuts(df, "k1", grid), "slab")
    df = _placed(df, "k2", _cuts(df, "k2", grid, "slab") if two else {}, "inner", "slab")
    df = df.withColumn("cell", F.col("slab") * GRID + F.col("inner"))
    bounds = df.groupBy("cell").agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in ("k1", "k2") for n, f in (("lo", F.min), ("hi", F.max))])
    found = bounds.collect()  # at most GRID * GRID rows
    blocks = [(r["cell"], -(-r["n"] // block_rows)) for r in found]
    dealt = _given(df, blocks, ["cell", "blocks"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    return dealt.drop("blocks"), [(r, n) for r, (_, n) in zip(found, blocks)]


def _may_hold(a, b, key: str, op: str | None) -> bool:
    if op is None:
        return True
    lo_a, hi_a, lo_b, hi_b = (x[f"{e}_{key}"] for x in (a, b) for e in ("lo", "hi"))
    if any(isinstance(x, float) and x != x for x in (lo_a, hi_a, lo_b, hi_b)):
        return True  # NaN bounds
    return {"<": lo_a < hi_b, "<=": lo_a <= hi_b, ">": hi_a > lo_b, ">=": hi_a >= lo_b}[op]


def matching_rows(left: DataFrame, right: DataFrame, conditions: Sequence[Inequality], carry: tuple[Sequence[str], Sequence[str]], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Struct columns ``l`` and ``r`` with the carried columns (named c0, c1, ...)
    of all row pairs that meet the one or two conditions.

    ``left`` and ``right`` are materialized and have a row number ``__row``."""
    one = conditions[0]
    two = conditions[1] if len(conditions) > 1 else None
    sides = []
    for df, name, names in ((left, "left", carry[0]), (right, "right", carry[1])):
        keys = []
        for c in (one, two):
            if c is None:
                keys.append(F.lit(0).cast("long"))
                continue
            values = [F.expr(x) if isinstance(x, str) else x for x in (c.left, c.right)]
            kinds = [d.select(v).schema[0].dataType for d, v in zip((left, right), values)]
            mine = 0 if name == "left" else 1
            key = ordered_long(values[mine], kinds[mine], kinds[1 - mine])
            if key is None:
                raise ValueError(f"cannot order {kinds[0].simpleString()} against {kinds[1].simpleString()}")
            keys.append(key)
        struct = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
        sides.append(df.select(keys[0].alias("k1"), keys[1].alias("k2"), F.col("__row").alias("id"), struct.alias("side_row")).where("k1 is not null and k2 is not null"))
    counts = [s.count() for s in sides]
    (a, cells_a), (b, cells_b) = (_cells(s, n, block_rows, two is not None) for s, n in zip(sides, counts))
    pairs = [
        (ra["cell"], rb["cell"], na, nb)
        for ra, na in cells_a
        for rb, nb in cells_b
        if _may_hold(ra, rb, "k1", one.op) and _may_hold(ra, rb, "k2", two.op if two else None)
    ]
    sent = []
    for side, df in ((0, a), (1, b)):
        meets = [(p[side], i, p[3 - side]) for i, p in enumerate(pairs)]
        met = _given(df, meets, ["cell", "pair", "others"])
        far = F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("far")
        met = met.select("pair", "k1", "k2", "side_row", "block", far)
        s, t = ("block", "far") if side == 0 else ("far", "block")
        empty = [F.lit(None).cast(x.schema["side_row"].dataType) for x in (a, b)]
        row = [F.col("side_row") if i == side else e for i, e in enumerate(empty)]
        sent.append(met.select("pair", F.col(s).alias("s"), F.col(t).alias("t"), F.lit(side).alias("side"), "k1", "k2", row[0].alias("l"), row[1].alias("r")))
    both = sent[0].union(sent[1]).repartition("pair", "s", "t").sortWithinPartitions("pair", "s", "t")
    schema = T.StructType([T.StructField(c, x.schema["side_row"].dataType) for c, x in (("l", a), ("r", b))])
    return both.mapInArrow(join_blocks(one.op, two.op if two else None), schema)


def inequality_join(
    left: DataFrame,
    right: DataFrame,
    conditions: Sequence[Inequality],
    residual: str | Column | None = None,
    how: str = "inner",
    block_rows: int = BLOCK_ROWS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Join on one or more inequalities.

    The first two find the pairs; further ones and ``residual``, any condition
    over both sides, filter them.  ``how`` is inner, left, right, full,
    left_semi or left_anti.  NULL values match nothing; rows without a partner
    are found by row number, so each comes out once.  An inequality join that
    most pairs satisfy has a result of that size; the work beside it is the
    block pairs on the edge of the conditions.  ``keep`` names the columns that
    are wanted of both sides (all by default): only these are paired and returned.
    """
    from cataloom.operators.join import join_type

    kind = join_type(how)
    if kind not in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        raise ValueError(f"inequality_join does not support how={how!r}")
    wanted = lambda name: keep is None or name.lower() in {k.lower() for k in keep}
    own, other = ([f.name for f in d.schema.fields if wanted(f.name)] for d in (left, right))
    a = materialize(left.withColumn("__row", F.monotonically_increasing_id()))
    b = materialize(right.withColumn("__row", F.monotonically_increasing_id()))
    extra = [c for c in conditions[2:]]
    if extra or residual is not None:
        ids = matching_rows(a, b, conditions[:2], (["__row"], ["__row"]), block_rows)
        ids = ids.select(F.col("l.c0").alias("__l"), F.col("r.c0").alias("__r"))
        found = a.withColumnRenamed("__row", "__left").join(ids, F.col("__left") == F.col("__l")).join(b.withColumnRenamed("__row", "__right"), F.col("__r") == F.col("__right"))
        ops = {"<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}
        for c in extra:
            one, two = (F.expr(x) if isinstance(x, str) else x for x in (c.left, c.right))
            found = found.where(getattr(one, ops[c.op])(two))
        if residual is not None:
            found = found.where(residual)
        names = [f"c{i}" for i in range(len(left.columns) + len(right.columns))]
        # by place: both sides may use a name
        found = found.toDF(*names[: len(left.columns)], "__left", "__l", "__r", *names[len(left.columns) :], "__right")
        matched = found.select(*[F.col(n) for n, c in zip(names, [*left.columns, *right.columns]) if wanted(c)], F.col("__left"), F.col("__right"))
    else:
        numbers = [] if kind == "inner" and own and other else ["__row"]
        rows = matching_rows(a, b, conditions, ([*own, *numbers], [*other, *numbers]), block_rows)
        flat = [F.col(f"l.c{i}").alias(f"c{i}") for i in range(len(own))] + [F.col(f"r.c{i}").alias(f"c{len(own) + i}") for i in range(len(other))]
        if kind != "inner":
            flat += [F.col(f"l.c{len(own)}").alias("__left"), F.col(f"r.c{len(other)}").alias("__right")]
        matched = rows.select(*flat)
    if kind in ("left_semi", "left_anti"):
        return a.join(matched.select(F.col("__left").alias("__row")).distinct(), "__row", kind).select(*[F.col(f"`{c}`") for c in own])
    if kind != "inner":
        matched = materialize(matched)
    out = matched.drop("__left", "__right").toDF(*own, *other)
    if kind in ("left", "full"):
        alone = a.join(matched.select(F.col("__left").alias("__row")).distinct(), "__row", "left_anti")
        out = out.union(alone.select(*[F.col(f"`{c}`") for c in own], *[F.lit(None).cast(f.dataType) for f in right.schema.fields if wanted(f.name)]))
    if kind in ("right", "full"):
        alone = b.join(matched.select(F.col("__right").alias("__row")).distinct(), "__row", "left_anti")
        out = out.union(alone.select(*[F.lit(None).cast(f.dataType) for f in left.schema.fields if wanted(f.name)], *[F.col(f"`{c}`") for c in other]))
    return out


# ---------------------------------------------------------------- conditions of a join
OPS = {"LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">="}


def _conjuncts(e, known=None) -> Iterator[tuple[str, object, object, dict]]:
    """(kind, left, right, common expressions) of a condition's AND parts."""
    kind = e.getClass().getSimpleName()
    known = known or {}
    if kind == "And":
        yield from _conjuncts(e.left(), known)
        yield from _conjuncts(e.right(), known)
    elif kind == "Between":
        yield from _conjuncts(e.replacement(), known)
    elif kind == "With":
        defs = e.defs()
        known = {**known, **{defs.apply(i).id().toString(): defs.apply(i).child() for i in range(defs.size())}}
        yield from _conjuncts(e.child(), known)
    elif kind in OPS or kind in ("EqualTo", "EqualNullSafe"):
        yield kind, e.left(), e.right(), known
    else:
        yield "other", None, None, known


def _text(e, known: dict) -> tuple[str, object]:
    """SQL text of an operand and the expression whose columns it reads."""
    kind = e.getClass().getSimpleName()
    if kind == "CommonExpressionRef":
        whole = known[e.id().toString()]
        return whole.sql(), whole
    if kind == "Cast" and e.child().getClass().getSimpleName() == "CommonExpressionRef":
        whole = known[e.child().id().toString()]
        return f"CAST({whole.sql()} AS {e.dataType().sql()})", whole
    return e.sql(), e


def inequalities_of(left: DataFrame, right: DataFrame, condition: Column) -> tuple[list[Inequality], bool] | None:
    """The inequalities between the two sides in a join condition, as Spark's
    analyzer resolves it, and whether they are all of it.  None when there is
    an equality between the sides (Spark joins on that), no inequality that
    can be ordered, or a side's expression cannot be told from the other's."""
    plan = left.join(right, condition)._jdf.queryExecution().analyzed()
    if plan.nodeName() != "Join" or plan.condition().isEmpty():
        return None
    sets = (plan.left().outputSet(), plan.right().outputSet())

    def side(e) -> int | None:
        refs = e.references()
        return next((i for i, s in enumerate(sets) if not refs.isEmpty() and refs.subsetOf(s)), None)

    found, whole = [], True
    for kind, l, r, known in _conjuncts(plan.condition().get()):
        if kind == "other":
            whole = False
            continue
        (text_l, l), (text_r, r) = _text(l, known), _text(r, known)
        at = (side(l), side(r))
        if set(at) != {0, 1}:
            whole = False
        elif kind not in OPS:
            return None
        else:
            op = OPS[kind]
            found.append(Inequality(text_l, op, text_r) if at == (0, 1) else Inequality(text_r, FLIPPED[op], text_l))
    usable = []
    for c in found:
        try:
            kinds = [d.select(F.expr(x)).schema[0].dataType for d, x in ((left, c.left), (right, c.right))]
        except AnalysisException:  # a name both sides share
            return None
        if ordered_long(F.lit(None), *kinds) is None:
            whole = False
        else:
            usable.append(c)
    return (usable, whole) if usable else None
