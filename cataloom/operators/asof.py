"""As-of join: each left row with the last right row at or before its time.

Both sides become one stream of rows ordered by key and time, in which a running
window carries the last right row forward: one shuffle of the rows.  A first
pass counts the rows of each key, combined in the tasks.  For keys of more than
``PART_ROWS`` rows time is cut into buckets, so a key that holds a third of all
rows spreads over many (key, bucket) groups: what a group starts with is the
last right row of the key's
buckets before, which a second, small window carries from bucket to bucket
(one row for each key and bucket).  A group of many rows of one moment is dealt
over several parts, each with the right rows of the group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.operators.inequality import ordered_long
from cataloom.session import materialize

#: Rows of a bucket on average (of all keys of many rows together), and rows of a key or (key, bucket) part.
BUCKET_ROWS, PART_ROWS = 2_000_000, 500_000


def _time(df: DataFrame, name: str, other: T.DataType) -> Column:
    kind = df.schema[name].dataType
    value = ordered_long(F.col(f"`{name}`"), kind, other)
    if value is None:
        raise ValueError(f"as-of join cannot compare {kind.simpleString()} with {other.simpleString()}")
    return value


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[tuple[str, str]],
    on: tuple[str, str],
    tie_break: Sequence[str] = (),
    how: str = "left",
    direction: str = "backward",
    allow_equal: bool = True,
    tolerance: float | None = None,
    bucket_rows: int = BUCKET_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Left rows with the nearest right row of equal ``by`` columns.

    ``by`` and ``on`` name (left, right) columns; ``on`` are numbers, dates or
    timestamps.  ``backward`` takes the last right row at or before the left
    time, ``forward`` the first at or after; ``allow_equal=False`` leaves out
    equal times.  Right rows of one moment are ordered by ``tie_break`` columns
    (the greatest is nearest), which should make the order total.
    ``tolerance`` is the greatest distance, in the column's unit (days for
    dates, microseconds for timestamps).  Output: left then right columns; a
    left row without a partner, with a NULL key or time has NULLs there, or is
    left out with ``how="inner"``.  Right rows with a NULL key or time match
    nothing.  Every left row comes out at most once.
    """
    if how not in ("left", "inner"):
        raise ValueError("asof_join is left or inner")
    if direction not in ("backward", "forward"):
        raise ValueError("direction is backward or forward")
    kinds = [d.schema[c].dataType for d, c in zip((left, right), on)]
    times = [_time(left, on[0], kinds[1]), _time(right, on[1], kinds[0])]
    if direction == "forward":
        times = [-t for t in times]
    keys = [f"__k{i}" for i in range(len(by))]
    struct = lambda df: F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    ties = F.struct(*[F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(tie_break)], F.lit(0).alias("t"))
    one = left.select(*[F.col(f"`{a}`").alias(k) for k, (a, _) in zip(keys, by)], times[0].alias("__t"), struct(left).alias("__l"), F.monotonically_increasing_id().alias("__id"))
    two = right.select(*[F.col(f"`{b}`").alias(k) for k, (_, b) in zip(keys, by)], times[1].alias("__t"), struct(right).alias("__r"), ties.alias("__tie"))
    there = F.lit(True)
    for c in (*keys, "__t"):
        there = there & F.col(c).isNotNull()
    two = two.where(there)
    # keys of more rows than a part, and how many left rows can have no partner
    sizes = one.select(*keys, there.alias("__there")).unionByName(two.select(*keys, F.lit(True).alias("__there")))
    sizes = sizes.select(*[F.when(F.col("__there"), F.col(k)).alias(k) for k in keys], "__there").groupBy(*keys, "__there").count()
    marks = materialize(sizes.where(F.col("count") > F.when(F.col("__there"), part_rows).otherwise(0)))
    found = {r["__there"] for r in marks.select("__there").distinct().collect()}
    outs = []
    if False in found:
        outs.append(one.where(~there).select("__l", F.lit(None).cast(two.schema["__r"].dataType).alias("__r"), F.lit(None).cast("double").alias("__apart")))
    empty = {c: F.lit(None).cast(d.schema[c].dataType) for d, c in ((one, "__l"), (two, "__r"), (two, "__tie"))}
    events = one.where(there).select(*keys, "__t", F.lit(not allow_equal).alias("__first"), "__l", "__id", empty["__r"].alias("__r"), empty["__tie"].alias("__tie"))
    marked = two.select(*keys, "__t", F.lit(allow_equal).alias("__first"), empty["__l"].alias("__l"), F.lit(None).cast("long").alias("__id"), "__r", "__tie")
    events = events.unionByName(marked)
    last = F.when(F.col("__r").isNotNull(), F.struct("__t", "__tie", "__r"))
    order = ["__t", F.col("__first").desc(), "__tie"]
    running = lambda *by: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hot = F.broadcast(marks.where("__there").select(*keys))  # at most rows / part_rows keys
    rest = events.join(hot, keys, "left_anti") if True in found else events
    stream = rest.withColumn("__found", F.last(last, ignorenulls=True).over(running(*keys)))
    if True in found:
        stream = stream.select("__l", "__t", "__found").unionByName(_hot_stream(events.join(hot, keys, "left_semi"), keys, last, running, bucket_rows, part_rows))
    stream = stream.where("__l is not null")
    outs.append(stream.select("__l", F.col("__found.__r").alias("__r"), (F.col("__t") - F.col("__found.__t")).cast("double").alias("__apart")))
    out = reduce(DataFrame.unionByName, outs)
    if tolerance is not None:
        out = out.withColumn("__r", F.when(F.col("__apart") <= tolerance, F.col("__r")))
    if how == "inner":
        out = out.where("__r is not null")
    names = [*left.columns, *right.columns]
    flat = [F.col(f"__l.c{i}").alias(f"c{i}") for i in range(len(left.columns))]
    flat += [F.col(f"__r.c{i}").alias(f"c{len(left.columns) + i}") for i in range(len(right.columns))]
    return out.select(*flat).toDF(*names)


def _hot_stream(events: DataFrame, keys: list[str], best: Column, running, bucket_rows: int, part_rows: int) -> DataFrame:
    """(__l, __t, __found) of the rows of keys with many rows, by time buckets."""
    n, low, high = events.agg(F.count("*"), F.min("__t").cast("double"), F.max("__t").cast("double")).first()
    buckets = 1 + n // bucket_rows
    width = ((high - low) / buckets if n else 0.0) or 1.0
    events = events.withColumn("__b", F.least(F.floor((F.col("__t").cast("double") - F.lit(low or 0.0)) / F.lit(width)), F.lit(buckets - 1)).cast("long"))
    # the last right row of each (key, bucket), carried into the key's buckets after it
    groups = events.groupBy(*keys, "__b").agg(F.max_by(best, F.when(F.col("__r").isNotNull(), F.struct("__t", "__tie"))).alias("__last"), F.count("__l").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = groups.select(*keys, "__b", F.last("__last", ignorenulls=True).over(before).alias("__carry"), F.ceil(F.col("__n") / part_rows).cast("int").alias("__parts"))
    carried = materialize(carried)
    joined = events.join(carried.where("__parts > 0"), [*keys, "__b"])
    most = carried.agg(F.max("__parts")).first()[0] or 0
    part = F.lit(0)
    if most > 1:  # a group of more rows than a part: left rows are dealt, right rows go to every part
        mine = F.pmod(F.col("__id"), F.col("__parts")).cast("int")  # by row number: equal rows spread too
        every = F.sequence(F.lit(0), F.col("__parts") - 1)
        joined = joined.withColumn("__p", F.explode(F.when(F.col("__r").isNull(), F.array(mine)).otherwise(every)))
        part = F.col("__p")
    joined = joined.withColumn("__part", part)
    here = F.last(best, ignorenulls=True).over(running(*keys, "__b", "__part"))
    return joined.select("__l", "__t", F.coalesce(here, F.col("__carry")).alias("__found"))
