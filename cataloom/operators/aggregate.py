"""Grouped aggregation and latest-row-per-group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from cataloom.operators.project import check_unique, prefix_columns
from cataloom.operators.tracked import resolve, rewrap, unwrap

# Aggregate names accepted besides pyspark.sql.functions names.
AGG_ALIASES = {"n": "count", "mean": "avg", "n_distinct": "count_distinct"}


def agg_column(fn: str, column: str | Column) -> Column:
    name = AGG_ALIASES.get(fn, fn)
    func = getattr(F, name, None)
    if func is None:
        raise ValueError(f"unknown aggregate function {fn!r}")
    return func(F.col(column) if isinstance(column, str) else column)


def aggregate(x, group_by: str | Sequence[str], *, catalog=None, **named):
    """Group by one or more columns with named aggregates (A1).

    ``named`` maps an output name to ``(function_name, column)`` or to a
    ready Column, e.g. ``count=("n", "s_store_id"), s1=("sum", "ss_net_paid")``.
    Partial aggregation runs before the shuffle, so a hot group costs one
    partial row per task.  ``x`` may be a ``source.table`` name with
    ``catalog``.
    """
    x = resolve(x, catalog)
    df, _ = unwrap(x)
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    aggs = []
    for name, spec in named.items():
        col = spec if isinstance(spec, Column) else agg_column(*spec)
        aggs.append(col.alias(name))
    check_unique(keys + list(named))
    return rewrap(x, df.groupBy(*keys).agg(*aggs))


def split_expressions(text: str) -> list[str]:
    """Comma-separated SQL expressions; commas in brackets or quotes belong to
    their expression."""
    parts, depth, quote = [""], 0, ""
    for c in text:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c == "," and not depth:
            parts.append("")
            continue
        parts[-1] += c
    return [x.strip() for x in parts if x.strip()]


def group_by_sql(df: DataFrame, group_by: str, *select_exprs: str, out_col_prefix: str | None = None) -> DataFrame:
    """``SELECT keys, exprs… GROUP BY keys`` from SQL text, any number of exprs (A2)."""
    keys = split_expressions(group_by)
    if not select_exprs:
        raise ValueError("group_by_sql needs at least one aggregate expression")
    out = df.groupBy(*[F.expr(k) for k in keys]).agg(*[F.expr(e) for e in select_exprs])
    if out_col_prefix is not None:
        out = prefix_columns(out, out_col_prefix, uppercase=True)
    return out


def count_if(condition: str | Column) -> Column:
    """``SUM(CASE WHEN c THEN 1 ELSE 0 END)`` as a BIGINT count (A4)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return F.count_if(cond)


def _first_ranked(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Rows that rank first in their group by ``order_by``, descending, NULLs last."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return df.withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") == 1).drop("__rank")


def latest_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    method: str = "window",
    materialize_winners: bool = True,
    split_ties: int | None = None,
) -> DataFrame:
    """Rows holding the greatest ``order_by`` tuple in each ``keys`` group.

    Semantics are those of "max of the first column per group, then max of
    the next among rows on that value, then join back on equality": ties are
    all kept, and a group yields nothing when a key, or the winning value of
    any ordering column, is NULL.

    ``window`` (default): ``rank() = 1``.  Spark puts a partial group limit
    below the exchange, so the input is read once and each task sends only its
    own best rows of a group; a group holding a third of all rows costs a few
    rows per task.  Only full ties (equal in all ordering columns) meet in one
    task.  Where these can be many, ``split_ties=n`` ranks each group in ``n``
    parts first and runs ``join_back`` on the survivors, whose last join AQE
    splits.
    ``join_back``: a hash aggregate of the last ordering column's maximum per
    (keys, leading ordering columns), combined map-side; the winning leading
    values are then chosen on that aggregated level, and one left-semi join on
    keys + full winning tuple returns the rows.  The input is read twice; the
    winners (one row per group) are checkpointed first, so the final semi-join
    is a plain shuffle join that AQE can split.
    ``struct_max``: one ``max(struct(...))`` aggregate (a sort aggregate)
    and one semi-join.
    """
    keys, order_by = list(keys), list(order_by)
    if method == "struct_max":
        best = df.groupBy(*keys).agg(F.max(F.struct(*order_by)).alias("__best"))
        winners = best.select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            *[F.col(f"__best.{c}").alias(f"__o{i}") for i, c in enumerate(order_by)],
        )
        cond = None
        for i, k in enumerate(keys):
            term = df[k] == winners[f"__k{i}"]
            cond = term if cond is None else cond & term
        for i, c in enumerate(order_by):
            cond = cond & (df[c] == winners[f"__o{i}"])
        return df.join(winners, cond, "left_semi")
    if method == "window":
        if not split_ties:
            return _first_ranked(df, keys, order_by).dropna(subset=[*keys, *order_by])
        from cataloom.session import materialize

        parted = df.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(split_ties)))
        survivors = materialize(_first_ranked(parted, [*keys, "__part"], order_by).drop("__part"))
        return latest_per_group(survivors, keys, order_by, "join_back", materialize_winners)
    if method == "join_back":
        # one hash aggregate over the rows: max of the last ordering column
        # per (keys, leading ordering columns) -- combined map-side
        last = order_by[-1]
        level = df.groupBy(*keys, *order_by[:-1]).agg(F.max(last).alias(last))
        # pick the greatest leading values on that (much smaller) level;
        # its exchange is shared by both uses below
        current = level
        for i, c in enumerate(order_by[:-1]):
            prefix = keys + order_by[:i]
            best = current.groupBy(*prefix).agg(F.max(c).alias("__m"))
            best = best.select(*[F.col(k).alias(f"__p{j}") for j, k in enumerate(prefix)], "__m")
            cond = current[c] == best["__m"]
            for j, k in enumerate(prefix):
                cond = cond & (current[k] == best[f"__p{j}"])
            current = current.join(best, cond, "left_semi")
        winners = current.select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)],
        )
        if materialize_winners:
            from cataloom.session import materialize

            winners = materialize(winners)
        cond = None
        for i, k in enumerate(keys):
            term = df[k] == winners[f"__k{i}"]
            cond = term if cond is None else cond & term
        for i, c in enumerate(order_by):
            cond = cond & (df[c] == winners[f"__o{i}"])
        return df.join(winners, cond, "left_semi")
    raise ValueError(f"unknown method {method!r}")
