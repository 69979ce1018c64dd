"""Projections, renames, filters and row limits (one Project per call)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import functions as F
from pyspark.sql.column import Column

from cataloom.operators.tracked import resolve, rewrap, unwrap

QUALIFIER = "__"


def check_unique(names: Iterable[str], what: str = "output") -> None:
    """Spark resolves names case-insensitively, so clashes are checked that way."""
    seen: dict[str, str] = {}
    for name in names:
        key = name.lower()
        if key in seen:
            raise ValueError(f"duplicate {what} column {name!r} (clashes with {seen[key]!r})")
        seen[key] = name


def select(x, *exprs: str | Column, keep_original: bool = True, catalog=None):
    """SQL-expression projection, optionally after all existing columns.

    ``x`` may be a DataFrame, a tracked frame, or a ``source.table`` name
    (with ``catalog``).  With no expressions the input comes back unchanged.
    """
    x = resolve(x, catalog)
    df, _ = unwrap(x)
    if not exprs:
        return x
    cols = [F.expr(e) if isinstance(e, str) else e for e in exprs]
    out = df.select("*", *cols) if keep_original else df.select(*cols)
    check_unique(out.columns)
    return rewrap(x, out)


def select_expr(x, *exprs: str):
    """Plain expression projection."""
    df, _ = unwrap(x)
    return rewrap(x, df.selectExpr(*exprs))


def filter_rows(x, condition: str | Column):
    """Filter by a SQL string or a Column, keeping lineage."""
    df, _ = unwrap(x)
    return rewrap(x, df.filter(condition))


def prefix_columns(x, prefix: str, uppercase: bool = False, sep: str = "_"):
    """Rename every column to ``prefix<sep>col``, optionally upper-cased.

    One projection, so Catalyst keeps a single Project and column pruning
    still reaches the scan.
    """
    df, _ = unwrap(x)
    names = []
    for c in df.columns:
        new = f"{prefix}{sep}{c}"
        names.append(new.upper() if uppercase else new)
    check_unique(names)
    return rewrap(x, df.select([F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)]))


def qualify_columns(x, table: str):
    """``table__column`` renaming used for catalogued tables in joins (P5)."""
    return prefix_columns(x, table, uppercase=False, sep=QUALIFIER)


def qualified_name(table: str, column: str) -> str:
    """Column name after P5; a name that already holds ``__`` is kept."""
    return column if QUALIFIER in column else f"{table}{QUALIFIER}{column}"


def subset(x, names: Sequence[str]):
    """Keep a list of columns, e.g. the left side's after a join-back."""
    df, _ = unwrap(x)
    return rewrap(x, df.select(*[F.col(f"`{n}`") for n in names]))


def project_mapping(x, mapping: Sequence[tuple[str | Column, str]]):
    """Rename-projection to a target layout: ``[(expr, name), ...]``."""
    df, _ = unwrap(x)
    cols = [(F.expr(e) if isinstance(e, str) else e).alias(n) for e, n in mapping]
    check_unique([n for _, n in mapping])
    return rewrap(x, df.select(*cols))


def preview(x, num_rows: int = 20):
    """First ``num_rows`` rows as a DataFrame (P8); show/collect stay Spark's."""
    df, _ = unwrap(x)
    return rewrap(x, df.limit(num_rows))
