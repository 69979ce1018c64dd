"""A DataFrame together with the catalogued base tables it came from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tracked:
    """``df`` plus lineage: the qualified names of its base tables.

    The lineage is what lets a derived table inherit the foreign keys of
    the tables it was built from (see ``cataloom.sources.derived``).
    """

    df: DataFrame
    tables: tuple[str, ...] = ()

    def with_df(self, df: DataFrame) -> "Tracked":
        return Tracked(df, self.tables)


def resolve(x, catalog=None):
    """A tracked frame for a catalogued ``source.table`` name, else ``x``."""
    if isinstance(x, str):
        if catalog is None:
            raise TypeError(f"table name {x!r} given without a catalog")
        return Tracked(catalog.read(x), (x,))
    return x


def unwrap(x, catalog=None) -> tuple[DataFrame, tuple[str, ...]]:
    x = resolve(x, catalog)
    if isinstance(x, Tracked):
        return x.df, x.tables
    if isinstance(x, DataFrame):
        return x, ()
    raise TypeError(f"expected a DataFrame, Tracked or catalogued table name, got {type(x).__name__}")


def rewrap(original, df: DataFrame):
    """Return ``df`` in the same wrapper kind as ``original``."""
    if isinstance(original, Tracked):
        return original.with_df(df)
    return df
