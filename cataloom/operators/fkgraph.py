"""Foreign-key graph of a catalog: edge list with referential checks,
adjacency matrix, and tables without foreign keys (J8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.sources.catalog import Catalog


def _short(dotted: str) -> str:
    return dotted.split(".")[-1]


EDGE_SCHEMA = "edge int, child_table string, parent_table string, child_column string, parent_column string"


def _key(columns: list[str], own: T.StructType, wanted: list[T.DataType]) -> Column:
    """The key columns as texts, in the parent's types; NULL when one is NULL."""
    texts, known = [], F.lit(True)
    for name, kind in zip(columns, wanted):
        text = F.col(name).cast("string")
        if own[name].dataType != kind:
            text = F.coalesce(F.col(name).try_cast(kind).cast("string"), text)
        texts.append(text)
        known = known & F.col(name).isNotNull()
    return F.when(known, F.array(*texts))


def fk_edges(catalog: Catalog) -> DataFrame:
    """One row per foreign key between two different tables.

    Besides the names, each row counts the child table's rows, its orphans (a
    non-NULL key with no parent row) and its linked rows (with a parent row).
    Every table is read once, however many keys start or end there: a row gives
    one (edge, key) pair per foreign key, the pairs are counted map-side (a hot
    key is one partial row per task), and one join brings the distinct keys of
    all edges together with the distinct parent keys.
    """
    edges, children, parents = [], {}, {}
    for doc in catalog.docs().values():
        for fk in doc.fk:
            if not fk or fk[0].t == doc.qualified:
                continue  # self-references are not edges
            own, other = [_short(r.f_by) for r in fk], [_short(r.by) for r in fk]
            children.setdefault(doc.qualified, []).append((len(edges), own, fk[0].t, other))
            parents.setdefault(fk[0].t, []).append((len(edges), other))
            edges.append((len(edges), doc.qualified, fk[0].t, ",".join(own), ",".join(other)))
    spark = catalog.spark
    names = spark.createDataFrame(edges, EDGE_SCHEMA)
    if not edges:
        zero = [F.lit(0).cast("bigint").alias(c) for c in ("child_rows", "orphan_rows", "linked_rows")]
        return names.select("*", *zero).drop("edge")
    frames = {name: catalog.read(name) for name in {*children, *parents}}

    def pairs(name: str, keys: list[tuple[int, Column]]) -> DataFrame:
        made = F.array(*[F.struct(F.lit(n).alias("edge"), key.alias("key")) for n, key in keys])
        return frames[name].select(F.explode(made).alias("e")).select("e.edge", "e.key")

    def types(name: str, columns: list[str]) -> list[T.DataType]:
        return [frames[name].schema[c].dataType for c in columns]

    held = reduce(DataFrame.union, [pairs(c, [(n, _key(own, frames[c].schema, types(t, other))) for n, own, t, other in fks]) for c, fks in children.items()])
    known = reduce(DataFrame.union, [pairs(p, [(n, _key(cols, frames[p].schema, types(p, cols))) for n, cols in fks]) for p, fks in parents.items()])
    counted = held.groupBy("edge", "key").count()
    met = counted.join(known.distinct().withColumn("hit", F.lit(True)), ["edge", "key"], "left")
    stats = met.groupBy("edge").agg(
        F.sum("count").alias("child_rows"),
        F.sum(F.when(F.col("key").isNotNull() & F.col("hit").isNull(), F.col("count"))).alias("orphan_rows"),
        F.sum(F.when(F.col("hit"), F.col("count"))).alias("linked_rows"),
    )
    out = names.join(stats, "edge", "left").fillna(0, ["child_rows", "orphan_rows", "linked_rows"])
    return out.drop("edge")


def fk_adjacency(catalog: Catalog, edges: DataFrame | None = None, counts: bool = False) -> DataFrame:
    """0/1 matrix: one row per table, one column per table it may reference;
    with ``counts`` a cell holds the number of rows that have a parent there.

    Pivot values are the catalog's table names (metadata), so the pivot
    needs no extra pass to find them.
    """
    names = sorted(catalog.docs())
    e = edges if edges is not None else fk_edges(catalog)
    tables = catalog.tables.select(F.concat_ws(".", "source", "table").alias("table_name"))
    cell = F.sum("linked_rows") if counts else F.max(F.lit(1))
    pivot = e.withColumnRenamed("child_table", "table_name").groupBy("table_name").pivot("parent_table", names).agg(cell)
    out = tables.join(pivot, "table_name", "left")
    return out.select(
        "table_name",
        *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("bigint" if counts else "int").alias(_short(n)) for n in names],
    )


def tables_without_foreign_keys(catalog: Catalog, edges: DataFrame | None = None) -> DataFrame:
    """Tables that reference no other table.

    Without ``edges`` the catalog's declared keys are used (metadata only);
    with ``fk_edges(catalog)`` a key counts where at least one row is linked.
    """
    if edges is None:
        fks = catalog.foreign_keys()
        edges = fks.filter(F.col("child_table") != F.col("parent_table")).select("child_table")
    elif "linked_rows" in edges.columns:
        edges = edges.filter("linked_rows > 0")
    tables = catalog.tables.select(F.concat_ws(".", "source", "table").alias("table_name"))
    return tables.join(edges.select(F.col("child_table").alias("table_name")), "table_name", "left_anti")
