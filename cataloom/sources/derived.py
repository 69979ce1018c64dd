"""Sinks and the derived-table life cycle (K1-K5).

A derived table is an external Spark table in a database named after its
source; its files live in shared storage, table properties record
``origin='derived'`` plus the foreign keys it inherited, and saving it again
or dropping it removes the files it had.  The package
catalog gets a matching document, so derived tables join like any other
(without ``table__`` renaming).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from cataloom.operators.project import QUALIFIER
from cataloom.operators.tracked import Tracked, unwrap
from cataloom.sources.catalog import Catalog, Relation, TableDoc


def write_orc(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """ORC write, overwriting by default (K1); local rows are converted first."""
    if not isinstance(df, DataFrame):
        df = SparkSession.getActiveSession().createDataFrame(df)
    df.write.mode(mode).orc(path)
    return path


def write_orc_new(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """ORC write that refuses an existing path unless ``mode='append'`` (K2)."""
    df.write.mode(mode).orc(path)
    return path


def inherited_foreign_keys(x: Tracked, catalog: Catalog, new_name: str) -> tuple[tuple[Relation, ...], ...]:
    """FKs of the base tables whose FK columns all survive in the frame,
    either as ``col`` or as ``table__col`` (K4 helper).

    The kept relations are rewritten to start from the derived table and
    name the column as it is called there, so the derived table joins on
    them directly.
    """
    df, tables = unwrap(x)
    present = {c.lower(): c for c in df.columns}
    kept = []
    for name in tables:
        for fk in catalog.doc(name).fk:
            if not fk:
                continue
            rewritten = []
            for r in fk:
                _, table, col = r.f_by.split(".", 2)
                found = present.get(col.lower()) or present.get(f"{table}{QUALIFIER}{col}".lower())
                if found is None:
                    break
                rewritten.append(Relation(r.t, new_name, f"{new_name}.{found}", r.by))
            else:
                kept.append(tuple(rewritten))
    return tuple(kept)


def save_derived_table(
    x,
    catalog: Catalog,
    source: str,
    table: str,
    fmt: str = "orc",
    location: str | None = None,
) -> Catalog:
    """Write a derived table's data and register its schema (K3 + K4).

    Data goes to ``location`` (default: a fresh folder in the shared
    checkpoint storage), then an external Spark table ``source.table`` is
    (re)registered there with ``origin='derived'`` and the inherited FKs as
    table properties.  Files of an earlier save are removed once the new table
    stands.  Returns a catalog that also holds the document and its source.
    """
    from cataloom.session import shared_path

    df, tables = unwrap(x)
    spark = df.sparkSession
    name = f"{source}.{table}"
    if name in catalog.docs() and not catalog.doc(name).derived:
        raise ValueError(f"{name} is an original table; it cannot be overwritten")
    fks = inherited_foreign_keys(Tracked(df, tables), catalog, name) if tables else ()
    location = location or shared_path(spark, "derived", source, table)
    df.write.format(fmt).mode("overwrite").save(location)
    fk_json = json.dumps([[r.__dict__ for r in fk] for fk in fks]).replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{source}`")
    before = registered_location(spark, f"`{source}`.`{table}`")
    spark.sql(f"DROP TABLE IF EXISTS `{source}`.`{table}`")
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE `{source}`.`{table}` USING {fmt} LOCATION '{quoted}' "
        f"TBLPROPERTIES ('origin'='derived', 'fk'='{fk_json}')"
    )
    if before and before != registered_location(spark, f"`{source}`.`{table}`"):
        delete_path(spark, before)
    doc = TableDoc(
        source=source, table=table, id=table, origin="derived", format=fmt,
        path=location, columns=tuple(df.columns), fk=fks,
    )
    return catalog.with_table(doc)


def registered_location(spark: SparkSession, name: str) -> str | None:
    """Folder of a derived table in Spark's catalog; None for another table or none."""
    if not spark.catalog.tableExists(name) or table_properties(spark, name).get("origin") != "derived":
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the Hadoop FileSystem of its URI."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def drop_derived_table(catalog: Catalog, name: str, delete_data: bool = True) -> Catalog:
    """Drop a derived table's schema entry and data (K5).

    Raises ``KeyError`` when the table is unknown and ``ValueError`` for an
    original table, which is never deleted.
    """
    if name not in catalog.docs():
        raise KeyError(f"No such table exists: {name}")
    doc = catalog.doc(name)
    if not doc.derived:
        raise ValueError(f"Can not delete original table {name}")
    source, table = name.split(".", 1)
    catalog.spark.sql(f"DROP TABLE IF EXISTS `{source}`.`{table}`")
    if delete_data and doc.path:
        delete_path(catalog.spark, doc.path)
    return catalog.without_table(name)
