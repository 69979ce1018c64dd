"""Scans: catalogued table files, plain paths, JSON, Avro and local rows."""

from __future__ import annotations

import os
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.column import Column

from cataloom.sources.catalog import Catalog, TableDoc

# The ingestion layout of table files under a source folder,
# <source path>/<table id>/merged/<format>/, then three folder levels below
# it (one for csv-ingested sources).
MERGED_DIR = "merged"


def table_location(doc: TableDoc) -> str:
    """Folder holding a table's files (S3).

    A document may carry an explicit ``path``.  Otherwise the ingestion
    layout ``<source path>/<table id>/merged/<format>`` is used and the
    folders below it are read by ``read_table``.
    """
    if doc.path:
        return doc.path
    if not doc.source_path:
        raise ValueError(f"table {doc.qualified} has neither a path nor a source path")
    return os.path.join(doc.source_path, doc.id, MERGED_DIR, doc.format)


def read_table(spark: SparkSession, doc: TableDoc) -> DataFrame:
    if doc.format == "table":  # a derived table registered in Spark's catalog
        return spark.table(doc.path or doc.qualified)
    location = table_location(doc)
    reader = spark.read.format(doc.format)
    if doc.format == "avro":
        return read_avro(spark, location)
    if doc.path:
        return reader.load(location)
    # ``key=value`` sub-folders are discovered as partition columns (and
    # prune on filters); plain nested folders (e.g. <date>/<batch>/) carry no
    # partition values, so their files are listed recursively instead.
    keyed, plain = folder_kinds(spark, location)
    if keyed and plain:
        raise ValueError(f"{location} mixes key=value folders with files or plain folders beside them")
    if keyed:
        return reader.option("basePath", location).load(location)
    return reader.option("recursiveFileLookup", "true").load(location)


def folder_kinds(spark: SparkSession, location: str) -> tuple[bool, bool]:
    """Whether ``location`` has ``key=value`` folders, and whether it has
    data files or other folders beside them (one listing, names only)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [(e.getPath().getName(), e.isDirectory()) for e in entries]
    names = [(n, d) for n, d in names if not n.startswith(("_", "."))]
    return any(d and "=" in n for n, d in names), any(not (d and "=" in n) for n, d in names)


def read_glob(spark: SparkSession, root: str, fmt: str = "orc", depth: int = 3) -> DataFrame:
    """Read ``root/*/…/*`` the way the ingestion layout is globbed (depth 3,
    or 1 for csv-ingested sources).

    ``basePath`` is set so that ``key=value`` folders still become columns and
    filters on them prune folders (``PartitionFilters`` in the plan).
    """
    pattern = os.path.join(root, *(["*"] * depth))
    return spark.read.format(fmt).option("basePath", root).load(pattern)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Avro scan (S6); needs the external spark-avro package on the classpath."""
    try:
        return spark.read.format("avro").load(path)
    except Exception as exc:  # pragma: no cover - depends on the deployment
        if "avro" in str(exc).lower():
            raise RuntimeError(
                "Avro needs the spark-avro package (--packages org.apache.spark:spark-avro)"
            ) from exc
        raise


def read_json_array(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A file holding one JSON array of records."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_lines(spark: SparkSession, path: str, schema=None, nested: str | None = None) -> DataFrame:
    """JSON lines, optionally flattening one nested struct column."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if nested:
        df = df.select(f"{nested}.*")
    return df


def from_local(spark: SparkSession, rows: Any, schema=None) -> DataFrame:
    """Local rows or a pandas frame as a Spark DataFrame."""
    return spark.createDataFrame(rows, schema)


def to_df(x: Any, catalog: Catalog | None = None, spark: SparkSession | None = None, fmt: str = "orc") -> DataFrame:
    """Resolve a tracked frame, DataFrame, catalogued name or path."""
    from cataloom.operators.tracked import Tracked

    if isinstance(x, DataFrame):
        return x
    if isinstance(x, Tracked):
        return x.df
    if isinstance(x, TableDoc):
        if catalog is None:
            raise TypeError("a table document needs its catalog")
        return catalog.read(x.qualified)
    if isinstance(x, str):
        if catalog is not None and x in catalog.docs():
            return catalog.read(x)
        session = spark or (catalog.spark if catalog else SparkSession.getActiveSession())
        return session.read.format(fmt).load(x)
    raise TypeError(
        "expected a tracked frame, a DataFrame, a catalogued 'source.table' name or a path, "
        f"got {type(x).__name__}"
    )


def select_table(
    df: DataFrame,
    filter_condition: str | Column | None = None,
    col_prefix: str | None = None,
) -> DataFrame:
    """Scan, filter on the original names, then prefix-rename upper-cased."""
    from cataloom.operators.project import prefix_columns

    if filter_condition is not None:
        df = df.filter(filter_condition)
    if col_prefix is not None:
        df = prefix_columns(df, col_prefix, uppercase=True)
    return df
