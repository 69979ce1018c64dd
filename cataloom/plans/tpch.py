"""Catalog of the driver's parquet tables (one source named ``tpch``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cataloom.sources.catalog import Catalog

SOURCE = "tpch"

# The driver's tables and their declared foreign keys
# (child column, referenced column).
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
FOREIGN_KEYS = [
    ("lineitem.l_orderkey", "orders.o_orderkey"),
    ("lineitem.l_partkey", "part.p_partkey"),
    ("lineitem.l_suppkey", "supplier.s_suppkey"),
    ("orders.o_custkey", "customer.c_custkey"),
    ("customer.c_nationkey", "nation.n_nationkey"),
    ("supplier.s_nationkey", "nation.n_nationkey"),
    ("nation.n_regionkey", "region.r_regionkey"),
    ("labels.doc_id", "documents.doc_id"),
]


def catalog(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> Catalog:
    """Catalog documents for the driver tables under ``sf_dir``."""
    return Catalog.from_files(spark, SOURCE, sf_dir, tables or TABLES, FOREIGN_KEYS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q(name: str) -> str:
    """Qualified catalog name of a driver table."""
    return f"{SOURCE}.{name}"
