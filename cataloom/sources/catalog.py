"""Table catalog: sources, data models, tables, columns and foreign keys.

The catalog is metadata -- one document per table -- kept as a small Spark
DataFrame with a fixed schema.  It grows with the number of tables, never with
the number of rows, so looking a table up on the driver is bounded.  Table
data is only ever read through ``spark.read`` from the document's location.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RELATION = T.StructType(
    [
        T.StructField("t", T.StringType()),  # referenced table, "source.table"
        T.StructField("ft", T.StringType()),  # referencing table, "source.table"
        T.StructField("f_by", T.StringType()),  # FK column, "source.table.col"
        T.StructField("by", T.StringType()),  # referenced column, "source.table.col"
    ]
)

FOREIGN_KEY = T.StructType([T.StructField("relations", T.ArrayType(RELATION))])

COLUMN = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("at", T.IntegerType())]
)

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("hdfs_path", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("kind", T.StringType()),  # source | datamodel
    ]
)

TABLE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("origin", T.StringType()),  # original | derived
        T.StructField("format", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("columns", T.ArrayType(COLUMN)),
        T.StructField("fk", T.ArrayType(FOREIGN_KEY)),
    ]
)

# a table document as a catalog keeps it; without a kind it belongs to either
TABLE_DOC_SCHEMA = T.StructType([*TABLE_SCHEMA.fields, T.StructField("kind", T.StringType())])


@dataclass(frozen=True)
class Relation:
    t: str
    ft: str
    f_by: str
    by: str


@dataclass(frozen=True)
class TableDoc:
    source: str
    table: str
    id: str
    origin: str = "original"
    format: str = "parquet"
    path: str | None = None
    columns: tuple[str, ...] = ()
    fk: tuple[tuple[Relation, ...], ...] = ()
    source_path: str | None = None
    source_type: str | None = None
    kind: str | None = None

    @property
    def qualified(self) -> str:
        return f"{self.source}.{self.table}"

    @property
    def derived(self) -> bool:
        return self.origin == "derived"


@dataclass
class Catalog:
    """Sources and table documents, addressable as ``source.table``."""

    spark: SparkSession
    sources: DataFrame
    tables: DataFrame
    _docs: dict[str, TableDoc] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if "kind" not in self.tables.columns:
            self.tables = self.tables.withColumn("kind", F.lit(None).cast("string"))

    # ------------------------------------------------------------ builders
    @classmethod
    def from_json(cls, spark: SparkSession, sources_path: str, tables_path: str) -> "Catalog":
        """Read catalog documents (JSON lines) with a fixed schema."""
        sources = spark.read.schema(SOURCE_SCHEMA).json(sources_path)
        tables = spark.read.schema(TABLE_DOC_SCHEMA).json(tables_path)
        return cls(spark, sources, tables)

    @classmethod
    def from_files(
        cls,
        spark: SparkSession,
        source: str,
        root: str,
        table_names: list[str],
        foreign_keys: list[tuple[str, str]] | list[list[tuple[str, str]]] = (),
        fmt: str = "parquet",
        kind: str = "source",
    ) -> "Catalog":
        """Describe a directory of table files as one source.

        Column lists come from each file's schema (footer only, no scan).
        ``foreign_keys`` holds ``("table.col", "table.col")`` pairs, or lists
        of pairs for composite keys, child side first.
        """
        source_row = [(source, source, root, fmt, kind)]
        table_rows = []
        by_child: dict[str, list] = {}
        for fk in foreign_keys:
            pairs = [fk] if isinstance(fk, tuple) else list(fk)
            child = pairs[0][0].split(".")[0]
            parent = pairs[0][1].split(".")[0]
            rels = [
                (f"{source}.{parent}", f"{source}.{child}", f"{source}.{a}", f"{source}.{b}")
                for a, b in pairs
            ]
            by_child.setdefault(child, []).append((rels,))
        for name in table_names:
            path = os.path.join(root, f"{name}.{fmt}")
            names = spark.read.format(fmt).load(path).schema.fieldNames()
            columns = [(c, i + 1) for i, c in enumerate(names)]
            table_rows.append(
                (source, name, name, "original", fmt, path, columns, by_child.get(name, []), kind)
            )
        sources = spark.createDataFrame(source_row, SOURCE_SCHEMA)
        tables = spark.createDataFrame(table_rows, TABLE_DOC_SCHEMA)
        # the documents are already known here: no need to collect them back
        docs = {}
        for src, name, tid, origin, tfmt, path, columns, fks, _ in table_rows:
            doc = TableDoc(
                source=src, table=name, id=tid, origin=origin, format=tfmt, path=path,
                columns=tuple(c for c, _ in columns),
                fk=tuple(tuple(Relation(*r) for r in rels) for (rels,) in fks),
                source_path=root, source_type=fmt, kind=kind,
            )
            docs[doc.qualified] = doc
        return cls(spark, sources, tables, docs)

    # ------------------------------------------------------------ S1 / S2
    def load_sources(self, *names: str) -> "Catalog":
        """Restrict to the named sources."""
        return self._restrict("source", names)

    def load_datamodels(self, *names: str) -> "Catalog":
        """Restrict to the named data models."""
        return self._restrict("datamodel", names)

    def _restrict(self, kind: str, names) -> "Catalog":
        wanted = [n.split(".")[-1] for n in names]
        sources = self.sources.filter((F.col("kind") == kind) & F.col("name").isin(wanted))
        own = self.tables.filter(F.col("kind").isNull() | (F.col("kind") == kind))
        tables = own.join(sources.select(F.col("name").alias("source")), "source", "left_semi")
        tables = tables.select(*TABLE_DOC_SCHEMA.fieldNames())
        return Catalog(self.spark, sources, tables)

    def union(self, other: "Catalog") -> "Catalog":
        return Catalog(
            self.spark,
            self.sources.unionByName(other.sources),
            self.tables.unionByName(other.tables),
        )

    def with_table(self, doc: TableDoc) -> "Catalog":
        """A catalog that also holds ``doc`` (replacing a same-named entry) and
        a row for its source."""
        known = self.sources.filter((F.col("name") == doc.source) & (F.col("kind") == (doc.kind or "source")))
        own = self.spark.createDataFrame([(doc.source, doc.source, doc.source_path, doc.format, doc.kind or "source")], SOURCE_SCHEMA)
        sources = self.sources.unionByName(own.join(known.select("name"), "name", "left_anti").select(*SOURCE_SCHEMA.fieldNames()))
        row = self.spark.createDataFrame([_doc_row(doc)], TABLE_DOC_SCHEMA)
        kept = self.tables.filter(
            ~((F.col("source") == doc.source) & (F.col("table") == doc.table))
        )
        docs = dict(self.docs())
        docs[doc.qualified] = doc
        return Catalog(self.spark, sources, kept.unionByName(row), docs)

    def without_table(self, qualified: str) -> "Catalog":
        source, table = qualified.split(".", 1)
        kept = self.tables.filter(~((F.col("source") == source) & (F.col("table") == table)))
        docs = {k: v for k, v in self.docs().items() if k != qualified}
        return Catalog(self.spark, self.sources, kept, docs)

    # ------------------------------------------------------------ lookups
    def docs(self) -> dict[str, TableDoc]:
        """All table documents by qualified name (metadata only)."""
        if not self._docs:
            src = {
                (r["name"], r["kind"]): (r["hdfs_path"], r["source_type"])
                for r in self.sources.select("name", "hdfs_path", "source_type", "kind").collect()
            }
            for r in self.tables.collect():
                fks = tuple(
                    tuple(Relation(x["t"], x["ft"], x["f_by"], x["by"]) for x in (fk["relations"] or []))
                    for fk in (r["fk"] or [])
                )
                cols = tuple(c["name"] for c in sorted(r["columns"] or [], key=lambda c: c["at"]))
                kinds = [r["kind"]] if r["kind"] else ["source", "datamodel", None]
                spath, stype = next((src[r["source"], k] for k in kinds if (r["source"], k) in src), (None, None))
                doc = TableDoc(
                    source=r["source"], table=r["table"], id=r["id"],
                    origin=r["origin"] or "original", format=r["format"] or "orc",
                    path=r["path"], columns=cols, fk=fks,
                    source_path=spath, source_type=stype, kind=r["kind"],
                )
                self._docs[doc.qualified] = doc
        return self._docs

    def doc(self, qualified: str) -> TableDoc:
        try:
            return self.docs()[qualified]
        except KeyError:
            raise KeyError(f"no table {qualified!r} in the catalog") from None

    def column(self, qualified_column: str) -> str:
        """Resolve ``source.table.col`` to the column name (checked, S1)."""
        source, table, name = qualified_column.split(".", 2)
        doc = self.doc(f"{source}.{table}")
        if name not in doc.columns:
            raise KeyError(f"no column {name!r} in {doc.qualified}")
        return name

    def column_index(self, qualified_column: str) -> int:
        """1-based ordinal of a catalogued column."""
        name = self.column(qualified_column)
        source, table, _ = qualified_column.split(".", 2)
        return self.doc(f"{source}.{table}").columns.index(name) + 1

    def path(self, qualified: str) -> str:
        from cataloom.sources.files import table_location

        return table_location(self.doc(qualified))

    def read(self, qualified: str) -> DataFrame:
        """Scan a catalogued table (S3)."""
        from cataloom.sources.files import read_table

        return read_table(self.spark, self.doc(qualified))

    def register_views(self, qualify: bool = False) -> list[str]:
        """Expose every table as a temp view named ``source_table`` for SQL.

        With ``qualify`` the view's columns are renamed ``table__column`` as
        in FK-discovered joins.  Returns the view names.
        """
        from cataloom.operators.project import qualify_columns

        names = []
        for qualified, doc in self.docs().items():
            df = self.read(qualified)
            if qualify and not doc.derived:
                df = qualify_columns(df, doc.table)
            view = f"{doc.source}_{doc.table}"
            df.createOrReplaceTempView(view)
            names.append(view)
        return names

    # ------------------------------------------------------------ J8
    def foreign_keys(self) -> DataFrame:
        """One row per FK column pair: child/parent table and columns."""
        rel = (
            self.tables.select(
                F.concat_ws(".", "source", "table").alias("child_table"),
                F.posexplode_outer("fk").alias("fk_index", "fk"),
            )
            .select(
                "child_table", "fk_index",
                F.posexplode_outer("fk.relations").alias("pair_index", "r"),
            )
            .filter(F.col("r").isNotNull())
        )
        return rel.select(
            "child_table",
            F.col("r.t").alias("parent_table"),
            F.element_at(F.split("r.f_by", r"\."), -1).alias("child_column"),
            F.element_at(F.split("r.by", r"\."), -1).alias("parent_column"),
            "fk_index",
            "pair_index",
        )


def _doc_row(doc: TableDoc) -> tuple:
    return (
        doc.source, doc.table, doc.id, doc.origin, doc.format, doc.path,
        [(c, i + 1) for i, c in enumerate(doc.columns)],
        [([(r.t, r.ft, r.f_by, r.by) for r in fk],) for fk in doc.fk], doc.kind,
    )


def write_catalog_json(catalog: Catalog, sources_path: str, tables_path: str) -> None:
    """Persist catalog documents as JSON lines (the document-store stand-in)."""
    catalog.sources.write.mode("overwrite").json(sources_path)
    catalog.tables.write.mode("overwrite").json(tables_path)


def relation_dicts(doc: TableDoc) -> str:
    """FK list of a document as JSON text (for table properties)."""
    return json.dumps([[r.__dict__ for r in fk] for fk in doc.fk])
