import os

from pyspark.sql import functions as F

from cataloom.operators import fkgraph
from cataloom.plans import tpch
from cataloom.sources import files
from cataloom.sources.catalog import Catalog, TableDoc, write_catalog_json

SF = "/root/testdata/sf0.001"


def test_catalog_from_files_columns_and_fks(spark):
    cat = tpch.catalog(spark, SF)
    doc = cat.doc("tpch.orders")
    assert doc.columns[:2] == ("o_orderkey", "o_custkey")
    assert doc.fk[0][0].t == "tpch.customer"
    fks = cat.foreign_keys().collect()
    assert len(fks) == len(tpch.FOREIGN_KEYS)


def test_catalog_json_roundtrip_and_load_filters(spark, scratch_dir):
    cat = tpch.catalog(spark, SF, ["nation", "region"])
    src, tab = os.path.join(scratch_dir, "src.json"), os.path.join(scratch_dir, "tab.json")
    write_catalog_json(cat, src, tab)
    back = Catalog.from_json(spark, src, tab)
    assert sorted(back.docs()) == ["tpch.nation", "tpch.region"]
    assert back.load_sources("sources.tpch").tables.count() == 2
    assert back.load_sources("other").tables.count() == 0
    assert back.load_datamodels("tpch").tables.count() == 0
    assert back.read("tpch.nation").count() == 25


def test_ingestion_layout_keeps_partition_columns(spark, scratch_dir):
    root = os.path.join(scratch_dir, "ingest")
    data = os.path.join(root, "t42", "merged", "orc")
    spark.read.parquet(f"{SF}/customer.parquet").write.partitionBy("c_mktsegment").orc(data)
    doc = TableDoc(source="s", table="customer", id="t42", format="orc", source_path=root)
    df = files.read_table(spark, doc)
    assert "c_mktsegment" in df.columns and df.count() == 150
    pruned = df.filter(F.col("c_mktsegment") == "BUILDING")
    assert "PartitionFilters: [isnotnull(c_mktsegment" in pruned._jdf.queryExecution().executedPlan().toString()
    globbed = files.read_glob(spark, data, fmt="orc", depth=1)
    assert "c_mktsegment" in globbed.columns and globbed.count() == 150


def test_to_df_resolution(spark):
    cat = tpch.catalog(spark, SF, ["nation"])
    df = files.to_df("tpch.nation", catalog=cat)
    assert df.count() == 25
    assert files.to_df(df) is df
    assert files.to_df(f"{SF}/nation.parquet", spark=spark, fmt="parquet").count() == 25
    try:
        files.to_df(42)
    except TypeError:
        pass
    else:
        raise AssertionError("expected TypeError")


def test_json_sources(spark, scratch_dir):
    arr = os.path.join(scratch_dir, "arr.json")
    with open(arr, "w") as fh:
        fh.write('[{"a": 1, "b": 2.5}, {"a": 2, "b": 3.5}]')
    assert files.read_json_array(spark, arr).count() == 2
    lines = os.path.join(scratch_dir, "lines.json")
    with open(lines, "w") as fh:
        fh.write('{"rx_fill": {"q": 1, "d": 30}}\n{"rx_fill": {"q": 2, "d": 90}}\n')
    flat = files.read_json_lines(spark, lines, nested="rx_fill")
    assert sorted(flat.columns) == ["d", "q"] and flat.count() == 2


def test_fk_graph_on_driver_tables(spark):
    cat = tpch.catalog(spark, SF)
    edges = fkgraph.fk_edges(cat)
    rows = {(r.child_table, r.parent_table): (r.child_rows, r.orphan_rows) for r in edges.collect()}
    assert rows[("tpch.lineitem", "tpch.orders")] == (6000, 0)
    adj = {r.table_name: r for r in fkgraph.fk_adjacency(cat, edges).collect()}
    assert adj["tpch.lineitem"]["orders"] == 1 and adj["tpch.orders"]["lineitem"] == 0
    lonely = sorted(r.table_name for r in fkgraph.tables_without_foreign_keys(cat, edges).collect())
    assert "tpch.region" in lonely and "tpch.lineitem" not in lonely


def test_avro_reader_is_gated(spark, scratch_dir):
    import pytest

    with pytest.raises(Exception) as err:
        files.read_avro(spark, os.path.join(scratch_dir, "missing_avro")).count()
    assert "avro" in str(err.value).lower() or "path does not exist" in str(err.value).lower()


def test_auto_join_equals_explicit_join(spark):
    from cataloom.operators.join import auto_join

    cat = tpch.catalog(spark, SF, ["lineitem", "orders", "customer"])
    auto = auto_join(cat, "tpch.customer", "tpch.lineitem", "tpch.orders").df
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    o = spark.read.parquet(f"{SF}/orders.parquet")
    c = spark.read.parquet(f"{SF}/customer.parquet")
    explicit = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    a = sorted(tuple(r) for r in auto.select("lineitem__l_orderkey", "lineitem__l_linenumber", "customer__c_name").collect())
    b = sorted(tuple(r) for r in explicit.select("l_orderkey", "l_linenumber", "c_name").collect())
    assert a == b and len(a) == 6000


def test_sources_and_datamodels_share_one_namespace(spark, scratch_dir):
    from cataloom.sources.catalog import SOURCE_SCHEMA, TABLE_SCHEMA

    root = os.path.join(scratch_dir, "dm")
    spark.range(3).write.mode("overwrite").parquet(os.path.join(root, "t_dm", "merged", "parquet"))
    sources = spark.createDataFrame(
        [("src", "s1", SF, None, "source"), ("model", "m1", root, None, "datamodel")], SOURCE_SCHEMA)
    tables = spark.createDataFrame(
        [("src", "nation", "nation", "original", "parquet", f"{SF}/nation.parquet", [], []),
         ("model", "facts", "t_dm", "original", "parquet", None, [], [])], TABLE_SCHEMA)
    cat = Catalog(spark, sources, tables)
    dm = cat.load_datamodels("datamodels.model")
    assert list(dm.docs()) == ["model.facts"]
    assert dm.read("model.facts").count() == 3  # data-model tables are scannable too
    assert list(cat.load_sources("src").docs()) == ["src.nation"]


def test_register_views_for_sql(spark):
    cat = tpch.catalog(spark, SF, ["nation", "region"])
    views = cat.register_views()
    assert sorted(views) == ["tpch_nation", "tpch_region"]
    n = spark.sql("SELECT count(*) AS n FROM tpch_nation JOIN tpch_region ON n_regionkey = r_regionkey").first().n
    assert n == 25
    cat.register_views(qualify=True)
    assert "nation__n_name" in spark.table("tpch_nation").columns


def test_column_addressing(spark):
    import pytest

    from cataloom.operators.aggregate import aggregate

    cat = tpch.catalog(spark, SF, ["supplier"])
    assert cat.column("tpch.supplier.s_nationkey") == "s_nationkey"
    assert cat.column_index("tpch.supplier.s_nationkey") == 3
    with pytest.raises(KeyError):
        cat.column("tpch.supplier.nope")
    out = aggregate("tpch.supplier", cat.column("tpch.supplier.s_nationkey"), catalog=cat,
                    count=("n", cat.column("tpch.supplier.s_suppkey")))
    assert out.df.count() <= 25


def test_ingestion_layout_with_plain_nested_folders(spark, scratch_dir):
    root = os.path.join(scratch_dir, "plain_ingest")
    for a, b in [("2016", "01"), ("2016", "02"), ("2017", "01")]:
        spark.range(5).write.orc(os.path.join(root, "t9", "merged", "orc", a, b, "batch"))
    doc = TableDoc(source="s", table="t", id="t9", format="orc", source_path=root)
    df = files.read_table(spark, doc)
    assert df.count() == 15 and df.columns == ["id"]


def test_sources_and_datamodels_of_one_name_stay_apart(spark):
    both = Catalog.from_files(spark, "m", SF, ["nation"], fmt="parquet").union(Catalog.from_files(spark, "m", SF, ["region"], kind="datamodel"))
    assert list(both.load_sources("m").docs()) == ["m.nation"]
    assert list(both.load_datamodels("m").docs()) == ["m.region"]


def test_fk_edges_count_orphans_nulls_and_other_types(spark, tmp_path):
    root = str(tmp_path)
    rows = [(1, "a", "10"), (2, "b", "11"), (None, "a", "x"), (9, "b", None)]
    spark.createDataFrame(rows, "p int, q string, r string").write.parquet(f"{root}/child.parquet")
    spark.createDataFrame([(1, "a"), (2, "a"), (10, "b")], "p bigint, q string").write.parquet(f"{root}/parent.parquet")
    keys = [("child.p", "parent.p"), [("child.p", "parent.p"), ("child.q", "parent.q")], ("child.r", "parent.p")]
    cat = Catalog.from_files(spark, "s", root, ["child", "parent"], keys)
    got = {r.child_column: (r.child_rows, r.orphan_rows, r.linked_rows) for r in fkgraph.fk_edges(cat).collect()}
    assert got == {"p": (4, 1, 2), "p,q": (4, 2, 1), "r": (4, 2, 1)}
