import os

import pytest

from cataloom.operators.join import auto_join
from cataloom.plans import tpch
from cataloom.sources import derived

SF = "/root/testdata/sf0.001"


def test_save_and_drop_derived_table(spark):
    cat = tpch.catalog(spark, SF, ["orders", "customer", "nation"])
    joined = auto_join(cat, "tpch.orders", "tpch.customer")
    kept = joined.with_df(joined.df.select("orders__o_orderkey", "orders__o_custkey", "customer__c_nationkey"))
    cat2 = derived.save_derived_table(kept, cat, "dsrc", "oc")
    doc = cat2.doc("dsrc.oc")
    assert doc.derived and doc.columns == ("orders__o_orderkey", "orders__o_custkey", "customer__c_nationkey")
    assert sorted(fk[0].t for fk in doc.fk) == ["tpch.customer", "tpch.nation"]
    assert sorted(fk[0].f_by for fk in doc.fk) == ["dsrc.oc.customer__c_nationkey", "dsrc.oc.orders__o_custkey"]
    props = derived.table_properties(spark, "dsrc.oc")
    assert props["origin"] == "derived" and "c_nationkey" in props["fk"]
    assert cat2.read("dsrc.oc").count() == 1500
    # derived tables join without renaming
    j = auto_join(cat2, "dsrc.oc", "tpch.nation")
    assert "orders__o_orderkey" in j.df.columns and j.df.count() == 1500
    with pytest.raises(ValueError):
        derived.drop_derived_table(cat2, "tpch.orders")
    with pytest.raises(KeyError):
        derived.drop_derived_table(cat2, "dsrc.missing")
    cat3 = derived.drop_derived_table(cat2, "dsrc.oc")
    assert "dsrc.oc" not in cat3.docs()
    assert not spark.catalog.tableExists("dsrc.oc")
    assert not os.path.exists(doc.path.replace("file:", ""))


def test_orc_writers(spark, scratch_dir):
    df = spark.range(5)
    path = os.path.join(scratch_dir, "orc_out")
    derived.write_orc(df, path)
    derived.write_orc(df, path)  # overwrite
    assert spark.read.orc(path).count() == 5
    with pytest.raises(Exception):
        derived.write_orc_new(df, path)
    derived.write_orc_new(df, path, mode="append")
    assert spark.read.orc(path).count() == 10


def test_saving_again_removes_the_old_files(spark):
    cat = tpch.catalog(spark, SF, ["nation"])
    nation = cat.read("tpch.nation")
    cat = derived.save_derived_table(nation, cat, "dsrc", "again")
    first = cat.doc("dsrc.again").path
    cat = derived.save_derived_table(nation.limit(3), cat, "dsrc", "again")
    assert not os.path.exists(first.replace("file:", "")) and cat.read("dsrc.again").count() == 3
    assert spark.table("dsrc.again").count() == 3
    assert list(cat.load_sources("dsrc").docs()) == ["dsrc.again"]
    derived.drop_derived_table(cat, "dsrc.again")


def test_location_with_a_quote(spark, scratch_dir):
    cat = tpch.catalog(spark, SF, ["region"])
    cat = derived.save_derived_table(cat.read("tpch.region"), cat, "dsrc", "quoted", location=os.path.join(scratch_dir, "it's here"))
    assert cat.read("dsrc.quoted").count() == 5 and spark.table("dsrc.quoted").count() == 5
    derived.drop_derived_table(cat, "dsrc.quoted")
