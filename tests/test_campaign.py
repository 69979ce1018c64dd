import datetime as dt

import pytest
from pyspark.sql import functions as F

from cataloom.functions import rules
from cataloom.plans import campaign as C
from cataloom.plans.campaign_analog import analog_tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return analog_tables(spark, SF)


@pytest.fixture(scope="module")
def opts():
    return C.CampaignOptions(as_of=dt.date(2001, 11, 29))


@pytest.fixture(scope="module")
def oracle():
    """DuckDB's version of the full output, from the registered oracle SQL."""
    from oracle_compare import duck

    from cataloom.plans import registry

    return duck(SF).sql(registry.ORACLE["campaign_full"]).df()


def test_stage_counts(tables, opts, oracle):
    base = C.claim_base(tables, opts)
    assert base.count() == 1556
    latest = C.latest_claims(base)
    assert latest.count() == 1139
    assert C.enrich(latest, tables, opts).count() == len(oracle)


def test_full_output_layout_and_flags(tables, opts, oracle):
    out = C.run_campaign(tables, opts)
    assert len(out.columns) == 45 and out.columns[0] == "MBR_OPPTY_GID" and out.columns[-1] == "CREATE_TMS"
    r = out.agg(
        *[F.count_if(F.col(c) == "Y").alias(c) for c in
          ["MINOR_IND", "MBR_CURR_ELIG_IND", "RTM_IND", "MCV_IND", "RFM_IND", "CONTROLLED_SUBSTANCE_IND", "FFM_IND"]],
        F.count_if(F.col("MBR_CURR_AGE").isNull()).alias("age_null"),
        *[F.count_if(F.col("NORMALIZED_DAY_SPLY_QTY") == v).alias(f"n{v}") for v in (30, 60, 90)],
    ).first()
    for flag in ["MINOR_IND", "MBR_CURR_ELIG_IND", "RTM_IND", "MCV_IND", "RFM_IND", "CONTROLLED_SUBSTANCE_IND", "FFM_IND"]:
        assert 0 < r[flag] == (oracle[flag] == "Y").sum(), flag
    assert r.age_null == oracle["MBR_CURR_AGE"].isna().sum()
    assert [r[f"n{v}"] for v in (30, 60, 90)] == [(oracle["NORMALIZED_DAY_SPLY_QTY"] == v).sum() for v in (30, 60, 90)]


def test_latest_methods_agree_on_claims(tables, opts):
    base = C.claim_base(tables, opts)
    key = ["PHMCY_CLM_EVNT_GID", "MBR_ACC_EPH_LINK_ID", "DRUG_GPI4_CD"]
    results = [sorted(tuple(r) for r in C.latest_claims(base, m).select(*key).collect())
               for m in ("struct_max", "window", "join_back")]
    assert results[0] == results[1] == results[2]


def test_ffm_window_equals_join_back(tables, opts):
    enriched = C.enrich(C.latest_claims(C.claim_base(tables, opts)), tables, opts)
    joined = C.with_mail_count(enriched)
    from pyspark.sql import Window

    w = Window.partitionBy("MBR_ACC_EPH_LINK_ID")
    windowed = enriched.withColumn(C.MAIL_COUNT, F.count_if(F.col("PHMCY_DLVRY_SYSTM_CD") == "M").over(w))
    cols = ["PHMCY_CLM_EVNT_GID", "MBR_ACC_EPH_LINK_ID", C.MAIL_COUNT]
    assert sorted(tuple(r) for r in joined.select(*cols).collect()) == sorted(tuple(r) for r in windowed.select(*cols).collect())


def test_write_orc(tables, opts, scratch_dir, oracle):
    out = C.run_campaign(tables, opts)
    path = C.write_campaign(out, f"{scratch_dir}/campaign_out")
    back = out.sparkSession.read.orc(path)
    assert back.count() == len(oracle) and back.columns == out.columns


def test_no_broadcast_is_forced(tables, opts):
    enriched = C.enrich(C.latest_claims(C.claim_base(tables, opts)), tables, opts)
    assert "ResolvedHint" not in enriched._jdf.queryExecution().optimizedPlan().toString()


def test_look_back_is_pushed_to_the_scan(tables, opts, spark, scratch_dir):
    path = f"{scratch_dir}/claims_pushdown"
    tables.claims.write.mode("overwrite").parquet(path)
    base = spark.read.parquet(path).where(rules.recent_fill("FILL_DT", opts.as_of, 180))
    assert "GreaterThanOrEqual(FILL_DT" in base._jdf.queryExecution().executedPlan().toString()


def test_salted_member_join_gives_same_output(tables, opts):
    plain = C.run_campaign(tables, opts)
    salty = C.run_campaign(tables, C.CampaignOptions(as_of=opts.as_of, member_salt_buckets=4))
    cols = ["MBR_OPPTY_GID", "MBR_ACCT_GID", "FFM_IND", "RFM_IND"]
    assert sorted(tuple(r) for r in plain.select(*cols).collect()) == sorted(tuple(r) for r in salty.select(*cols).collect())


def test_job_reads_catalog_and_writes_orc(spark, tables, scratch_dir, oracle):
    """End to end: ten tables written as files, described by a JSON catalog,
    loaded by source name, run, and written as ORC."""
    import os

    from cataloom.plans import campaign_job
    from cataloom.plans.campaign_analog import VIEW_FOR
    from cataloom.sources.catalog import SOURCE_SCHEMA, TABLE_SCHEMA

    root = os.path.join(scratch_dir, "poc")
    rows = []
    for field, view in VIEW_FOR.items():
        getattr(tables, field).write.mode("overwrite").orc(os.path.join(root, view, "merged", "orc"))
        rows.append(("POC", view, view, "original", "orc", None, [], []))
    src_json, tab_json = os.path.join(scratch_dir, "src.json"), os.path.join(scratch_dir, "tab.json")
    spark.createDataFrame([("POC", "poc-id", root, None, "source")], SOURCE_SCHEMA).write.mode("overwrite").json(src_json)
    spark.createDataFrame(rows, TABLE_SCHEMA).write.mode("overwrite").json(tab_json)
    out = os.path.join(scratch_dir, "campaign_job_out")
    campaign_job.main(["--sources", src_json, "--tables", tab_json, "--source", "sources.POC",
                       "--as-of", "2001-11-29", "--out", out])
    result = spark.read.orc(out)
    assert result.count() == len(oracle) and len(result.columns) == 45


def test_ffm_counts_rows_after_fan_out(spark):
    """0, 1, 2 mail rows per member; one mail row doubled by a fan-out join
    counts twice, so that member is not first-fill-at-mail."""
    from cataloom.functions import rules

    rows = [
        # member 1: one mail row -> Y
        (1, "M", "Y"),
        (1, "R", "Y"),
        # member 2: two mail rows -> N
        (2, "M", "Y"),
        (2, "M", "Y"),
        # member 3: no mail row -> N
        (3, "R", "Y"),
        # member 4: one mail claim seen twice after the program join -> N
        (4, "M", "Y"),
        (4, "M", "Y"),
    ]
    df = spark.createDataFrame(rows, "MBR_ACC_EPH_LINK_ID int, PHMCY_DLVRY_SYSTM_CD string, BNFT_PLAN_RCP_OPTNS_MAIL_IND string")
    counted = C.with_mail_count(df)
    flagged = counted.select(
        "MBR_ACC_EPH_LINK_ID", "PHMCY_DLVRY_SYSTM_CD",
        rules.first_fill_at_mail_flag("BNFT_PLAN_RCP_OPTNS_MAIL_IND", "PHMCY_DLVRY_SYSTM_CD", C.MAIL_COUNT).alias("f"),
    )
    got = sorted(tuple(r) for r in flagged.collect())
    assert got == [(1, "M", "Y"), (1, "R", "N"), (2, "M", "N"), (2, "M", "N"), (3, "R", "N"), (4, "M", "N"), (4, "M", "N")]
