"""Campaign job entry point: catalog -> ten input tables -> run -> ORC.

Submit with ``spark-submit -m cataloom.plans.campaign_job`` (or
``python -m``) on a cluster; the session comes from the submit
configuration, and ``spark.checkpoint.dir`` should name shared storage.

    python -m cataloom.plans.campaign_job --sources sources.json --tables tables.json \\
        --source CLAIMS --as-of 2024-06-14 --out /data/campaign/out
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from cataloom.plans.campaign import VIEW_FOR, CampaignOptions, CampaignTables, run_campaign, write_campaign
from cataloom.sources.catalog import Catalog


def tables_from_catalog(catalog: Catalog, source: str) -> CampaignTables:
    """The ten inputs, read from their catalogued locations."""
    return CampaignTables(**{field: catalog.read(f"{source}.{view}") for field, view in VIEW_FOR.items()})


def run(spark: SparkSession, sources_json: str, tables_json: str, source: str, as_of: dt.date,
        out: str, lookback_days: int = 180, age_method: str = "months") -> str:
    name = source.split(".")[-1]  # "sources.X" style names address source X
    catalog = Catalog.from_json(spark, sources_json, tables_json).load_sources(name)
    opts = CampaignOptions(as_of=as_of, lookback_days=lookback_days, age_method=age_method)
    return write_campaign(run_campaign(tables_from_catalog(catalog, name), opts), out)


def main(argv: list[str] | None = None) -> str:
    ap = argparse.ArgumentParser(description="mail-order opportunity campaign")
    ap.add_argument("--sources", required=True, help="catalog source documents (JSON lines)")
    ap.add_argument("--tables", required=True, help="catalog table documents (JSON lines)")
    ap.add_argument("--source", required=True, help="source holding the ten input tables")
    ap.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="run date (YYYY-MM-DD)")
    ap.add_argument("--out", required=True, help="output folder (ORC, overwritten)")
    ap.add_argument("--lookback-days", type=int, default=180)
    ap.add_argument("--age-method", choices=["months", "days365"], default="months")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    return run(spark, args.sources, args.tables, args.source, args.as_of, args.out,
               args.lookback_days, args.age_method)


if __name__ == "__main__":
    main()
