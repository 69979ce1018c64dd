"""Mail-order opportunity campaign: claims -> latest claim per member and
drug class -> dimension enrichment -> indicators -> 45-column output.

Scale notes:

* filters sit on the scans (COB code, 180-day window, member flags) and are
  pushed into the file reader;
* the latest claim per (member link, drug class) is a ranked window whose
  group limit runs below the exchange, so claims are read once and a member
  with a third of all claims sends a few rows per task;
* member-keyed tables join on the same key one after another (the program
  join is rewritten onto the member key), so the claim side is shuffled
  once for all of them; whether a dimension is broadcast is left to Spark;
* the per-member mail count is an aggregate, materialized, then joined back,
  so AQE can split a hot member's partition; because both the count and the
  output read the enriched table, it is checkpointed to the shared checkpoint
  folder, with the columns that the wanted outputs need and no others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.functions import rules
from cataloom.operators.aggregate import count_if, latest_per_group
from cataloom.operators.join import join_back_aggregate
from cataloom.operators.project import check_unique, project_mapping
from cataloom.sources.files import select_table

# Column prefixes given to each input table.
PREFIX = {
    "claims": "PHMCY",
    "members": "MBR_ACC",
    "drugs": "DRUG",
    "coverage": "MBR_ACC_CVRG",
    "cont_coverage": "MBR_ACC_CONT_CVRG",
    "client_accounts": "CLNT_ACCT_DENORM",
    "pharmacies": "PHMCY_DENORM",
    "plan_options": "BNFT_PLAN_RCP_OPTNS",
    "hierarchy": "MBR_ACCT_HRCHY",
    "programs": "MBR_PGM_RX_SCHD_HIST",
}

# Catalogued view of each input table.
VIEW_FOR = {
    "claims": "V_PHMCY_CLM",
    "members": "V_MBR_ACCT_HIST",
    "drugs": "V_DRUG_DENORM",
    "coverage": "V_MBR_ACCT_CVRG",
    "cont_coverage": "V_MBR_ACCT_CONT_CVRG",
    "client_accounts": "V_CLNT_ACCT_DENORM",
    "pharmacies": "V_PHMCY_DENORM",
    "plan_options": "V_BNFT_PLAN_RXC_CAG_PLAN_OPTNS",
    "hierarchy": "V_MBR_ACCT_HRCHY",
    "programs": "V_MBR_PGM_RX_SCHD_HIST",
}

# The 45-column output layout, (source column, output name).
TARGET_LAYOUT = [
    ("PHMCY_ZIW_ROW_ID", "MBR_OPPTY_GID"),
    ("MBR_ACC_EPH_LINK_ID", "EPH_LINK_ID"),
    ("DRUG_GPI4_CD", "GPI4_CD"),
    ("PHMCY_LVL1_ACCT_GID", "LVL1_ACCT_GID"),
    ("PHMCY_LVL3_ACCT_GID", "LVL3_ACCT_GID"),
    ("CLNT_ACCT_DENORM_LVL0_ACCT_ID", "LVL0_ACCT_ID"),
    ("CLNT_ACCT_DENORM_LVL0_ACCT_NM", "LVL0_ACCT_NM"),
    ("CLNT_ACCT_DENORM_LVL0_EFF_DT", "LVL0_EFF_DT"),
    ("CLNT_ACCT_DENORM_LVL0_EXPRN_DT", "LVL0_EXPRN_DT"),
    ("CLNT_ACCT_DENORM_LVL1_ACCT_ID", "LVL1_ACCT_ID"),
    ("CLNT_ACCT_DENORM_LVL1_ACCT_NM", "LVL1_ACCT_NM"),
    ("CLNT_ACCT_DENORM_LVL1_EFF_DT", "LVL1_EFF_DT"),
    ("CLNT_ACCT_DENORM_LVL1_EXPRN_DT", "LVL1_EXPRN_DT"),
    ("CLNT_ACCT_DENORM_NON_PBM_CLNT_TYP_CD", "NON_PBM_CLNT_TYP_CD"),
    ("CLNT_ACCT_DENORM_NON_PBM_LOB_CD", "NON_PBM_LOB_CD"),
    ("DRUG_DRUG_PROD_GID", "DRUG_PROD_GID"),
    ("PHMCY_CLM_EVNT_GID", "LAST_FILL_CLM_GID"),
    ("PHMCY_FILL_DT", "LAST_FILL_DT"),
    ("PHMCY_MBR_ACCT_GID", "MBR_ACCT_GID"),
    ("MBR_ACC_CVRG_CVRG_EFF_DT", "CVRG_EFF_DT"),
    ("MBR_ACC_CVRG_CVRG_EXPRN_DT", "CVRG_EXPRN_DT"),
    ("MBR_ACC_CONT_CVRG_ELIG_CC_EFF_DT", "ELIG_CC_EFF_DT"),
    ("MBR_ACC_CONT_CVRG_ELIG_CC_EXPRN_DT", "ELIG_CC_EXPRN_DT"),
    ("PHMCY_DENORM_PHMCY_PTY_GID", "PHMCY_PTY_GID"),
    ("PHMCY_DENORM_CVS_MAIL_IND", "CVS_MAIL_IND"),
    ("PHMCY_SRC_CD", "CLM_SRC_CD"),
    ("PHMCY_PRSCBR_PTY_GID", "PRSCBR_PTY_GID"),
    ("PHMCY_DLVRY_SYSTM_CD", "DLVRY_SYSTM_CD"),
    ("PHMCY_DAY_SPLY_QTY", "DAY_SPLY_QTY"),
    ("NORMALIZED_DAY_SPLY_QTY", "NORMALIZED_DAY_SPLY_QTY"),
    ("PHMCY_ADJD_FRMLY_CD", "ADJD_FRMLY_CD"),
    ("PHMCY_MEDD_CLM_IND", "MEDD_CLM_IND"),
    ("MBR_ACC_GNDR_CD", "GNDR_CD"),
    ("MBR_CURR_AGE", "MBR_CURR_AGE"),
    ("MINOR_IND", "MINOR_IND"),
    ("MBR_CURR_ELIG_IND", "MBR_CURR_ELIG_IND"),
    ("RTM_IND", "RTM_IND"),
    ("MCV_IND", "MCV_IND"),
    ("RFM_IND", "RFM_IND"),
    ("FFM_IND", "FFM_IND"),
    ("CONTROLLED_SUBSTANCE_IND", "CONTROLLED_SUBSTANCE_IND"),
    ("DRUG_BUS_MAINT_IND", "MAINTENANCE_IND"),
    ("PHMCY_PHMCY_LTC_IND", "PHMCY_LTC_IND"),
    ("DRUG_SPCLT_DRUG_IND", "SPCLT_DRUG_IND"),
]

MAIL_COUNT = "MEMBER_MAIL_ROWS"
MEMBER = "MBR_ACC_EPH_LINK_ID"
# Columns that each derived output is computed from.
INDICATOR_INPUTS = {
    "FFM_IND": ["BNFT_PLAN_RCP_OPTNS_MAIL_IND", "PHMCY_DLVRY_SYSTM_CD", MEMBER],
    "NORMALIZED_DAY_SPLY_QTY": ["PHMCY_DAY_SPLY_QTY"],
    "MBR_CURR_AGE": ["MBR_ACC_MBR_BRTH_DT"],
    "MINOR_IND": ["MBR_ACC_MBR_BRTH_DT"],
    "MBR_CURR_ELIG_IND": ["MBR_ACC_CVRG_CVRG_EFF_DT", "MBR_ACC_CVRG_CVRG_EXPRN_DT"],
    "RTM_IND": ["BNFT_PLAN_RCP_OPTNS_MAIL_IND", "PHMCY_DLVRY_SYSTM_CD"],
    "MCV_IND": [
        "BNFT_PLAN_RCP_OPTNS_MAINT_CHOICE_TYP_CD", "PHMCY_DAY_SPLY_QTY", "PHMCY_DLVRY_SYSTM_CD",
        "PHMCY_DENORM_CVS_RTL_IND", "PHMCY_DENORM_CVS_MAIL_IND",
    ],
    "RFM_IND": [
        "MBR_PGM_RX_SCHD_HIST_SCH_PGM_ID", "MBR_PGM_RX_SCHD_HIST_SCHD_OPT_IN_PRCS_SRC_CD",
        "MBR_PGM_RX_SCHD_HIST_SCHD_OPT_OUT_DT",
    ],
    "CONTROLLED_SUBSTANCE_IND": ["DRUG_DEA_CLS_CD"],
}
LATEST_KEYS = ["MBR_ACC_EPH_LINK_ID", "DRUG_GPI4_CD"]
LATEST_ORDER = ["PHMCY_FILL_DT", "PHMCY_CLM_EVNT_GID"]


@dataclass(frozen=True)
class CampaignTables:
    """The ten inputs, with their raw (unprefixed) column names."""

    claims: DataFrame
    members: DataFrame
    drugs: DataFrame
    coverage: DataFrame
    cont_coverage: DataFrame
    client_accounts: DataFrame
    pharmacies: DataFrame
    plan_options: DataFrame
    hierarchy: DataFrame
    programs: DataFrame


@dataclass(frozen=True)
class CampaignOptions:
    as_of: dt.date
    lookback_days: int = 180
    age_method: str = "months"
    checkpoint_enriched: bool = True
    member_salt_buckets: int | None = None  # salt the per-member join-back (hot members)


def _join(left: DataFrame, right: DataFrame, pairs, how: str) -> DataFrame:
    cond = None
    for a, b in pairs:
        term = F.col(a) == F.col(b)
        cond = term if cond is None else cond & term
    out = left.join(right, cond, how)
    check_unique(out.columns)
    return out


def claim_base(t: CampaignTables, opts: CampaignOptions) -> DataFrame:
    """Primary claims in the look-back window joined to eligible members
    and their drugs (C1)."""
    claims = select_table(
        t.claims,
        (F.col("COB_CD") == "PRMRY") & rules.recent_fill("FILL_DT", opts.as_of, opts.lookback_days),
        PREFIX["claims"],
    )
    members = select_table(
        t.members,
        rules.nonzero_id("EPH_LINK_ID", text=t.members.schema["EPH_LINK_ID"].dataType.typeName() == "string") & (F.col("REC_SRC_FLG") == "Y"),
        PREFIX["members"],
    )
    drugs = select_table(t.drugs, None, PREFIX["drugs"])
    base = _join(claims, members, [("PHMCY_MBR_ACCT_GID", "MBR_ACC_MBR_ACCT_GID")], "inner")
    return _join(base, drugs, [("PHMCY_DRUG_PROD_GID", "DRUG_DRUG_PROD_GID")], "inner")


def latest_claims(base: DataFrame, method: str = "window") -> DataFrame:
    """Claims on the latest fill date with the greatest claim id, per member
    link and drug class (C2-C4); ties kept."""
    return latest_per_group(base, LATEST_KEYS, LATEST_ORDER, method=method)


def enrich(latest: DataFrame, t: CampaignTables, opts: CampaignOptions) -> DataFrame:
    """Coverage, client, pharmacy, plan, hierarchy and program joins."""
    coverage = select_table(t.coverage, None, PREFIX["coverage"])
    cont = select_table(t.cont_coverage, None, PREFIX["cont_coverage"])
    hierarchy = select_table(t.hierarchy, F.col("SRC_CD") == "Q", PREFIX["hierarchy"])
    programs = select_table(t.programs, None, PREFIX["programs"])
    clients = select_table(t.client_accounts, None, PREFIX["client_accounts"])
    pharmacies = select_table(t.pharmacies, None, PREFIX["pharmacies"])
    plans = select_table(t.plan_options, F.col("STUS_CD") == "A", PREFIX["plan_options"])

    member = "MBR_ACC_MBR_ACCT_GID"
    # member-keyed tables first: one shuffle of the claim side on the member key
    out = _join(latest, coverage, [(member, "MBR_ACC_CVRG_MBR_ACCT_GID")], "inner")
    out = _join(out, cont, [(member, "MBR_ACC_CONT_CVRG_MBR_ACCT_GID")], "left")
    out = _join(out, hierarchy, [(member, "MBR_ACCT_HRCHY_MBR_ACCT_GID")], "left")
    # Programs join on the hierarchy row's member id.  Where a hierarchy row
    # matched, that id equals the member key, so "member key = program id and
    # a hierarchy row matched" is the same condition -- and it keeps the
    # member-key partitioning of the three joins above (no extra shuffle).
    out = out.join(
        programs,
        (F.col(member) == F.col("MBR_PGM_RX_SCHD_HIST_SCHD_ENRL_BNFCY_ID"))
        & F.col("MBR_ACCT_HRCHY_MBR_ACCT_GID").isNotNull(),
        "left",
    )
    check_unique(out.columns)
    # dimensions: Spark broadcasts the small ones by byte size; the two
    # (LVL1, LVL3)-keyed ones are adjacent, so that otherwise they share a shuffle
    account = [("PHMCY_LVL1_ACCT_GID", "CLNT_ACCT_DENORM_LVL1_ACCT_GID"),
               ("PHMCY_LVL3_ACCT_GID", "CLNT_ACCT_DENORM_LVL3_ACCT_GID")]
    plan_keys = [("PHMCY_LVL1_ACCT_GID", "BNFT_PLAN_RCP_OPTNS_LVL1_ACCT_GID"),
                 ("PHMCY_LVL3_ACCT_GID", "BNFT_PLAN_RCP_OPTNS_LVL3_ACCT_GID")]
    out = _join(out, clients, account, "inner")
    out = _join(out, plans, plan_keys, "inner")
    out = _join(out, pharmacies, [("PHMCY_PHMCY_PTY_GID", "PHMCY_DENORM_PHMCY_PTY_GID")], "inner")
    return out


def with_mail_count(enriched: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """Per-member count of mail rows in the enriched table, joined back."""
    return join_back_aggregate(
        enriched,
        [MEMBER],
        [count_if(F.col("PHMCY_DLVRY_SYSTM_CD") == rules.MAIL).alias(MAIL_COUNT)],
        salt_buckets=salt_buckets,
    )


def add_indicators(df: DataFrame, opts: CampaignOptions, wanted: Sequence[str] = tuple(INDICATOR_INPUTS)) -> DataFrame:
    """The ``wanted`` derived columns in one projection."""
    age = rules.member_age("MBR_ACC_MBR_BRTH_DT", opts.as_of, opts.age_method)
    made = {
        "FFM_IND": lambda: rules.first_fill_at_mail_flag("BNFT_PLAN_RCP_OPTNS_MAIL_IND", "PHMCY_DLVRY_SYSTM_CD", MAIL_COUNT),
        "NORMALIZED_DAY_SPLY_QTY": lambda: rules.normalized_day_supply("PHMCY_DAY_SPLY_QTY"),
        "MBR_CURR_AGE": lambda: age,
        "MINOR_IND": lambda: rules.minor_flag(age),
        "MBR_CURR_ELIG_IND": lambda: rules.eligible_flag(opts.as_of, "MBR_ACC_CVRG_CVRG_EFF_DT", "MBR_ACC_CVRG_CVRG_EXPRN_DT"),
        "RTM_IND": lambda: rules.retail_to_mail_flag("BNFT_PLAN_RCP_OPTNS_MAIL_IND", "PHMCY_DLVRY_SYSTM_CD"),
        "MCV_IND": lambda: rules.maintenance_choice_flag(
            "BNFT_PLAN_RCP_OPTNS_MAINT_CHOICE_TYP_CD", "PHMCY_DAY_SPLY_QTY", "PHMCY_DLVRY_SYSTM_CD",
            "PHMCY_DENORM_CVS_RTL_IND", "PHMCY_DENORM_CVS_MAIL_IND",
        ),
        "RFM_IND": lambda: rules.ready_fill_flag(
            "MBR_PGM_RX_SCHD_HIST_SCH_PGM_ID", "MBR_PGM_RX_SCHD_HIST_SCHD_OPT_IN_PRCS_SRC_CD",
            "MBR_PGM_RX_SCHD_HIST_SCHD_OPT_OUT_DT",
        ),
        "CONTROLLED_SUBSTANCE_IND": lambda: rules.controlled_substance_flag("DRUG_DEA_CLS_CD"),
    }
    return df.select("*", *[made[name]().alias(name) for name in wanted])


def target_projection(df: DataFrame, opts: CampaignOptions, columns: Sequence[str] | None = None) -> DataFrame:
    """The 45-column output, or some ``columns`` of it; CREATE_TMS is the
    run's ``as_of`` (C15)."""
    mapping = [(F.col(src), name) for src, name in TARGET_LAYOUT if columns is None or name in columns]
    if columns is None or "CREATE_TMS" in columns:
        # a string cast to TIMESTAMP_NTZ involves no time zone (a datetime literal would)
        created = f"{opts.as_of.isoformat()} 00:00:00"
        mapping.append((F.lit(created).cast("timestamp_ntz"), "CREATE_TMS"))
    return project_mapping(df, mapping)


def enriched_table(t: CampaignTables, opts: CampaignOptions, columns: Sequence[str] | None = None) -> DataFrame:
    """The enriched claims, or some ``columns`` of them, checkpointed if asked for."""
    enriched = enrich(latest_claims(claim_base(t, opts)), t, opts)
    if columns is not None:
        enriched = enriched.select(*columns)
    if opts.checkpoint_enriched:
        from cataloom.session import materialize

        enriched = materialize(enriched)
    return enriched


def run_campaign(t: CampaignTables, opts: CampaignOptions, columns: Sequence[str] | None = None) -> DataFrame:
    """The whole pipeline as one DataFrame (C16), or some output ``columns``.

    Only what these need is read and shuffled; without the mail count the
    enriched table has one reader and is not checkpointed.
    """
    sources = [src for src, name in TARGET_LAYOUT if columns is None or name in columns]
    derived = [src for src in sources if src in INDICATOR_INPUTS]
    inputs = [src for src in sources if src not in INDICATOR_INPUTS]
    inputs += [c for name in derived for c in INDICATOR_INPUTS[name]]
    counted = "FFM_IND" in derived
    if not counted:
        opts = replace(opts, checkpoint_enriched=False)
    enriched = enriched_table(t, opts, list(dict.fromkeys(inputs)))
    if counted:
        enriched = with_mail_count(enriched, opts.member_salt_buckets)
    return target_projection(add_indicators(enriched, opts, derived), opts, columns)


def write_campaign(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """ORC output, overwritten by default."""
    df.write.mode(mode).orc(path)
    return path
