"""Column lists of the campaign analog views (for oracle SQL text)."""

# Output columns of each analog view, in view order.
ANALOG_COLUMNS = {
    "V_PHMCY_CLM": [
        "CLM_EVNT_GID", "MBR_ACCT_GID", "DRUG_PROD_GID", "LVL1_ACCT_GID", "LVL3_ACCT_GID",
        "PHMCY_PTY_GID", "PRSCBR_PTY_GID", "FILL_DT", "COB_CD", "DLVRY_SYSTM_CD", "DAY_SPLY_QTY",
        "ADJD_FRMLY_CD", "MEDD_CLM_IND", "SRC_CD", "PHMCY_LTC_IND", "ZIW_ROW_ID",
    ],
    "V_MBR_ACCT_HIST": ["MBR_ACCT_GID", "EPH_LINK_ID", "REC_SRC_FLG", "MBR_BRTH_DT", "GNDR_CD"],
    "V_DRUG_DENORM": ["DRUG_PROD_GID", "GPI4_CD", "DEA_CLS_CD", "BUS_MAINT_IND", "SPCLT_DRUG_IND"],
    "V_MBR_ACCT_CVRG": ["MBR_ACCT_GID", "CVRG_EFF_DT", "CVRG_EXPRN_DT"],
    "V_MBR_ACCT_CONT_CVRG": ["MBR_ACCT_GID", "ELIG_CC_EFF_DT", "ELIG_CC_EXPRN_DT"],
    "V_CLNT_ACCT_DENORM": [
        "LVL1_ACCT_GID", "LVL3_ACCT_GID", "LVL0_ACCT_ID", "LVL0_ACCT_NM", "LVL0_EFF_DT",
        "LVL0_EXPRN_DT", "LVL1_ACCT_ID", "LVL1_ACCT_NM", "LVL1_EFF_DT", "LVL1_EXPRN_DT",
        "NON_PBM_CLNT_TYP_CD", "NON_PBM_LOB_CD",
    ],
    "V_PHMCY_DENORM": ["PHMCY_PTY_GID", "CVS_MAIL_IND", "CVS_RTL_IND"],
    "V_BNFT_PLAN_RXC_CAG_PLAN_OPTNS": [
        "LVL1_ACCT_GID", "LVL3_ACCT_GID", "STUS_CD", "MAIL_IND", "MAINT_CHOICE_TYP_CD",
    ],
    "V_MBR_ACCT_HRCHY": ["MBR_ACCT_GID", "SRC_CD"],
    "V_MBR_PGM_RX_SCHD_HIST": [
        "SCHD_ENRL_BNFCY_ID", "SCH_PGM_ID", "SCHD_OPT_IN_PRCS_SRC_CD", "SCHD_OPT_OUT_DT",
    ],
}
