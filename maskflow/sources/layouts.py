"""Record layouts of the public claim and claim line feed files, by file number.

Fixed values: field name, width and format, in line order.
"""

from __future__ import annotations

from maskflow.sources.fixedwidth import Field

CLAIM_LAYOUTS: dict[str, list[Field]] = {
    "cclf1": [
        Field("CUR_CLM_UNIQ_ID", 13, "9"),
        Field("PRVDR_OSCAR_NUM", 6, "X"),
        Field("BENE_HIC_NUM", 11, "X"),
        Field("CLM_TYPE_CD", 2, "9"),
        Field("CLM_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_THRU_DT", 10, "YYYY-MM-DD"),
        Field("CLM_BILL_FAC_TYPE_CD", 1, "X"),
        Field("CLM_BILL_CLSFCTN_CD", 1, "X"),
        Field("PRNCPL_DGNS_CD", 7, "X"),
        Field("ADMTG_DGNS_CD", 7, "X"),
        Field("CLM_MDCR_NPMT_RSN_CD", 2, "X"),
        Field("CLM_PMT_AMT", 17, "-9.99"),
        Field("CLM_NCH_PRMRY_PYR_CD", 1, "X"),
        Field("PRVDR_FAC_FIPS_ST_CD", 2, "X"),
        Field("BENE_PTNT_STUS_CD", 2, "X"),
        Field("DGNS_DRG_CD", 4, "X"),
        Field("CLM_OP_SRVC_TYPE_CD", 1, "X"),
        Field("FAC_PRVDR_NPI_NUM", 10, "X"),
        Field("OPRTG_PRVDR_NPI_NUM", 10, "X"),
        Field("ATNDG_PRVDR_NPI_NUM", 10, "X"),
        Field("OTHR_PRVDR_NPI_NUM", 10, "X"),
        Field("CLM_ADJSMT_TYPE_CD", 2, "X"),
        Field("CLM_EFCTV_DT", 10, "YYYY-MM-DD"),
        Field("CLM_IDR_LD_DT", 10, "YYYY-MM-DD"),
        Field("BENE_EQTBL_BIC_HICN_NUM", 11, "X"),
        Field("CLM_ADMSN_TYPE_CD", 2, "X"),
        Field("CLM_ADMSN_SRC_CD", 2, "X"),
        Field("CLM_BILL_FREQ_CD", 1, "X"),
        Field("CLM_QUERY_CD", 1, "X"),
    ],
    "cclf2": [
        Field("CUR_CLM_UNIQ_ID", 13, "9"),
        Field("CLM_LINE_NUM", 10, "9"),
        Field("BENE_HIC_NUM", 11, "X"),
        Field("CLM_TYPE_CD", 2, "9"),
        Field("CLM_LINE_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_THRU_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_PROD_REV_CTR_CD", 4, "X"),
        Field("CLM_LINE_INSTNL_REV_CTR_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_HCPCS_CD", 5, "X"),
        Field("BENE_EQTBL_BIC_HICN_NUM", 11, "X"),
        Field("PRVDR_OSCAR_NUM", 6, "X"),
        Field("CLM_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_THRU_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_ALOWD_UNIT_QTY", 11, "-9.99"),
        Field("CLM_LINE_CVRD_PD_AMT", 17, "-9.99"),
        Field("HCPCS_1_MDFR_CD", 2, "X"),
        Field("HCPCS_2_MDFR_CD", 2, "X"),
        Field("HCPCS_3_MDFR_CD", 2, "X"),
        Field("HCPCS_4_MDFR_CD", 2, "X"),
        Field("HCPCS_5_MDFR_CD", 2, "X"),
    ],
    "cclf3": [
        Field("CUR_CLM_UNIQ_ID", 13, "9"),
        Field("BENE_HIC_NUM", 11, "X"),
        Field("CLM_TYPE_CD", 2, "9"),
        Field("CLM_VAL_SQNC_NUM", 2, "9"),
        Field("CLM_PRCDR_CD", 7, "X"),
        Field("CLM_PRCDR_PRFRM_DT", 10, "YYYY-MM-DD"),
        Field("BENE_EQTBL_BIC_HICN_NUM", 11, "X"),
        Field("PRVDR_OSCAR_NUM", 6, "X"),
        Field("CLM_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_THRU_DT", 10, "YYYY-MM-DD"),
    ],
    "cclf4": [
        Field("CUR_CLM_UNIQ_ID", 13, "9"),
        Field("BENE_HIC_NUM", 11, "X"),
        Field("CLM_TYPE_CD", 2, "9"),
        Field("CLM_PROD_TYPE_CD", 1, "X"),
        Field("CLM_VAL_SQNC_NUM", 2, "9"),
        Field("CLM_DGNS_CD", 7, "X"),
        Field("BENE_EQTBL_BIC_HICN_NUM", 11, "X"),
        Field("PRVDR_OSCAR_NUM", 6, "X"),
        Field("CLM_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_THRU_DT", 10, "YYYY-MM-DD"),
        Field("CLM_POA_IND", 7, "X"),
    ],
    "cclf5": [
        Field("CUR_CLM_UNIQ_ID", 13, "9"),
        Field("CLM_LINE_NUM", 10, "9"),
        Field("BENE_HIC_NUM", 11, "X"),
        Field("CLM_TYPE_CD", 2, "9"),
        Field("CLM_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_THRU_DT", 10, "YYYY-MM-DD"),
        Field("RNDRG_PRVDR_TYPE_CD", 3, "X"),
        Field("RNDRG_PRVDR_FIPS_ST_CD", 2, "X"),
        Field("CLM_PRVDR_SPCLTY_CD", 2, "X"),
        Field("CLM_FED_TYPE_SRVC_CD", 1, "X"),
        Field("CLM_POS_CD", 2, "X"),
        Field("CLM_LINE_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_THRU_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_HCPCS_CD", 5, "X"),
        Field("CLM_LINE_CVRD_PD_AMT", 15, "-9.99"),
        Field("CLM_PRMRY_PYR_CD", 1, "X"),
        Field("CLM_LINE_DGNS_CD", 7, "X"),
        Field("CLM_RNDRG_PRVDR_TAX_NUM", 10, "X"),
        Field("RNDRG_PRVDR_NPI_NUM", 10, "X"),
        Field("CLM_CARR_PMT_DNL_CD", 2, "X"),
        Field("CLM_PRCSG_IND_CD", 2, "X"),
        Field("CLM_ADJSMT_TYPE_CD", 2, "X"),
        Field("CLM_EFCTV_DT", 10, "YYYY-MM-DD"),
        Field("CLM_IDR_LD_DT", 10, "YYYY-MM-DD"),
        Field("CLM_CNTL_NUM", 40, "X"),
        Field("BENE_EQTBL_BIC_HICN_NUM", 11, "X"),
        Field("CLM_LINE_ALOWD_CHRG_AMT", 17, "-9.99"),
        Field("CLM_LINE_ALOWD_UNIT_QTY", 11, "-9.99"),
        Field("HCPCS_1_MDFR_CD", 2, "X"),
        Field("HCPCS_2_MDFR_CD", 2, "X"),
        Field("HCPCS_3_MDFR_CD", 2, "X"),
        Field("HCPCS_4_MDFR_CD", 2, "X"),
        Field("HCPCS_5_MDFR_CD", 2, "X"),
        Field("CLM_DISP_CD", 2, "X"),
        Field("CLM_DGNS_1_CD", 7, "X"),
        Field("CLM_DGNS_2_CD", 7, "X"),
        Field("CLM_DGNS_3_CD", 7, "X"),
        Field("CLM_DGNS_4_CD", 7, "X"),
        Field("CLM_DGNS_5_CD", 7, "X"),
        Field("CLM_DGNS_6_CD", 7, "X"),
        Field("CLM_DGNS_7_CD", 7, "X"),
        Field("CLM_DGNS_8_CD", 7, "X"),
    ],
    "cclf6": [
        Field("CUR_CLM_UNIQ_ID", 13, "9"),
        Field("CLM_LINE_NUM", 10, "9"),
        Field("BENE_HIC_NUM", 11, "X"),
        Field("CLM_TYPE_CD", 2, "9"),
        Field("CLM_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_THRU_DT", 10, "YYYY-MM-DD"),
        Field("CLM_FED_TYPE_SRVC_CD", 1, "X"),
        Field("CLM_POS_CD", 2, "X"),
        Field("CLM_LINE_FROM_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_THRU_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_HCPCS_CD", 5, "X"),
        Field("CLM_LINE_CVRD_PD_AMT", 15, "-9.99"),
        Field("CLM_PRMRY_PYR_CD", 1, "X"),
        Field("PAYTO_PRVDR_NPI_NUM", 10, "X"),
        Field("ORDRG_PRVDR_NPI_NUM", 10, "X"),
        Field("CLM_CARR_PMT_DNL_CD", 2, "X"),
        Field("CLM_PRCSG_IND_CD", 2, "X"),
        Field("CLM_ADJSMT_TYPE_CD", 2, "X"),
        Field("CLM_EFCTV_DT", 10, "YYYY-MM-DD"),
        Field("CLM_IDR_LD_DT", 10, "YYYY-MM-DD"),
        Field("CLM_CNTL_NUM", 40, "X"),
        Field("BENE_EQTBL_BIC_HICN_NUM", 11, "X"),
        Field("CLM_LINE_ALOWD_CHRG_AMT", 17, "-9.99"),
        Field("CLM_DISP_CD", 2, "X"),
    ],
    "cclf7": [
        Field("CUR_CLM_UNIQ_ID", 13, "9"),
        Field("BENE_HIC_NUM", 11, "X"),
        Field("CLM_LINE_NDC_CD", 11, "X"),
        Field("CLM_TYPE_CD", 2, "9"),
        Field("CLM_LINE_FROM_DT", 10, "YYYY-MM-DD"),
        Field("PRVDR_SRVC_ID_QLFYR_CD", 2, "X"),
        Field("CLM_SRVC_PRVDR_GNRC_ID_NUM", 20, "X"),
        Field("CLM_DSPNSNG_STUS_CD", 1, "X"),
        Field("CLM_DAW_PROD_SLCTN_CD", 1, "X"),
        Field("CLM_LINE_SRVC_UNIT_QTY", 13, "-9.9999"),
        Field("CLM_LINE_DAYS_SUPLY_QTY", 9, "9"),
        Field("PRVDR_PRSBNG_ID_QLFYR_CD", 2, "X"),
        Field("CLM_PRSBNG_PRVDR_GNRC_ID_NUM", 20, "X"),
        Field("CLM_LINE_BENE_PMT_AMT", 13, "-9.99"),
        Field("CLM_ADJSMT_TYPE_CD", 2, "X"),
        Field("CLM_EFCTV_DT", 10, "YYYY-MM-DD"),
        Field("CLM_IDR_LD_DT", 10, "YYYY-MM-DD"),
        Field("CLM_LINE_RX_SRVC_RFRNC_NUM", 12, "X"),
        Field("CLM_LINE_RX_FILL_NUM", 9, "X"),
    ],
    "cclf8": [
        Field("BENE_HIC_NUM", 11, "X"),
        Field("BENE_FIPS_STATE_CD", 2, "9"),
        Field("BENE_FIPS_CNTY_CD", 3, "9"),
        Field("BENE_ZIP_CD", 5, "X"),
        Field("BENE_DOB", 10, "YYYY-MM-DD"),
        Field("BENE_SEX_CD", 1, "X"),
        Field("BENE_RACE_CD", 1, "X"),
        Field("BENE_AGE", 3, "9"),
        Field("BENE_MDCR_STUS_CD", 2, "X"),
        Field("BENE_DUAL_STUS_CD", 2, "X"),
        Field("BENE_DEATH_DT", 10, "YYYY-MM-DD"),
        Field("BENE_RNG_BGN_DT", 10, "YYYY-MM-DD"),
        Field("BENE_RNG_END_DT", 10, "YYYY-MM-DD"),
        Field("BENE_1ST_NAME", 30, "X"),
        Field("BENE_MIDL_NAME", 15, "X"),
        Field("BENE_LAST_NAME", 40, "X"),
    ],
    "cclf9": [
        Field("CRNT_HIC_NUM", 11, "X"),
        Field("PRVS_HIC_NUM", 11, "X"),
        Field("PRVS_HICN_EFCTV_DT", 10, "YYYY-MM-DD"),
        Field("PRVS_HICN_OBSLT_DT", 10, "YYYY-MM-DD"),
        Field("BENE_RRB_NUM", 12, "X"),
    ],
}
