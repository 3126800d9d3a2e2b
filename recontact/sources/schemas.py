"""Schemas of the campaign tables this library writes, and of the ledger view it reads."""

from pyspark.sql import types as T

CAM_SELECT = T.StructType(
    [
        T.StructField("select_id", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("case_id", T.StringType()),
        T.StructField("client_name", T.StringType()),
        T.StructField("first_voucher_code", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("control_flag", T.IntegerType()),
        T.StructField("count_cases_patient", T.IntegerType()),
        T.StructField("reached_patient_flag", T.DecimalType(38, 0)),
        T.StructField("reached_date", T.DateType()),
        T.StructField("refusal_reason", T.StringType()),
        T.StructField("opt_out", T.DecimalType(38, 0)),
        T.StructField("new_case_id", T.StringType()),
        T.StructField("app_state", T.StringType()),
        T.StructField("korb", T.StringType()),
        T.StructField("preferred_language", T.StringType()),
    ]
)

CAM_BATCH = T.StructType(
    [
        T.StructField("cam_id", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("batch_acceptor", T.StringType()),
        T.StructField("batch_selection_date", T.DateType()),
        T.StructField("batch_transfer_date", T.DateType()),
        T.StructField("batch_start", T.DateType()),
        T.StructField("batch_stop", T.DateType()),
    ]
)

CAM_CAM = T.StructType(
    [
        T.StructField("cam_id", T.IntegerType()),
        T.StructField("cam_channel", T.StringType()),
        T.StructField("cam_name", T.StringType()),
        T.StructField("cam_description", T.StringType()),
        T.StructField("cam_audience", T.StringType()),
        T.StructField("cam_type", T.StringType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
        T.StructField("cam_category", T.StringType()),
    ]
)

CAMPAIGN_TABLES = {"cam_select": CAM_SELECT, "cam_batch": CAM_BATCH, "cam_cam": CAM_CAM}
