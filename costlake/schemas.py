"""Schemas, column lists and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the reference for equal results) -------------

# The 14 columns a usage (cost and usage report) export must carry, in order.
USAGE_COLUMNS: list[str] = [
    "identity_line_item_id",
    "identity_time_interval",
    "bill_payer_account_id",
    "line_item_usage_account_id",
    "line_item_line_item_type",
    "line_item_usage_start_date",
    "line_item_usage_end_date",
    "line_item_product_code",
    "line_item_usage_type",
    "line_item_operation",
    "line_item_usage_amount",
    "line_item_unblended_cost",
    "line_item_blended_cost",
    "line_item_currency_code",
]

# Product code -> service category; anything else is "Other".
SERVICE_CATEGORIES: dict[str, str] = {
    "AmazonEC2": "Compute",
    "AmazonS3": "Storage",
    "AmazonRDS": "Database",
    "AmazonRedshift": "Database",
    "AWSLambda": "Serverless",
    "AmazonCloudWatch": "Monitoring",
}
DEFAULT_CATEGORY = "Other"

# Open end of a validity interval (effective_to IS NULL).
OPEN_END_DATE = "9999-12-31"

# Masked phone prefix and masked e-mail token length (SHA-256 hex).
PHONE_MASK_PREFIX = "XXX-XXX-"
EMAIL_TOKEN_LENGTH = 64

# Control id that marks an emergency override in the evidence ledger.
OVERRIDE_CONTROL_ID = "C-11"

# --- Spark schemas ------------------------------------------------------------

# Raw usage layer: every column is text, NULL stays NULL.
RAW_USAGE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in USAGE_COLUMNS])

# Money inside the engine: exact decimals, double only at the output edge. Usage
# prices go down to 1e-9 and below per line, so a line keeps 15 decimals.
MONEY_IN = T.DecimalType(28, 15)
MONEY_SUM = T.DecimalType(38, 15)
MONEY_2DP = T.DecimalType(38, 2)

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("email", T.StringType(), True),
    T.StructField("phone", T.StringType(), True),
    T.StructField("first_name", T.StringType(), True),
    T.StructField("last_name", T.StringType(), True),
    T.StructField("segment", T.StringType(), True),
    T.StructField("created_at", T.StringType(), True),
])

DIM_SERVICE_COLUMNS = [
    "service_key", "product_code", "usage_type", "service_category",
    "first_seen_date", "last_seen_date", "_loaded_at", "_updated_at",
]

DIM_CUSTOMER_COLUMNS = [
    "customer_key", "customer_id", "email_token", "phone_redacted",
    "first_name", "last_name", "segment", "effective_from", "effective_to",
    "is_current", "_loaded_at",
]

FACT_DAILY_COLUMNS = [
    "usage_date", "service_key", "daily_cost", "record_count",
    "null_cost_count", "_loaded_at",
]

FACT_CUSTOMER_COLUMNS = [
    "usage_date", "customer_key", "service_key", "allocated_cost",
    "record_count", "null_cost_count", "_loaded_at",
]

LEDGER_SCHEMA = T.StructType([
    T.StructField("evidence_id", T.StringType(), True),
    T.StructField("control_id", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("remediation_status", T.StringType(), True),
    T.StructField("standard_controls_deferred", T.ArrayType(T.StringType()), True),
    T.StructField("remediation_deadline", T.StringType(), True),
    T.StructField("emergency_approver", T.StringType(), True),
])

# Column names that must never appear in a fact table (raw PII).
PII_COLUMN_NAMES = ["email", "phone", "first_name", "last_name"]
