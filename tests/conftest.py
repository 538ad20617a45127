import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("costlake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="costlake-test-ckpt-"))
    yield s


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="costlake-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


USAGE_COLS = [
    "identity_line_item_id", "identity_time_interval", "bill_payer_account_id",
    "line_item_usage_account_id", "line_item_line_item_type", "line_item_usage_start_date",
    "line_item_usage_end_date", "line_item_product_code", "line_item_usage_type",
    "line_item_operation", "line_item_usage_amount", "line_item_unblended_cost",
    "line_item_blended_cost", "line_item_currency_code",
]


def usage_df(spark, lines):
    """lines: (id, date, product, usage_type, cost_text) -> 14-column text frame."""
    data = []
    for lid, d, pc, ut, cost in lines:
        data.append((lid, f"{d}/{d}", "123456789012", "123456789012", "Usage", d, d, pc, ut, "Op",
                     "1.0", cost, cost, "USD"))
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in USAGE_COLS))
