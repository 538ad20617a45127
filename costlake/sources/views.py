"""Usage lines and customer snapshots derived from the driver tables.

The driver tables carry no billing data, so each operator runs on a
deterministic view that Spark derives from them (and that the SQL oracle
derives the same way):

* usage lines from ``events``: one line per event, service = event type,
  usage type = event type + ``:`` + (event_id mod 3), cost = value to the
  cent, NULL cost on every event whose id ends in 7 modulo 50 (the table has
  no NULLs of its own);
* long usage lines from ``lineitem`` joined to ``part``: ship date, part type
  as service, extended price as cost; the id (order, line) repeats;
* customer snapshots from ``customer``: v1 (2024-01-01) without the keys
  that are 19 modulo 20 (they arrive as new in v2), v2 (2024-01-15) with
  every customer, keys 3 modulo 7 moved to segment BUILDING (MACHINERY if
  already BUILDING) and keys 5 modulo 11 with a new phone number.

These rules only shape the data; every row of the source tables is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.schemas import USAGE_COLUMNS

# Fixed values of the derived views.
LINE_ID = "identity_line_item_id"
PAYER_ACCOUNT = "123456789012"
SNAPSHOT_V1_DATE = "2024-01-01"
SNAPSHOT_V2_DATE = "2024-01-15"
SEGMENT_MOVE_TO = "BUILDING"
SEGMENT_MOVE_ALT = "MACHINERY"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(d: Column) -> Column:
    """DATE -> ``YYYY-MM-DD`` text (the cast needs no per-row formatter)."""
    return d.cast("string")


def _cents_text(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def usage_from_events(events: DataFrame) -> DataFrame:
    d = F.to_date(F.col("ts"))
    start, end = _iso(d), _iso(F.date_add(d, 1))
    eid = F.col("event_id")
    cost = F.when(eid % 50 == 7, F.lit(None).cast("string")).otherwise(_cents_text(F.col("value")))
    cols = {
        "identity_line_item_id": eid.cast("string"),
        "identity_time_interval": F.concat(start, F.lit("T00:00:00Z/"), end, F.lit("T00:00:00Z")),
        "bill_payer_account_id": F.lit(PAYER_ACCOUNT),
        "line_item_usage_account_id": F.lpad(F.col("user_id").cast("string"), 12, "0"),
        "line_item_line_item_type": F.lit("Usage"),
        "line_item_usage_start_date": start,
        "line_item_usage_end_date": end,
        "line_item_product_code": F.col("event_type"),
        "line_item_usage_type": F.concat(F.col("event_type"), F.lit(":"), (eid % 3).cast("string")),
        "line_item_operation": F.col("event_type"),
        "line_item_usage_amount": F.lit("1"),
        "line_item_unblended_cost": cost,
        "line_item_blended_cost": cost,
        "line_item_currency_code": F.lit("USD"),
    }
    return events.select([cols[c].alias(c) for c in USAGE_COLUMNS])


def with_line_id(lineitem: DataFrame) -> DataFrame:
    return lineitem.withColumn(LINE_ID, F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                                                 F.col("l_linenumber").cast("string")))


def usage_from_lineitem(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    named = lineitem if LINE_ID in lineitem.columns else with_line_id(lineitem)
    li = named.join(part.select("p_partkey", "p_type"),
                    named["l_partkey"] == part["p_partkey"], "inner")
    d = F.to_date(F.col("l_shipdate"))
    start, end = _iso(d), _iso(F.date_add(d, 1))
    cost = _cents_text(F.col("l_extendedprice"))
    cols = {
        LINE_ID: F.col(LINE_ID),
        "identity_time_interval": F.concat(start, F.lit("T00:00:00Z/"), end, F.lit("T00:00:00Z")),
        "bill_payer_account_id": F.lit(PAYER_ACCOUNT),
        "line_item_usage_account_id": F.lpad(F.col("l_suppkey").cast("string"), 12, "0"),
        "line_item_line_item_type": F.lit("Usage"),
        "line_item_usage_start_date": start,
        "line_item_usage_end_date": end,
        "line_item_product_code": F.col("p_type"),
        "line_item_usage_type": F.concat(F.col("p_type"), F.lit(":"), F.col("l_returnflag")),
        "line_item_operation": F.col("l_linestatus"),
        "line_item_usage_amount": F.col("l_quantity").cast("decimal(18,2)").cast("string"),
        "line_item_unblended_cost": cost,
        "line_item_blended_cost": cost,
        "line_item_currency_code": F.lit("USD"),
    }
    return li.select([cols[c].alias(c) for c in USAGE_COLUMNS])


def _snapshot(customer: DataFrame, version: int) -> DataFrame:
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    phone_area = F.lit("555-")
    if version == 2:
        seg = F.when(key % 7 == 3, F.when(seg == SEGMENT_MOVE_TO, F.lit(SEGMENT_MOVE_ALT))
                     .otherwise(F.lit(SEGMENT_MOVE_TO))).otherwise(seg)
        phone_area = F.when(key % 11 == 5, F.lit("556-")).otherwise(F.lit("555-"))
    src = customer if version == 2 else customer.filter(key % 20 != 19)
    return src.select(
        key.cast("bigint").alias("customer_id"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
        F.concat(phone_area, F.lpad(key.cast("string"), 7, "0")).alias("phone"),
        F.substring_index(F.col("c_name"), "#", 1).alias("first_name"),
        F.substring_index(F.col("c_name"), "#", -1).alias("last_name"),
        seg.alias("segment"),
        F.lit(SNAPSHOT_V1_DATE).alias("created_at"),
    )


def snapshot_v1(customer: DataFrame) -> DataFrame:
    return _snapshot(customer, 1)


def snapshot_v2(customer: DataFrame) -> DataFrame:
    return _snapshot(customer, 2)


def snapshot_series(customer: DataFrame, dates: list[str]) -> DataFrame:
    """One full customer snapshot per date. Snapshot k lacks the keys with
    (key + 3k) mod 11 = 0, moves the segment of those with (key + k) mod 7 = 3 or
    (key + 2k) mod 13 = 1, and gives keys 5 modulo 11 a phone area of its own."""
    key, k, seg = F.col("c_custkey"), F.col("k"), F.col("c_mktsegment")
    moved = ((key + k) % 7 == 3) | ((key + 2 * k) % 13 == 1)
    each = customer.select("c_custkey", "c_name", "c_mktsegment", F.posexplode(F.array(*map(F.lit, dates))).alias("k", "snapshot_date"))
    return each.filter((key + 3 * k) % 11 != 0).select(
        "snapshot_date", key.cast("bigint").alias("customer_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.when(key % 11 == 5, 560 + k).otherwise(555).cast("string"), F.lit("-"),
                 F.lpad(key.cast("string"), 7, "0")).alias("phone"),
        F.substring_index("c_name", "#", 1).alias("first_name"), F.substring_index("c_name", "#", -1).alias("last_name"),
        F.when(moved, F.when(seg == SEGMENT_MOVE_TO, SEGMENT_MOVE_ALT).otherwise(SEGMENT_MOVE_TO)).otherwise(seg).alias("segment"),
        F.lit(dates[0]).alias("created_at"))
