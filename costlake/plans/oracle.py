"""SQL oracle: for each named query, ANSI SQL that DuckDB runs on the driver
tables (registered as views under their table names).

Written independently of the DataFrame code: the views of
``costlake.sources.views`` are spelled out again as CTEs. Money is summed as
DECIMAL and cast to DOUBLE on the way out, exactly like the Spark side.
"""

from __future__ import annotations

from costlake.schemas import SERVICE_CATEGORIES

# --- shared CTE bodies ------------------------------------------------------------

USAGE = """
usage AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         strftime(CAST(ts AS DATE), '%Y-%m-%d') AS usage_date,
         event_type AS product_code,
         event_type || ':' || CAST(event_id % 3 AS VARCHAR) AS usage_type,
         CASE WHEN event_id % 50 = 7 THEN NULL
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS cost
  FROM events
)"""

USAGE_LONG = """
usage AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
         strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS usage_date,
         p_type AS product_code,
         p_type || ':' || l_returnflag AS usage_type,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS cost
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

SUMMARY = """
summary AS (
  SELECT usage_date, product_code AS service_name,
         SUM(COALESCE(CAST(cost AS DECIMAL(28,15)), 0)) AS daily_cost,
         CAST(COUNT(*) AS BIGINT) AS record_count
  FROM usage GROUP BY usage_date, product_code
)"""


def pct(cur: str, prev: str) -> str:
    return (f"CASE WHEN {prev} IS NULL OR {cur} IS NULL THEN NULL "
            f"WHEN CAST({prev} AS DOUBLE) <> 0 THEN CAST({cur} - {prev} AS DOUBLE) / CAST({prev} AS DOUBLE) "
            f"WHEN {cur} - {prev} > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN {cur} - {prev} < 0 THEN CAST('-Infinity' AS DOUBLE) "
            f"ELSE CAST('NaN' AS DOUBLE) END")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["daily_cost_summary"] = _with(USAGE, SUMMARY) + """
SELECT usage_date, service_name, CAST(daily_cost AS DOUBLE) AS daily_cost, record_count
FROM summary"""

SQL["cost_trend_7"] = _with(USAGE, SUMMARY) + """
SELECT usage_date, service_name, CAST(daily_cost AS DOUBLE) AS daily_cost, record_count,
       CASE WHEN COUNT(*) OVER w = 7 THEN CAST(SUM(daily_cost) OVER w AS DOUBLE) / 7.0 END AS cost_7d_avg
FROM summary
WINDOW w AS (PARTITION BY service_name ORDER BY usage_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

SQL["top_services"] = _with(USAGE, SUMMARY) + """
SELECT service_name, CAST(COALESCE(SUM(daily_cost), 0) AS DOUBLE) AS total_cost
FROM summary GROUP BY service_name
ORDER BY COALESCE(SUM(daily_cost), 0) DESC, service_name LIMIT 10"""

SQL["month_over_month"] = _with(USAGE_LONG, SUMMARY, """
monthly AS (
  SELECT service_name, substr(usage_date, 1, 7) AS month, SUM(daily_cost) AS monthly_cost
  FROM summary GROUP BY 1, 2
),
lagged AS (
  SELECT *, LAG(monthly_cost) OVER (PARTITION BY service_name ORDER BY month) AS prev
  FROM monthly
)""") + f"""
SELECT service_name, month, CAST(monthly_cost AS DOUBLE) AS monthly_cost,
       {pct('monthly_cost', 'prev')} AS pct_change
FROM lagged"""

SQL["weekly_anomalies"] = _with(USAGE_LONG, SUMMARY, """
weekly AS (
  SELECT service_name, strftime(CAST(usage_date AS DATE), '%Y-W%W') AS week,
         SUM(daily_cost) AS weekly_cost
  FROM summary GROUP BY 1, 2
),
lagged AS (
  SELECT *, LAG(weekly_cost) OVER (PARTITION BY service_name ORDER BY week) AS prev_weekly_cost
  FROM weekly
),
changed AS (
  SELECT *, """ + pct('weekly_cost', 'prev_weekly_cost') + """ AS pct_change FROM lagged
)""") + """
SELECT service_name, week, CAST(weekly_cost AS DOUBLE) AS weekly_cost,
       CAST(prev_weekly_cost AS DOUBLE) AS prev_weekly_cost, pct_change
FROM changed WHERE pct_change > 0.20"""

# --- dimensions ---------------------------------------------------------------------------

SALT = "costlake-demo-salt"
RUN_TS = "2024-02-01 00:00:00"

CATEGORY = ("COALESCE((SELECT m.category FROM (VALUES "
            + ", ".join(f"('{code}', '{category}')" for code, category in SERVICE_CATEGORIES.items())
            + ") AS m(code, category) WHERE m.code = {pc}), 'Other')")

DIM_SERVICE = """
obs AS (
  SELECT product_code, usage_type, MIN(usage_date) AS first_seen, MAX(usage_date) AS last_seen
  FROM usage GROUP BY product_code, usage_type
),
dim AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY product_code, usage_type) AS BIGINT) AS service_key,
         product_code, usage_type, """ + CATEGORY.format(pc="product_code") + """ AS service_category,
         first_seen AS first_seen_date, last_seen AS last_seen_date
  FROM obs
)"""

SQL["dim_service"] = _with(USAGE, DIM_SERVICE) + "SELECT * FROM dim"

SQL["dim_service_reload"] = _with(USAGE, """
obs1 AS (SELECT product_code, usage_type, MIN(usage_date) AS first_seen, MAX(usage_date) AS last_seen
         FROM usage WHERE usage_date < '2024-01-16' GROUP BY 1, 2),
k1 AS (SELECT ROW_NUMBER() OVER (ORDER BY product_code, usage_type) AS service_key, * FROM obs1),
obs2 AS (SELECT product_code, usage_type, MIN(usage_date) AS first_seen, MAX(usage_date) AS last_seen
         FROM usage GROUP BY 1, 2),
k2 AS (SELECT ROW_NUMBER() OVER (ORDER BY product_code, usage_type)
              + (SELECT COALESCE(MAX(service_key), 0) FROM k1) AS service_key, * FROM obs2)""") + """
SELECT CAST(COALESCE(k1.service_key, k2.service_key) AS BIGINT) AS service_key,
       COALESCE(k1.product_code, k2.product_code) AS product_code,
       COALESCE(k1.usage_type, k2.usage_type) AS usage_type,
       """ + CATEGORY.format(pc="COALESCE(k1.product_code, k2.product_code)") + """ AS service_category,
       CASE WHEN k1.product_code IS NOT NULL THEN k1.first_seen ELSE k2.first_seen END AS first_seen_date,
       CASE WHEN k2.product_code IS NOT NULL THEN k2.last_seen ELSE k1.last_seen END AS last_seen_date,
       CASE WHEN k1.product_code IS NOT NULL THEN 'load-1' ELSE 'load-2' END AS _loaded_at,
       CASE WHEN k2.product_code IS NOT NULL THEN 'load-2' ELSE 'load-1' END AS _updated_at
FROM k1 FULL OUTER JOIN k2 ON k1.product_code = k2.product_code AND k1.usage_type = k2.usage_type"""

SNAPSHOTS = """
v1 AS (
  SELECT c_custkey AS customer_id, lower(c_name) || '@example.com' AS email,
         '555-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone,
         regexp_extract(c_name, '^[^#]*') AS first_name, regexp_extract(c_name, '[^#]*$') AS last_name,
         c_mktsegment AS segment
  FROM customer WHERE c_custkey % 20 <> 19
),
v2 AS (
  SELECT c_custkey AS customer_id, lower(c_name) || '@example.com' AS email,
         CASE WHEN c_custkey % 11 = 5 THEN '556-' ELSE '555-' END || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone,
         regexp_extract(c_name, '^[^#]*') AS first_name, regexp_extract(c_name, '[^#]*$') AS last_name,
         CASE WHEN c_custkey % 7 = 3 THEN CASE WHEN c_mktsegment = 'BUILDING' THEN 'MACHINERY' ELSE 'BUILDING' END
              ELSE c_mktsegment END AS segment
  FROM customer
)"""


def _mask(src: str) -> str:
    return f"""
  SELECT customer_id, sha256(lower(trim(email)) || '{SALT}') AS email_token,
         'XXX-XXX-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS phone_redacted,
         first_name, last_name, segment
  FROM {src}"""


MASKED = f"""
m1 AS ({_mask('v1')}),
m2 AS ({_mask('v2')})"""

DIM_CUSTOMER = """
load1 AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY customer_id) AS BIGINT) AS customer_key, * FROM m1
),
ins2 AS (
  SELECT m2.* FROM m2 LEFT JOIN load1 l ON l.customer_id = m2.customer_id
  WHERE l.customer_id IS NULL OR l.segment IS DISTINCT FROM m2.segment
),
closed AS (SELECT i.customer_id FROM ins2 i JOIN load1 l ON l.customer_id = i.customer_id),
dimc AS (
  SELECT l.customer_key, l.customer_id, l.email_token, l.phone_redacted, l.first_name, l.last_name,
         l.segment, '2024-01-01' AS effective_from,
         CASE WHEN c.customer_id IS NOT NULL THEN '2024-01-15' END AS effective_to,
         c.customer_id IS NULL AS is_current, '2024-01-01' AS _loaded_at
  FROM load1 l LEFT JOIN closed c ON c.customer_id = l.customer_id
  UNION ALL
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY customer_id) + (SELECT MAX(customer_key) FROM load1) AS BIGINT),
         customer_id, email_token, phone_redacted, first_name, last_name, segment,
         '2024-01-15', CAST(NULL AS VARCHAR), TRUE, '2024-01-15'
  FROM ins2
)"""

SQL["masked_customers"] = _with(SNAPSHOTS, MASKED) + """
SELECT *, (position('@' IN email_token) = 0 AND length(email_token) = 64) AS email_masked,
       starts_with(phone_redacted, 'XXX-XXX-') AS phone_masked
FROM m2"""

SQL["snapshot_diff"] = _with(SNAPSHOTS) + """
SELECT COALESCE(n.customer_id, o.customer_id) AS customer_id,
       CASE WHEN o.customer_id IS NULL THEN 'new'
            WHEN n.customer_id IS NULL THEN 'removed'
            WHEN o.segment IS DISTINCT FROM n.segment THEN 'segment_changed'
            WHEN o.email IS DISTINCT FROM n.email OR o.phone IS DISTINCT FROM n.phone THEN 'contact_changed'
            ELSE 'unchanged' END AS change_type,
       o.segment AS old_segment, n.segment AS new_segment
FROM v1 o FULL OUTER JOIN v2 n ON o.customer_id = n.customer_id"""

SQL["dim_customer_scd2"] = _with(SNAPSHOTS, MASKED, DIM_CUSTOMER) + "SELECT * FROM dimc"

# --- facts ---------------------------------------------------------------------------------


def _service_daily(usage: str = "usage") -> str:
    """The view's costs are text with two decimals: summed as whole cents."""
    return f"""
  SELECT usage_date, service_key, CAST(cents AS DECIMAL(36,0)) * CAST(0.01 AS DECIMAL(3,2)) AS daily_cost,
         record_count, null_cost_count
  FROM (SELECT product_code, usage_type, usage_date, CAST(COUNT(*) AS BIGINT) AS record_count,
               CAST(COUNT(*) - COUNT(cost) AS BIGINT) AS null_cost_count,
               SUM(CAST(replace(COALESCE(cost, '0.00'), '.', '') AS BIGINT)) AS cents
        FROM {usage} GROUP BY ALL) per_type
  JOIN dim USING (product_code, usage_type)"""


SD = f"""
sd AS ({_service_daily()})"""

SQL["fact_daily_cost"] = _with(USAGE, DIM_SERVICE, SD) + """
SELECT usage_date, service_key, CAST(daily_cost AS DOUBLE) AS daily_cost, record_count, null_cost_count
FROM sd"""

SQL["fact_daily_upsert"] = _with(USAGE, DIM_SERVICE, """
usage1 AS (SELECT * FROM usage WHERE id IN (SELECT CAST(event_id AS VARCHAR) FROM events
                                            WHERE ts < TIMESTAMP '2024-01-20 12:00:00')),
usage2 AS (SELECT * FROM usage WHERE id IN (SELECT CAST(event_id AS VARCHAR) FROM events
                                            WHERE ts >= TIMESTAMP '2024-01-10 00:00:00')),""" + f"""
f1 AS ({_service_daily('usage1')}),
f2 AS ({_service_daily('usage2')})""") + """
SELECT COALESCE(f1.usage_date, f2.usage_date) AS usage_date,
       COALESCE(f1.service_key, f2.service_key) AS service_key,
       CAST(CASE WHEN f2.usage_date IS NOT NULL THEN f2.daily_cost ELSE f1.daily_cost END AS DOUBLE) AS daily_cost,
       CASE WHEN f2.usage_date IS NOT NULL THEN f2.record_count ELSE f1.record_count END AS record_count,
       CASE WHEN f2.usage_date IS NOT NULL THEN f2.null_cost_count ELSE f1.null_cost_count END AS null_cost_count,
       CASE WHEN f2.usage_date IS NOT NULL THEN 'run-2' ELSE 'run-1' END AS _loaded_at
FROM f1 FULL OUTER JOIN f2 ON f1.usage_date = f2.usage_date AND f1.service_key = f2.service_key"""



def _fact(dim: str, p: str = "") -> str:
    """Customer fact over the versions in ``dim``. Active versions of a date are
    those opened by then less those closed by then; a service-day's share is
    in whole cents, worked out before any customer is joined."""
    return f"""
{p}cc AS (
  SELECT usage_date, CAST(opened - closed AS BIGINT) AS active_count
  FROM (SELECT usage_date,
               (SELECT COUNT(*) FROM {dim} o WHERE o.effective_from <= days.usage_date) AS opened,
               (SELECT COUNT(*) FROM {dim} e WHERE e.effective_to <= days.usage_date) AS closed
        FROM (SELECT DISTINCT usage_date FROM sd) days) counted
  WHERE opened > closed
),
{p}share AS (
  SELECT usage_date, service_key, record_count, null_cost_count,
         CAST(sign(daily_cost) * ((CAST(abs(daily_cost) * 200 AS HUGEINT) + active_count) // (2 * active_count))
              AS DECIMAL(38,0)) AS alloc_cents
  FROM sd JOIN {p}cc USING (usage_date)
),
{p}fact AS (
  SELECT usage_date, customer_key, service_key, CAST(alloc_cents AS DOUBLE) / 100.0 AS allocated_cost, alloc_cents,
         record_count, null_cost_count
  FROM {dim} v JOIN {p}share
    ON usage_date >= effective_from AND (effective_to IS NULL OR usage_date < effective_to)
)"""


ACTIVE = _fact("dimc")

_CUST = (USAGE, DIM_SERVICE, SD, SNAPSHOTS, MASKED, DIM_CUSTOMER, ACTIVE)

SQL["active_customers"] = _with(*_CUST) + "SELECT usage_date, active_count FROM cc"

SQL["fact_customer_cost"] = _with(*_CUST) + """
SELECT usage_date, customer_key, service_key, allocated_cost, record_count, null_cost_count FROM fact"""

USAGE_TIMED = USAGE.replace("usage AS (", "bare AS (", 1) + """,
usage AS (
  SELECT id, product_code, usage_type, cost,
         usage_date || CASE WHEN CAST(substr(usage_date, 9, 2) AS INTEGER) % 3 = 1
                              OR CAST(substr(usage_date, 9, 2) AS INTEGER) % 10 = 0 THEN 'T00:00:00Z' ELSE '' END
         AS usage_date
  FROM bare
)"""

SQL["customer_cost_timed_dates"] = _with(USAGE_TIMED, *_CUST[1:]) + """
SELECT usage_date, customer_key, service_key, allocated_cost, record_count, null_cost_count FROM fact"""

SQL["fact_customer_upsert"] = _with(*_CUST, """
first_dim AS (SELECT customer_key, '2024-01-01' AS effective_from, CAST(NULL AS VARCHAR) AS effective_to FROM load1)""",
                                    _fact("first_dim", "old_")) + """
SELECT usage_date, customer_key, service_key, allocated_cost, record_count, null_cost_count, 'run-2' AS _loaded_at
FROM fact
UNION ALL
SELECT usage_date, customer_key, service_key, allocated_cost, record_count, null_cost_count, 'run-1'
FROM old_fact o ANTI JOIN fact f USING (usage_date, customer_key, service_key)"""

SQL["segment_cost"] = _with(*_CUST) + """
SELECT c.segment, CAST(SUM(f.alloc_cents) / 100 AS DOUBLE) AS total_cost
FROM fact f JOIN dimc c ON f.customer_key = c.customer_key
GROUP BY c.segment"""

SQL["distinct_customers_per_date"] = _with(*_CUST) + """
SELECT usage_date, CAST(COUNT(DISTINCT customer_key) AS BIGINT) AS customers FROM fact GROUP BY usage_date"""

SQL["enriched_fact"] = _with(USAGE, DIM_SERVICE, SD) + """
SELECT sd.usage_date, sd.service_key, d.product_code, d.usage_type, d.service_category,
       CAST(sd.daily_cost AS DOUBLE) AS daily_cost
FROM sd JOIN dim d ON sd.service_key = d.service_key
ORDER BY sd.daily_cost DESC, sd.usage_date, sd.service_key
LIMIT 5"""

# --- ingest / SQL surface ------------------------------------------------------------------------

SQL["new_usage_rows"] = _with(USAGE_LONG) + """
SELECT b.id AS identity_line_item_id, b.usage_date AS line_item_usage_start_date,
       b.product_code AS line_item_product_code, b.usage_type AS line_item_usage_type,
       b.cost AS line_item_unblended_cost
FROM usage b
WHERE b.usage_date >= '1998-01-01' AND b.id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM usage t WHERE t.usage_date < '1998-07-01' AND t.id = b.id)"""

SQL["segment_counts"] = _with(SNAPSHOTS, MASKED, DIM_CUSTOMER) + """
SELECT segment, CAST(COUNT(*) AS BIGINT) AS customers FROM dimc WHERE is_current GROUP BY segment"""

SQL["daily_cost_since"] = _with(USAGE, DIM_SERVICE, SD) + """
SELECT usage_date, service_key, CAST(daily_cost AS DOUBLE) AS daily_cost, record_count
FROM sd WHERE usage_date >= '2024-01-15'"""

# --- data quality ------------------------------------------------------------------------------------


def _orphan(label: str, fact: str, key: str, dim: str) -> str:
    return (f"SELECT '{label}' AS check_name, CAST(COUNT(*) AS BIGINT) AS violations FROM {fact} f "
            f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})")


SQL["dq_orphans"] = _with(*_CUST) + "\nUNION ALL\n".join([
    _orphan("fact_customer_cost.customer_key", "fact", "customer_key", "dimc"),
    _orphan("fact_customer_cost.service_key", "fact", "service_key", "dim"),
    _orphan("fact_daily_cost.service_key", "sd", "service_key", "dim"),
])


def _grain(label: str, table: str, keys: str) -> str:
    return (f"SELECT '{label}' AS table_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS row_count, "
            f"CAST(COUNT(*) AS BIGINT) AS distinct_keys, "
            f"CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_keys "
            f"FROM (SELECT {keys}, COUNT(*) AS n FROM {table} GROUP BY {keys}) g")


USAGE_LONG_NAMED = USAGE_LONG.replace("usage AS (", "usage_long AS (", 1)

GRAIN = "\nUNION ALL\n".join([
    _grain("dim_service", "dim", "service_key"),
    _grain("dim_service.natural_key", "dim", "product_code, usage_type"),
    _grain("dim_customer", "dimc", "customer_key"),
    _grain("fact_daily_cost", "sd", "usage_date, service_key"),
    _grain("fact_customer_cost", "fact", "usage_date, customer_key, service_key"),
    _grain("raw_usage", "usage", "id"),
    _grain("raw_usage_long", "usage_long", "id"),
])

SQL["dq_grain"] = _with(*_CUST, USAGE_LONG_NAMED) + GRAIN

SQL["override_status"] = _with(*_CUST, USAGE_LONG_NAMED, f"""
grain AS ({GRAIN}),
ledger AS (
  SELECT 'dq_grain:' || table_name AS evidence_id, 'C-06' AS control_id,
         CASE WHEN duplicate_keys > 0 THEN 'fail' ELSE 'pass' END AS status,
         CAST(NULL AS VARCHAR) AS remediation_status
  FROM grain
  UNION ALL
  SELECT 'override:' || table_name, 'C-11', 'pass', 'pending' FROM grain WHERE duplicate_keys > 0
),
o AS (SELECT COALESCE(remediation_status, 'unknown') AS rs FROM ledger WHERE control_id = 'C-11')""") + """
SELECT CAST(COUNT(*) AS BIGINT) AS overrides_found,
       CASE WHEN COUNT(*) = 0 THEN 'CLEAN'
            WHEN bool_and(rs = 'completed') THEN 'REMEDIATED'
            WHEN bool_or(rs = 'escalated') THEN 'ESCALATED'
            ELSE 'PENDING' END AS status
FROM o"""

SQL["dq_reconcile_counts"] = _with(USAGE, DIM_SERVICE, SD) + """
SELECT fact_records, raw_rows, raw_rows - fact_records AS unmatched FROM (
  SELECT CAST((SELECT COALESCE(SUM(record_count), 0) FROM sd) AS BIGINT) AS fact_records,
         CAST((SELECT COUNT(*) FROM usage) AS BIGINT) AS raw_rows) t"""

SQL["dq_reconcile_cost"] = _with(*_CUST, """
alloc AS (
  SELECT usage_date, service_key, CAST(SUM(alloc_cents) AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) AS total,
         COUNT(*) AS customers
  FROM fact GROUP BY usage_date, service_key
),
rc AS (
  SELECT COALESCE(a.usage_date, s.usage_date) AS usage_date, COALESCE(a.service_key, s.service_key) AS service_key,
         a.total, s.daily_cost, CAST(COALESCE(a.customers, 0) AS BIGINT) AS customers,
         COALESCE(a.total, 0) - COALESCE(s.daily_cost, 0) AS diff
  FROM alloc a FULL OUTER JOIN sd s ON a.usage_date = s.usage_date AND a.service_key = s.service_key
)""") + """
SELECT usage_date, service_key, CAST(total AS DOUBLE) AS allocated_total, CAST(daily_cost AS DOUBLE) AS daily_cost,
       customers, CAST(diff AS DOUBLE) AS diff,
       ABS(diff) <= customers * CAST(0.005 AS DECIMAL(10,6)) AS within_tolerance
FROM rc"""

DQ_SCD2 = """
SELECT 'multiple_current' AS check_name, CAST(COUNT(*) FILTER (WHERE first AND currents > 1) AS BIGINT) AS violations FROM scdw
UNION ALL SELECT 'no_current', CAST(COUNT(*) FILTER (WHERE first AND currents = 0) AS BIGINT) FROM scdw
UNION ALL SELECT 'closed_without_end', CAST(COUNT(*) FILTER (WHERE NOT is_current AND effective_to IS NULL) AS BIGINT) FROM scdw
UNION ALL SELECT 'current_with_end', CAST(COUNT(*) FILTER (WHERE is_current AND effective_to IS NOT NULL) AS BIGINT) FROM scdw
UNION ALL SELECT 'end_before_start', CAST(COUNT(*) FILTER (WHERE COALESCE(effective_to, '9999-12-31') < effective_from) AS BIGINT) FROM scdw
UNION ALL SELECT 'overlapping_versions', CAST(COUNT(*) FILTER (WHERE next_from IS NOT NULL AND next_from < COALESCE(effective_to, '9999-12-31')) AS BIGINT) FROM scdw
UNION ALL SELECT 'duplicate_customer_key', CAST(COUNT(*) AS BIGINT) FROM (SELECT customer_key FROM dimc GROUP BY customer_key HAVING COUNT(*) > 1) d"""

SCDW = """
scdw AS (
  SELECT *, LEAD(effective_from) OVER (PARTITION BY customer_id ORDER BY effective_from, customer_key) AS next_from,
         COUNT(*) FILTER (WHERE is_current) OVER (PARTITION BY customer_id) AS currents,
         ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY effective_from, customer_key) = 1 AS first
  FROM dimc
)"""

SQL["dq_scd2"] = _with(SNAPSHOTS, MASKED, DIM_CUSTOMER, SCDW) + DQ_SCD2

DQ_RANGES = """
SELECT 'null_cost' AS check_name, CAST(COUNT(*) FILTER (WHERE daily_cost IS NULL) AS BIGINT) AS violations FROM sd
UNION ALL SELECT 'negative_cost', CAST(COUNT(*) FILTER (WHERE daily_cost < 0) AS BIGINT) FROM sd
UNION ALL SELECT 'non_positive_record_count', CAST(COUNT(*) FILTER (WHERE record_count <= 0) AS BIGINT) FROM sd
UNION ALL SELECT 'negative_null_cost_count', CAST(COUNT(*) FILTER (WHERE null_cost_count < 0) AS BIGINT) FROM sd
UNION ALL SELECT 'null_service_key', CAST(COUNT(*) FILTER (WHERE service_key IS NULL) AS BIGINT) FROM sd
UNION ALL SELECT 'more_than_2dp', CAST(COUNT(*) FILTER (WHERE daily_cost IS NOT NULL AND ROUND(daily_cost, 2) <> daily_cost) AS BIGINT) FROM sd
UNION ALL SELECT 'empty_usage_date', CAST(COUNT(*) FILTER (WHERE usage_date IS NULL OR length(usage_date) = 0) AS BIGINT) FROM sd"""

SQL["dq_ranges"] = _with(USAGE, DIM_SERVICE, SD) + DQ_RANGES

DQ_PII = """
SELECT 'email_token_has_at' AS check_name, CAST(COUNT(*) FILTER (WHERE contains(email_token, '@')) AS BIGINT) AS violations FROM dimc
UNION ALL SELECT 'email_token_not_sha256_hex', CAST(COUNT(*) FILTER (WHERE NOT regexp_full_match(email_token, '[0-9a-f]{64}')) AS BIGINT) FROM dimc
UNION ALL SELECT 'phone_not_redacted', CAST(COUNT(*) FILTER (WHERE NOT regexp_full_match(phone_redacted, 'XXX-XXX-[0-9]{4}')) AS BIGINT) FROM dimc
UNION ALL SELECT 'pii_column_in_fact', CAST(0 AS BIGINT)"""

SQL["dq_pii"] = _with(SNAPSHOTS, MASKED, DIM_CUSTOMER) + DQ_PII

SQL["control_coverage"] = _with(USAGE, DIM_SERVICE, SD, SNAPSHOTS, MASKED, DIM_CUSTOMER, SCDW, f"""
ledger AS (
  SELECT 'dq_pii:' || check_name AS evidence_id, 'C-04' AS control_id,
         CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({DQ_PII}) a
  UNION ALL
  SELECT 'dq_ranges:' || check_name, 'C-06', CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END FROM ({DQ_RANGES}) b
  UNION ALL
  SELECT 'dq_scd2:' || check_name, 'C-08', CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END FROM ({DQ_SCD2}) c
),
required AS (SELECT * FROM (VALUES ('C-04'), ('C-05'), ('C-06'), ('C-08')) r(control_id)),
per AS (
  SELECT r.control_id, CASE WHEN p.n IS NOT NULL THEN 'SATISFIED' ELSE 'MISSING' END AS status,
         CAST(COALESCE(p.n, 0) AS BIGINT) AS evidence_count
  FROM required r
  LEFT JOIN (SELECT control_id, COUNT(*) AS n FROM ledger WHERE status = 'pass' GROUP BY control_id) p
    ON p.control_id = r.control_id
)""") + """
SELECT *, CASE WHEN MIN(CASE WHEN status = 'SATISFIED' THEN 1 ELSE 0 END) OVER () = 1 THEN 'READY' ELSE 'BLOCKED' END
       AS gate_result
FROM per"""

SQL["usage_metrics"] = _with(USAGE) + """
SELECT CAST(COUNT(*) AS BIGINT) AS rows_read,
       CAST(COUNT(*) FILTER (WHERE cost IS NULL) AS BIGINT) AS null_cost,
       CAST(COUNT(*) FILTER (WHERE cost IS NULL OR CAST(cost AS DECIMAL(28,15)) = 0) AS BIGINT) AS zero_or_null_cost,
       CAST(COUNT(*) FILTER (WHERE id IS NULL) AS BIGINT) AS null_id
FROM usage"""

SQL["duplicate_usage_ids"] = _with(USAGE_LONG) + """
SELECT id AS identity_line_item_id, CAST(COUNT(*) AS BIGINT) AS n
FROM usage GROUP BY id HAVING COUNT(*) > 1"""

# --- inputs with faults ------------------------------------------------------------------------------

SQL["dq_orphans_old_dims"] = _with(*_CUST, """
old_dim AS (SELECT * FROM dim WHERE usage_type NOT LIKE '%:2')""") + "\nUNION ALL\n".join([
    _orphan("fact_customer_cost.customer_key", "fact", "customer_key", "load1"),
    _orphan("fact_customer_cost.service_key", "fact", "service_key", "old_dim"),
    _orphan("fact_daily_cost.service_key", "sd", "service_key", "old_dim"),
])

SQL["dq_ranges_faulty"] = _with(USAGE, DIM_SERVICE, SD, """
faulty AS (
  SELECT CASE WHEN usage_date[10] = '4' THEN '' ELSE usage_date END AS usage_date,
         CASE WHEN usage_date[10] = '3' THEN NULL ELSE service_key END AS service_key,
         CASE service_key % 5 WHEN 0 THEN NULL WHEN 1 THEN -1 - abs(CAST(daily_cost AS DECIMAL(30,3)))
              WHEN 2 THEN CAST(daily_cost AS DECIMAL(30,3)) + CAST(0.001 AS DECIMAL(4,3))
              ELSE CAST(daily_cost AS DECIMAL(30,3)) END AS daily_cost,
         CASE service_key % 4 WHEN 0 THEN 0 ELSE record_count END AS record_count,
         CASE service_key % 4 WHEN 1 THEN -1 ELSE null_cost_count END AS null_cost_count
  FROM sd
)""") + DQ_RANGES.replace("FROM sd", "FROM faulty")

SQL["dq_scd2_faulty"] = _with(SNAPSHOTS, MASKED, DIM_CUSTOMER, """
faulty AS (
  SELECT customer_id, effective_from,
         customer_key - CASE WHEN customer_id % 13 = 5 THEN customer_key % 2 ELSE 0 END AS customer_key,
         CASE customer_id % 13 WHEN 4 THEN '2023-12-31' WHEN 3 THEN NULL ELSE effective_to END AS effective_to,
         CASE customer_id % 13 WHEN 1 THEN TRUE WHEN 2 THEN FALSE ELSE is_current END AS is_current
  FROM dimc
)""", SCDW.replace("FROM dimc", "FROM faulty")) + DQ_SCD2.replace("FROM dimc", "FROM faulty")

SQL["dq_pii_faulty"] = _with(USAGE, DIM_SERVICE, SD, SNAPSHOTS, MASKED, DIM_CUSTOMER, """
faulty AS (
  SELECT CASE customer_id % 7 WHEN 1 THEN first_name || '@example.com' WHEN 2 THEN upper(email_token)
              ELSE email_token END AS email_token,
         CASE customer_id % 7 WHEN 3 THEN '555-000' || customer_id ELSE phone_redacted END AS phone_redacted
  FROM dimc
),
leaky AS (SELECT *, '' AS "Email", '' AS phone FROM sd LIMIT 1)""") + DQ_PII.replace("FROM dimc", "FROM faulty").replace(
    "CAST(0 AS BIGINT)", """CAST(COUNT(*) AS BIGINT) FROM (SELECT lower(unnest(json_keys(to_json(leaky)))) AS k FROM leaky) c
  WHERE k IN ('email', 'phone', 'first_name', 'last_name')""")

USAGE_BY_CODE = USAGE.replace("usage AS (", "plain AS (", 1) + """,
usage AS (
  SELECT id, usage_date, usage_type, cost,
         CASE WHEN CAST(id AS BIGINT) % 9 < 6 THEN """ + repr(sorted(SERVICE_CATEGORIES)) + """[CAST(id AS BIGINT) % 9 + 1]
              ELSE product_code END AS product_code
  FROM plain
)"""

SQL["dim_service_growth"] = SQL["dim_service_reload"].replace(_with(USAGE)[:-1], _with(USAGE_BY_CODE)[:-1]).replace(
    "FROM usage WHERE usage_date < '2024-01-16'",
    "FROM usage WHERE usage_date < '2024-01-16' AND product_code NOT IN " + str(tuple(sorted(SERVICE_CATEGORIES))))

SQL["top_services_ties"] = _with(USAGE_LONG.replace("usage AS (", "priced AS (", 1), """
usage AS (SELECT * REPLACE (CASE WHEN usage_type LIKE 'S%' THEN '-' || cost ELSE '0' END AS cost,
                            usage_type AS product_code) FROM priced)""",
                                 SUMMARY) + SQL["top_services"].removeprefix(_with(USAGE, SUMMARY))

SQL["weekly_anomalies_from_zero"] = SQL["weekly_anomalies"].replace(USAGE_LONG, USAGE_LONG.replace(
    "usage AS (", "priced AS (", 1) + """,
usage AS (SELECT * REPLACE (CASE WHEN CAST(usage_date[9:10] AS INTEGER) <= 15 THEN '0.00' ELSE cost END AS cost) FROM priced)""")

SQL["masked_customers_padded"] = _with(SNAPSHOTS, MASKED) + "SELECT * FROM m2"

SQL["usage_metrics_faulty"] = SQL["usage_metrics"].replace(USAGE, USAGE.replace("usage AS (", "priced AS (", 1) + """,
usage AS (SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 50 = 8 THEN '0.00' ELSE cost END AS cost,
                            CASE WHEN CAST(id AS BIGINT) % 40 <> 3 THEN id END AS id) FROM priced)""")

SQL["control_evidence"] = f"""
SELECT evidence_id, control_id FROM (
  SELECT 'dq_ranges_faulty:' || check_name AS evidence_id, 'C-06' AS control_id, violations FROM ({SQL["dq_ranges_faulty"]}) r
  UNION ALL SELECT 'dq_scd2_faulty:' || check_name, 'C-08', violations FROM ({SQL["dq_scd2_faulty"]}) v
  UNION ALL SELECT 'dq_ranges:' || check_name, 'C-07', violations FROM ({SQL["dq_ranges"]}) c) ledger
WHERE violations < 20 AND control_id IN ('C-04', 'C-05', 'C-06', 'C-08')"""


# --- appends, loads and replays ----------------------------------------------------------------

SQL["append_indexed"] = _with(USAGE_LONG, """
dealt AS (
  SELECT *, CASE WHEN usage_date < '1996-06-01' THEN 1 WHEN usage_date < '1998-01-01' THEN 2
                 WHEN usage_date < '1999-09-01' THEN 3 ELSE 4 END AS batch FROM usage
),
owner AS (SELECT id, MIN(batch) AS batch FROM dealt GROUP BY id)""") + """
SELECT id AS identity_line_item_id, usage_date AS line_item_usage_start_date, product_code AS line_item_product_code,
       cost AS line_item_unblended_cost, 'batch-' || CAST(batch AS VARCHAR) AS load_id
FROM dealt JOIN owner USING (id, batch)"""


def _service_loads(cuts: list[str]) -> str:
    """Four full loads, each over every line up to its cut."""
    ctes, outs = [], []
    for i, cut in enumerate([*cuts, "9999"], 1):
        ctes.append(f"seen{i} AS (SELECT product_code, usage_type, MIN(usage_date) AS a, MAX(usage_date) AS b "
                    f"FROM usage WHERE usage_date < '{cut}' GROUP BY 1, 2)")
        top = f"(SELECT COALESCE(MAX(service_key), 0) FROM load{i - 1})" if i > 1 else "0"
        key = f"ROW_NUMBER() OVER (ORDER BY product_code, usage_type) + {top}"
        new = (f"SELECT CAST(service_key AS BIGINT) AS service_key, product_code, usage_type, a AS first_seen_date, b AS last_seen_date, "
               f"'load-{i}' AS _loaded_at, 'load-{i}' AS _updated_at FROM (SELECT *, {key} AS service_key FROM seen{i}) k")
        if i > 1:
            new = (f"SELECT o.service_key, o.product_code, o.usage_type, o.first_seen_date, s.b AS last_seen_date, o._loaded_at, "
                   f"'load-{i}' AS _updated_at FROM load{i - 1} o JOIN seen{i} s USING (product_code, usage_type) UNION ALL "
                   f"{new} WHERE NOT EXISTS (SELECT 1 FROM load{i - 1} o WHERE o.product_code = k.product_code AND o.usage_type = k.usage_type)")
        ctes.append(f"load{i} AS ({new})")
        outs.append(f"SELECT CAST({i} AS BIGINT) AS load, *, {CATEGORY.format(pc='product_code')} AS service_category FROM load{i}")
    return ", ".join(ctes) + "\n" + " UNION ALL ".join(outs)


_CODES = "[" + ", ".join(f"'{c}'" for c in sorted(SERVICE_CATEGORIES)) + "]"
SQL["dim_service_incremental"] = f"""WITH {USAGE.replace("usage AS", "plain AS")},
usage AS (SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 9 < {len(SERVICE_CATEGORIES)}
                                 THEN ({_CODES})[CAST(id AS BIGINT) % 9 + 1] ELSE product_code END AS product_code) FROM plain),
""" + _service_loads(["2024-01-08", "2024-01-15", "2024-01-22"])


def _snapshot_loads(dates: list[str]) -> str:
    """CTEs ``dim0..``: one load after the other, each closing what changed."""
    out = []
    for k, d in enumerate(dates):
        moved = f"((c_custkey + {k}) % 7 = 3 OR (c_custkey + {2 * k}) % 13 = 1)"
        out.append(f"""s{k} AS (
  SELECT c_custkey AS customer_id, sha256(lower(c_name) || '@example.com' || '{SALT}') AS email_token,
         'XXX-XXX-' || right(lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 4) AS phone_redacted,
         regexp_extract(c_name, '^[^#]*') AS first_name, regexp_extract(c_name, '[^#]*$') AS last_name,
         CASE WHEN NOT {moved} THEN c_mktsegment WHEN c_mktsegment = 'BUILDING' THEN 'MACHINERY' ELSE 'BUILDING' END AS segment
  FROM customer WHERE (c_custkey + {3 * k}) % 11 <> 0)""")
        before = f"dim{k - 1}" if k else "(SELECT CAST(0 AS BIGINT) AS customer_key, s0.*, '' AS effective_from, CAST(NULL AS VARCHAR) AS effective_to, TRUE AS is_current FROM s0 WHERE FALSE)"
        out.append(f"""n{k} AS (
  SELECT s.* FROM s{k} s LEFT JOIN {before} o ON o.customer_id = s.customer_id AND o.is_current
  WHERE o.customer_id IS NULL OR o.segment IS DISTINCT FROM s.segment)""")
        out.append(f"""dim{k} AS (
  SELECT o.* REPLACE (CASE WHEN o.is_current AND n.customer_id IS NOT NULL THEN '{d}' ELSE o.effective_to END AS effective_to,
                      o.is_current AND n.customer_id IS NULL AS is_current)
  FROM {before} o LEFT JOIN n{k} n ON n.customer_id = o.customer_id
  UNION ALL
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY customer_id) + (SELECT COALESCE(MAX(customer_key), 0) FROM {before}) AS BIGINT), n.*,
         '{d}', CAST(NULL AS VARCHAR), TRUE FROM n{k} n)""")
    return "WITH " + ",\n".join(out)


SQL["scd2_replay"] = _snapshot_loads(["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01", "2024-02-15"]) + """
SELECT *, effective_from AS _loaded_at FROM dim5"""

SQL["active_pairs_long"] = _snapshot_loads(["1995-03-01", "1996-01-15", "1997-07-01", "1998-02-10", "1999-12-31", "2001-06-01"]) + """,
days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
SELECT customer_key, COUNT(*) AS n_dates, strftime(MIN(d), '%Y-%m-%d') AS first_date, strftime(MAX(d), '%Y-%m-%d') AS last_date,
       CAST(SUM(date_diff('day', DATE '1990-01-01', d)) AS BIGINT) AS day_sum
FROM dim5 JOIN days ON d >= CAST(effective_from AS DATE) AND (effective_to IS NULL OR d < CAST(effective_to AS DATE))
GROUP BY customer_key"""

SQL["distinct_customers_range"] = """
WITH ranges(range_start, range_end) AS (VALUES ('2024-01-01', '2024-01-08'), ('2024-01-05', '2024-01-20'),
  ('2024-01-10', '2024-01-11'), ('2024-01-01', '2024-03-01'), ('2023-01-01', '2023-02-01'))
SELECT range_start, range_end, COUNT(DISTINCT user_id) AS exact, TRUE AS within_2pct
FROM ranges JOIN events ON CAST(ts AS DATE) >= CAST(range_start AS DATE) AND CAST(ts AS DATE) < CAST(range_end AS DATE)
GROUP BY range_start, range_end"""

SQL["stream_ingest"] = _with(USAGE) + """
SELECT id AS identity_line_item_id, usage_date AS line_item_usage_start_date, product_code AS line_item_product_code,
       usage_type AS line_item_usage_type, cost AS line_item_unblended_cost FROM usage"""

SQL["variant_usage"] = """
WITH texts AS (
  SELECT event_id, '{"line": {"id": "' || event_id || '", "day": ' ||
         CASE WHEN event_id % 101 = 9 THEN '{}' ELSE '"' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '"' END ||
         '}, "product": {"code": "' || event_type || '", "types": ["' || event_type || ':' || (event_id % 3) || '", "x"]}, "cost": ' ||
         CASE WHEN event_id % 89 = 3 THEN '"n/a"' WHEN event_id % 50 = 7 THEN 'null'
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END || '}' AS whole FROM events
),
cut AS (SELECT event_id, CASE WHEN event_id % 97 = 5 THEN left(whole, length(whole) - 9) ELSE whole END AS t FROM texts),
j AS (SELECT event_id, CASE WHEN json_valid(t) THEN CAST(t AS JSON) END AS j FROM cut),
p AS (SELECT event_id, j,
             CASE WHEN json_type(j, '$.line.day') = 'VARCHAR' THEN j->>'$.line.day' END AS usage_date,
             CASE WHEN json_type(j, '$.cost') IN ('DOUBLE', 'UBIGINT', 'BIGINT') THEN CAST(CAST(j->>'$.cost' AS DECIMAL(18,2)) AS DOUBLE) END AS cost FROM j)
SELECT event_id, j->>'$.line.id' AS id, usage_date, j->>'$.product.code' AS product_code,
       j->>'$.product.types[0]' AS usage_type, cost,
       CASE WHEN j IS NULL THEN 'no JSON'
            ELSE nullif(concat_ws(',', CASE WHEN usage_date IS NULL THEN 'usage_date' END,
                                  CASE WHEN json_type(j, '$.cost') = 'VARCHAR' THEN 'cost' END), '') END AS problem
FROM p"""

SQL["ledger_from_files"] = """
WITH e AS (
  SELECT o_orderkey AS n, 'E-' || o_orderkey AS evidence_id, 'C-0' || (o_orderkey % 9) AS control_id,
         CASE WHEN o_orderstatus = 'F' THEN 'pass' ELSE 'fail' END AS status,
         CASE WHEN o_orderkey % 19 <> 4 THEN CAST(1 AS BIGINT) END AS deferred FROM orders
),
r AS (SELECT *, CASE WHEN n % 17 = 3 OR n % 29 = 7 THEN 'not a ledger entry'
                     WHEN n % 23 = 5 THEN 'no control_id' END AS reason FROM e)
SELECT evidence_id, CASE WHEN reason IS NULL THEN control_id END AS control_id, CASE WHEN reason IS NULL THEN status END AS status,
       CASE WHEN reason IS NULL THEN deferred END AS deferred, reason
FROM r"""

SQL["customer_slice"] = _with(*_CUST) + """
SELECT f.usage_date, f.customer_key, f.service_key, f.allocated_cost, f.record_count, f.null_cost_count
FROM fact f JOIN dimc c USING (customer_key) WHERE c.customer_id % 100 = 0"""

SQL["fact_customer_upsert_bucketed"] = SQL["fact_customer_upsert"]

SQL["dq_grain_bucketed"] = _with(*_CUST, USAGE_LONG_NAMED, f"grains AS ({GRAIN})") + """
SELECT * FROM grains WHERE table_name = 'fact_customer_cost'"""

SQL["segment_cost_of_fact"] = SQL["segment_cost"]
SQL["warehouse_rebuild"] = SQL["fact_customer_cost"]

SQL["deferred_controls"] = """
WITH l AS (
  SELECT o_orderkey AS n, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS deadline,
         CASE WHEN o_orderkey % 5 = 1 THEN 'completed' WHEN o_orderkey % 7 = 2 THEN 'pending'
              WHEN o_orderkey % 1009 = 3 THEN 'escalated' END AS state
  FROM orders WHERE o_orderkey % 3 = 0
),
d AS (SELECT n, deadline, state, unnest(['C-0' || (n % 4), 'C-06']) AS control_id FROM l
      WHERE n % 11 <> 4 AND state IS DISTINCT FROM 'completed')
SELECT control_id, COUNT(*) AS open_overrides, COALESCE(bool_or(state = 'escalated'), FALSE) AS escalated,
       MIN(deadline) AS first_deadline FROM d GROUP BY control_id"""
