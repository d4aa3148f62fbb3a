"""Shared parts of the oracle SQL: the same derivations, written for DuckDB."""

TX = """
raw_lines AS (
  SELECT *, (l_orderkey * 7919 + l_partkey * 104729 + l_linenumber) % 86400 AS secs
  FROM lineitem
),
tx AS (
  SELECT
    l_orderkey, l_linenumber, l_partkey, l_suppkey,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS transaction_amount,
    CASE WHEN l_orderkey % 211 = 0 THEN NULL
         WHEN l_orderkey % 223 = 0 THEN 'not a date'
         WHEN l_orderkey % 227 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
         ELSE strftime(l_shipdate + to_seconds(secs), '%Y-%m-%d %H:%M:%S') END AS transaction_date,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
         WHEN l_orderkey % 4 = 0 THEN 'debit card'
         WHEN l_orderkey % 4 = 1 THEN 'bank transfer'
         WHEN l_orderkey % 4 = 2 THEN 'PayPal'
         ELSE 'credit card' END AS payment_method,
    p_type AS product_category,
    CASE WHEN l_partkey % 103 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN 0
         ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    CASE WHEN o_custkey % 89 = 0 THEN NULL
         ELSE CAST(15 + o_custkey % 60 AS INTEGER) END AS customer_age,
    CASE WHEN o_custkey % 79 = 0 THEN NULL
         ELSE cn.n_name || ', Côte ' || c_mktsegment END AS customer_location,
    CASE WHEN l_partkey % 3 = 0 THEN 'desktop' WHEN l_partkey % 3 = 1 THEN 'mobile'
         ELSE 'tablet' END AS device_used,
    concat_ws('.', '10', l_orderkey % 256, l_partkey % 256, l_suppkey % 256) AS ip_address,
    CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE sn.n_name END AS shipping_address,
    CASE WHEN o_custkey % 73 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN cn.n_name
         ELSE sn.n_name END AS billing_address,
    CASE WHEN l_orderkey % 131 = 0 THEN NULL
         WHEN l_returnflag = 'R' AND l_linestatus = 'F'
              AND (secs < 43200 OR l_extendedprice > 50000) THEN 1
         ELSE 0 END AS is_fraudulent,
    CAST(l_partkey % 365 AS INTEGER) AS account_age_days,
    CASE WHEN l_orderkey % 83 = 0 THEN NULL
         ELSE CAST(secs // 3600 AS INTEGER) END AS transaction_hour,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date
  FROM raw_lines
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
)"""

FEATURES = """
timed AS (SELECT *, try_cast(transaction_date AS TIMESTAMP) AS ts FROM tx),
feat AS (
  SELECT *,
    CAST(day(ts) AS INTEGER) AS day_of_month,
    CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
    CAST(month(ts) AS INTEGER) AS month,
    CASE WHEN shipping_address <> billing_address THEN 1 ELSE 0 END AS address_mismatch,
    CASE WHEN quantity > 0 THEN CAST(transaction_amount AS DOUBLE) / quantity
         ELSE CAST(transaction_amount AS DOUBLE) END AS amount_per_quantity,
    CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN transaction_hour >= 22 OR transaction_hour <= 5 THEN 1 ELSE 0 END AS is_night_time
  FROM timed
)"""

AGE_GROUP = """CASE WHEN customer_age IS NULL THEN 'Unknown' WHEN customer_age < 20 THEN 'Under 20'
  WHEN customer_age < 30 THEN '20-29' WHEN customer_age < 40 THEN '30-39'
  WHEN customer_age < 50 THEN '40-49' ELSE '50+' END"""


def _dim(name: str, raw: str, column: str, key: str) -> str:
    return f"""
{name} AS (
  SELECT {raw} AS {column}, row_number() OVER (ORDER BY {raw} NULLS FIRST) - 1 AS {key}
  FROM (SELECT DISTINCT {raw} FROM tx)
)"""


DIMS = ",".join(
    [
        _dim("dim_payment_methods", "payment_method", "payment_method", "payment_method_id"),
        _dim("dim_product_categories", "product_category", "product_category", "product_category_id"),
        _dim("dim_devices", "device_used", "device_type", "device_id"),
        f"""
dim_customers AS (
  SELECT DISTINCT customer_id, customer_age, customer_location, account_age_days,
    {AGE_GROUP} AS age_group
  FROM tx
)""",
        """
dim_time AS (
  SELECT DISTINCT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_id, transaction_hour,
    day_of_week AS transaction_dayofweek, month AS transaction_month,
    CAST(year(ts) AS INTEGER) AS transaction_year
  FROM feat
)""",
        """
fact_transactions AS (
  SELECT transaction_id, customer_id, transaction_amount, quantity,
    CASE WHEN is_fraudulent = 1 THEN 'true' ELSE 'false' END AS is_fraudulent,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp,
    CAST(payment_method_id AS VARCHAR) AS payment_method_id,
    CAST(product_category_id AS VARCHAR) AS product_category_id,
    CAST(device_id AS VARCHAR) AS device_id
  FROM feat f
  LEFT JOIN dim_payment_methods p ON f.payment_method = p.payment_method
  LEFT JOIN dim_product_categories c ON f.product_category = c.product_category
  LEFT JOIN dim_devices d ON f.device_used = d.device_type
)""",
        """
fact AS (
  SELECT transaction_id, customer_id, transaction_amount, quantity,
    CAST(is_fraudulent AS BOOLEAN) AS is_fraudulent,
    CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp,
    CAST(payment_method_id AS INTEGER) AS payment_method_id,
    CAST(product_category_id AS INTEGER) AS product_category_id,
    CAST(device_id AS INTEGER) AS device_id
  FROM fact_transactions
)""",
    ]
)

MART_PAYMENT = """
  SELECT payment_method, COUNT(*) AS transaction_count
  FROM fact JOIN dim_payment_methods USING (payment_method_id) GROUP BY payment_method"""
MART_DEVICE = """
  SELECT device_type, COUNT(*) AS transaction_count
  FROM fact JOIN dim_devices USING (device_id) GROUP BY device_type"""
MART_AGE = """
  SELECT age_group,
    round(CAST(SUM(transaction_amount) AS DOUBLE) / COUNT(transaction_amount), 6) AS average_amount
  FROM fact JOIN dim_customers USING (customer_id) GROUP BY age_group"""
MART_MONTH = """
  SELECT strftime(transaction_timestamp, '%B') AS transaction_month,
    CAST(month(transaction_timestamp) AS INTEGER) AS month_number, COUNT(*) AS transaction_count
  FROM fact GROUP BY 1, 2"""
MART_FRAUD = """
  SELECT CASE WHEN is_fraudulent THEN 'Fraudulent' ELSE 'Non-Fraudulent' END AS transaction_type,
    COUNT(*) AS transaction_count
  FROM fact GROUP BY 1"""
MART_CATEGORY = """
  SELECT product_category, CAST(SUM(transaction_amount) AS DOUBLE) AS total_transaction_amount
  FROM fact JOIN dim_product_categories USING (product_category_id) GROUP BY product_category"""

# Fraud results as the validating stream emits them, and as the dashboard reads them.
RESULTS = """
results AS (
  SELECT transaction_id, is_fraudulent <> 0 AS is_fraud, transaction_date AS "timestamp",
    CAST(transaction_amount AS DOUBLE) AS amount, payment_method, product_category
  FROM tx
  WHERE transaction_date IS NOT NULL AND transaction_date <> '' AND is_fraudulent IS NOT NULL
),
dash AS (
  SELECT * REPLACE (
    try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
    CASE lower(payment_method) WHEN 'credit card' THEN 'Credit Card'
      WHEN 'debit card' THEN 'Debit Card' WHEN 'bank transfer' THEN 'Bank Transfer'
      WHEN 'paypal' THEN 'PayPal' ELSE 'unknown' END AS payment_method)
  FROM results
  WHERE try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') IS NOT NULL
)"""


def over(select: str, *parts: str) -> str:
    """A full statement: the named parts as WITH clauses, then the SELECT."""
    return "WITH " + ",".join(parts) + "\n" + select.strip()


def box_sql(source: str, group: str, value: str) -> str:
    return f"""
SELECT {group}, COUNT({value}) AS n, CAST(MIN({value}) AS DOUBLE) AS lowest,
  round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  CAST(MAX({value}) AS DOUBLE) AS highest,
  round(q1 - 1.5 * (q3 - q1), 6) AS lower_fence, round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence
FROM {source} JOIN (
  SELECT {group},
    quantile_cont(CAST({value} AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST({value} AS DOUBLE), 0.5) AS median,
    quantile_cont(CAST({value} AS DOUBLE), 0.75) AS q3
  FROM {source} GROUP BY {group}) cuts USING ({group})
GROUP BY {group}, q1, median, q3"""
