"""Features, profiles, star schema, reports, exploration and dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.functions import features as fx
from txnlens.functions import privacy
from txnlens.ml.split import hash_split
from txnlens.operators import quality, star
from txnlens.plans import dashboard, eda, marts
from txnlens.plans.daily import write_star
from txnlens.registry import oracle as sql
from txnlens.session import once
from txnlens.sources.tables import transactions

TX, FEATURES, DIMS, RESULTS, over = sql.TX, sql.FEATURES, sql.DIMS, sql.RESULTS, sql.over

DS = "2025-05-25"

DEVICES = ["desktop", "mobile", "tablet"]

CUSTOMER_COLUMNS = ["customer_id", "customer_age", "customer_location", "account_age_days"]

#: Points per label of the sampled scatter.
SCATTER = 500

RESULT_COLUMNS = [
    "transaction_id",
    "is_fraud",
    "timestamp",
    "amount",
    "payment_method",
    "product_category",
]


def batch_results(
    spark: SparkSession, sf_dir: str, columns: list[str] = RESULT_COLUMNS
) -> DataFrame:
    """Fraud results of the stored transactions, as the stream would emit them."""
    names = {"is_fraud": "is_fraudulent", "timestamp": "transaction_date", "amount": "transaction_amount"}
    needed = {names.get(c, c) for c in columns} | {"is_fraudulent", "transaction_date"}
    raw = transactions(spark, sf_dir, sorted(needed))
    date = F.col("transaction_date")
    valid = raw.where(date.isNotNull() & (date != "") & F.col("is_fraudulent").isNotNull())
    found = valid.withColumn("is_fraudulent", F.col("is_fraudulent").cast("boolean"))
    return found.select(*(F.col(names.get(c, c)).alias(c) for c in columns))


def _with_raw(columns, build):
    return lambda spark, sf_dir: build(transactions(spark, sf_dir, columns))


def _with_rows(build, columns=("is_fraud", "timestamp", "payment_method")):
    """A dashboard query; only the result columns it reads are computed."""
    return lambda spark, sf_dir: build(
        dashboard.dashboard_rows(batch_results(spark, sf_dir, list(columns)))
    )


def _star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the stored, typed star schema, which is written once per session."""
    base = once(spark, f"star {sf_dir}", lambda path: write_star(transactions(spark, sf_dir), path, DS), sf_dir)
    return spark.read.parquet(f"{base}/{name}/ds={DS}")


def _mart(build, *dims):
    """A report over the stored fact and the dimensions it joins."""
    return lambda spark, sf_dir: build(*(_star(spark, sf_dir, name) for name in ("fact_transactions", *dims)))


def _chart(mart, dimension: str, metric: str, name: str | None = None):
    """The roll-up one chart runs over one report."""
    return lambda spark, sf_dir: marts.chart(
        mart(spark, sf_dir), [dimension], F.sum(metric), name or metric
    )


def _dim(name: str):
    raw_column = star.CATEGORY_DIMS[name][0]
    return _with_raw([raw_column], lambda raw: star.category_dims(raw, [name])[name])


def _fact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = transactions(spark, sf_dir)
    fact = star.fact_transactions(raw, star.category_dims(raw))
    return fact.withColumn("transaction_amount", F.col("transaction_amount").cast("double"))


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = transactions(spark, sf_dir)
    dims = star.category_dims(raw)
    return quality.row_counts(
        {
            "dim_customers": star.dim_customers(transactions(spark, sf_dir, CUSTOMER_COLUMNS)),
            **dims,
            "dim_time": star.dim_time(
                transactions(spark, sf_dir, ["transaction_date", "transaction_hour"])
            ),
            # Each fact row is a raw row: the dimension joins neither drop nor repeat any.
            "fact_transactions": transactions(spark, sf_dir, ["transaction_id"]),
        }
    )


def _split_ratio(raw: DataFrame) -> DataFrame:
    return quality.split_ratio(*hash_split(raw, "transaction_id"))


def _split_rows(raw: DataFrame) -> DataFrame:
    train, test = hash_split(raw, "transaction_id")
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


def _weights(raw: DataFrame) -> DataFrame:
    return fx.with_class_weight(raw).groupBy("is_fraudulent").agg(
        F.round(F.max("class_weight"), 8).alias("class_weight"), F.count("*").alias("n")
    )


FEATURE_INPUT = [
    "transaction_id",
    "transaction_amount",
    "transaction_date",
    "quantity",
    "shipping_address",
    "billing_address",
    "transaction_hour",
]

payment_mart = _mart(marts.payment_distribution, "dim_payment_methods")
device_mart = _mart(marts.device_volume, "dim_devices")
age_mart = _mart(marts.average_amount_by_age, "dim_customers")
month_mart = _mart(marts.transactions_by_month)
fraud_mart = _mart(marts.fraud_proportion)
category_mart = _mart(marts.amount_by_category, "dim_product_categories")

SPLIT_SIDE = """CASE WHEN CAST('0x' || substr(md5('42:' || transaction_id), 1, 7) AS BIGINT) % 1000 < 800
    THEN 'train' ELSE 'test' END AS split"""
SPLIT = f"""
split AS (SELECT *, {SPLIT_SIDE} FROM tx)"""

DAILY = """
daily AS (
  SELECT CAST(ts AS DATE) AS transaction_day, COUNT(*) AS transaction_count,
    CAST(SUM(transaction_amount) AS DOUBLE) AS total_amount,
    avg(CAST(is_fraudulent AS DOUBLE)) AS fraud_share
  FROM timed WHERE ts IS NOT NULL GROUP BY 1
)"""
TIMED = "timed AS (SELECT *, try_cast(transaction_date AS TIMESTAMP) AS ts FROM tx)"


def _mart_sql(select: str) -> str:
    return over(select, TX, FEATURES, DIMS)


def _chart_sql(mart: str, dimension: str, metric: str, name: str | None = None) -> str:
    total = f"SUM({metric})" if metric != "transaction_count" else f"CAST(SUM({metric}) AS BIGINT)"
    return over(
        f'SELECT {dimension}, {total} AS "{name or metric}" FROM mart GROUP BY {dimension}',
        TX, FEATURES, DIMS, f"mart AS ({mart})",
    )


ENTRIES = {
    # Features
    "feat_time_parts": (
        _with_raw(
            ["transaction_id", "transaction_date"],
            lambda raw: fx.with_time_parts(raw).select(
                "transaction_id",
                fx.moment_text("transaction_timestamp").alias("transaction_timestamp"),
                "transaction_dayofweek",
                "transaction_month",
                "transaction_year",
            ),
        ),
        over(
            """SELECT transaction_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp,
            CAST(dayofweek(ts) + 1 AS INTEGER) AS transaction_dayofweek,
            CAST(month(ts) AS INTEGER) AS transaction_month,
            CAST(year(ts) AS INTEGER) AS transaction_year FROM timed""",
            TX, TIMED,
        ),
    ),
    "feat_date_parts": (
        _with_raw(
            ["transaction_id", "transaction_date"],
            lambda raw: fx.with_date_parts(raw).drop("transaction_date"),
        ),
        over("SELECT transaction_id, day_of_month, day_of_week, month FROM feat", TX, FEATURES),
    ),
    "feat_derived": (
        _with_raw(
            FEATURE_INPUT,
            lambda raw: fx.with_model_features(raw).select(
                "transaction_id",
                "address_mismatch",
                "amount_per_quantity",
                "is_weekend",
                "is_night_time",
            ),
        ),
        over(
            """SELECT transaction_id, address_mismatch, amount_per_quantity, is_weekend,
            is_night_time FROM feat""",
            TX, FEATURES,
        ),
    ),
    "feat_age_group": (
        _with_raw(
            ["transaction_id", "customer_age"],
            lambda raw: raw.select(
                "transaction_id", "customer_age", fx.age_group("customer_age").alias("age_group")
            ),
        ),
        over(f"SELECT transaction_id, customer_age, {sql.AGE_GROUP} AS age_group FROM tx", TX),
    ),
    "feat_class_weight": (
        _with_raw(["is_fraudulent"], _weights),
        over(
            """SELECT is_fraudulent, round(CASE WHEN is_fraudulent = 1 THEN other / (fraud + other) * 5.0
            ELSE fraud / (fraud + other) END, 8) AS class_weight, COUNT(*) AS n
            FROM tx, (SELECT CAST(COUNT(*) FILTER (is_fraudulent = 1) AS DOUBLE) AS fraud,
              CAST(COUNT(*) FILTER (is_fraudulent = 0) AS DOUBLE) AS other FROM tx) t
            GROUP BY is_fraudulent, fraud, other""",
            TX,
        ),
    ),
    "feat_fillna": (
        _with_raw(
            ["transaction_id", "payment_method", "product_category", "customer_location", "device_used"],
            fx.fill_unknown,
        ),
        over(
            """SELECT transaction_id, coalesce(payment_method, 'unknown') AS payment_method,
            coalesce(product_category, 'unknown') AS product_category,
            coalesce(customer_location, 'unknown') AS customer_location,
            coalesce(device_used, 'unknown') AS device_used FROM tx""",
            TX,
        ),
    ),
    "feat_payment_norm": (
        _with_raw(
            ["transaction_id", "payment_method"],
            lambda raw: raw.select(
                "transaction_id", fx.payment_name("payment_method").alias("payment_name")
            ),
        ),
        over(
            """SELECT transaction_id, CASE lower(payment_method) WHEN 'credit card' THEN 'Credit Card'
            WHEN 'debit card' THEN 'Debit Card' WHEN 'bank transfer' THEN 'Bank Transfer'
            WHEN 'paypal' THEN 'PayPal' ELSE 'unknown' END AS payment_name FROM tx""",
            TX,
        ),
    ),
    "priv_pseudonymise": (
        _with_raw(
            ["transaction_id", "customer_id", "ip_address", "shipping_address", "billing_address"],
            lambda raw: privacy.pseudonymise(raw, "pepper"),
        ),
        over(
            r"""SELECT transaction_id, sha256('pepper' || customer_id) AS customer_id,
            regexp_replace(ip_address, '\.[0-9]+$', '.0') AS ip_address,
            sha256('pepper' || shipping_address) AS shipping_address,
            sha256('pepper' || billing_address) AS billing_address FROM tx""",
            TX,
        ),
    ),
    # Profiles
    "dq_null_profile": (
        _with_raw(None, quality.null_profile),
        over(
            """SELECT name AS column_name, nulls FROM (SELECT COUNT(*) - COUNT(COLUMNS(* EXCLUDE
            (l_orderkey, l_linenumber, l_partkey, l_suppkey, order_date))) FROM tx)
            UNPIVOT (nulls FOR name IN (*))""",
            TX,
        ),
    ),
    "dq_row_counts": (
        _row_counts,
        over(
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {name}"
                for name in (
                    "dim_customers",
                    "dim_payment_methods",
                    "dim_product_categories",
                    "dim_devices",
                    "dim_time",
                    "fact_transactions",
                )
            ),
            TX, FEATURES, DIMS,
        ),
    ),
    "dq_class_balance": (
        _with_raw(["is_fraudulent"], quality.class_balance),
        over(
            """SELECT fraud AS fraud_count, other AS non_fraud_count,
            round(fraud / CAST(fraud + other AS DOUBLE), 6) AS fraud_ratio,
            round(other / CAST(fraud AS DOUBLE), 6) AS imbalance
            FROM (SELECT COUNT(*) FILTER (is_fraudulent = 1) AS fraud,
              COUNT(*) FILTER (is_fraudulent = 0) AS other FROM tx)""",
            TX,
        ),
    ),
    "dq_split_ratio": (
        _with_raw(["transaction_id", "is_fraudulent"], _split_ratio),
        over(
            """SELECT split, COUNT(*) AS n,
            round(COUNT(*) FILTER (is_fraudulent = 1) / CAST(COUNT(*) AS DOUBLE), 6) AS fraud_ratio
            FROM split GROUP BY split""",
            TX, SPLIT,
        ),
    ),
    "ml_split": (
        _with_raw(["transaction_id", "is_fraudulent"], _split_rows),
        over("SELECT transaction_id, is_fraudulent, split FROM split", TX, SPLIT),
    ),
    # Star schema
    "star_dim_customers": (
        _with_raw(CUSTOMER_COLUMNS, star.dim_customers),
        over("SELECT * FROM dim_customers", TX, FEATURES, DIMS),
    ),
    "star_dim_payment": (
        _dim("dim_payment_methods"),
        over("SELECT * FROM dim_payment_methods", TX, FEATURES, DIMS),
    ),
    "star_dim_product": (
        _dim("dim_product_categories"),
        over("SELECT * FROM dim_product_categories", TX, FEATURES, DIMS),
    ),
    "star_dim_device": (
        _dim("dim_devices"),
        over("SELECT * FROM dim_devices", TX, FEATURES, DIMS),
    ),
    "star_dim_time": (
        _with_raw(["transaction_date", "transaction_hour"], star.dim_time),
        over("SELECT * FROM dim_time", TX, FEATURES, DIMS),
    ),
    "star_fact": (
        _fact_query,
        over(
            """SELECT * REPLACE (CAST(transaction_amount AS DOUBLE) AS transaction_amount)
            FROM fact_transactions""",
            TX, FEATURES, DIMS,
        ),
    ),
    # Reports
    "mart_payment_distribution": (payment_mart, _mart_sql(sql.MART_PAYMENT)),
    "mart_device_volume": (device_mart, _mart_sql(sql.MART_DEVICE)),
    "mart_avg_amount_by_age": (age_mart, _mart_sql(sql.MART_AGE)),
    "mart_tx_by_month": (month_mart, _mart_sql(sql.MART_MONTH)),
    "mart_fraud_proportion": (fraud_mart, _mart_sql(sql.MART_FRAUD)),
    "mart_amount_by_category": (category_mart, _mart_sql(sql.MART_CATEGORY)),
    "chart_fraud_overview": (
        _chart(fraud_mart, "transaction_type", "transaction_count"),
        _chart_sql(sql.MART_FRAUD, "transaction_type", "transaction_count"),
    ),
    "chart_tx_by_month": (
        _chart(month_mart, "transaction_month", "transaction_count"),
        _chart_sql(sql.MART_MONTH, "transaction_month", "transaction_count"),
    ),
    "chart_avg_by_age": (
        _chart(age_mart, "age_group", "average_amount"),
        _chart_sql(sql.MART_AGE, "age_group", "average_amount"),
    ),
    "chart_payment": (
        _chart(payment_mart, "payment_method", "transaction_count"),
        _chart_sql(sql.MART_PAYMENT, "payment_method", "transaction_count"),
    ),
    "chart_device": (
        _chart(device_mart, "device_type", "transaction_count"),
        _chart_sql(sql.MART_DEVICE, "device_type", "transaction_count"),
    ),
    "chart_revenue_by_category": (
        _chart(
            category_mart, "product_category", "total_transaction_amount", "Total Transaction Amount"
        ),
        _chart_sql(
            sql.MART_CATEGORY,
            "product_category",
            "total_transaction_amount",
            "Total Transaction Amount",
        ),
    ),
    # Exploration
    "eda_top_fraud_categories": (
        _with_raw(
            ["product_category", "is_fraudulent"], lambda raw: eda.top_fraud(raw, "product_category")
        ),
        over(
            """SELECT product_category, COUNT(*) AS fraud_count FROM tx
            WHERE is_fraudulent = 1 AND product_category IS NOT NULL
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
            TX,
        ),
    ),
    "eda_top_fraud_locations": (
        _with_raw(
            ["customer_location", "is_fraudulent"],
            lambda raw: eda.top_fraud(raw, "customer_location"),
        ),
        over(
            """SELECT customer_location, COUNT(*) AS fraud_count FROM tx
            WHERE is_fraudulent = 1 AND customer_location IS NOT NULL
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
            TX,
        ),
    ),
    "eda_fraud_by_location": (
        _with_raw(
            ["customer_location", "is_fraudulent"],
            lambda raw: eda.fraud_by(raw, "customer_location"),
        ),
        over(
            """SELECT customer_location, COUNT(*) AS fraud_count FROM tx
            WHERE is_fraudulent = 1 AND customer_location IS NOT NULL GROUP BY 1""",
            TX,
        ),
    ),
    "eda_fraud_by_payment": (
        _with_raw(
            ["payment_method", "is_fraudulent"], lambda raw: eda.fraud_by(raw, "payment_method")
        ),
        over(
            """SELECT payment_method, COUNT(*) AS fraud_count FROM tx
            WHERE is_fraudulent = 1 AND payment_method IS NOT NULL GROUP BY 1""",
            TX,
        ),
    ),
    "eda_tx_by_hour": (
        _with_raw(["transaction_hour"], eda.transactions_by_hour),
        over(
            """SELECT transaction_hour, COUNT(*) AS transaction_count FROM tx
            WHERE transaction_hour IS NOT NULL GROUP BY 1""",
            TX,
        ),
    ),
    "eda_account_age_box": (
        _with_raw(["account_age_days", "is_fraudulent"], eda.account_age_box),
        over(
            sql.box_sql("labelled", "is_fraudulent", "account_age_days"),
            TX,
            "labelled AS (SELECT * FROM tx WHERE is_fraudulent IS NOT NULL)",
        ),
    ),
    "eda_device_fraud": (
        _with_raw(["device_used", "is_fraudulent"], eda.device_fraud),
        over(
            """SELECT device_used, is_fraudulent, COUNT(*) AS transaction_count FROM tx
            WHERE is_fraudulent IS NOT NULL AND device_used IS NOT NULL GROUP BY 1, 2""",
            TX,
        ),
    ),
    "eda_amount_vs_age": (
        _with_raw(["transaction_amount", "account_age_days", "is_fraudulent"], eda.amount_vs_age),
        over(
            """SELECT CAST(transaction_amount AS DOUBLE) AS transaction_amount, account_age_days,
            is_fraudulent FROM tx WHERE is_fraudulent IS NOT NULL""",
            TX,
        ),
    ),
    "eda_scatter_sample": (
        _with_raw(
            ["transaction_id", "transaction_date", "transaction_amount", "account_age_days", "is_fraudulent"],
            lambda raw: eda.scatter_sample(raw, SCATTER),
        ),
        over(
            f"""SELECT transaction_id, CAST(transaction_amount AS DOUBLE) AS transaction_amount, account_age_days,
            is_fraudulent FROM (SELECT *, row_number() OVER (PARTITION BY is_fraudulent
              ORDER BY md5(concat_ws('|', '42', transaction_id, coalesce(transaction_date, ''))), transaction_amount,
                account_age_days) AS place
              FROM tx WHERE is_fraudulent IS NOT NULL AND transaction_amount IS NOT NULL AND account_age_days IS NOT NULL)
            WHERE place <= {SCATTER}""",
            TX,
        ),
    ),
    "eda_amount_corr": (
        _with_raw(["transaction_amount", "is_fraudulent"], eda.amount_fraud_correlation),
        over(
            """SELECT round(corr(CAST(transaction_amount AS DOUBLE), is_fraudulent), 6) AS correlation,
            COUNT(*) FILTER (is_fraudulent IS NOT NULL) AS n FROM tx""",
            TX,
        ),
    ),
    "eda_fraud_hour_device": (
        _with_raw(
            ["transaction_hour", "device_used", "is_fraudulent"],
            lambda raw: eda.fraud_by_hour_device(raw, DEVICES),
        ),
        over(
            """SELECT transaction_hour, COUNT(*) FILTER (device_used = 'desktop') AS desktop,
            COUNT(*) FILTER (device_used = 'mobile') AS mobile,
            COUNT(*) FILTER (device_used = 'tablet') AS tablet
            FROM tx WHERE is_fraudulent = 1 AND transaction_hour IS NOT NULL GROUP BY 1""",
            TX,
        ),
    ),
    "eda_tx_daily": (
        _with_raw(
            ["transaction_date", "transaction_amount", "is_fraudulent"],
            lambda raw: eda.daily(raw).select("transaction_day", "transaction_count"),
        ),
        over("SELECT transaction_day, transaction_count FROM daily", TX, TIMED, DAILY),
    ),
    "eda_daily_spikes": (
        _with_raw(["transaction_date", "transaction_amount", "is_fraudulent"], eda.daily_spikes),
        over(
            """SELECT transaction_day, total_amount, round(fraud_share, 6) AS fraud_share,
            round(CASE WHEN stddev_samp(total_amount) OVER w > 1e-9 THEN
              (total_amount - avg(total_amount) OVER w) / stddev_samp(total_amount) OVER w END, 4)
              AS amount_z,
            round(CASE WHEN stddev_samp(fraud_share) OVER w > 1e-9 THEN
              (fraud_share - avg(fraud_share) OVER w) / stddev_samp(fraud_share) OVER w END, 4)
              AS fraud_z
            FROM daily
            WINDOW w AS (ORDER BY transaction_day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
            TX, TIMED, DAILY,
        ),
    ),
    # Dashboard
    "dash_fraud_split": (
        _with_rows(dashboard.fraud_split, ("is_fraud", "timestamp")),
        over(
            """SELECT CASE WHEN is_fraud THEN 'Fraud' ELSE 'Normal' END AS kind, COUNT(*) AS n,
            round(COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) AS share
            FROM dash GROUP BY 1""",
            TX, RESULTS,
        ),
    ),
    "dash_amount_box": (
        _with_rows(dashboard.amount_box, ("is_fraud", "timestamp", "amount")),
        over(sql.box_sql("dash", "is_fraud", "amount"), TX, RESULTS),
    ),
    "dash_amount_box_payment": (
        _with_rows(
            dashboard.amount_box_by_payment, ("is_fraud", "timestamp", "amount", "payment_method")
        ),
        over(sql.box_sql("dash", "payment_method, is_fraud", "amount"), TX, RESULTS),
    ),
    "dash_payment_hist": (
        _with_rows(dashboard.payment_counts),
        over(
            "SELECT payment_method, is_fraud, COUNT(*) AS n FROM dash GROUP BY 1, 2", TX, RESULTS
        ),
    ),
    "dash_fraud_rate_payment": (
        _with_rows(
            dashboard.fraud_rate_by_payment,
            ("transaction_id", "is_fraud", "timestamp", "payment_method"),
        ),
        over(
            """SELECT payment_method, round(avg(CAST(is_fraud AS INTEGER)) * 100, 6) AS fraud_rate,
            COUNT(transaction_id) AS n FROM dash GROUP BY 1""",
            TX, RESULTS,
        ),
    ),
    "dash_payment_daily": (
        _with_rows(dashboard.payment_daily),
        over(
            """SELECT CAST("timestamp" AS DATE) AS day, payment_method, is_fraud, COUNT(*) AS n
            FROM dash GROUP BY 1, 2, 3""",
            TX, RESULTS,
        ),
    ),
    "dash_cumulative_trend": (
        _with_rows(dashboard.cumulative_trend, ("is_fraud", "timestamp")),
        over(
            """SELECT day, CAST(SUM(fraud) OVER (ORDER BY day) AS BIGINT) AS fraud_total,
            CAST(SUM(normal) OVER (ORDER BY day) AS BIGINT) AS normal_total
            FROM (SELECT CAST("timestamp" AS DATE) AS day, COUNT(*) FILTER (is_fraud) AS fraud,
              COUNT(*) FILTER (NOT is_fraud) AS normal FROM dash GROUP BY 1)""",
            TX, RESULTS,
        ),
    ),
    "dash_trend_points": (
        _with_rows(dashboard.trend_points, ("transaction_id", "is_fraud", "timestamp")),
        over(
            """SELECT "timestamp", transaction_id, is_fraud,
            CAST(SUM(CAST(is_fraud AS INTEGER)) OVER w AS BIGINT) AS fraud_total,
            CAST(SUM(CAST(NOT is_fraud AS INTEGER)) OVER w AS BIGINT) AS normal_total
            FROM dash
            WINDOW w AS (ORDER BY "timestamp", transaction_id ROWS UNBOUNDED PRECEDING)""",
            TX, RESULTS,
        ),
    ),
    "dash_latest": (
        _with_rows(
            lambda rows: dashboard.latest(rows).withColumn("amount", F.col("amount").cast("double")),
            RESULT_COLUMNS,
        ),
        over(
            """SELECT transaction_id, is_fraud, "timestamp", amount, payment_method,
            product_category, row_number() OVER (ORDER BY "timestamp" DESC, transaction_id) AS place
            FROM dash""",
            TX, RESULTS,
        ),
    ),
}
