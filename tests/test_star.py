from compare import rows
from pyspark.sql import functions as F

from txnlens.operators import star
from txnlens.plans import eda, marts
from txnlens.plans.daily import run_daily
from txnlens.schemas import RAW, STAR_DDL
from txnlens.sources.tables import transactions


def raw_row(**values):
    base = {
        "transaction_id": "t1", "customer_id": "c1", "transaction_amount": 10.5,
        "transaction_date": "2025-05-24 10:00:00", "payment_method": "PayPal",
        "product_category": "clothing", "quantity": 1, "customer_age": 30,
        "customer_location": "Paris, France", "device_used": "mobile", "ip_address": "1.2.3.4",
        "shipping_address": "a", "billing_address": "a", "is_fraudulent": 0,
        "account_age_days": 5, "transaction_hour": 10,
    } | values
    return tuple(base[name] for name in RAW.names)


def raw_frame(spark, *changes):
    return spark.createDataFrame([raw_row(**c) for c in changes], RAW)


# The value lists the deployed dimensions hold.
PAYMENTS = ["debit card", "bank transfer", "PayPal", "credit card"]
CATEGORIES = ["health & beauty", "toys & games", "electronics", "clothing", "home & garden"]
DEVICES = ["desktop", "mobile", "tablet"]


def test_dimensions_hold_the_known_values_once(spark):
    raw = raw_frame(
        spark,
        *(
            {"payment_method": p, "product_category": c, "device_used": d}
            for p in PAYMENTS for c in CATEGORIES for d in DEVICES
        ),
    )
    dims = star.category_dims(raw)
    assert [r[0] for r in rows(dims["dim_payment_methods"], "payment_method_id")] == sorted(PAYMENTS)
    assert rows(dims["dim_devices"], "device_id") == [(d, i) for i, d in enumerate(DEVICES)]
    assert {r[1] for r in rows(dims["dim_product_categories"])} == set(range(5))


def test_null_category_has_a_row_but_no_key(spark):
    raw = raw_frame(spark, {"payment_method": None}, {"payment_method": "PayPal"})
    dims = star.category_dims(raw)
    assert rows(dims["dim_payment_methods"], "payment_method_id") == [(None, 0), ("PayPal", 1)]
    fact = star.fact_transactions(raw, dims)
    assert rows(fact.select("payment_method_id")) == [("1",), (None,)]
    report = marts.payment_distribution(
        star.typed("fact_transactions", fact),
        star.typed("dim_payment_methods", dims["dim_payment_methods"]),
    )
    assert rows(report) == [("PayPal", 1)]


def test_typed_fact_has_the_declared_types(spark):
    raw = raw_frame(spark, {"transaction_date": "bad", "is_fraudulent": None})
    typed = star.typed("fact_transactions", star.fact_transactions(raw, star.category_dims(raw)))
    declared = spark.createDataFrame([], STAR_DDL["fact_transactions"])
    assert typed.dtypes == declared.dtypes
    row = typed.first()
    assert row.is_fraudulent is False and row.transaction_timestamp is None


def test_average_by_age_weighs_by_customer_states(spark):
    """A customer with two states counts twice, as in a plain join."""
    raw = raw_frame(
        spark,
        {"customer_id": "c1", "transaction_amount": 10.0, "customer_age": 30},
        {"customer_id": "c1", "transaction_amount": 20.0, "customer_age": 35},
        {"customer_id": "c2", "transaction_amount": 60.0, "customer_age": 31},
        {"customer_id": "c2", "transaction_amount": None, "customer_age": 31},
        {"customer_id": "c3", "transaction_amount": 7.0, "customer_age": None},
    )
    fact = star.typed("fact_transactions", star.fact_transactions(raw, {}))
    customers = star.dim_customers(raw)
    plain = fact.join(customers, "customer_id").groupBy("age_group").agg(
        F.round(F.avg("transaction_amount").cast("double"), 6).alias("average_amount")
    )
    assert rows(marts.average_amount_by_age(fact, customers)) == rows(plain)


def test_months_of_different_years_merge(spark):
    raw = raw_frame(
        spark,
        {"transaction_date": "2024-05-01 00:00:00"},
        {"transaction_date": "2025-05-01 00:00:00"},
        {"transaction_date": "2025-01-01 00:00:00"},
    )
    fact = star.typed("fact_transactions", star.fact_transactions(raw, {}))
    assert rows(marts.transactions_by_month(fact), "month_number") == [("January", 1, 1), ("May", 5, 2)]


def test_chart_row_limit_keeps_the_first_rows(spark):
    df = spark.range(50).selectExpr("id AS d", "1 AS m")
    assert [r[0] for r in marts.chart(df, ["d"], F.sum("m"), "m", limit=3).collect()] == [0, 1, 2]


def test_spikes_compare_with_the_days_before(spark):
    changes = [
        {"transaction_date": f"2025-05-{day:02d} 10:00:00", "transaction_amount": amount}
        for day, amount in ((1, 10.0), (2, 12.0), (3, 14.0), (4, 100.0))
    ]
    found = rows(eda.daily_spikes(raw_frame(spark, *changes)), "transaction_day")
    assert [r[3] for r in found] == [None, None, round(3 / 2**0.5, 4), 44.0]


def test_daily_run_replaces_its_day_and_moves_the_views(spark, tmp_path):
    base = str(tmp_path)
    run_daily(spark, raw_frame(spark, {}, {"payment_method": "cash"}), base, "2025-05-24")
    run_daily(spark, raw_frame(spark, {}), base, "2025-05-25")
    assert spark.table("fact_transactions").count() == 1
    run_daily(spark, raw_frame(spark, {}, {}, {}), base, "2025-05-25")
    assert spark.table("fact_transactions").count() == 3
    run_daily(spark, raw_frame(spark, {}, {"payment_method": "cash"}), base, "2025-05-24")
    assert rows(spark.table("dim_payment_methods")) == [("PayPal", 0), ("cash", 1)]
    stored = spark.read.parquet(f"{base}/fact_transactions")
    assert stored.groupBy("ds").count().count() == 2


def test_only_needed_parents_are_read(spark, sf_dir):
    def files(df):
        return {path.rsplit("/", 1)[-1] for path in df.inputFiles()}

    assert files(transactions(spark, sf_dir, ["payment_method"])) == {"lineitem.parquet"}
    assert files(transactions(spark, sf_dir, ["customer_id"])) == {"lineitem.parquet", "orders.parquet"}
    assert "part.parquet" not in files(transactions(spark, sf_dir, ["customer_location"]))
