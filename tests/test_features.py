from compare import rows
from pyspark.sql import functions as F

from txnlens.functions import features as fx
from txnlens.functions import privacy
from txnlens.operators import quality

MODEL_ROW = (
    "transaction_id STRING, transaction_date STRING, shipping_address STRING, "
    "billing_address STRING, transaction_amount DOUBLE, quantity INT, transaction_hour INT, "
    "payment_method STRING"
)


def test_age_groups_at_their_bounds(spark):
    ages = [None, 19, 20, 29, 30, 39, 40, 49, 50]
    df = spark.createDataFrame([(a,) for a in ages], "age INT")
    found = [r[0] for r in df.select(fx.age_group("age")).collect()]
    assert found == [
        "Unknown", "Under 20", "20-29", "20-29", "30-39", "30-39", "40-49", "40-49", "50+",
    ]


def test_unreadable_dates_are_null(spark):
    texts = [None, "", "bad", "2025-05-24", "2025-05-24 23:59:59"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    loose = [r[0] is not None for r in df.select(fx.event_time("t")).collect()]
    strict = [r[0] is not None for r in df.select(fx.strict_event_time("t")).collect()]
    assert loose == [False, False, False, True, True]
    assert strict == [False, False, False, False, True]


def test_model_features_on_edge_rows(spark):
    df = spark.createDataFrame(
        [
            ("saturday", "2025-05-24 10:00:00", "a", "a", 10.0, 2, 22, None),
            ("sunday", "2025-05-25 10:00:00", "a", "b", 10.0, 0, 21, "x"),
            ("monday", "2025-05-26 10:00:00", None, "b", 10.0, -1, 5, "x"),
            ("no date", "bad", None, None, 10.0, None, 6, "x"),
            ("no hour", None, "a", "b", None, 2, None, "x"),
        ],
        MODEL_ROW,
    )
    found = fx.with_model_features(df).select(
        "transaction_id", "day_of_week", "address_mismatch", "amount_per_quantity", "is_weekend",
        "is_night_time", "payment_method",
    )
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {
        "saturday": (7, 0, 5.0, 1, 1, "unknown"),
        "sunday": (1, 1, 10.0, 1, 0, "x"),
        "monday": (2, 0, 10.0, 0, 1, "x"),
        "no date": (None, 0, 10.0, 0, 0, "x"),
        "no hour": (None, 1, None, 0, 0, "x"),
    }


def test_payment_names(spark):
    texts = [None, "", "paypal", "PayPal", "CREDIT CARD", "cash"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r[0] for r in df.select(fx.payment_name("t")).collect()] == [
        "unknown", "unknown", "PayPal", "PayPal", "Credit Card", "unknown",
    ]


def test_label_text_counts_null_as_false(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "label INT")
    assert [r[0] for r in df.select(fx.label_text("label")).collect()] == ["true", "false", "false"]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "is_fraudulent INT")
    found = {r[0]: r[1] for r in fx.with_class_weight(df).distinct().collect()}
    assert found == {1: 0.75 * 5, 0: 0.25, None: 0.25}


def test_balance_without_fraud_has_no_imbalance(spark):
    df = spark.createDataFrame([(0,), (None,)], "is_fraudulent INT")
    assert rows(quality.class_balance(df)) == [(0, 1, 0.0, None)]
    assert rows(quality.class_balance(df.where("is_fraudulent > 5"))) == [(0, 0, None, None)]


def test_null_profile_counts_each_column(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a INT, b STRING")
    assert rows(quality.null_profile(df)) == [("a", 1), ("b", 2)]


def test_pseudonyms_join_but_do_not_show(spark):
    df = spark.createDataFrame([("c1", "10.1.2.3"), ("c1", None), (None, "x")],
                               "customer_id STRING, ip_address STRING")
    found = privacy.pseudonymise(df, "salt").collect()
    assert found[0][0] == found[1][0] != "c1" and found[2][0] is None
    assert [r[1] for r in found] == ["10.1.2.0", None, "x"]
    other = privacy.pseudonymise(df, "pepper").where(F.col("customer_id").isNotNull()).first()
    assert other[0] != found[0][0]
