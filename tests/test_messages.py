import datetime
import json
import math

import pytest
from compare import rows
from pyspark.sql import functions as F

from test_star import raw_frame
from txnlens.functions import messages as msg
from txnlens.schemas import FRAUD_RESULT_MESSAGE, MESSAGE_KEYS, RAW_NAMES

GOOD = {
    "Transaction ID": "t1", "Customer ID": "c1", "Transaction Amount": 10.5,
    "Transaction Date": "2025-05-24 10:00:00", "Payment Method": "PayPal",
    "Product Category": "clothing", "Quantity": 2, "Customer Age": 30,
    "Customer Location": "Paris, France", "Device Used": "mobile", "IP Address": "1.2.3.4",
    "Shipping Address": "a", "Billing Address": "b", "Is Fraudulent": 1,
    "Account Age Days": 5, "Transaction Hour": 10,
}
NOW = datetime.datetime(2025, 6, 1)


def without(*keys):
    return {k: v for k, v in GOOD.items() if k not in keys}


def stream_of(spark, *messages):
    texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value STRING, position BIGINT")


def reasons(spark, *messages, labelled=True):
    judged = msg.with_reason(msg.decode(stream_of(spark, *messages)), labelled)
    return [r.reason for r in judged.orderBy("position").collect()]


def test_reasons_follow_the_order_of_the_rules(spark):
    assert reasons(
        spark,
        GOOD,
        GOOD | {"Transaction Amount": 10},
        GOOD | {"Quantity": None},
        json.dumps(GOOD)[:-20],
        "[1]",
        without("Device Used", "Transaction Date"),
        GOOD | {"Transaction Date": None},
        GOOD | {"Transaction Date": "", "Is Fraudulent": None},
        GOOD | {"Is Fraudulent": None, "Quantity": "two"},
        GOOD | {"Quantity": "two"},
        GOOD | {"Quantity": float("nan")},
        GOOD | {"Transaction Amount": float("nan")},
    ) == [
        None, None, None, "invalid_json", "invalid_json", "missing_columns", "missing_date",
        "missing_date", "missing_label", "bad_type", "bad_type", None,
    ]


def test_messages_to_score_need_no_label(spark):
    unlabelled = without("Is Fraudulent")
    assert reasons(spark, unlabelled, labelled=False) == [None]
    assert reasons(spark, unlabelled) == ["missing_columns"]
    assert reasons(spark, unlabelled | {"Transaction Date": ""}, labelled=False) == ["missing_date"]


def test_one_bad_message_does_not_take_others_along(spark):
    judged = msg.with_reason(msg.decode(stream_of(spark, GOOD, GOOD | {"Quantity": "two"}, GOOD)))
    assert msg.valid(judged).count() == 2
    assert rows(msg.quarantined(judged).select("reason", "transaction_id")) == [("bad_type", "t1")]


def test_encoding_and_decoding_give_the_same_rows(spark):
    raw = raw_frame(spark, {}, {"quantity": None, "payment_method": None}, {"customer_location": 'a"b\nc'})
    text = raw.select(msg.encode().alias("value"), F.lit(0).alias("position"))
    assert set(json.loads(text.first().value)) == set(MESSAGE_KEYS.values())
    assert rows(msg.decode(text).select(*msg.record_columns())) == rows(raw)


def test_result_message_has_the_seven_fields(spark):
    judged = msg.with_reason(msg.decode(stream_of(spark, GOOD)))
    text = msg.valid(judged).select(msg.encoded_result().alias("value")).first().value
    assert json.loads(text) == {
        "transaction_id": "t1", "is_fraud": True, "timestamp": "2025-05-24 10:00:00",
        "amount": 10.5, "payment_method": "PayPal", "product_category": "clothing", "error": None,
    }
    assert list(json.loads(text)) == FRAUD_RESULT_MESSAGE.names


def coerced(spark, *messages, coerce=msg.coerced_transactions):
    found = coerce(stream_of(spark, *messages), now=F.lit(NOW))
    return found.orderBy("position").collect()


def test_missing_keys_get_defaults(spark):
    row = coerced(spark, {})[0]
    assert row.reason is None
    for name in RAW_NAMES:
        want = {"transaction_amount": 0.0, "transaction_date": NOW}.get(
            name, 0 if isinstance(row[name], int) else "unknown"
        )
        assert row[name] == want


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"Quantity": None}, "bad_value"),
        ({"Quantity": "two"}, "bad_value"),
        ({"Quantity": float("nan")}, "bad_value"),
        ({"Transaction Amount": None}, "bad_value"),
        ({"Transaction Date": "2025-05-24"}, "bad_value"),
        ({"Transaction Date": None}, "bad_value"),
        ({"Transaction ID": None}, "missing_key"),
        ({"Payment Method": None}, None),
        ({"Quantity": "7"}, None),
    ],
)
def test_present_but_unreadable_values_reject_the_row(spark, change, reason):
    assert coerced(spark, GOOD | change)[0].reason == reason


def test_numbers_are_cut_and_nan_amounts_stay(spark):
    row = coerced(spark, GOOD | {"Quantity": 2.7, "Transaction Amount": float("nan")})[0]
    assert row.reason is None and row.quantity == 2 and math.isnan(row.transaction_amount)


def test_null_text_stays_null_and_invalid_json_is_named(spark):
    found = coerced(spark, GOOD | {"Payment Method": None}, "{broken")
    assert found[0].payment_method is None and found[1].reason == "invalid_json"


def test_results_are_coerced(spark):
    good = {"transaction_id": "t", "is_fraud": True, "timestamp": "2025-05-24 10:00:00", "amount": 1}
    found = coerced(
        spark, good, good | {"is_fraud": None}, good | {"is_fraud": 0}, {},
        good | {"timestamp": "bad"}, good | {"transaction_id": None},
        coerce=msg.coerced_results,
    )
    assert [r.is_fraud for r in found[:4]] == [True, False, False, False]
    assert (found[0].payment_method, found[0].error, found[3].transaction_id) == ("unknown", None, "unknown")
    assert [r.reason for r in found] == [None, None, None, None, "bad_value", "missing_key"]
