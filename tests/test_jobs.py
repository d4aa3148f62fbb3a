"""The whole chain from fetched records to stored results, through the job entry points."""

import json

from compare import rows

from test_messages import GOOD, without
from test_streams import write_messages
from txnlens.__main__ import main
from txnlens.ml import train as tr
from txnlens.schemas import STORED_TRANSACTIONS
from txnlens.sinks.upsert import KeyedTable, read_table

WORDS = ["PayPal", "credit card", "debit card"]


def records(count):
    return [
        GOOD | {
            "Transaction ID": f"t{i}", "Customer ID": f"c{i % 7}", "Payment Method": WORDS[i % 3],
            "Transaction Amount": float(10 + i % 50), "Transaction Hour": i % 24,
            "Is Fraudulent": int(i % 24 < 5),
        }
        for i in range(count)
    ]


def test_records_become_star_model_and_results(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    day = ["--base", base, "--ds", "2025-05-25"]
    (tmp_path / "records.json").write_text("\n".join(json.dumps(r) for r in records(300)))
    main(["landing", *day, "--records", f"{base}/records.json"])
    main(["daily", *day])
    assert spark.table("fact_transactions").count() == 300
    assert [r[0] for r in rows(spark.table("dim_payment_methods"))] == WORDS

    # Two quick learners stand in for the full competition.
    quick = {"Decision Tree": tr.classifiers({})["Decision Tree"]}
    monkeypatch.setattr(tr, "classifiers", lambda settings: quick)
    monkeypatch.setattr(tr, "FOREST_GRID", [{"numTrees": 2, "maxDepth": 2, "impurity": "gini"}])
    main(["train", *day])
    main(["train", *day])

    inbox, out = f"{base}/inbox", f"{base}/out"
    write_messages(spark, inbox, [without("Is Fraudulent") | {"Transaction ID": f"n{i}"} for i in range(5)])
    stream = ["--inbox", inbox, "--out"]
    main(["score", "--base", base, "--model", "Decision Tree", *stream, f"{out}/scored"])
    found = spark.read.parquet(f"{out}/scored/data")
    assert sorted(r.transaction_id for r in found.collect()) == [f"n{i}" for i in range(5)]
    main(["detect", *stream, f"{out}/detected"])
    assert spark.read.parquet(f"{out}/detected/data").count() == 0
    main(["persist", *stream, f"{out}/stored"])
    stored = KeyedTable(f"{out}/stored/transactions", STORED_TRANSACTIONS, "transaction_id", "transaction_date", "day", 8)
    assert read_table(spark, stored).count() == 5


def test_scratch_tables_go_with_their_job(spark):
    from txnlens import session

    kept = session.settle(spark.range(3), "kept")
    with session.scratch_of_a_job(spark):
        path = session.once(spark, "job's own", lambda folder: spark.range(2).write.parquet(f"{folder}/t"))
        assert spark.read.parquet(f"{path}/t").count() == 2
        assert session.once(spark, "job's own", lambda folder: None) == path
    assert kept.count() == 3
    again = []
    assert session.once(spark, "job's own", again.append) != path and again


def test_what_was_made_of_tables_is_made_again_once_they_change(spark, tmp_path):
    from txnlens import session

    source, made = str(tmp_path), []

    def get():
        return session.once(spark, "of tables", made.append, source)

    spark.range(3).write.parquet(f"{source}/t.parquet")
    first = get()
    assert get() == first and len(made) == 1
    spark.range(4).write.mode("append").parquet(f"{source}/t.parquet")
    assert get() != first and len(made) == 2
