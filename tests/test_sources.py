import json

import pytest
from compare import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from test_star import raw_frame
from txnlens.schemas import MESSAGE_KEYS, RAW, RAW_NAMES
from txnlens.sinks.daily import land, write_day
from txnlens.sources import files

HEADER = ",".join(MESSAGE_KEYS[n] for n in RAW_NAMES)
LINE = 't1,c1,10.5,2025-05-24 10:00:00,PayPal,clothing,2,30,"Paris, ""FR""",mobile,1.2.3.4,a,b,1,5,10'


def test_columns_bind_by_position_and_bad_cells_are_null(spark, tmp_path):
    bad = LINE.replace(",2,30,", ",two,30,")
    (tmp_path / "t.csv").write_text("\n".join(["x," * 15 + "x", LINE, bad]))
    found = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert found.schema.names == RAW.names
    assert rows(found.select("quantity", "customer_location")) == [
        (2, 'Paris, "FR"'),
        (None, 'Paris, "FR"'),
    ]


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    (tmp_path / "t.csv").write_text("\n".join([HEADER, LINE.replace("Paris, ", "Paris\n")]))
    path = str(tmp_path / "t.csv")
    assert files.read_csv(spark, path, multi_line=True).first().customer_location == 'Paris\n"FR"'
    assert files.read_csv(spark, path).count() == 2


def test_latin1_bytes_are_read_without_loss(spark, tmp_path):
    text = "\n".join([HEADER, LINE.replace("Paris", "Orléans")])
    (tmp_path / "t.csv").write_bytes(text.encode("latin-1"))
    found = files.read_csv(spark, str(tmp_path / "t.csv"), encoding="ISO-8859-1").first()
    assert found.customer_location == 'Orléans, "FR"'


def test_first_existing_path_is_read(spark, tmp_path):
    (tmp_path / "second.csv").write_text("\n".join([HEADER, LINE]))
    second = str(tmp_path / "second.csv")
    assert files.read_first_existing(spark, [str(tmp_path / "first.csv"), second]).count() == 1
    with pytest.raises(AnalysisException):
        files.read_first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count()


def test_landing_days_are_pruned(spark, tmp_path):
    base = str(tmp_path)
    for day in ("2025-04-30", "2025-05-01", "2025-05-02"):
        land(raw_frame(spark, {"transaction_id": day}), base, day)
    land(raw_frame(spark, {"transaction_id": "again"}), base, "2025-05-02")
    found = files.read_landing(spark, base, "2025-05-01", "2025-05-31")
    assert rows(found.select("transaction_id", "ds")) == [
        ("2025-05-01", "2025-05-01"),
        ("again", "2025-05-02"),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "2025-05-01" in pruned


def test_json_records_fill_missing_keys_with_null(spark, tmp_path):
    records = [{"Transaction ID": "a", "Quantity": 2}, {"Transaction ID": "b", "Device Used": "tablet"}]
    (tmp_path / "r.json").write_text(json.dumps(records))
    found = files.read_json_records(spark, str(tmp_path / "r.json"), one_array=True)
    assert found.columns == RAW_NAMES
    assert rows(found.select("transaction_id", "quantity", "device_used")) == [
        ("a", 2, None),
        ("b", None, "tablet"),
    ]


def test_a_day_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    write_day(spark.createDataFrame([(1,), (2,)], "a INT"), path, "2025-05-24")
    write_day(spark.createDataFrame([(3,)], "a INT"), path, "2025-05-25")
    write_day(spark.createDataFrame([(4,)], "a INT"), path, "2025-05-24")
    found = spark.read.parquet(path).withColumn("ds", F.col("ds").cast("string"))
    assert rows(found) == [(3, "2025-05-25"), (4, "2025-05-24")]


def test_daily_parquet_is_written_with_zstd(spark, tmp_path):
    write_day(spark.range(3), f"{tmp_path}/d", "2025-05-24")
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(f"{tmp_path}/d").inputFiles())
