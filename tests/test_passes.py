import pytest

from test_messages_at_size import tables  # noqa: F401
from txnlens.registry import models, storage
from txnlens.sources.tables import transactions


@pytest.mark.parametrize("name", ["ml_scale_numeric", "ml_features"])
def test_stages_pass_over_stored_rows(spark, tables, name):  # noqa: F811
    found = models.ENTRIES[name][0](spark, tables)
    read = {f.rsplit("/", 2)[-2] for f in found.inputFiles()}
    assert not {"lineitem.parquet", "orders.parquet"} & read and found.count() > 0


def test_json_records_are_stored_compressed(spark, tables):  # noqa: F811
    found = storage.ENTRIES["src_json_records"][0](spark, tables)
    assert found.count() == transactions(spark, tables).count() == 300
    assert all(f.endswith(".json.gz") for f in found.inputFiles())
