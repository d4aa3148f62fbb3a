
from test_messages_at_size import tables  # noqa: F401
from txnlens.registry import increments as queries
from txnlens.session import SESSION_CONF
from txnlens.sources.streams import file_stream


def test_streams_that_are_matched_take_few_files_at_a_time(spark, tables, monkeypatch):  # noqa: F811
    """All files in one batch would put the whole history into the state, as no watermark passes within a batch."""
    asked = []

    def spied(spark, path, files_per_batch=1000):
        asked.append(files_per_batch)
        return file_stream(spark, path, 1)

    monkeypatch.setattr("txnlens.registry.streams.file_stream", spied)
    found = queries.ENTRIES["st_first_match"][0](spark, tables)
    rows = [tuple(r) for r in found.collect()]
    assert len(asked) == 2 and max(asked) <= 8 and int(SESSION_CONF["spark.sql.streaming.minBatchesToRetain"]) == 2
    # One row per id, whatever the number of batches.
    assert rows and len({r[0] for r in rows}) == len(rows)
