"""Transaction and fraud analytics on Spark: star schema, reports, streams, models."""
