"""Daily and intraday market-data jobs as Spark DataFrame pipelines."""
