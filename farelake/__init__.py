"""Trip analytics on Spark: bronze files to star schema, gold tables, read queries and forecasts."""
