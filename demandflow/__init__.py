"""Retail demand planning on Spark: ingest, star schema, features, forecast, actions, reports."""
