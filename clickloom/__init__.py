"""Clickstream analytics on Spark: event contract, star schema, marts, streams, series and price snapshots."""
