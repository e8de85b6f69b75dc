"""Effective-dated pricing mart on Spark: load, repair, serve and check price history."""
