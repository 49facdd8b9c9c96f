"""Marketplace orders on Spark: upserted dimensions, a fact table and a monthly customer report."""
