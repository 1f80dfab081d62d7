"""Lakehouse pipelines as plain DataFrame, SQL and Structured Streaming operators."""
