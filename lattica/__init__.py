"""Lattica: a Spark-first engine for AI-evaluation response data."""
