"""Equity-market analytics as Spark DataFrame jobs."""
