"""Retail recommendation and promotion jobs as Spark DataFrame plans."""
