"""Spark-first analytics for genome-editing break sites."""
