"""Operators for large-scale training-data pipelines.

Nothing outside this folder imports it.  Every operator takes and returns
DataFrames; state that outlives a job is written below spark.checkpoint.dir.
"""
