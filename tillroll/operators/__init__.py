"""Relational operators of the pipeline: staging, dimensions, fact, marts,
KPIs and data tests.  DataFrames in, DataFrame out, no actions."""
