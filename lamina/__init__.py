"""Layered registry pipelines as plain functions over Spark DataFrames."""
