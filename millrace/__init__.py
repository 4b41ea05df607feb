"""Millrace: sync, retrieval, memory and governance jobs as plain PySpark DataFrames."""
