"""Distributed analytics operators for PySpark: DataFrame in, DataFrame out."""
