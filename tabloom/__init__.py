"""Tabular learning queries on Spark: DataFrame in, DataFrame out."""
