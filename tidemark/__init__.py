"""Auditable batch analytics on Spark: DataFrame in, DataFrame out."""
