"""Spark-native macro time-series lakehouse: bronze vintages to silver, gold, features and nowcasts.

Every operator takes DataFrames and returns a DataFrame; dates that drive a result (``as_of``,
``cutoff``) are arguments, never the clock.
"""
