"""Retail analytics built from Spark DataFrame, SQL, streaming and ML operators."""
