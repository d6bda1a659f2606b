"""Operators for building language-model training data on Spark.

Nothing in the rest of the package imports this subpackage.
"""
