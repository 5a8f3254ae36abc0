"""Operators for preparing language-model training data, each by one named method.

Nothing outside this package imports it. Every operator takes DataFrames with whatever other
columns they have and returns a DataFrame; intermediate tables go to the shared folder of the
session (``spark.checkpoint.dir``).
"""
