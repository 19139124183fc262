"""Point-in-time features and honest evaluation on Spark DataFrames.

Every feature of a row is built only from what existed before that row.
"""
