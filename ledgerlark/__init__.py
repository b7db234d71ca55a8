"""Ledgerlark: customer intelligence over retail sales data, written as Spark jobs.

Every operator is a plain function from DataFrames and parameters to a DataFrame.
"""
