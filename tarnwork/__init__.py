"""Reusable batch operators on the Spark DataFrame API.

Every operator takes DataFrames and returns a DataFrame. Nothing here changes
session settings, and nothing depends on them.
"""
