"""Civic-records analytics on Spark: tolerant loading, cleaning, and a fixed family of reports.

Every operator takes DataFrames plus column names and returns a lazy DataFrame, so the same
report runs on permits, orders or any other table that can fill the roles.
"""

__version__ = "0.1.0"
