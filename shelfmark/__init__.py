"""Bulk catalog, transfer, tagging and sharing jobs for a file store, on Spark.

Every operator takes DataFrames and returns a DataFrame; see README.md for the
tour and ``shelfmark.plans`` for one runnable query per operator.
"""

__version__ = "0.1.0"
