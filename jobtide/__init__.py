"""Job-posting analytics on Spark DataFrames.

Every operator takes and returns DataFrames, every function takes and returns
Columns, and all of them are built from Spark's own expressions, so Catalyst
sees one plan from the scan to the sink.
"""

__version__ = "0.1.0"
