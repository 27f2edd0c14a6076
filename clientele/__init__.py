"""Customer and transaction analytics on PySpark DataFrames."""
