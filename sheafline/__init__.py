"""sheafline: seasonal supply forecasting operators on Spark DataFrames.

``functions``  column helpers (rounding, ISO weeks, seasons, cyclic encodings)
``sources``    input schemas, parquet readers and table writers
``operators``  the DataFrame -> DataFrame operators
``plans``      the operators bound to the test tables, one entry per query

Every operator is lazy: it takes DataFrames and plain parameters and returns a
DataFrame. Nothing reads the clock; a run date is always passed as ``as_of``.
"""

__version__ = "0.1.0"
