"""tickmart: daily market bars, metrics, marts and quality checks on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark
built-ins; time (``as_of``, ``batch_ts``) is always an argument.
"""

__version__ = "0.1.0"
