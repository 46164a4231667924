"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
driver queries and their DuckDB SQL.  Every operator takes and returns
DataFrames: Spark partitions, shuffles, sorts and recovers the work, numpy over
Arrow batches does the byte-level inner loops inside a task.
"""
