"""Operators for large text corpora (quality, deduplication, decontamination,
classifiers, tokenising, sharding).

Nothing outside this package imports it.  ``queries.py`` holds the registered
queries and their SQL.  Every operator takes and returns DataFrames, names its
columns by parameter, and writes intermediate tables only into the folder of
``spark.checkpoint.dir``.
"""
