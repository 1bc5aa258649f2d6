"""martforge: reporting marts for marketing, sales and workspace data on Spark.

Sub-packages
------------
functions  column-level semantics (NULL-aware regex, strict aggregates, dates, URLs, rule ladders)
operators  DataFrame -> DataFrame building blocks (latest version, fills, mode, joins, reshape, ...)
sources    readers / writers and adapters that give the driver tables a source shape
plans      composed datasets (extracts and marts) and the registered query catalog
"""

__version__ = "0.1.0"
