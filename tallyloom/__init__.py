"""tallyloom: warehouse-building operators as plain functions over Spark DataFrames.

Sub-packages:

* ``sources``   - reading and writing tables, calendars, literal and metadata frames
* ``functions`` - Column helpers (keys, text, dates, buckets, money)
* ``operators`` - DataFrame -> DataFrame operators (dedup, upsert, joins, pivots, ledgers, ...)
* ``plans``     - the registered queries over the driver tables and their SQL oracles
* ``streaming`` - micro-batch wrappers around the batch change operators
"""

__all__ = ["session"]
