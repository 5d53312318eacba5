"""tidewater: table-to-table batch transforms on Spark DataFrames.

Layout:

- ``functions``: column expressions (names, text, numbers, dates, rules, JSON).
- ``operators``: DataFrame -> DataFrame operators (joins, versions, reshapes,
  history merges, set operations, aggregates).
- ``sources``: readers and writers (parquet, delimited text, partitions, audit rows).
- ``plans``: the named jobs built from the operators, plus the query catalogue
  run on the driver tables.
- ``streaming``: incremental (high-water-mark and partition-window) reads.

Every transform is lazy and pure: nothing reads the clock (``as_of`` is an
argument) and nothing collects data to the driver.
"""

from tidewater.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
