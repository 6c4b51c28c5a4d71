"""statlens: indicator and snapshot analytics as Spark DataFrame plans.

Subpackages:

* ``sources``   - readers and table writers (indicator CSVs, employee snapshots, parquet tables)
* ``functions`` - column helpers and exact aggregate expressions
* ``operators`` - cleaning, statistics, subsets, joins, ranking, chart datasets, profiles,
  department statistics and publishing
* ``plans``     - the indicator analysis, the snapshot job, and the registered test-table queries
* ``streaming`` - the file-triggered refresh
"""

__version__ = "0.1.0"
