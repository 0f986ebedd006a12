"""tradelanes: Spark-native trade-lane analytics.

Every operator takes and returns DataFrames and is built from Spark's own
column expressions, joins, aggregates and windows.  Layout:

* ``sources``   - CSV scans with contracts, landing, manifest, layout writer
* ``functions`` - scalar column expressions (ratios, growth caps, keys, bands)
* ``operators`` - relational building blocks (conform, reshape, enrich,
                  measures, periods, ranking, anomaly, quality)
* ``plans``     - silver / gold / serving compositions and the analogue
                  inputs built on the driver tables
* ``streaming`` - incremental pickup of arriving files
"""

__version__ = "0.1.0"
