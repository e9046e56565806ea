"""Spark-native document and transaction analytics.

Every operator is a plain function over DataFrames; see the sub-packages:

* ``functions``  column expressions shared by the operators
* ``sources``    scans and sinks
* ``operators``  change data, enrichment, marts, reconciliation, documents,
                 semantic layer, profiling and serving
* ``plans``      declarative specs (domains, metric views, document contracts)
                 and the plans built from them (gates, medallion)
* ``streaming``  incremental apply of change logs
* ``workload``   the registered queries and their SQL oracles
"""
