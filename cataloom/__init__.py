"""cataloom: catalog-driven table analytics on Spark DataFrames.

Modules:

* ``cataloom.session`` -- session builder, shared checkpoint folder,
  ``materialize``, ``cluster_conf``.
* ``cataloom.sources`` -- ``catalog`` (documents, FKs, views), ``files``
  (scans, JSON, Avro, ingestion layout), ``derived`` (ORC sinks, derived
  table life cycle).
* ``cataloom.operators`` -- ``project``, ``join`` (FK-discovered, condition,
  equi, range, join-back, salting), ``aggregate`` (named and SQL aggregates,
  latest row per group), ``fkgraph``, ``profile``, ``learn``.
* ``cataloom.functions.rules`` -- campaign indicator rules as Columns.
* ``cataloom.plans`` -- driver-table catalog, campaign job and its analog
  inputs, the registry of queries with DuckDB oracle SQL.
* ``cataloom.streaming`` -- file-stream scan, state-store max, sinks.
"""

__version__ = "0.1.0"
