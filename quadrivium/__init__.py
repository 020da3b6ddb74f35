"""Catalog, feedback and retrieval analytics as plain Spark DataFrame jobs.

Layers, from small to large:

* ``functions``  column expressions (text, HTML, JSON replies, vectors)
* ``sources``    table schemas, readers, writers, small fixed dimensions
* ``operators``  reusable distributed building blocks (pair folds, exact
  positions, running totals, salted joins, keyed updates, clustering)
* ``plans``      whole jobs: ingest, retrieval, drift, bias, evaluation
* ``streaming``  the incremental ingest as a file stream
* ``workloads``  the jobs bound to the driver tables, each with its SQL twin
"""
