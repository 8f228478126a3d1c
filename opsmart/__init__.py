"""opsmart - facility-operations analytics as plain PySpark DataFrame jobs.

Layers: ``sources`` (landing/bronze/silver storage and JDBC publishing), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame building blocks), ``plans``
(silver tables, gold marts, serving queries, batch jobs) and ``streaming`` (the
incremental ingest as a file stream).
"""
