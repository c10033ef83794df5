"""aqlake: a Spark-native lake for environmental measurement documents.

Layers, each a set of ``DataFrame -> DataFrame`` functions:

* ``sources``   - register CSV, JSON document files, declared schemas
* ``functions`` - column expressions (labels, calendar parts, keys, JSON paths)
* ``operators`` - dedup, flatten, feed join, register match, star schema, upsert
* ``plans``     - the derived tables put together, and their versioned refresh
* ``streaming`` - continuous ingest and incremental refresh
"""
