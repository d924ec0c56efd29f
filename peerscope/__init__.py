"""peerscope: layered place analytics and peer matching on Apache Spark.

Sub-packages
------------
functions   pure ``Column -> Column`` expressions (hashes, slugs, casts, bands)
operators   ``DataFrame -> DataFrame`` building blocks (dedup, aggregates,
            joins, quality checks, matching)
sources     table contracts, readers and writers
plans       the layered models (staging, intermediate, marts) and the
            queries over the benchmark tables
streaming   file-stream ingest with Structured Streaming
"""

__version__ = "0.1.0"
