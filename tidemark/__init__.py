"""Measure how the content of recurring, versioned documents shifts over time, on Spark.

Layout
------
``functions``  column builders (scores, text, vectors, identifiers, SQL registration)
``operators``  DataFrame -> DataFrame steps (intensity, changes, drift, chunking, gold ...)
``sources``    readers and writers (corpus tables, filing archives, HTTP, gold layer)
``plans``      compositions: end-to-end drift plan, gold star, report slices, query catalog
``streaming``  incremental refresh with Structured Streaming
"""

__version__ = "0.1.0"
