"""Layered monthly feature tables as plain Spark jobs.

``sources``/``sinks``   read and write the lake layers
``functions``           column expressions (casts, text, dates, ids, classes)
``operators``           DataFrame -> DataFrame building blocks
``plans``               the jobs: ingest, conform, stage, book, whole month
``checks``              the registered queries and their SQL oracles
"""

__version__ = "0.1.0"
