"""ledgerspark: bank-transaction ingest and analytics as plain Spark jobs.

Layout
------
``functions``  typed columns (the one place for casts) and exact money math
``sources``    record schemas, Kafka-shaped frames, JSON parse, bronze tables,
               catalog checks, test fixtures derived from the given tables
``operators``  one ``DataFrame -> DataFrame`` function per analytic or rule
``plans``      query registry, section runner, typed silver layer
``streaming``  Structured Streaming ingest
"""

__version__ = "0.1.0"
