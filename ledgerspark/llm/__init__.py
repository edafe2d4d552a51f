"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this package imports it.  Every operator takes DataFrames and
returns DataFrames; tables that a later step reads more than once are written
as Parquet below the session's shared folder (``spark.checkpoint.dir``).
"""
