"""Catalog checks and listings: catalogs, namespaces, tables, counts, schema."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerspark.sources.schemas import BRONZE_NAMESPACE, BRONZE_TABLES


# Spark's error conditions for a name that leads nowhere.
MISSING = (
    "TABLE_OR_VIEW_NOT_FOUND",
    "SCHEMA_NOT_FOUND",
    "CATALOG_NOT_FOUND",
    "REQUIRES_SINGLE_PART_NAMESPACE",  # the first part of the name is no catalog
)


class MissingObject(LookupError):
    """A catalog, namespace or table a query needs does not exist."""


def has_catalog(spark: SparkSession, name: str) -> bool:
    return any(c.name == name for c in spark.catalog.listCatalogs())


def has_namespace(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(name)


def table_exists(spark: SparkSession, table: str) -> bool:
    """Exact-name existence.  A missing namespace or catalog means that the
    table is missing too; any other error is raised."""
    try:
        return spark.catalog.tableExists(table)
    except AnalysisException as exc:
        if exc.getCondition() in MISSING:
            return False
        raise


def require_namespace(spark: SparkSession, namespace: str = BRONZE_NAMESPACE, catalog: str | None = None) -> None:
    """``MissingObject`` unless the catalog and the namespace exist."""
    if catalog and not has_catalog(spark, catalog):
        raise MissingObject(f"catalog {catalog!r} not found")
    ns = f"{catalog}.{namespace}" if catalog else namespace
    if not has_namespace(spark, ns):
        raise MissingObject(f"namespace {ns!r} not found")


def preflight(
    spark: SparkSession,
    table: str,
    namespace: str = BRONZE_NAMESPACE,
    catalog: str | None = None,
) -> bool:
    """Checks before the analytics run: catalog, namespace and table exist
    (else ``MissingObject``); returns False when the table has no rows.

    The emptiness check reads at most one row.
    """
    require_namespace(spark, namespace, catalog)
    if not table_exists(spark, table):
        raise MissingObject(f"table {table!r} not found")
    return not spark.table(table).isEmpty()


def bronze_tables(spark: SparkSession, database: str = BRONZE_NAMESPACE) -> DataFrame:
    """Tables of a namespace (temporary views excluded)."""
    return (
        spark.sql(f"SHOW TABLES IN {database}")
        .where(~F.col("isTemporary"))
        .select(F.col("tableName").alias("table_name"))
    )


def bronze_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each frame, in one job.

    Each count is a global aggregate (per-task partial counts, one row each
    into the final), so nothing but counts crosses the shuffle.
    """
    parts = [
        f.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, f in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def bronze_counts_in(spark: SparkSession, database: str = BRONZE_NAMESPACE, tables=None) -> DataFrame:
    """Row counts of the known bronze tables that exist; absent ones skipped."""
    names = tables or BRONZE_TABLES
    present = {t: spark.table(f"{database}.{t}") for t in names if table_exists(spark, f"{database}.{t}")}
    if not present:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return bronze_counts(present)


SCHEMA_LISTING = StructType(
    [
        StructField("column_name", StringType(), False),
        StructField("data_type", StringType(), False),
    ]
)


def bronze_schema(spark: SparkSession, table: str) -> DataFrame:
    """Column name and type of ``table`` in ordinal order, without the
    technical partition column.

    Built from the table's schema (metadata, one row per column), not from
    its data.
    """
    fields = spark.table(table).schema.fields
    rows = [(f.name, f.dataType.simpleString()) for f in fields if f.name != "_batch"]
    return spark.createDataFrame(rows, SCHEMA_LISTING)
