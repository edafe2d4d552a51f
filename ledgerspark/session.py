"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "ledgerspark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings every job here assumes.

    * UTC session zone: business times are zone-less ``timestamp_ntz`` and the
      ingestion stamp is compared in UTC.
    * AQE on, with partition coalescing and skew-join splitting, so the
      initial ``spark.sql.shuffle.partitions`` can be sized for the largest
      stage (thousands on a cluster) and small stages shrink at run time.
    * No UI server.
    * No per-call Python origin capture (a debugging aid that costs a JVM
      round trip per DataFrame call while plans are built).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def iceberg_conf(catalog: str = "lakehouse", env: dict[str, str] | None = None) -> dict[str, str]:
    """Spark settings for an Iceberg catalog in object storage, for
    ``build_session(extra=...)``.

    Everything comes from the environment; nothing has a default, secrets
    least of all, and settings whose variable is unset are left out:
    ``ICEBERG_CATALOG_IMPL``, ``ICEBERG_CATALOG_URI``, ``ICEBERG_CATALOG_REF``,
    ``ICEBERG_WAREHOUSE``, ``ICEBERG_IO_IMPL``, ``S3_ENDPOINT``, ``S3_REGION``,
    ``S3_ACCESS_KEY``, ``S3_SECRET_KEY``.  The Iceberg jar is not bundled.
    """
    e = os.environ if env is None else env
    if not e.get("ICEBERG_WAREHOUSE"):
        raise ValueError("an Iceberg catalog needs a warehouse (ICEBERG_WAREHOUSE)")
    own = f"spark.sql.catalog.{catalog}"
    conf = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        own: "org.apache.iceberg.spark.SparkCatalog",
        "spark.sql.defaultCatalog": catalog,
    }
    per_variable = {
        "ICEBERG_CATALOG_IMPL": [f"{own}.catalog-impl"],
        "ICEBERG_CATALOG_URI": [f"{own}.uri"],
        "ICEBERG_CATALOG_REF": [f"{own}.ref"],
        "ICEBERG_WAREHOUSE": [f"{own}.warehouse"],
        "ICEBERG_IO_IMPL": [f"{own}.io-impl"],
        "S3_ENDPOINT": [f"{own}.s3.endpoint", "spark.hadoop.fs.s3a.endpoint"],
        "S3_REGION": [f"{own}.s3.region"],
        "S3_ACCESS_KEY": [f"{own}.s3.access-key-id", "spark.hadoop.fs.s3a.access.key"],
        "S3_SECRET_KEY": [f"{own}.s3.secret-access-key", "spark.hadoop.fs.s3a.secret.key"],
    }
    for variable, names in per_variable.items():
        if e.get(variable):
            conf.update(dict.fromkeys(names, e[variable]))
    if e.get("S3_ENDPOINT"):  # an own endpoint serves buckets as paths
        conf[f"{own}.s3.path-style-access"] = conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
    return conf


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for tables and checkpoints written by jobs.

    Read from the session (``spark.checkpoint.dir``, the cluster's shared
    storage).  Only when it is unset and the master is local (tests, laptops)
    is a local folder created and registered.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = sc.getCheckpointDir()
        if current:
            base = current
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "before running jobs that write tables or checkpoints"
            )
        base = tempfile.mkdtemp(prefix="ledgerspark-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new, unused location under the scratch folder."""
    return os.path.join(scratch_dir(spark), f"{kind}-{uuid.uuid4().hex[:12]}")
