"""Session settings and the shared work folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Every timestamp rule in the library is written for UTC.  The adaptive settings
# are what splits a hot join key: a shuffle partition far above the median is cut
# by map output, whatever its rows hold.  Broadcasts are left to the planner and
# its size threshold; the library gives no broadcast hint of unproven size.
# A join that filters one side lets the other be filtered before it is shuffled, at any size.
# The JVM compiles no method of over 8,000 bytes of code; a stage that would be generated as one, the catalogue's for
# one, is run operator by operator instead, since its method would be interpreted row by row.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; returns the session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "feedloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Where that is unset (tests, a single machine) it is a folder of the session's own
    warehouse, ``spark.sql.warehouse.dir``, which every executor can reach as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return shared.rstrip("/") if shared else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the work folder."""
    return f"{work_folder(spark)}/{name}-{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors, unlike cached or local copies."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint(eager=True)
