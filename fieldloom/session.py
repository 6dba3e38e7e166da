"""Session settings that every entry point shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "fieldloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC clocks and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings |= {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``. Where it is unset, a local session gets a temporary one;
    on a cluster that is an error, as executors wouldn't find one another's files."""
    context = spark.sparkContext._jsc.sc()
    found = spark.conf.get("spark.checkpoint.dir", None) or (context.getCheckpointDir().get() if context.getCheckpointDir().isDefined() else None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="fieldloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, its lineage cut; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
