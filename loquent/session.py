"""Session helpers: shared scratch space and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a temporary folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder would be lost
    with its machine.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="loquent-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/loquent/{uuid.uuid4().hex}/{label}"


def write_out(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used where several branches of a plan would repeat costly work. The written
    table cuts the lineage, survives lost executors, and tells the optimizer
    its true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
