"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

def build_session(app: str = "termloom", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots.

    A cluster passes its own ``spark.*`` settings through spark-submit, so
    nothing that depends on cluster size is fixed here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def package_on_path(spark: SparkSession) -> None:
    """Put the package on the path of this session's Python workers, where it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where it is unset, as in tests, it is set to a folder in the warehouse, which the
    executors of a session share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/termloom/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_tables(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once results are read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_session_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared Parquet table and read it back.

    Used where a later plan reads the same rows several times: the lineage ends
    at the files, so a lost executor costs a re-read and not a re-computation,
    and each reader still prunes to the columns it needs.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
