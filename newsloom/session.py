"""Session settings the engine relies on, and its shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "newsloom", **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution.

    The number of shuffle partitions is left to the cluster's settings and to
    adaptive coalescing.
    """
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               # Feed snapshots can be large: few of them per transfer to Python.
               .config("spark.sql.execution.arrow.maxRecordsPerBatch", "500"))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Work folders of local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    It is read from ``spark.checkpoint.dir``, then from the checkpoint folder of
    the context; no setting is changed.  Only a local session, where driver and
    tasks share one machine, may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="newsloom-")
    return _LOCAL_ROOTS[app]


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared work folder."""
    return f"{work_root(spark)}/newsloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The data survives the loss of any executor, and later plans start from a
    plain Parquet scan, with column pruning and file statistics.
    """
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan out over as many tasks as ``newsloom.scan.partitions`` says.

    Only for tables of few, unsplittable files; without the setting a scan is
    left as Spark reads it.
    """
    wanted = scan.sparkSession.conf.get("newsloom.scan.partitions", None)
    return scan.repartition(int(wanted)) if wanted else scan
