"""Session settings and the shared folder used for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_base: dict[str, str] = {}  # application id -> folder of a local session


def build_session(app: str = "tideline", master: str | None = None, **conf) -> SparkSession:
    """A session with AQE on and UTC time; ``conf`` entries override (dots as ``__``)."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session may fall back to a machine-local folder: on a cluster
    the executors would not see it.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        app = context.applicationId
        if app not in _local_base:
            _local_base[app] = tempfile.mkdtemp(prefix="tideline-")
        base = _local_base[app]
    return f"{base.rstrip('/')}/tideline/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a derived table feeds several branches of one plan: the work is
    done once, survives lost executors, and later scans still prune columns.
    At most ``files`` tasks write, which the caller derives from the rows: a file costs an executor
    several processes, as Hadoop sets the rights of local files and folders by ``chmod``.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    if files is not None:
        df = df.coalesce(max(files, 1))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
