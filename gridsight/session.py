"""Session defaults and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    app: str = "gridsight", cores: str = "*", partitions: int = 8, settings: dict | None = None
) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GRIDSIGHT_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


#: Folders made by this process.
_OWNED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where neither that setting nor a checkpoint directory exists, a folder is made only for a
    local master, since a cluster's machines cannot see one another's temporary folders.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not (named or context.getCheckpointDir()):
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="gridsight-")
    if named and not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return (named or context.getCheckpointDir()).rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no earlier run has used.

    All paths of an application lie in one folder, which the driver's Hadoop client removes when the
    application ends; results that are to stay are written elsewhere.
    """
    application = f"{shared_dir(spark)}/gridsight-{spark.sparkContext.applicationId}"
    if application not in _OWNED:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(application)
        fs = at.getFileSystem(conf)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _OWNED.add(application)
    return f"{application}/{purpose}-{uuid.uuid4().hex}"
