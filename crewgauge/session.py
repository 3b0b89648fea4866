"""Session helpers: local sessions for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("crewgauge")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster the
    setting is required, because a machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    folder = tempfile.mkdtemp(prefix="crewgauge-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# The folder of this process's runs below the shared folder, made with the first path.
_run: list[str] = []
_databases: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call uses; ``release`` deletes it."""
    if not _run:
        _run.append(f"{shared_dir(spark)}/crewgauge/run-{uuid.uuid4().hex}")
    return f"{_run[0]}/{name}-{uuid.uuid4().hex}"


def scratch_database(name: str) -> None:
    """Let ``release`` drop a database."""
    _databases.append(name)


def release(spark: SparkSession) -> None:
    """Delete all scratch files and databases of this process.

    Frames made before are lazy and may still read them, so whoever runs the queries calls this
    when their results are out, also after an error.
    """
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")
    while _run:
        path = spark._jvm.org.apache.hadoop.fs.Path(_run.pop())
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
