"""Session helpers: a local session for tests and benches, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches. Cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyframe")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    conf = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallyframe-")} | conf
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders chosen for local sessions that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only for a local master that names none is a local folder chosen, once per application; on a
    cluster a missing setting is an error, because a machine's own folder is not shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tallyframe-")
    return _LOCAL_FOLDERS[context.applicationId]


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run's table under the shared folder."""
    return f"{shared_folder(spark)}/tallyframe/{uuid.uuid4().hex}/{name}"
