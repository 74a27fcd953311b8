"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # sessions of a hot key are merged on the map side before they are shuffled
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # what a query shuffled is deleted when it has ended; a cached table that loses a block makes it anew
    CLEANUP: "true",
}


#: Folders of local applications without the setting, which a live session doesn't accept.
_local: dict[str, str] = {}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options every operator relies on (all can be changed on a live session)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    A temporary folder, one per application, is used only where the setting is missing and Spark runs in local mode.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local:
        _local[application] = tempfile.mkdtemp(prefix="run-")
    return _local[application]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, so that later steps start from the table.

    What the write shuffled is not needed again and is deleted with it, on this session from now on.
    """
    path = fresh_dir(df.sparkSession, label)
    df.sparkSession.conf.set(CLEANUP, "true")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that `cut_lineage` wrote, once everything made from them is written as well."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
