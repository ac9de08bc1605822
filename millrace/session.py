"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on: zone-less timestamps compare in UTC, runtime re-planning is on, a bad cast
# raises instead of turning into NULL (the tolerant paths use try_cast on purpose).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# Writer options of folders that are read only once their ``_SUCCESS`` mark is there.
MARK_FINISHED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above, and this package on its executors; extra settings are given as
    ``spark__sql__x="v"`` keywords."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, which Python functions running there import."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), home.name), "zip", home.parent, home.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach. ``spark.checkpoint.dir`` names it on a cluster; a machine-local
    folder is made only for a local master where nothing is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _local_scratch[context.applicationId]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path (not yet created) under the shared scratch folder."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: its lineage ends there, and its size is known from
    the files, so Spark broadcasts it exactly when it is small."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes, -1 when broadcasting is off."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob on whatever file system the path names (metadata only)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(path)
    return sorted(status.getPath().toString() for status in found) if found else []
