"""Cutting lineage with tables in the folder that all executors share.

A written table survives the loss of an executor, carries exact sizes for the join planner, and can be read column by
column, which an RDD checkpoint can't. Files go to the folder named by spark.checkpoint.dir; only a local master may
fall back to a folder of its own.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, or for a local master a fresh temporary one. Raises ValueError on a cluster without the setting."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):  # a local-cluster has executors of its own
        raise ValueError(f"{_SETTING} must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="spoolwright-", dir=os.environ.get("TMPDIR"))
    return _own[app]


def hadoop_path(spark: SparkSession, path: str):
    """The path's Hadoop file system and the path in it, whatever store it lies in."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def cut(df: DataFrame, label: str) -> DataFrame:
    """Writes the frame to the shared folder and returns a scan of it; the plan above it ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spoolwright/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts(spark: SparkSession) -> None:
    """Deletes the tables that this process has written with cut() in the session; frames built on them can't be read afterwards."""
    mine = [path for owner, path in _written if owner is spark]
    _written[:] = [(owner, path) for owner, path in _written if owner is not spark]
    for path in mine:
        files, where = hadoop_path(spark, path)
        files.delete(where, True)


@atexit.register
def _tidy() -> None:
    for spark in {id(owner): owner for owner, _ in _written}.values():
        try:
            drop_cuts(spark)
        except Exception:  # the session may be gone already
            pass
