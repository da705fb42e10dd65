"""Tables between two steps of a job, in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_paths: dict = {}


def scratch(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of our own, which only a local master may use."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir is not set: on a cluster it has to name a folder that all machines share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="lograil-"))
    return _own_dir[0]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch(spark)}/lograil-{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes df to the shared folder and reads it back.

    It cuts the lineage as checkpoint() does, but runs the plan once, and a lost executor costs no more than a re-read.
    """
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[id(out)] = (weakref.ref(out), path)
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes the tables of materialized frames that no plan will read again."""
    for df in frames:
        ref, path = _paths.pop(id(df), (None, ""))
        if ref is not None and ref() is df:
            jvm = df.sparkSession.sparkContext._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
