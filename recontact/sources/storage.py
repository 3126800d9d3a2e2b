"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set, a session whose executors run in the driver's own process gets a temporary
    one; any other is refused, as its executors would not see it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="recontact-"))
    return sc.getCheckpointDir()


def _hadoop(spark: SparkSession, path: str):
    """File system and path, of whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library with all it holds; one that is not there is no error."""
    files, place = _hadoop(spark, path)
    files.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; none if it is not there."""
    files, place = _hadoop(spark, path)
    if not files.exists(place):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory())


PREPARED = "_prepared"


def mark_prepared(spark: SparkSession, path: str) -> None:
    """Note in a folder that it was written to its end. Readers of the table skip the mark."""
    files, place = _hadoop(spark, f"{path.rstrip('/')}/{PREPARED}")
    files.create(place, True).close()


def is_prepared(spark: SparkSession, path: str) -> bool:
    files, place = _hadoop(spark, f"{path.rstrip('/')}/{PREPARED}")
    return files.exists(place)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_WRITTEN: dict[str, list[tuple[DataFrame, str]]] = {}


def written_once(df: DataFrame, label: str = "rows") -> DataFrame:
    """Rows computed once and read back from a table in the shared folder, without lineage.

    A lost executor costs a re-read, and later passes read only the columns they need. The table stays
    until ``release`` or ``release_all``, as results read it when they run.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append((read, path))
    return read


def release(*frames: DataFrame) -> None:
    """Delete the tables of frames that ``written_once`` returned and that nothing reads any more."""
    for df in frames:
        own = _WRITTEN.get(df.sparkSession.sparkContext.applicationId, [])
        for entry in [e for e in own if e[0] is df]:
            delete(df.sparkSession, entry[1])
            own.remove(entry)


def release_all(spark: SparkSession) -> int:
    """Delete all tables that this session wrote and did not release, at the end of a job whose
    results are stored; their number."""
    own = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for _, path in own:
        delete(spark, path)
    return len(own)
