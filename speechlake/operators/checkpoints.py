"""Cut lineage in a folder every executor can reach."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOTS: dict[str, str] = {}  # application id to the folder of its tables
_OPEN = threading.local()  # tables settled inside ``temporary`` blocks of this thread


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _remove_quietly(spark: SparkSession, path: str) -> None:
    try:
        _remove(spark, path)
    except Exception:  # noqa: BLE001  the JVM may be gone when Python ends
        pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The application's own folder under ``spark.checkpoint.dir``; removed when the program ends.

    Without that setting a cluster is refused; in local mode a scratch folder stands in for it.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not named:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            named = tempfile.mkdtemp(prefix="spark-")
        _ROOTS[app] = f"{named.rstrip('/')}/settled-{uuid.uuid4().hex}"
        atexit.register(_remove_quietly, spark, _ROOTS[app])
    return _ROOTS[app]


def settle(df: DataFrame) -> DataFrame:
    """Write the table to the shared folder as Parquet and go on from there; runs a job.

    Later steps read only the columns they need, plans stay short, and a lost executor costs
    a re-read, not a recomputation. Shuffle files go when the table is written: nothing reads them again.
    ``discard`` removes the table.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    for held in getattr(_OPEN, "blocks", []):
        held.append(out)
    return out


@contextlib.contextmanager
def temporary():
    """Tables settled inside the block are removed at its end, also after an error; what is to last is written elsewhere."""
    blocks = _OPEN.blocks = getattr(_OPEN, "blocks", [])
    blocks.append([])
    try:
        yield
    finally:
        for df in blocks.pop():
            discard(df)


def discard(df: DataFrame) -> None:
    """Remove a settled table that nothing reads any more."""
    path = getattr(df, "_settled_at", None)
    if path:
        _remove(df.sparkSession, path)
