"""Publish a result at once: versions in folders of their own, and a marker that names the current one.

``overwrite`` removes the old files before the new ones are there, so a reader or a failed job meets half a result. Here a
version is written to a new folder, and only when its job has succeeded does a marker file appear, by a rename of a
numbered claim. Readers take the version of the highest marker. Markers are numbered, so of two writers
that publish at the same time both succeed, one after the other, and no version is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MARKERS = "_published"
TRIES = 100  # writers that may take a number before this one


def _files(spark: SparkSession, root: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{root}/{MARKERS}")
    return jvm, place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and folder of every published version, oldest first."""
    _, place, fs = _files(spark, root)
    if not fs.exists(place):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(place)]
    marks = sorted(n.split("-", 1) for n in names if n[0].isdigit())
    return [(int(number), f"{root}/version-{folder}") for number, folder in marks]


def current(spark: SparkSession, root: str) -> str:
    """Folder of the version to read."""
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"nothing is published under {root}")
    return found[-1][1]


def publish(spark: SparkSession, root: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Call ``write(folder)`` with a new folder, then make it the current version; returns the folder.

    If ``write`` fails, its folder is removed and the version before stays current. The last ``keep`` versions stay, so
    a reader that has begun keeps its files; older ones are removed.
    """
    jvm, place, fs = _files(spark, root)
    name = uuid.uuid4().hex
    folder = f"{root}/version-{name}"
    path = jvm.org.apache.hadoop.fs.Path
    try:
        write(folder)
    except BaseException:
        fs.delete(path(folder), True)
        raise
    fs.mkdirs(place)
    for _ in range(TRIES):
        taken = [int(f.getPath().getName().removeprefix("claim-").split("-")[0]) for f in fs.listStatus(place)]
        number = max(taken, default=0) + 1  # beyond claims too, which a writer that died may have left
        claim = path(place, f"claim-{number:012d}")
        # The claim is taken by one writer only: creating it fails where it exists.
        if fs.createNewFile(claim):
            fs.rename(claim, path(place, f"{number:012d}-{name}"))
            break
    else:
        raise RuntimeError(f"no version number is free under {root}")
    for number, old in versions(spark, root)[:-keep]:
        fs.delete(path(place, f"{number:012d}-{old.rsplit('-', 1)[1]}"), False)
        fs.delete(path(old), True)
    return folder


def publish_table(df: DataFrame, root: str, keep: int = 2) -> str:
    """The table as Parquet, as the new version."""
    return publish(df.sparkSession, root, lambda folder: df.write.parquet(folder), keep)


def read_published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(current(spark, root))
