"""Stored lists as versions: a folder per version, which counts once its success marker is there.

Spark's committer writes the marker last. Versions are numbered; the highest marked one is the current one, so
replacing a list never leaves a moment without one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_PREFIX, _MARKER = "v=", "_SUCCESS"
# Versions that stay when a new one is there.
KEPT = 2


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folders(spark: SparkSession, path: str, prefix: str) -> dict[str, tuple[str, int]]:
    """Complete folders whose name begins with ``prefix``: the rest of the name, path and time of change."""
    files, place = _folder(spark, path)
    if not files.exists(place):
        return {}
    found = {}
    for status in files.listStatus(place):
        folder = status.getPath()
        name = folder.getName()
        marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, _MARKER)
        if status.isDirectory() and name.startswith(prefix) and files.exists(marker):
            found[name[len(prefix) :]] = (folder.toString(), status.getModificationTime())
    return found


def delete(spark: SparkSession, path: str) -> None:
    files, place = _folder(spark, path)
    files.delete(place, True)


def complete(spark: SparkSession, path: str) -> list[str]:
    """Paths of the complete versions, oldest first."""
    return [folder for _, (folder, _) in sorted(folders(spark, path, _PREFIX).items())]


def current(spark: SparkSession, path: str) -> str | None:
    """Path of the current version; None before the first one."""
    found = complete(spark, path)
    return found[-1] if found else None


def next_path(spark: SparkSession, path: str, note: str = "") -> str:
    """A folder for the next version; ``note`` ends its name."""
    names = sorted(folders(spark, path, _PREFIX))
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    return f"{path.rstrip('/')}/{_PREFIX}{number:020d}-{uuid.uuid4().hex[:8]}{note}"


def tidy(spark: SparkSession, path: str, kept: int = KEPT, hours: float = 0) -> None:
    """Delete all but the last ``kept`` versions, of those the ones the newest is ``hours`` younger than.

    The times are the storage's own.
    """
    found = [status for _, status in sorted(folders(spark, path, _PREFIX).items())]
    for folder, changed in found[:-kept]:
        if found[-1][1] - changed >= hours * 3_600_000:
            delete(spark, folder)


def write(rows: DataFrame, path: str, fmt: str) -> None:
    spark = rows.sparkSession
    rows.write.format(fmt).save(next_path(spark, path))
    tidy(spark, path)
