"""What lies in a shared folder, through the file systems that Spark reads and writes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of files and folders, sorted; none if there is no such folder."""
    system, target = _folder(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write of Spark's to the folder has been committed."""
    system, target = _folder(spark, f"{path}/_SUCCESS")
    return system.exists(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    system, one = _folder(spark, source)
    _, other = _folder(spark, target)
    if not system.rename(one, other):
        raise OSError(f"cannot move {source} to {target}")


def make(spark: SparkSession, path: str) -> None:
    """An empty folder, unless there is one."""
    system, target = _folder(spark, path)
    if not system.mkdirs(target):
        raise OSError(f"cannot make {path}")


def delete(spark: SparkSession, path: str) -> None:
    """A folder with all that is in it, if it is there."""
    system, target = _folder(spark, path)
    system.delete(target, True)


def numbered(spark: SparkSession, path: str, key: str, after: int | None = None) -> list[int]:
    """Numbers of the committed folders `key=number`, in order; above `after` alone."""
    found = []
    for name in names_in(spark, path):
        start, _, text = name.partition("=")
        if start != key or not text.lstrip("-").isdigit():
            continue
        number = int(text)
        if (after is None or number > after) and is_complete(spark, f"{path}/{name}"):
            found.append(number)
    return sorted(found)
