"""Folders and files through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def qualified(spark: SparkSession, name: str) -> str:
    """The URI of a path with the default file system filled in, for readers outside the JVM."""
    system, path = _open(spark, name)
    full = system.makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if not full.startswith("file:///") else full


def exists(spark: SparkSession, name: str) -> bool:
    system, path = _open(spark, name)
    return system.exists(path)


def children(spark: SparkSession, folder: str) -> list[tuple[str, int, bool]]:
    """(name, bytes, is a folder) of what a folder holds, hidden names left out."""
    system, path = _open(spark, folder)
    if not system.exists(path):
        return []
    found = [(s.getPath().getName(), s.getLen(), s.isDirectory()) for s in system.listStatus(path)]
    return sorted(f for f in found if not f[0].startswith(("_", ".")))


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of a partitioned table's folders; one listing of its root."""
    prefix = f"{column}="
    names = (name for name, _, folder in children(spark, root) if folder)
    return [name.removeprefix(prefix) for name in names if name.startswith(prefix)]


def delete(spark: SparkSession, name: str) -> None:
    system, path = _open(spark, name)
    system.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    system, path = _open(spark, source)
    _, place = _open(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(path, place):
        raise OSError(f"could not move {source} to {target}")


def touch(spark: SparkSession, name: str) -> None:
    system, path = _open(spark, name)
    system.create(path).close()


def make_folder(spark: SparkSession, name: str) -> None:
    system, path = _open(spark, name)
    system.mkdirs(path)
