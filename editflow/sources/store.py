"""Small control files in shared folders: listing, atomic writes, removal.

Spark reads and writes all data here through DataFrames. What a stream has to publish in one step
(which batch is complete, which files make up a table) is a file of a few bytes, written under a
temporary name and renamed, through the file system that Spark itself uses for the path.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there. Temporary and checksum files are left out."""
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(where))
    return sorted(n for n in found if not n.startswith((".", "_tmp")))


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see all of it or none; an existing one is replaced."""
    fs, where = _at(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), "_tmp-" + where.getName())
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(temporary, where):  # the target is there already, from an earlier attempt
        fs.delete(where, False)
        if not fs.rename(temporary, where):
            raise OSError(f"could not publish {path}")


def text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
