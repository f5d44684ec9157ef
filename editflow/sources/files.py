"""Small file-system helpers over the session's Hadoop FileSystem.

Only metadata operations (exists / list / rename / delete) run on the
driver; data always moves through Spark readers and writers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def list_names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(
        status.getPath().getName()
        for status in fs.listStatus(hpath)
        if status.getPath().getName().startswith(prefix)
    )


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _fs_and_path(spark, source)
    jvm = spark.sparkContext._jvm
    dst = jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; a target of the same size is a copy whose source was not removed, any other is made again."""
    fs, src = _fs_and_path(spark, source)
    dst = _fs_and_path(spark, target)[1]
    if fs.exists(dst):
        if fs.getFileStatus(dst).getLen() == fs.getFileStatus(src).getLen():
            fs.delete(src, False)
            return
        fs.delete(dst, False)
    rename(spark, source, target)


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_and_path(spark, path)
    fs.delete(hpath, True)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches a glob pattern."""
    fs, hpath = _fs_and_path(spark, pattern)
    return bool(fs.globStatus(hpath))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text (notes of a few hundred bytes)."""
    fs, hpath = _fs_and_path(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it may be seen half-written, so rename it to the name that readers look for."""
    fs, hpath = _fs_and_path(spark, path)
    stream = fs.create(hpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
