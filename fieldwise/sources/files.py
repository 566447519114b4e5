"""Files of a table's folder through Hadoop's file system, wherever the folder is.

Only names and small text files pass through the driver, never rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a folder; none, if it is absent."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with what it holds (a version or a partition that is given up)."""
    _fs(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None, if it is absent."""
    if not exists(spark, path):
        return None
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place in one step: readers see the old text or the new one."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    fresh = f"{path}.{uuid.uuid4().hex}"
    out = _fs(spark, fresh).create(_path(spark, fresh), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    target = _path(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)  # noqa: SLF001
    options[0] = option.OVERWRITE
    context.rename(_path(spark, fresh), target, options)
