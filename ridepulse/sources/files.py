"""Small files on the cluster's file system (any store that Spark reaches), from the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if there is no such folder."""
    fs, path = _fs(spark, folder), _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file, whole or not at all; False if there is one already (it stays as it is)."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
    fs = _fs(spark, path)
    stream = fs.create(_path(spark, hidden), False)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(_path(spark, hidden), _path(spark, path), plain)  # fails if the target exists
        return True
    except Exception:
        if not fs.exists(_path(spark, path)):
            raise
        return False
    finally:
        fs.delete(_path(spark, hidden), False)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the library's own output; nothing if it is gone."""
    _fs(spark, path).delete(_path(spark, path), True)
