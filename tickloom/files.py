"""Files and folders, through the Hadoop file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    path, files = _at(spark, folder)
    return sorted(x.getPath().getName() for x in files.listStatus(path)) if files.exists(path) else []


def exists(spark: SparkSession, path: str) -> bool:
    path, files = _at(spark, path)
    return files.exists(path)


def make_folder(spark: SparkSession, path: str) -> None:
    path, files = _at(spark, path)
    files.mkdirs(path)


def delete(spark: SparkSession, name: str) -> None:
    path, files = _at(spark, name)
    files.delete(path, True)


def delete_at_end(spark: SparkSession, name: str) -> None:
    """Delete a path when the application ends."""
    path, files = _at(spark, name)
    files.deleteOnExit(path)


def write_text(spark: SparkSession, name: str, text: str) -> None:
    path, files = _at(spark, name)
    out = files.create(path, True)
    out.writeUTF(text)
    out.close()


def read_text(spark: SparkSession, name: str) -> str:
    path, files = _at(spark, name)
    source = files.open(path)
    text = source.readUTF()
    source.close()
    return text
