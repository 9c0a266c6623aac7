"""Directory listing and removal through Hadoop's FileSystem, so any store Spark reads works."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (one listing call, not recursive)."""
    fs, hadoop_path = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]


def listing(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of last change of what lies in ``path`` (one listing call): differs once a table there was written anew."""
    fs, hadoop_path = _file_system(spark, path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(hadoop_path)))


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def delete_files(spark: SparkSession, uris: Sequence[str]) -> None:
    """Remove files, named as in ``_metadata.file_path``, and the folders that are empty without them."""
    folders = {}
    for uri in uris:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(hadoop_path, False)
        folders[hadoop_path.getParent().toString()] = (fs, hadoop_path.getParent())
    for fs, folder in folders.values():
        if len(fs.listStatus(folder)) == 0:
            fs.delete(folder, False)
