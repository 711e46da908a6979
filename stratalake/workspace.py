"""Durable scratch folders, and the few file system calls the jobs make from the driver."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Where that is unset, a local session uses a folder of its warehouse; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody else uses, below the shared folder. It is not created yet."""
    return f"{shared_root(spark)}/stratalake/{purpose}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = _path(spark, path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    file_system, hadoop_path = _file_system(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that is there whole or not at all."""
    file_system, hadoop_path = _file_system(spark, path)
    written = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = file_system.create(written, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not file_system.rename(written, hadoop_path):
        raise OSError(f"{path} could not be written")


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in one call. A missing path is nothing to delete."""
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.delete(hadoop_path, True)


def delete_file(spark: SparkSession, path: str) -> bool:
    """Delete one file; false if it is not there any more."""
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.delete(hadoop_path, False)


def move_file(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file into a folder, under its own name."""
    file_system, hadoop_path = _file_system(spark, path)
    if not file_system.rename(hadoop_path, _path(spark, f"{folder}/{hadoop_path.getName()}")):
        raise OSError(f"{path} could not be moved to {folder}")


def folder_entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Path of each entry of a folder, and whether it is a folder itself."""
    file_system, hadoop_path = _file_system(spark, path)
    return [(e.getPath().toString(), e.isDirectory()) for e in file_system.listStatus(hadoop_path)]


def delete_empty_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder that holds nothing; one that does stays, whenever that came in."""
    file_system, hadoop_path = _file_system(spark, path)
    try:
        return file_system.delete(hadoop_path, False)
    except Py4JJavaError as error:
        if "java.io.IOException" in str(error.java_exception):
            return False
        raise
