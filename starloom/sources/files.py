"""File system steps Spark readers and writers do not offer."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists in the file system it names."""
    system, jvm_path = _locate(spark, path)
    return system.exists(jvm_path)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none if it does not exist."""
    system, jvm_path = _locate(spark, path)
    if not system.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(jvm_path))


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does."""
    system, jvm_path = _locate(spark, path)
    try:
        out = system.create(jvm_path, False)
    except Py4JJavaError as error:
        if system.exists(jvm_path):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    system, jvm_path = _locate(spark, path)
    source = system.open(jvm_path)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written."""
    system, jvm_path = _locate(spark, path)
    system.delete(jvm_path, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have a written folder deleted when the driver's JVM ends, unless it has gone before."""
    system, jvm_path = _locate(spark, path)
    system.deleteOnExit(jvm_path)
