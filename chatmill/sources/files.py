"""Files and folders of any file system that Spark reaches, from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop's objects."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop(spark, path)
    return fs.exists(target)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, hidden ones too; none if there is no such folder."""
    fs, target = hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, target = hadoop(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a file or folder to a name that is not taken; False if there is none."""
    (fs, source), (_, target) = hadoop(spark, path), hadoop(spark, to)
    if not fs.exists(source):
        return False
    if fs.exists(target):
        raise FileExistsError(to)
    return fs.rename(source, target)


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with this text, whole or not at all; False if the path is taken already.

    Written under a hidden name and renamed, which no file system does onto a name that exists.
    """
    fs, target = hadoop(spark, path)
    if fs.exists(target):
        return False
    _, hidden = hadoop(spark, f"{target.getParent().toString()}/.{target.getName()}.{spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()}")
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.rename(hidden, target):
        return True
    fs.delete(hidden, False)
    return False


def text_of(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, target = hadoop(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def file_system(path: str):
    """The file system of a path or address, and the path in it, as pyarrow's objects: for tasks, and wherever there is no JVM."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)


def mounted_path(path: str) -> str | None:
    """The path in the local file tree of a folder that is mounted there; None for other file systems."""
    from pyarrow import fs

    system, inside = file_system(path)
    return inside if isinstance(system, fs.LocalFileSystem) else None
