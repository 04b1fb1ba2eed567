"""Small files beside the data, on whatever file system holds it."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the file or folder is there, asked of the file system that holds it."""
    hadoop = _path(spark, path)
    return _system(spark, hadoop).exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds, if it is there."""
    hadoop = _path(spark, path)
    _system(spark, hadoop).delete(hadoop, True)


def _link(spark: SparkSession, source, target) -> bool:
    """Give a local file another name, unless there is a file of that name."""
    files = spark._jvm.java.nio.file.Files
    as_file = spark._jvm.java.io.File
    try:
        files.createLink(as_file(target.toUri().getPath()).toPath(), as_file(source.toUri().getPath()).toPath())
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def publish_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with this text, all of it at once; False if there was one by that name already.

    Of several writers exactly one makes the file, and no reader sees part of it:
    it is written under a hidden name and then renamed, which fails where the name
    is taken. A local rename would replace the file, so a link is made there. The
    file system must rename atomically, as HDFS and shared disks do.
    """
    named = _path(spark, path)
    folder = named.getParent()
    _system(spark, folder).mkdirs(folder)
    folder = _system(spark, folder).resolvePath(folder)
    system = _system(spark, folder)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder, named.getName())
    if system.exists(target):
        return False
    hidden = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{named.getName()}-{uuid.uuid4().hex}")
    out = system.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if system.getUri().getScheme() == "file":
            return _link(spark, hidden, target)
        if system.rename(hidden, target):
            return True
        if not system.exists(target):
            raise OSError(f"{path} can't be written")
        return False
    finally:
        system.delete(hidden, False)
