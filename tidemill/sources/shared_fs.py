"""Small files in a folder that may lie on any file system Spark can reach."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write text to a path that must not exist; False if it does. The text is written to a
    side file first, so that a reader never sees half of it, and takes its name in one step that fails if the
    name is taken: a hard link on a local file system, elsewhere a rename that does not replace (one step on HDFS; an object store
    whose rename is a copy needs a single writer)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    jvm = spark.sparkContext._jvm
    side = jvm.org.apache.hadoop.fs.Path(f"{path}.{jvm.java.util.UUID.randomUUID()}.tmp")
    out = fs.create(side, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if (p.toUri().getScheme() or fs.getScheme()) == "file":
            os.link(side.toUri().getPath(), p.toUri().getPath())
        else:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            none = spark.sparkContext._gateway.new_array(rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(side.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(side, p, none)
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    finally:
        fs.delete(side, False)
    return True


def size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getLen()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    s = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(s, "UTF-8")
    finally:
        s.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def modified(spark: SparkSession, path: str) -> int:
    """Milliseconds of the epoch."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
