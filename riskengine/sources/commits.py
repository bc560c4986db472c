"""Commit files: written aside and claimed by a rename that never overwrites."""

from __future__ import annotations

import threading

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Hadoop's local file system looks before it renames; threads of one driver take turns here.
_TURN = threading.Lock()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def claim(spark: SparkSession, written: str, name: str) -> bool:
    """Give a written file a name that nobody has taken; False if somebody has."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(name)
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(hadoop, "Options$Rename")
    never = spark.sparkContext._gateway.new_array(kind, 1)
    never[0] = kind.NONE
    try:
        with _TURN:
            context.rename(hadoop.Path(written), target, never)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
