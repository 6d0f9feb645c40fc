"""Small files through which readers find what writers have finished.

On HDFS and local disks each step that readers depend on happens whole or not at all.  An object store without an
atomic rename needs a committer or table format in its place.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

POINTER = "CURRENT"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def read_text(spark: SparkSession, path: str) -> str:
    fs, source = file_system(spark, path)
    stream = fs.open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = file_system(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def _rename(spark: SparkSession, source: str, target: str, overwrite: bool) -> None:
    jvm = spark._jvm
    fs, old = file_system(spark, source)
    _, new = file_system(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    context.rename(fs.makeQualified(old), fs.makeQualified(new), options)


def point(spark: SparkSession, folder: str, at: str) -> None:
    """Make the pointer of a folder name ``at``: written beside the old one and put in its place in one step."""
    beside = f"{folder}/.{POINTER}.{uuid.uuid4().hex}"
    write_text(spark, beside, at)
    _rename(spark, beside, f"{folder}/{POINTER}", overwrite=True)


def pointed_at(spark: SparkSession, folder: str) -> str | None:
    pointer = f"{folder}/{POINTER}"
    fs, path = file_system(spark, pointer)
    return read_text(spark, pointer).strip() if fs.exists(path) else None


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text; False if it is there already, whoever was first."""
    folder, name = path.rsplit("/", 1)
    beside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    fs, target = file_system(spark, path)
    try:
        if fs.getUri().getScheme() == "file":
            # Hadoop's rename on a local disk looks first and moves then; a link is one step
            local = [spark._jvm.org.apache.hadoop.fs.Path.getPathWithoutSchemeAndAuthority(p).toString() for p in (file_system(spark, beside)[1], target)]
            os.link(*local)
        else:
            _rename(spark, beside, path, overwrite=False)
    except FileExistsError:
        return False
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    finally:
        fs.delete(file_system(spark, beside)[1], False)
    return True
