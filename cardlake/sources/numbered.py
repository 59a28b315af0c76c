"""Small JSON files in a folder, each number written once.

The one primitive that several drivers can agree by without a database: of all
that try to write a number, one succeeds. Table versions and leases are kept
this way, on the table's own file system.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop path and the file system it is on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    at, fs = file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n[:-5]) for n in names(spark, folder) if n.endswith(".json") and n[:-5].isdigit())


def file_name(number: int) -> str:
    return f"{number:012d}.json"


def get(spark: SparkSession, folder: str, number: int) -> dict:
    at, fs = file_system(spark, f"{folder}/{file_name(number)}")
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """The highest number with its content; 0 and nothing in a new folder."""
    found = numbers(spark, folder)
    return (found[-1], get(spark, folder, found[-1])) if found else (0, {})


def put(spark: SparkSession, folder: str, number: int, content: dict) -> bool:
    """Write a number; False if someone else has written it.

    The content is complete before it gets its name, so a reader never sees a
    part of it. Locally the name is a hard link, which fails if it exists;
    elsewhere it is a rename without overwriting, as in Spark's own streaming log.
    """
    at, fs = file_system(spark, f"{folder}/.{uuid.uuid4().hex}.tmp")
    to, _ = file_system(spark, f"{folder}/{file_name(number)}")
    out = fs.create(at, True)
    try:
        out.write(json.dumps(content).encode())
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(at.toUri().getPath(), to.toUri().getPath())
        else:
            kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(at, to, spark.sparkContext._gateway.new_array(kind, 0))
        return True
    except (FileExistsError, Py4JJavaError, PySparkException):
        if not fs.exists(to):
            raise
        return False
    finally:
        fs.delete(at, False)
