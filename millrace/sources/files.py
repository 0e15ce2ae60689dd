"""Small metadata files on whatever file system a path belongs to."""

from __future__ import annotations

import json
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _hadoop_path(jvm):
    """The class, looked up once: each part of its name is a call to the JVM."""
    return jvm.org.apache.hadoop.fs.Path


def _resolve(spark: SparkSession, path: str):
    hpath = _hadoop_path(spark._jvm)(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _resolve(spark, path)
    return fs.exists(hpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; an absent folder has none."""
    fs, hpath = _resolve(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hpath))


def remove(spark: SparkSession, path: str) -> None:
    fs, hpath = _resolve(spark, path)
    fs.delete(hpath, True)


def remove_if_empty(spark: SparkSession, path: str) -> None:
    fs, hpath = _resolve(spark, path)
    if fs.exists(hpath) and not fs.listStatus(hpath):
        fs.delete(hpath, False)


def make(spark: SparkSession, path: str) -> None:
    fs, hpath = _resolve(spark, path)
    fs.mkdirs(hpath)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; what the target held before is gone."""
    fs, hpath = _resolve(spark, path)
    to = _hadoop_path(spark._jvm)(target)
    fs.mkdirs(to.getParent())
    fs.delete(to, True)
    if not fs.rename(hpath, to):
        raise OSError(f"{path} could not be moved to {target}")


def read_json(spark: SparkSession, path: str) -> dict:
    """A small file, read without a Spark job."""
    fs, hpath = _resolve(spark, path)
    stream = fs.open(hpath)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish_json(spark: SparkSession, path: str, body: dict, replace: bool = False) -> None:
    """Write beside the target under a name of its own and rename, so readers see all of it or none.

    With ``replace`` the rename takes the place of the target, which never is absent.  Without, an existing target is an
    error; the check and the rename are two steps: one writer at a time.
    """
    fs, target = _resolve(spark, path)
    staging = _hadoop_path(spark._jvm)(f"{path}.{uuid.uuid4().hex}.staging")
    stream = fs.create(staging, False)
    try:
        stream.write(bytearray(json.dumps(body, indent=1).encode("utf-8")))
    finally:
        stream.close()
    hadoop, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    if not replace and fs.exists(target):
        fs.delete(staging, False)
        raise FileExistsError(f"{path} is there already")
    kind = getattr(hadoop, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if replace else kind.NONE
    hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(staging), fs.makeQualified(target), options)
