"""Small files and folders in whatever file system Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str) -> tuple[object, object]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = located(spark, path)
    return fs.exists(folder)


def listed(spark: SparkSession, path: str, prefix: str = "") -> dict[str, str]:
    """Entries of a folder that start with a prefix: what follows it, and their paths."""
    fs, folder = located(spark, path)
    if not fs.exists(folder):
        return {}
    found = [s.getPath() for s in fs.listStatus(folder)]
    return {p.getName()[len(prefix):]: p.toString() for p in found if p.getName().startswith(prefix)}


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = located(spark, path)
    fs.delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = located(spark, path)
    fs.mkdirs(folder)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all, in place of one of that name."""
    fs, target = located(spark, path)
    _, staged = located(spark, f"{path}-{uuid.uuid4().hex}.tmp")
    out = fs.create(staged)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(staged, target):
        fs.delete(target, False)
        if not fs.rename(staged, target):
            raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None if there is none."""
    fs, target = located(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
