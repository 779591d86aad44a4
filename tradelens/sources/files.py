"""Small file-system steps through the session's Hadoop file systems."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none when it does not exist."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def stamp_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """(modification time, length) of a file or folder itself."""
    fs, p = _at(spark, path)
    s = fs.getFileStatus(p)
    return s.getModificationTime(), s.getLen()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file: aside first, then renamed into place."""
    fs, p = _at(spark, path)
    aside = p.suffix(".tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small file, None when it does not exist."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet: whole or not at all. False
    when it exists. The file is written aside and put into place by a hard link
    (local folders) or a rename, which fail when there is a target."""
    fs, p = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return bool(fs.rename(aside, p))
        local = [spark._jvm.java.io.File(q.toUri().getPath()).toPath() for q in (p, aside)]
        spark._jvm.java.nio.file.Files.createLink(*local)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    finally:
        fs.delete(aside, False)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; a source that is gone was moved before."""
    fs, s = _at(spark, source)
    t = _at(spark, target)[1]
    if not fs.exists(s):
        return
    try:
        done = fs.rename(s, t)
    except Py4JJavaError:
        done = False
    if not done and fs.exists(s):
        raise OSError(f"cannot move {source} to {target}")


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time."""
    fs, p = _at(spark, path)
    fs.setTimes(p, millis, -1)


def partition_values(part: str) -> list[str | None]:
    """Values of a partition folder such as ``FLOW=E/YEAR=2020``."""
    values = [unquote(p.split("=", 1)[1]) for p in part.split("/")]
    return [None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values]
