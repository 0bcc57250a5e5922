"""Small files beside the tables: written whole, claimed once, kept inside their folder. Any Hadoop file system will do."""

from __future__ import annotations

import os
import posixpath
import uuid
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path there), both of the JVM."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on this machine, or null for another file system."""
    fs, where = file_system(spark, path)
    return unquote(where.toUri().getPath()) if fs.getUri().getScheme() == "file" else None


def contained(base: str, path: str) -> str:
    """The path under ``base``, or an error if it would lead out of it, by ``..`` or by a link on this machine.

    A leading slash counts from ``base``. The path needn't exist.
    """
    inner = posixpath.normpath(path.lstrip("/")) if path.strip("/") else "."
    full = posixpath.normpath(posixpath.join(base, inner)) if "://" not in base else f"{base.rstrip('/')}/{inner}"
    outside = inner == ".." or inner.startswith("../")
    if "://" not in base and not outside:
        real, top = os.path.realpath(base.removeprefix("file:")), os.path.realpath(full.removeprefix("file:"))
        outside = os.path.commonpath([real, top]) != real
    if outside:
        raise ValueError(f"{path!r} leads out of {base!r}")
    return full


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return bool(fs.exists(where))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, invalid UTF-8 replaced; null if it isn't there."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8", "replace")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, *, replace: bool = True) -> bool:
    """Writes a small file at once: a reader sees the old text or the new one, never none. False if it may not be replaced.

    The text is written under a name of its own, which then takes the file's place; on a file system without a replacing
    rename (an object store) the file is written in place, which is atomic there. Without ``replace`` see :func:`claim`.
    """
    if not replace:
        return claim(spark, path, text)
    fs, where = file_system(spark, path)
    local = local_path(spark, path)
    part = f"{path}.{uuid.uuid4().hex}.part"
    if local is not None:
        own = Path(unquote(spark._jvm.org.apache.hadoop.fs.Path(part).toUri().getPath()))
        own.parent.mkdir(parents=True, exist_ok=True)
        own.write_bytes(text.encode())
        os.replace(own, local)
        return True
    jvm = spark._jvm
    target = where if fs.getUri().getScheme() not in ("hdfs", "viewfs") else jvm.org.apache.hadoop.fs.Path(part)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()
    if target is not where:
        how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(target, where, how)
    return True


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file unless it is there: of several that try at once, one gets True."""
    local = local_path(spark, path)
    if local is not None:
        Path(local).parent.mkdir(parents=True, exist_ok=True)
        try:
            with Path(local).open("xb") as f:
                f.write(text.encode())
        except FileExistsError:
            return False
        return True
    fs, where = file_system(spark, path)
    try:
        out = fs.create(where, False)
    except Exception:
        if fs.exists(where):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Puts a written folder in the place of another."""
    fs, to = file_system(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    if fs.exists(to):
        fs.delete(to, True)
    if not fs.rename(path(source), to):
        raise OSError(f"{source} could not be moved to {target}")
