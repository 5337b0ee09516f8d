"""Numbered commits in a folder: what a table's readers see changes in one step.

A commit is a small file ``<number>.json`` that is put only if it is absent, so of two
writers with one number one loses and tries again on top of the other.  ``_head``
holds a number already reached; readers look for the next ones from there, so the
cost of finding the last commit does not grow with history.  Put-if-absent is a
rename that fails if the target exists (a hard link on local disks).
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer was first, again and again."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, by the file system the pattern names."""
    fs, path = _fs(spark, pattern)
    return sorted(str(f.getPath().toString()) for f in fs.globStatus(path) or [])


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file was put; False if there is one."""
    jvm, (fs, target) = spark._jvm, _fs(spark, path)
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    source = jvm.org.apache.hadoop.fs.Path(draft)
    try:
        if fs.getScheme() == "file":
            local = [jvm.java.nio.file.Path.of(fs.makeQualified(p).toUri()) for p in (target, source)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context.rename(source, target, options)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise
    finally:
        fs.delete(source, False)
    return True


def _name(log_dir: str, version: int) -> str:
    return f"{log_dir}/{version:020d}.json"


def head(spark: SparkSession, log_dir: str) -> int:
    """The last commit's number, 0 before the first."""
    version = int(read_text(spark, f"{log_dir}/_head") or 0)
    fs, _ = _fs(spark, log_dir)
    while fs.exists(_fs(spark, _name(log_dir, version + 1))[1]):
        version += 1
    return version


def read(spark: SparkSession, log_dir: str, version: int) -> dict:
    return json.loads(read_text(spark, _name(log_dir, version)))


def commit(spark: SparkSession, log_dir: str, version: int, content: dict) -> bool:
    """Put commit ``version``; False if another writer has."""
    if not put_if_absent(spark, _name(log_dir, version), json.dumps(content)):
        return False
    write_text(spark, f"{log_dir}/_head", str(version))
    return True
