"""The current build of a folder of builds.

Each finished build is published as the next version: a small file whose name is
the version's number and whose text is the build's folder, created under a name
that must not exist yet, which a file store does in one step. Readers take the
highest number, so they see the build before or the new one, never a mixture,
and a build that failed has no version. Two builds that finish together get two
numbers. Versions beyond the last ``keep`` are removed with their folders, if
asked for; a reader that opened one of those in the meantime must open again.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

VERSIONS = "versions"


def new_folder(root: str) -> str:
    return f"{root.rstrip('/')}/build-{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, root: str) -> dict[int, str]:
    """Published builds of ``root`` by version."""
    fs, where = _store(spark, f"{root.rstrip('/')}/{VERSIONS}")
    if not fs.exists(where):
        return {}
    out = {}
    for entry in fs.listStatus(where):
        name = entry.getPath().getName()
        if name.isdigit():
            stream = fs.open(entry.getPath())
            text = bytes(stream.readAllBytes()).decode()
            stream.close()
            if text.endswith("\n"):  # else it is still being written
                out[int(name)] = text.strip()
    return out


def current(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest finished build under ``root``; None without any."""
    known = versions(spark, root)
    return f"{root.rstrip('/')}/{known[max(known)]}" if known else None


def publish(spark: SparkSession, root: str, folder: str, keep: int | None = None) -> int:
    """Make ``folder`` (under ``root``) the current build; its version."""
    root = root.rstrip("/")
    name = folder.removeprefix(f"{root}/")
    if name == folder or "/" in name:
        raise ValueError(f"{folder} is not a folder of {root}")
    if keep is not None and keep < 1:
        raise ValueError("keep at least one build")
    number = max(versions(spark, root), default=0) + 1
    while not _create(spark, f"{root}/{VERSIONS}/{number:010d}", name):
        number += 1  # another build finished meanwhile
    if keep is not None:
        known = versions(spark, root)
        for old in sorted(known)[:-keep]:
            for path in (f"{root}/{VERSIONS}/{old:010d}", f"{root}/{known[old]}"):
                fs, where = _store(spark, path)
                fs.delete(where, True)
    return number


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Whether ``path`` was created, with ``text``; False if it exists."""
    fs, where = _store(spark, path)
    try:
        stream = fs.create(where, False)
    except Py4JJavaError as err:
        if "AlreadyExists" not in str(err.java_exception):
            raise
        return False
    stream.write(bytearray(f"{text}\n".encode()))
    stream.close()
    return True
