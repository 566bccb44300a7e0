"""Versions behind a pointer: readers see the old or the new data, never a half-written mix (K1-K3, Q10).

A writer puts a new version into a folder of its own beside the current one and,
when it is complete, replaces one small pointer file (``_current``) that names it;
that is the commit.  A writer that fails leaves the pointer, and so the old version,
as it was; its folder is never read.  The version before the current one is kept for
readers that opened it; older ones and those of failed writers go with the next commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "_current"


def _path(spark: SparkSession, at: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in ``root`` (none if it is not there)."""
    path, fs = _path(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def _read_pointer(spark: SparkSession, root: str) -> list[str]:
    path, fs = _path(spark, f"{root}/{POINTER}")
    if not fs.exists(path):
        return []
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the published version; None when nothing was published."""
    names = _read_pointer(spark, root)
    return f"{root.rstrip('/')}/{names[0]}" if names else None


def publish(spark: SparkSession, root: str, write: Callable[[str], object]) -> str:
    """Have ``write(folder)`` make a new version below ``root`` and commit it; returns its folder."""
    root, name = root.rstrip("/"), f"version={uuid.uuid4().hex[:16]}"
    write(f"{root}/{name}")
    before = _read_pointer(spark, root)
    kept = [name, *before[:1]]
    draft, fs = _path(spark, f"{root}/{POINTER}.{uuid.uuid4().hex[:8]}")
    out = fs.create(draft, True)
    out.write(bytearray("\n".join(kept).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, _path(spark, f"{root}/{POINTER}")[0], options)  # the commit
    for old in children(spark, root):
        if old.startswith("version=") and old not in kept:
            fs.delete(_path(spark, f"{root}/{old}")[0], True)
    return f"{root}/{name}"


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], object]) -> None:
    """Have ``write(folder)`` make a folder beside ``path`` and put it in its place when it is complete."""
    path = path.rstrip("/")
    parent, name = path.rsplit("/", 1)
    mark = uuid.uuid4().hex[:12]
    staged, old = f"{parent}/_staged-{name}-{mark}", f"{parent}/_replaced-{name}-{mark}"
    target, fs = _path(spark, path)
    try:
        write(staged)
    except BaseException:
        fs.delete(_path(spark, staged)[0], True)
        raise
    if fs.exists(target):
        fs.rename(target, _path(spark, old)[0])
    if not fs.rename(_path(spark, staged)[0], target):
        raise OSError(f"cannot put {staged} in the place of {path}")
    fs.delete(_path(spark, old)[0], True)
