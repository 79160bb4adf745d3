"""Atomic replacement of a target folder.

Spark's overwrite deletes the old files first and then runs the write job:
if the job fails — a bad value caught in the writing stage, or executors
lost beyond the retry limit — the target is left empty.  Here the new data
is written to a fresh sibling folder first; only after the job has
committed are the folders swapped (two renames on the driver), and only
then is the old data deleted.  A failed job leaves the target as it was.  A
target that does not exist is written in place, without a rename.

Between the two renames the target is absent for a moment; a driver lost just
there leaves the old data in a hidden sibling, and the next call moves it back
before it does anything else.  On object stores a folder rename is a copy run
by the driver, so there an existing folder is not replaced: write to a new
folder, or use a catalog table, which switches its location instead
(``sinks.tables``).
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

from urllib.parse import urlsplit

from pyspark.sql import SparkSession

from tablewright.errors import CapabilityError
from tablewright.session import require_context
from tablewright.sinks.guards import qualify

_VERSION = re.compile(r"-v[0-9a-f]{12}$")


def _fs(spark: SparkSession, path: str):
    sc = require_context(spark, "replacing a folder")
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def sibling(path: str, tag: str) -> str:
    """A fresh version folder next to ``path`` (``name-v<id>``)."""
    base = _VERSION.sub("", path.rstrip("/"))
    return f"{base}{tag}{uuid.uuid4().hex[:12]}"


def hidden_sibling(path: str, tag: str) -> str:
    """A fresh folder next to ``path`` whose name starts with a dot, so that
    readers listing the parent folder (Spark skips ``.``/``_`` names) never
    see half-written or outgoing data."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{tag}-{uuid.uuid4().hex[:12]}"


# Schemes of stores without a folder rename.
OBJECT_STORES = {"s3", "s3a", "s3n", "gs", "oss", "cos", "cosn", "obs", "swift", "wasb", "wasbs"}


def _restore(spark: SparkSession, tgt: str) -> None:
    """Move back what a run that was lost between its renames has left aside."""
    parent, _, name = tgt.rpartition("/")
    p, fs = _fs(spark, parent)
    if not fs.exists(p):
        return
    left = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith(f".{name}.old-")]
    if len(left) == 1:
        fs.rename(left[0], _fs(spark, tgt)[0])


def replace_path(spark: SparkSession, target: str, write: Callable[[str], None]) -> None:
    """Make what ``write(folder)`` writes the new content of ``target``."""
    tgt = qualify(spark, target)
    dst, target_fs = _fs(spark, tgt)
    if not target_fs.exists(dst):
        _restore(spark, tgt)
    if not target_fs.exists(dst):
        try:
            write(tgt)
        except BaseException:
            delete_path(spark, tgt)  # it was not there before
            raise
        return
    if urlsplit(tgt).scheme in OBJECT_STORES:
        raise CapabilityError(f"{tgt} exists on an object store, where replacing a folder copies it; "
                              "write to a new folder or overwrite a catalog table")
    staging = hidden_sibling(tgt, "staging")
    try:
        write(staging)
    except BaseException:
        delete_path(spark, staging)  # the failed attempt leaves nothing behind
        raise
    src_p, fs = _fs(spark, staging)
    dst_p, _ = _fs(spark, tgt)
    backup = None
    if fs.exists(dst_p):
        backup = hidden_sibling(tgt, "old")
        if not fs.rename(dst_p, _fs(spark, backup)[0]):
            raise OSError(f"could not move {tgt} aside")
    if not fs.rename(src_p, dst_p):
        if backup:
            fs.rename(_fs(spark, backup)[0], dst_p)
        raise OSError(f"could not move {staging} to {tgt}")
    if backup:
        fs.delete(_fs(spark, backup)[0], True)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def make_dirs(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def upload_local_file(spark: SparkSession, local_path: str, folder: str) -> None:
    """Copy a file from the driver's disk into ``folder`` (shared storage)."""
    src, _ = _fs(spark, "file:" + os.path.abspath(local_path))
    dst, fs = _fs(spark, folder)
    fs.mkdirs(dst)
    fs.copyFromLocalFile(False, True, src, dst)
