"""Folders that all executors share, for what a plan has to store on its way.

They are deleted when the application ends, or earlier by whoever knows that
nothing reads them any more.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark import SparkContext
from pyspark.sql import SparkSession

_folders: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a local folder where that is unset and the master is local (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="palisade-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder that isn't there yet."""
    if not _folders:
        atexit.unregister(clean_up)
        atexit.register(clean_up)
    _folders.append(f"{shared_folder(spark)}/palisade-{name}-{uuid.uuid4().hex}")
    return _folders[-1]


def drop(folder: str) -> None:
    jvm = SparkContext._jvm  # there as long as the process is, whatever session is stopped
    if jvm is not None:
        path, active = jvm.org.apache.hadoop.fs.Path(folder), SparkContext._active_spark_context
        conf = active._jsc.hadoopConfiguration() if active is not None else jvm.org.apache.hadoop.conf.Configuration()
        path.getFileSystem(conf).delete(path, True)
    with suppress(ValueError):
        _folders.remove(folder)


def clean_up() -> None:
    """Deletes all folders made so far; call it when the results that read them are written."""
    for folder in list(_folders):
        with suppress(Exception):  # the application is at its end: another try isn't to be had
            drop(folder)


@contextmanager
def scope() -> Iterator[set[str]]:
    """Deletes the folders made inside once it is left, but those put into the set that it gives."""
    before, kept = set(_folders), set()
    yield kept
    for folder in list(_folders):
        if folder not in before and folder not in kept:
            drop(folder)
