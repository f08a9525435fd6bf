"""Several partitioned tables of one folder, replaced together.

A run writes its partitions below ``_staged/<run>``, where no reader looks.
When all are written a marker is put there: from then on the run counts, and its
partitions take the places of the old ones.  A run that dies before the marker
has changed nothing.  One that dies after it is finished by whoever comes next,
reader or writer, since every move can be repeated.  One writer at a time.

Only folders are touched here, one at a time, as a partition overwrite does.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STAGED = "_staged"
READY = "_READY"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _below(fs, at) -> list:
    return sorted((s.getPath() for s in fs.listStatus(at) if not s.getPath().getName().startswith(("_", "."))),
                  key=lambda p: p.getName())


def _replace(fs, new, old) -> None:
    """Move a partition to its place; what was there goes."""
    if fs.exists(old):
        fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"cannot move {new} to {old}")


def _finish(spark: SparkSession, folder: str, run) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, base = file_system(spark, folder)
    for table in _below(fs, run):
        target = path(base, table.getName())
        fs.mkdirs(target)
        for partition in _below(fs, table):
            _replace(fs, partition, path(target, partition.getName()))
    _discard(fs, run)


def _discard(fs, run) -> None:
    """Remove a run, its marker last, and the folder of runs if it was the only one."""
    for s in fs.listStatus(run):
        if s.getPath().getName() != READY:
            fs.delete(s.getPath(), True)
    fs.delete(run, True)
    if not fs.listStatus(run.getParent()):
        fs.delete(run.getParent(), True)


def finish_runs(spark: SparkSession, folder: str) -> None:
    """Finish a run that counts but was not moved to its end."""
    fs, staged = file_system(spark, f"{folder}/{STAGED}")
    if not fs.exists(staged):
        return
    for s in fs.listStatus(staged):
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), READY)):
            _finish(spark, folder, s.getPath())


@contextmanager
def replaced_together(spark: SparkSession, folder: str) -> Iterator[str]:
    """A place to write to; what is written there replaces the partitions of ``folder`` when the block ends.

    If the block raises, nothing is replaced.
    """
    finish_runs(spark, folder)
    place = f"{folder}/{STAGED}/{uuid.uuid4().hex}"
    fs, run = file_system(spark, place)
    fs.mkdirs(run)
    try:
        yield place
        fs.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(run, READY))
    except BaseException:
        _discard(fs, run)
        raise
    _finish(spark, folder, run)
