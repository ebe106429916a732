"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import new_scratch_path, remove_path

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_passing: list[list[str]] = []


def staged(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """The same rows, written once to the shared folder and read from there; see ``passing`` for ``keep``."""
    path = new_scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    if _passing and not keep:
        _passing[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession):
    """What is staged inside goes at the end, but for rows staged with ``keep``, which must not read any of it."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            remove_path(spark, path)


def give_back() -> None:
    """Give the system back what this worker has freed: it outlives its tasks, idle beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def freed(run):
    """``run`` for mapInArrow, with ``give_back`` after it."""

    def task(batches):
        yield from run(batches)
        give_back()

    return task


def freed_by_group(run):
    """``run`` for applyInArrow, with ``give_back`` after each group."""

    def group(table):
        try:
            return run(table)
        finally:
            give_back()

    return group


def freed_by_pair(run):
    """``run`` for applyInArrow of a cogroup, with ``give_back`` after each."""

    def group(left, right):
        try:
            return run(left, right)
        finally:
            give_back()

    return group


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), lambda w: w != "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
