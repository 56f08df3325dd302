"""Helpers shared by the operators: the shared folder, size-checked joins, text measures."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but space, tab, newline, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A side is broadcast only if it was counted and has at most this many narrow rows.
BROADCAST_ROWS = 400_000


def workspace(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local session uses a folder in the warehouse; others must set it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_workspace"
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: this cuts its lineage.

    The files outlive any executor, so later stages never recompute what came before.
    """
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def opened(folder: str) -> Iterator[pyarrow.NativeFile]:
    """The data files of a saved folder, for tasks that read them themselves; none if it isn't there."""
    if folder.startswith("file:/"):
        folder = "file:///" + folder.removeprefix("file:").lstrip("/")
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    listed = system.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
    for info in sorted(listed, key=lambda info: info.path):
        if info.is_file and not info.base_name.startswith(("_", ".")):
            with system.open_input_file(info.path) as file:
                yield file


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a saved frame has at most ``limit`` rows. Reads only file footers."""
    return df.count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a saved frame of narrow rows for broadcast if it was counted to be small.

    Beyond the limit the frame is left alone and the join is a shuffle join.
    """
    return F.broadcast(df) if small(df, limit) else df


def same_keys(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality of the named columns."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def only(df: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose keys are in the saved frame ``rows``, if those are few.

    Their keys are counted and, if few, broadcast, so that what is left out is never shuffled.
    Otherwise ``df`` comes back whole. Either way a join with ``rows`` has to follow.
    """
    wanted = rows.select(*keys).distinct()
    if not small(rows):
        return df
    return df.join(F.broadcast(wanted), same_keys(df, wanted, keys), "left_semi")


def join_counted(rows: DataFrame, counted: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` (inner or left) with the saved frame ``counted``: one narrow row per key, with its rows as ``n``.

    The keys with more than a thousandth of the rows are broadcast, fewer than a thousand at every size, and only
    the rows of the others are shuffled by key, so no task gets all rows of a frequent key. NULL keys meet nothing.
    """
    keys = list(keys)
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counted.filter(F.col("n") > total // 1000))
    usual = rows.join(hot.select(*keys), keys, "left_anti").join(counted, keys, how)
    return rows.join(hot, keys).unionByName(usual)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, A_TO_Z, A_TO_Z.lower())
