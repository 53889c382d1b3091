"""What several operators of this package share: derived tables, normalisation, blocks of text."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that the driver and all executors share (spark.checkpoint.dir).

    Where the setting is absent, a local session gets a folder of its own; a cluster gets an error, since
    executors would otherwise write to their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_derived"
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    if _made.lists:
        _made.lists[-1].append(path)
    return path


class _Made(threading.local):
    def __init__(self):
        self.lists: list[list[str]] = []


_made = _Made()


@contextmanager
def noting_folders():
    """Notes the folders that this thread's operators take within the block, oldest first."""
    _made.lists.append([])
    try:
        yield _made.lists[-1]
    finally:
        _made.lists.pop()


def emptied(spark: SparkSession, folders: list[str]) -> None:
    """Overwrites derived tables with empty ones, so that they take no space. Frames that read them have no rows from then on."""
    for path in folders:
        spark.range(0).write.mode("overwrite").parquet(path)


def stored(frame: DataFrame, codec: str = "zstd") -> DataFrame:
    """The frame written as a table in the shared folder and read back: cuts its lineage, survives lost executors."""
    path = shared_folder(frame.sparkSession)
    frame.write.option("compression", codec).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Text of one byte a character takes the fast built-in, with the same result."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def plain(text: str) -> Column:
    """A text column with null as the empty string."""
    return F.coalesce(F.col(text), F.lit(""))


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many underscores as it takes to differ from all of the columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
