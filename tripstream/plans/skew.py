"""Keys too large for one task."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


class HotKeys(NamedTuple):
    keys: list
    """At most one key per shuffle partition, since each has more rows than the mean partition."""
    rows: int
    """About how many rows they have together."""
    limit: int
    """Rows of one key that one task is meant to take."""


def find_hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> HotKeys:
    """Keys of `df` with more than `min_rows` rows that also exceed the mean shuffle partition.

    One scan of the key column into a sketch of fixed size, without shuffling rows. The counts
    are estimates: they steer how work is spread, never what a query returns.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shown = min(max(partitions, 100), 20_000)
    sketch = F.call_function(
        "approx_top_k", F.col(key), F.lit(shown), F.lit(min(10 * shown, 200_000))
    )
    found = (
        df.filter(F.col(key).isNotNull())
        .agg(F.count("*").alias("rows"), sketch.alias("top"))
        .first()
    )
    limit = max(min_rows, found["rows"] // partitions)
    hot = [entry for entry in found["top"] or [] if entry["count"] > limit]
    return HotKeys([h["item"] for h in hot], sum(h["count"] for h in hot), limit)
