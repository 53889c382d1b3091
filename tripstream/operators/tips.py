"""Hourly tips. One definition for tables and for watermarked streams (append mode).

Both steps aggregate partially before their shuffle: a driver with a third of all fares sends
one row per task and hour, and an hour sends one row per task to the second shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.schemas import HOUR


def _tips_by_window(fares: DataFrame, size: str, scale: int) -> DataFrame:
    # Sums of decimals don't depend on the order of partial sums, which differs between runs and after a lost executor.
    exact = F.col("tip").try_cast(f"decimal(28, {scale + 6})")
    return fares.groupBy(F.window("event_time", size), "driver_id").agg(
        F.round(F.sum(exact), scale).cast("double").alias("total_tips")
    )


def tips_per_driver_hour(fares: DataFrame, size: str = HOUR, scale: int = 4) -> DataFrame:
    """Total tips per driver and tumbling window, labelled with the window's exclusive end.

    Tips count to six decimals beyond `scale`, totals are rounded to `scale`. A tip that isn't a finite number that fits is as none.
    """
    return _tips_by_window(fares, size, scale).select(
        F.col("window.end").alias("window_end"), "driver_id", "total_tips"
    )


def hourly_tips_max(fares: DataFrame, size: str = HOUR, scale: int = 4) -> DataFrame:
    """The driver with the highest total of each window; the smallest id wins a tie."""
    # bitwise_not reverses the order of ids and, unlike negation, cannot overflow.
    best = F.max(F.struct("total_tips", F.bitwise_not("driver_id").alias("rank"), "driver_id"))
    return (
        _tips_by_window(fares, size, scale)
        .groupBy(F.window(F.window_time("window"), size))
        .agg(best.alias("best"))
        .select(F.col("window.end").alias("window_end"), "best.driver_id", "best.total_tips")
    )
