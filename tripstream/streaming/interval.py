"""Stream pairing by time difference for ids with one ride and one fare: built-in joins only.

Not the same rule as `enrichment_stream`: the limit is the difference of the two event times, not
the watermark's passing one of them. State is bounded by the limit and holds no Python.
"""

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rides_fares_within_stream(rides: DataFrame, fares: DataFrame, bound_seconds: int) -> DataFrame:
    """Pairs at most `bound_seconds` apart, as (ride_id, ride, fare)."""
    return _joined(rides, fares, bound_seconds, "inner").select("ride_id", "ride", "fare")


def unmatched_fares_within_stream(
    rides: DataFrame, fares: DataFrame, bound_seconds: int
) -> DataFrame:
    """Fares with no ride in the bound, put out once the watermark rules a ride out."""
    lone = _joined(rides, fares, bound_seconds, "left_outer").filter("ride IS NULL")
    return lone.select("fare.*")


def _joined(rides: DataFrame, fares: DataFrame, bound_seconds: int, how: str) -> DataFrame:
    bound = F.lit(timedelta(seconds=bound_seconds))
    ride = rides.select(
        F.col("ride_id").alias("match_id"), F.col("event_time").alias("ride_time"),
        F.struct("*").alias("ride"),
    )
    fare = fares.select(
        "ride_id", F.col("event_time").alias("fare_time"), F.struct("*").alias("fare")
    )
    near = F.col("ride_time").between(F.col("fare_time") - bound, F.col("fare_time") + bound)
    return fare.join(ride, (F.col("ride_id") == F.col("match_id")) & near, how)
