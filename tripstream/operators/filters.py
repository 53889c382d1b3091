"""Row filters on rides: no shuffle, one code-generated stage."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.functions import Box, in_box
from tripstream.schemas import DROPPED_MODULUS


def ride_cleansing(rides: DataFrame, box: Box) -> DataFrame:
    """Start and end events of rides that both begin and finish in `box`."""
    return rides.filter(
        in_box("start_lon", "start_lat", box) & in_box("end_lon", "end_lat", box)
    )


def ride_starts(rides: DataFrame) -> DataFrame:
    return rides.filter("is_start")


def ride_starts_sampled(rides: DataFrame, modulus: int = DROPPED_MODULUS) -> DataFrame:
    """Start events except those whose *id* is a multiple of `modulus`."""
    return ride_starts(rides).filter(F.col("ride_id") % modulus != 0)
