"""Record layouts. Streams and CSV files are always read with one of these, never inferred."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RIDE = StructType([
    StructField("ride_id", LongType()),
    StructField("is_start", BooleanType()),
    StructField("event_time", TimestampType()),
    StructField("start_lon", DoubleType()),
    StructField("start_lat", DoubleType()),
    StructField("end_lon", DoubleType()),
    StructField("end_lat", DoubleType()),
])

FARE = StructType([
    StructField("ride_id", LongType()),
    StructField("driver_id", LongType()),
    StructField("event_time", TimestampType()),
    StructField("tip", DoubleType()),
])

STATION = StructType([
    StructField("id", IntegerType()),
    StructField("name", StringType()),
    StructField("lat", DoubleType()),
    StructField("long", DoubleType()),
    StructField("dock_count", IntegerType()),
    StructField("city", StringType()),
    StructField("installation_date", DateType()),
])

# Outcome tags, the out-of-order bound, the window size, and the modulus whose
# multiples are dropped from the ride starts.
MATCHED = "matched"
UNMATCHED_RIDE = "unmatched_ride"
UNMATCHED_FARE = "unmatched_fare"
MAX_DELAY = "60 seconds"
HOUR = "1 hour"
DROPPED_MODULUS = 1000
