"""The four analyses as running streams: folders of landing files in, parquet files out.

Each takes the folder its records land in, a folder for results, and a checkpoint folder on shared
storage, and returns the started query. Further arguments go to `start_sink`; `source` holds
arguments of `read_stream` such as the file format or the bound of a micro-batch, which is
MICRO_BATCH_BYTES if none is given: a backlog is taken in at that rate, and no id has more rows at once.
"""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripstream.functions import Box
from tripstream.operators.filters import ride_cleansing, ride_starts, ride_starts_sampled
from tripstream.operators.tips import hourly_tips_max
from tripstream.schemas import FARE, RIDE
from tripstream.sources import read_stream
from tripstream.streaming.sinks import start_sink
from tripstream.streaming.stateful import enrichment_stream, rides_fares_stream


MICRO_BATCH_BYTES = 1 << 30


def _source(source: dict | None, **defaults) -> dict:
    options = {**defaults, **(source or {})}
    if options.get("max_bytes") is None and options.get("max_files") is None:
        options["max_bytes"] = MICRO_BATCH_BYTES
    return options


def start_ride_cleansing(
    spark: SparkSession, rides: str, results: str, checkpoint: str, box: Box,
    source: dict | None = None, **sink,
) -> StreamingQuery:
    """Rides that begin and end in `box`."""
    records = read_stream(spark, rides, RIDE, **_source(source, max_delay=None))
    return start_sink(ride_cleansing(records, box), results, checkpoint, **sink)


def start_hourly_tips(
    spark: SparkSession, fares: str, results: str, checkpoint: str,
    source: dict | None = None, **sink,
) -> StreamingQuery:
    """The driver with the most tips of each hour."""
    records = read_stream(spark, fares, FARE, **_source(source))
    return start_sink(hourly_tips_max(records), results, checkpoint, **sink)


def start_rides_and_fares(
    spark: SparkSession, rides: str, fares: str, results: str, checkpoint: str,
    ttl_ms: int | None = None, source: dict | None = None, **sink,
) -> StreamingQuery:
    """Each ride start with its fare."""
    options = _source(source, max_delay=None)
    pairs = rides_fares_stream(
        ride_starts(read_stream(spark, rides, RIDE, **options)),
        read_stream(spark, fares, FARE, **options),
        ttl_ms,
    )
    idle = {} if ttl_ms is None else {"idle_batches": False}
    return start_sink(pairs, results, checkpoint, **{**idle, **sink})


def start_expiring_state(
    spark: SparkSession, rides: str, fares: str, results: str, checkpoint: str,
    on_duplicate: str = "replace", source: dict | None = None, **sink,
) -> StreamingQuery:
    """Matched and unmatched records, one result folder per outcome.

    Ride starts with a multiple of 1000 as id are dropped on the way in, so their fares come out
    as unmatched.
    """
    outcomes = enrichment_stream(
        ride_starts_sampled(read_stream(spark, rides, RIDE, **_source(source))),
        read_stream(spark, fares, FARE, **_source(source)),
        on_duplicate,
    )
    return start_sink(outcomes, results, checkpoint, **{"partition_by": "outcome", **sink})
