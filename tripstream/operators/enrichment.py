"""Rides, fares and the ones left without partner, on tables with one ride and fare per id.

The arrival-driven form, for ids that repeat, is `tripstream.streaming.stateful`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.functions import bucket_start
from tripstream.plans import MAX_WORDS, members
from tripstream.schemas import MATCHED, UNMATCHED_FARE, UNMATCHED_RIDE


def _aside(*needed: str) -> Column:
    """A second join key: a hash of the id, but for records that lack a key and so match nothing, one that spreads them over all tasks.

    It is of the record's text, which, unlike the record, may hold maps. (A constant in place of the hash of the id would be
    taken out of the join by Catalyst, and the spreading with it.)
    """
    lacking = F.col(needed[0]).isNull()
    for name in needed[1:]:
        lacking = lacking | F.col(name).isNull()
    return F.when(lacking, F.xxhash64(F.to_json(F.struct("*")))).otherwise(_of_id(needed[0]))


def _of_id(name: str = "ride_id") -> Column:
    return F.xxhash64(name)


def enrichment_outcomes(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """(outcome, ride_id, ride, fare) for every record, matched or not; a record without id matches nothing."""
    keys = ["ride_id", "aside"]
    ride = rides.select("ride_id", _aside("ride_id").alias("aside"), F.struct("*").alias("ride"))
    fare = fares.select("ride_id", _aside("ride_id").alias("aside"), F.struct("*").alias("fare"))
    return ride.join(fare, keys, "full_outer").select(
        F.when(F.col("fare").isNull(), UNMATCHED_RIDE)
        .when(F.col("ride").isNull(), UNMATCHED_FARE)
        .otherwise(MATCHED)
        .alias("outcome"),
        "ride_id", "ride", "fare",
    )


def side_output(outcomes: DataFrame, tag: str) -> DataFrame:
    """The records carrying one outcome tag."""
    return outcomes.filter(F.col("outcome") == tag)


def unmatched_fares(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """Fares whose id no ride has, those without id too. Each input is scanned once; a repeated ride id is sent once a task."""
    keys = ["ride_id", "aside"]
    known = rides.filter("ride_id IS NOT NULL").select("ride_id", _of_id().alias("aside")).distinct()
    # As one column, a record keeps whatever names its fields have.
    records = fares.select("ride_id", _aside("ride_id").alias("aside"), F.struct("*").alias("record"))
    return records.join(known, keys, "left_anti").select("record.*")


def unmatched_rides(rides: DataFrame, fares: DataFrame) -> DataFrame:
    return unmatched_fares(fares, rides)


def unmatched_fares_filtered(rides: DataFrame, fares: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """As `unmatched_fares`, for fares most of which have no ride: what a filter of the rides' ids rules out is not shuffled.

    The filter is broadcast; its size is bounded by `max_words`, and where the rides are too many for it, the plain join is
    returned. Only fares that it lets through meet the rides. Fares are scanned twice, once for those ruled out and once for the
    rest. Building it runs a job that counts the ids.
    """
    known = members(rides, "ride_id", max_words)
    if known is None:
        return unmatched_fares(rides, fares)
    records = known.may_hold(fares.select("ride_id", F.struct("*").alias("record")), "ride_id", "may_match")
    lone = records.filter("NOT may_match").select("record.*")
    return lone.unionByName(unmatched_fares(rides, records.filter("may_match").select("record.*")))


def unmatched_fares_within(rides: DataFrame, fares: DataFrame, bound_seconds: int) -> DataFrame:
    """Fares with no ride of the same id at most `bound_seconds` before or after them.

    Time is cut into buckets as wide as the bound. A ride in the fare's own bucket is always near
    enough; of the bucket before only the latest ride matters, of the one after only the earliest.
    So rides shrink to one row per id and bucket, partially before the shuffle, and no fare meets
    more than one of them: ids that repeat cost a join of equal size, not all pairs of an id. A bound of zero asks for the
    same instant.
    """
    if bound_seconds < 0:
        raise ValueError(f"bound_seconds must not be negative: {bound_seconds}")
    bound = bound_seconds * 1_000_000
    width = max(1, bound)
    at = F.unix_micros("event_time")
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    nearest = (
        rides.filter("ride_id IS NOT NULL AND event_time IS NOT NULL")
        .select("ride_id", at.alias("at"), F.explode(steps).alias("step"))
        .groupBy("ride_id", _of_id().alias("aside"), (bucket_start(F.col("at"), width) + F.col("step") * width).alias("bucket"))
        .agg(
            F.bool_or(F.col("step") == 0).alias("inside"),
            F.max(F.when(F.col("step") == 1, F.col("at"))).alias("latest_before"),
            F.min(F.when(F.col("step") == -1, F.col("at"))).alias("earliest_after"),
        )
    )
    near_side = nearest.alias("near")
    keyed = fares.select(
        "ride_id", bucket_start(at, width).alias("bucket"), _aside("ride_id", "event_time").alias("aside"), at.alias("at"),
        F.struct("*").alias("record"),
    ).alias("fare")
    near = (
        F.col("near.inside")
        | (F.col("fare.at") - F.col("near.latest_before") <= bound)
        | (F.col("near.earliest_after") - F.col("fare.at") <= bound)
    )
    for key in ("ride_id", "bucket", "aside"):
        near = near & (F.col(f"fare.{key}") == F.col(f"near.{key}"))
    return keyed.join(near_side, near, "left_anti").select("record.*")
