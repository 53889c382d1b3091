"""One-to-one pairing of rides and fares whose ids repeat, in event-time order, on tables.

Per ride id one record at most waits. An arriving record pairs with a waiting one of the other
kind, and both are used up; else it becomes the waiting record and replaces one of its own kind.
With each id's events in order, a *run* begins wherever the kind repeats. Inside a run the first
record pairs with the second, the third with the fourth, and so on. A record left over at the end
of a run waits if it is the id's last event, and was replaced otherwise. So two window functions
over one sort give the pairs, with no replay.

The work is split by ride id. An id too large for one task is cut into time-ordered slices; each
slice is settled by itself, up to a few facts about the slices before it that are handed on as one
row per slice.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstream.functions import orderable
from tripstream.plans import HOT_ROWS, HotKeys, find_hot_keys, new_folder


#: Text of timestamps down to the microsecond and the second of the offset; Spark's own ends at milliseconds.
_WHOLE_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _order(events: DataFrame) -> list[Column]:
    """At one instant rides come before fares; the payload makes the order total. Rounds, where events have them, come one after the other."""
    payload = [orderable(F.col(c), events.schema[c].dataType) for c in ("ride", "fare")]
    return [*_rounds(events), F.col("event_time"), F.col("is_ride").desc(), *payload]


def _rounds(events: DataFrame) -> list[Column]:
    return [F.col("round")] if "round" in events.columns else []


_PLACED = "ride_id IS NOT NULL AND event_time IS NOT NULL"


def tagged(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """Both kinds in one layout: ride_id, event_time, is_ride, and the record as ride or fare.

    A record without ride id or time has no place in any id's history and is left out; `unplaced` has these.
    """
    return _in_one_layout(rides, fares).filter(_PLACED)


def unplaced(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """The records that `tagged` leaves out, in its layout, to be counted or kept."""
    return _in_one_layout(rides, fares).filter(f"NOT ({_PLACED})")


def _in_one_layout(rides: DataFrame, fares: DataFrame) -> DataFrame:
    ride_type = rides.select(F.struct("*").alias("r")).schema["r"].dataType
    fare_type = fares.select(F.struct("*").alias("f")).schema["f"].dataType
    left = rides.select(
        "ride_id", "event_time", F.lit(True).alias("is_ride"),
        F.struct("*").alias("ride"), F.lit(None).cast(fare_type).alias("fare"),
    )
    right = fares.select(
        "ride_id", "event_time", F.lit(False).alias("is_ride"),
        F.lit(None).cast(ride_type).alias("ride"), F.struct("*").alias("fare"),
    )
    return left.unionByName(right)


def _scanned(events: DataFrame, *group: str) -> DataFrame:
    """Adds what each event can know from its own group: place, run begin, previous record."""
    order = Window.partitionBy(*group).orderBy(*_order(events))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.col("prior_is_ride").isNull() | (F.col("prior_is_ride") == F.col("is_ride"))
    placed = events.select(
        *group, *_rounds(events), "event_time", "is_ride", "ride", "fare",
        F.row_number().over(order).cast("bigint").alias("pos"),
        F.lag("is_ride").over(order).alias("prior_is_ride"),
        F.lag("ride").over(order).alias("prior_ride"),
        F.lag("fare").over(order).alias("prior_fare"),
        F.lead("is_ride").over(order).isNull().alias("last"),
    )
    return placed.withColumn("run", F.max(F.when(begins, F.col("pos"))).over(so_far))


def _carried(scanned: DataFrame) -> DataFrame:
    """One row per slice: what the earlier slices of its id leave behind."""
    order = Window.partitionBy("ride_id").orderBy("slice")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    tails = scanned.filter("last").select(
        "ride_id", "slice", "head", F.col("pos").alias("rows"), "run", "is_ride", "ride", "fare"
    )
    linked = tails.select(
        "*",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"),
        F.lag("ride").over(order).alias("earlier_ride"),
        F.lag("fare").over(order).alias("earlier_fare"),
        F.coalesce(F.lag("is_ride").over(order) != F.col("head"), F.lit(False)).alias("goes_on"),
        F.lead("slice").over(order).isNotNull().alias("followed"),
    )
    # Where the latest run begun in this slice starts, counted over the whole history.
    begun = F.when((F.col("run") > 1) | ~F.col("goes_on"), F.col("offset") + F.col("run"))
    lead_in = F.col("offset") + 1 - F.max("begun").over(earlier)
    return linked.withColumn("begun", begun).select(
        "ride_id", "slice", "earlier_ride", "earlier_fare", "followed",
        F.when(F.col("goes_on"), lead_in).otherwise(0).alias("lead_in"),
    )


def _settled(events: DataFrame, hot: HotKeys) -> DataFrame:
    """Adds the previous record, `last`, and `place`: the events before it in the event's run."""
    in_run = F.col("pos") - F.col("run")
    result = ["ride_id", "is_ride", "ride", "fare", "prior_ride", "prior_fare", "last", "place"]
    if not hot.keys:
        return _scanned(events, "ride_id").withColumn("place", in_run).select(result)

    is_hot = F.col("ride_id").isin(hot.keys)
    cold = _scanned(events.filter(~is_hot), "ride_id").withColumn("place", in_run).select(result)

    # Copies of one record follow each other, and all between the first and the last are replaced
    # unseen: two stand for any number, which no range could split.
    copies = F.least(F.count("*"), F.lit(2)).alias("copies")
    # Their text tells apart what grouping would take as equal (0.0 and -0.0), and a record comes out as it went in.
    told_apart = (
        events.filter(is_hot)
        .groupBy("ride_id", *_rounds(events), "event_time", "is_ride", F.to_json(F.struct("ride", "fare"), _WHOLE_TIMES).alias("text"))
        .agg(F.first("ride").alias("ride"), F.first("fare").alias("fare"), copies)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .select(events.columns)
    )
    # Range partitions hold whole stretches of an id's history and split even a single instant;
    # several to a task's share even out where they go. Their bounds are sampled, so what depends
    # on them is written down before it is used twice.
    slices = 4 * hot.rows // hot.limit + 2
    cut = (
        told_apart.repartitionByRange(slices, "ride_id", *_order(events))
        .withColumn("slice", F.spark_partition_id())
    )
    head = F.first("is_ride").over(Window.partitionBy("ride_id", "slice").orderBy(*_order(events)))
    spark, written = events.sparkSession, new_folder(events.sparkSession, "slices")
    _scanned(cut, "ride_id", "slice").withColumn("head", head).write.parquet(written)
    scanned = spark.read.parquet(written)
    # A partition boundary cuts one id at most, so there are no more than `slices` plus the number of hot ids rows to hand on.
    # With keys from find_hot_keys that is below a small multiple of the shuffle partitions, and they are broadcast; a
    # caller's own keys can come to more, and then Spark chooses the join.
    carried = _carried(scanned)
    if slices + len(hot.keys) <= 8 * int(spark.conf.get("spark.sql.shuffle.partitions")) + 64:
        carried = F.broadcast(carried)
    hot_part = (
        scanned.join(carried, ["ride_id", "slice"])
        .withColumn("prior_ride", F.coalesce("prior_ride", _where_first("earlier_ride")))
        .withColumn("prior_fare", F.coalesce("prior_fare", _where_first("earlier_fare")))
        .withColumn("last", F.col("last") & ~F.col("followed"))
        .withColumn("place", in_run + F.when(F.col("run") == 1, F.col("lead_in")).otherwise(0))
        .select(result)
    )
    return cold.unionByName(hot_part)


def _where_first(column: str) -> Column:
    return F.when(F.col("pos") == 1, F.col(column))


def _own_or_prior(kind: str) -> Column:
    return F.coalesce(kind, f"prior_{kind}").alias(kind)


def settled(rides: DataFrame, fares: DataFrame, hot: HotKeys | None = None, min_rows: int = HOT_ROWS) -> DataFrame:
    """Each event's place in its id's history, for `pairs_of` and `waiting_of`: settling once serves both.

    Building it runs jobs: a scan for hot ids, unless `hot` has them, and with hot ids the writing of their slices.
    """
    return settled_events(tagged(rides, fares), hot, min_rows)


def settled_events(events: DataFrame, hot: HotKeys | None = None, min_rows: int = HOT_ROWS) -> DataFrame:
    """As `settled`, for tagged events. Where they have a column `round`, the events of a lower one come first, whatever their time."""
    return _settled(events, find_hot_keys(events, "ride_id", min_rows) if hot is None else hot)


def pairs_of(events: DataFrame) -> DataFrame:
    """(ride_id, ride, fare) for every pair of settled events."""
    return events.filter("place % 2 = 1").select("ride_id", _own_or_prior("ride"), _own_or_prior("fare"))


def waiting_of(events: DataFrame) -> DataFrame:
    """(ride_id, ride, fare) for each id whose last settled event is unpaired; one of the two is null."""
    return events.filter("last AND place % 2 = 0").select("ride_id", "ride", "fare")


def rides_fares_pairs(
    rides: DataFrame, fares: DataFrame, hot: HotKeys | None = None, min_rows: int = HOT_ROWS
) -> DataFrame:
    """(ride_id, ride, fare) for every pair; each record is in one pair at most.

    `hot` takes the result of an earlier `find_hot_keys` on the same data; by default the ids are
    checked here, in one scan of the id column.
    """
    return pairs_of(settled(rides, fares, hot, min_rows))


def rides_fares_waiting(
    rides: DataFrame, fares: DataFrame, hot: HotKeys | None = None, min_rows: int = HOT_ROWS
) -> DataFrame:
    """(ride_id, ride, fare) for each id whose last event is unpaired; one of the two is null."""
    return waiting_of(settled(rides, fares, hot, min_rows))


def rides_fares_join(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """Pairing where an id has one ride and one fare at most: a plain inner join."""
    return _recorded(rides, "ride").join(_recorded(fares, "fare"), "ride_id")


def _recorded(df: DataFrame, kind: str) -> DataFrame:
    return df.select("ride_id", F.struct("*").alias(kind))
