"""Every operator as a query over the driver's tables.

Fares are `events` (driver = user, tip = value). Rides and fares with repeating ids are its events
of type view and purchase, keyed by user. Rides and fares with one record per id are `orders` and
`lineitem` summed up by order. Results carry flat columns and timestamps without zone.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstream.functions import Box, as_event_time
from tripstream.operators import digests, enrichment, filters, pairing, registry, tips
from tripstream.plans import new_folder, write_bucketed, write_by_place
from tripstream.replay import Replay
from tripstream.schemas import STATION, UNMATCHED_FARE, UNMATCHED_RIDE
from tripstream.sources import read_stations, read_table, write_stations
from tripstream.streaming import batches, interval, stateful
from tripstream.streaming.sinks import FASTEST, counting_dropped, read_dropped, read_waiting, start_sink

# No bounds of the region are given anywhere; these suit the coordinates derived below.
BOX = Box(west=-1.0, south=-1.0, east=1.0, north=1.0)
BOUND_DAYS = 30
BOUND_SECONDS = BOUND_DAYS * 86400


# --- inputs ---------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _tip_fares(spark, sf_dir, *more):
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("driver_id"),
        as_event_time("ts").alias("event_time"),
        F.col("value").alias("tip"),
        *more,
    )


def _placed_rides(spark, sf_dir):
    def coordinate(factor, modulus):
        return F.col("event_id") * factor % modulus / 100 - 2

    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ride_id"),
        (F.col("event_type") == "view").alias("is_start"),
        as_event_time("ts").alias("event_time"),
        coordinate(7, 401).alias("start_lon"),
        coordinate(11, 397).alias("start_lat"),
        coordinate(13, 389).alias("end_lon"),
        coordinate(17, 383).alias("end_lat"),
    )


def _repeating(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    rides = events.filter("event_type = 'view'").select(
        F.col("user_id").alias("ride_id"), as_event_time("ts").alias("event_time"), "event_id"
    )
    fares = events.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("ride_id"), as_event_time("ts").alias("event_time"), "event_id",
        F.col("value").alias("tip"),
    )
    return rides, fares


def _order_rides(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ride_id"),
        (F.col("o_orderstatus") == "O").alias("is_start"),
        as_event_time("o_orderdate").alias("event_time"),
    )


def _order_fares(spark, sf_dir):
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("ride_id"))
        .agg(
            as_event_time(F.min("l_shipdate")).alias("event_time"),
            F.round(F.sum("l_extendedprice"), 2).alias("tip"),
        )
    )


def _unique(spark, sf_dir):
    """Every order is a start here; the dropped ids leave fares over."""
    rides = _order_rides(spark, sf_dir).withColumn("is_start", F.lit(True))
    return filters.ride_starts_sampled(rides), _order_fares(spark, sf_dir)


def _registries(spark, sf_dir):
    def listed(name, prefix):
        return _table(spark, sf_dir, name).select(
            F.col(f"{prefix}_nationkey").alias("nation"),
            F.floor(F.col(f"{prefix}_acctbal") / 1000).alias("band"),
        )

    return listed("customer", "c"), listed("supplier", "s")


# --- results --------------------------------------------------------------------------------


def _zoneless(df: DataFrame) -> DataFrame:
    stamps = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema
              if f.dataType.typeName() == "timestamp"}
    return df.withColumns(stamps) if stamps else df


def _flat(df: DataFrame) -> DataFrame:
    """(outcome,) ride_id, ride, fare as plain columns."""
    first = ["outcome"] if "outcome" in df.columns else []
    sides = [
        F.col(f"{side}.{name}").alias(f"{side}_{name}")
        for side in ("ride", "fare")
        for name in df.schema[side].dataType.fieldNames()
        if name in ("event_time", "event_id", "tip")
    ]
    return _zoneless(df.select(*first, "ride_id", *sides))


# --- queries --------------------------------------------------------------------------------


def _ride_cleansing(spark, sf_dir):
    return _zoneless(filters.ride_cleansing(_placed_rides(spark, sf_dir), BOX))


def _ride_starts(spark, sf_dir):
    return _zoneless(filters.ride_starts(_placed_rides(spark, sf_dir)))


def _ride_starts_sampled(spark, sf_dir):
    return _zoneless(filters.ride_starts_sampled(_order_rides(spark, sf_dir)))


def _tips_per_driver_hour(spark, sf_dir):
    return _zoneless(tips.tips_per_driver_hour(_tip_fares(spark, sf_dir)))


def hourly_tips_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(tips.hourly_tips_max(_tip_fares(spark, sf_dir)))


def _on_repeating(operator):
    return lambda spark, sf_dir: _flat(operator(*_repeating(spark, sf_dir)))


def _on_unique(operator, *arguments):
    def query(spark, sf_dir):
        result = operator(*_unique(spark, sf_dir), *arguments)
        return _flat(result) if "ride" in result.columns else _zoneless(result)

    return query


def _unmatched_rides(spark, sf_dir):
    rides, fares = _unique(spark, sf_dir)
    return _zoneless(enrichment.unmatched_rides(rides, fares).drop("is_start"))


def _unmatched_fares_filtered(spark, sf_dir):
    """Only open orders are rides here, so about half of the fares have none."""
    rides = filters.ride_starts_sampled(_order_rides(spark, sf_dir))
    return _zoneless(enrichment.unmatched_fares_filtered(rides, _order_fares(spark, sf_dir)))


def _bucketed(df):
    path = new_folder(df.sparkSession, "bucketed")
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_bucketed(df, f"tripstream_{path.rsplit('-', 1)[-1]}", path, buckets)


def _rides_fares_join_bucketed(spark, sf_dir):
    """Both inputs written as tables bucketed by ride id first, which then join where they lie."""
    return _flat(pairing.rides_fares_join(*map(_bucketed, _unique(spark, sf_dir))))


def _rides_fares_pairs_bucketed(spark, sf_dir):
    """Both kinds written as one bucketed table of events first, which is then paired where it lies."""
    events = _bucketed(pairing.tagged(*_repeating(spark, sf_dir)))
    return _flat(pairing.pairs_of(pairing.settled_events(events)))


_PLACES = ["start_lon", "start_lat", "end_lon", "end_lat"]


def _ride_cleansing_by_place(spark, sf_dir):
    rides, path = _placed_rides(spark, sf_dir), new_folder(spark, "by-place")
    write_by_place(rides, path, _PLACES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _zoneless(filters.ride_cleansing(read_table(spark, path, rides.schema), BOX))


def _stations(spark, sf_dir):
    """The suppliers in the layout of stations."""
    key = F.col("s_suppkey")
    return _table(spark, sf_dir, "supplier").select(
        key.cast("int").alias("id"),
        F.concat(F.col("s_name"), F.lit(" (a/b, @c)")).alias("name"),
        (key % 1801 / 20 - 45).alias("lat"),
        (key % 3601 / 20 - 90).alias("long"),
        (key % 9 * 4 + 11).cast("int").alias("dock_count"),
        F.concat(F.lit("City "), F.col("s_nationkey")).alias("city"),
        F.date_add(F.lit("2013-08-06").cast("date"), (key % 900).cast("int")).alias(
            "installation_date"
        ),
    )


def _scanned(stations, line_end="\n"):
    """Written as CSV and scanned from there."""
    path = new_folder(stations.sparkSession, "stations")
    write_stations(stations, path, line_end)
    return read_stations(stations.sparkSession, path).select(STATION.fieldNames())


def _station_scan(spark, sf_dir):
    return _scanned(_stations(spark, sf_dir))


def _on_station_files(operator):
    """All stations against a file with CRLF line ends of every second one, of which every fourth has another dock count."""

    def query(spark, sf_dir):
        stations = _stations(spark, sf_dir)
        docks = F.when(F.col("id") % 4 == 0, F.col("dock_count") + 1).otherwise(F.col("dock_count"))
        other = stations.filter("id % 2 = 0").withColumn("dock_count", docks)
        return operator(_scanned(stations), _scanned(other, "\r\n"))

    return query


def _on_registries(operator):
    return lambda spark, sf_dir: operator(*_registries(spark, sf_dir))


def _registry_except_all_stored(spark, sf_dir):
    """The registries stored with their trees of digests, then compared from there."""
    paths = []
    for side in _registries(spark, sf_dir):
        paths.append(new_folder(spark, "digested"))
        digests.write_digested(side, paths[-1], buckets=32)
    return digests.except_all_stored(spark, *paths)


def _registry_renumbered(spark, sf_dir):
    """Parts against a copy in which every third has a new key."""
    old = _table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id")
    moved = F.when(F.col("id") % 3 == 0, F.col("id") + 1_000_000_000).otherwise(F.col("id"))
    return registry.registry_renumbered(old, old.withColumn("id", moved))


def _replayed(inputs, build, **options):
    return Replay(inputs, build, **options).run()


def _stream_ride_cleansing(spark, sf_dir):
    return _zoneless(_replayed(
        {"rides": _placed_rides(spark, sf_dir)},
        lambda rides: filters.ride_cleansing(rides, BOX),
        max_delay=None,
    ))


def _stream_hourly_tips(spark, sf_dir):
    return _zoneless(_replayed({"fares": _tip_fares(spark, sf_dir)}, tips.hourly_tips_max))


def _stream_hourly_tips_late(spark, sf_dir):
    """Every seventh fare lands a slice late: what its hour's end has passed by is dropped."""
    fares = _tip_fares(spark, sf_dir, "event_id")
    return _zoneless(_replayed({"fares": fares}, tips.hourly_tips_max, late=F.col("event_id") % 7 == 0))


def _stream_hourly_tips_dropped(spark, sf_dir):
    """What the query above drops, by slice: groups of late fares, one for each driver and hour."""
    counts = new_folder(spark, "dropped")
    with counting_dropped(spark, counts) as listener:
        def start(*args, **sink):
            query = start_sink(*args, **sink)
            listener.await_counts(query)
            return query

        inputs = {"fares": _tip_fares(spark, sf_dir, "event_id")}
        replay = Replay(inputs, tips.hourly_tips_max, late=F.col("event_id") % 7 == 0, start=start)
        replay.play()
    by_batch = read_dropped(spark, counts).groupBy("batch").agg(
        F.max("input_rows").alias("fares"), F.sum("dropped").alias("dropped_groups")
    )
    place = F.row_number().over(Window.orderBy("batch")) - 1  # a row for each of the few batches
    return by_batch.filter("fares > 0").select(place.alias("slice"), "fares", "dropped_groups")


def _two(pair):
    return dict(zip(("rides", "fares"), pair, strict=True))


def _stream_rides_fares(spark, sf_dir):
    inputs = _two(_repeating(spark, sf_dir))
    return _flat(_replayed(inputs, stateful.rides_fares_stream, max_delay=None))


def _stream_rides_waiting(spark, sf_dir):
    replay = Replay(_two(_repeating(spark, sf_dir)), stateful.rides_fares_stream, max_delay=None)
    replay.run()
    return _flat(read_waiting(spark, replay.checkpoint))


# Every thirteenth record lands a slice late; the pairing takes it in all the same.
_LATE = "event_id % 13 = 0"
# The test tables are numbered in the order of time.
_FIRST_HALF = "event_time < timestamp '2024-01-16'"


def _stream_enrichment(on_duplicate):
    def query(spark, sf_dir):
        return _flat(_replayed(
            _two(_repeating(spark, sf_dir)),
            lambda rides, fares: stateful.enrichment_stream(rides, fares, on_duplicate),
            late=F.expr(_LATE),
        ))

    return query


def _stream_unmatched(tag, kind):
    def query(spark, sf_dir):
        outcomes = _replayed(
            _two(_repeating(spark, sf_dir)), stateful.enrichment_stream, partition_by="outcome", late=F.expr(_LATE)
        )
        return _zoneless(enrichment.side_output(outcomes, tag).select(f"{kind}.*"))

    return query


def _in_batches(read):
    """Pairing that settles each micro-batch as a table, into a store of pairs and of what waits."""

    def query(spark, sf_dir):
        replay = Replay(_two(_repeating(spark, sf_dir)), pairing.tagged, max_delay=None, start=batches.start_store)
        replay.play()
        return _flat(read(spark, replay.results, replay.stream().schema))

    return query


def _stream_rides_fares_begun(spark, sf_dir):
    """The first half settled as a table; what waits at its end is the state that a stream of the second half begins with."""
    rides, fares = _repeating(spark, sf_dir)
    done = pairing.settled(rides.filter(_FIRST_HALF), fares.filter(_FIRST_HALF))
    later = _two(df.filter(f"NOT {_FIRST_HALF}") for df in (rides, fares))
    waiting = pairing.waiting_of(done)
    rest = _replayed(later, lambda rides, fares: stateful.rides_fares_stream(rides, fares, begun=waiting), max_delay=None)
    return _flat(pairing.pairs_of(done).unionByName(rest))


def _stream_rides_fares_widened(spark, sf_dir):
    """The second half of time is played by a later deployment, whose fares have one column more."""
    rides, fares = _repeating(spark, sf_dir)
    replay = None
    for part, known in ((_FIRST_HALF, fares.drop("tip")), (f"NOT {_FIRST_HALF}", fares)):
        inputs = _two(df.filter(part) for df in (rides, known))
        replay = Replay(inputs, stateful.rides_fares_stream, max_delay=None, after=replay, wider_layouts=True)
        found = replay.run()
    return _flat(found)


def _stream_enrichment_fastest(spark, sf_dir):
    """Rides fall silent after half of the time; fares alone move the watermark from then on."""
    rides, fares = _repeating(spark, sf_dir)
    return _flat(_replayed(
        _two((rides.filter(_FIRST_HALF), fares)), stateful.enrichment_stream, late=F.expr(_LATE), time_moved_by=FASTEST,
    ))


def _on_unique_streams(operator):
    def query(spark, sf_dir):
        result = _replayed(
            _two(_unique(spark, sf_dir)),
            lambda rides, fares: operator(rides, fares, BOUND_SECONDS),
        )
        return _flat(result) if "ride" in result.columns else _zoneless(result)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "hourly_tips_max": hourly_tips_max,
        "tips_per_driver_hour": _tips_per_driver_hour,
        "ride_cleansing": _ride_cleansing,
        "ride_starts": _ride_starts,
        "ride_starts_sampled": _ride_starts_sampled,
        "rides_fares_pairs": _on_repeating(pairing.rides_fares_pairs),
        "rides_fares_waiting": _on_repeating(pairing.rides_fares_waiting),
        "rides_fares_join": _on_unique(pairing.rides_fares_join),
        "enrichment_outcomes": _on_unique(enrichment.enrichment_outcomes),
        "unmatched_fares": _on_unique(enrichment.unmatched_fares),
        "unmatched_rides": _unmatched_rides,
        "unmatched_fares_within": _on_unique(enrichment.unmatched_fares_within, BOUND_SECONDS),
        "unmatched_fares_filtered": _unmatched_fares_filtered,
        "rides_fares_join_bucketed": _rides_fares_join_bucketed,
        "rides_fares_pairs_bucketed": _rides_fares_pairs_bucketed,
        "ride_cleansing_by_place": _ride_cleansing_by_place,
        "station_scan": _station_scan,
        "station_intersect": _on_station_files(registry.registry_intersect),
        "station_except": _on_station_files(registry.registry_except),
        "registry_union_all": _on_registries(registry.registry_union_all),
        "registry_union": _on_registries(registry.registry_union),
        "registry_intersect": _on_registries(registry.registry_intersect),
        "registry_except": _on_registries(registry.registry_except),
        "registry_except_all": _on_registries(registry.registry_except_all),
        "registry_except_all_stored": _registry_except_all_stored,
        "registry_renumbered": _registry_renumbered,
        "stream_ride_cleansing": _stream_ride_cleansing,
        "stream_hourly_tips": _stream_hourly_tips,
        "stream_hourly_tips_late": _stream_hourly_tips_late,
        "stream_hourly_tips_dropped": _stream_hourly_tips_dropped,
        "stream_rides_fares": _stream_rides_fares,
        "stream_rides_fares_widened": _stream_rides_fares_widened,
        "stream_rides_waiting": _stream_rides_waiting,
        "stream_rides_fares_batches": _in_batches(batches.read_pairs),
        "stream_rides_waiting_batches": _in_batches(batches.read_states),
        "stream_rides_fares_begun": _stream_rides_fares_begun,
        "stream_enrichment_fastest": _stream_enrichment_fastest,
        "stream_enrichment": _stream_enrichment("replace"),
        "stream_enrichment_emit": _stream_enrichment("emit"),
        "stream_unmatched_fares": _stream_unmatched(UNMATCHED_FARE, "fare"),
        "stream_unmatched_rides": _stream_unmatched(UNMATCHED_RIDE, "ride"),
        "stream_rides_fares_within": _on_unique_streams(interval.rides_fares_within_stream),
        "stream_unmatched_fares_within": _on_unique_streams(
            interval.unmatched_fares_within_stream
        ),
    }
