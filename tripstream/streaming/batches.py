"""Arrival-order pairing on streams whose ids can be hot: each micro-batch is settled as a table.

Keyed state gives an id to one task, which takes its rows one by one. Here a micro-batch and the records that waited for it are
settled with window functions instead, and an id too large for one task is cut into slices, as on tables. What waits is
itself a table: every batch writes the new state of the ids it touched, next to its pairs, in one job; every few batches the
latest states are gathered into a snapshot.

A store is a folder on shared storage. Batch n owns the folder batch=n and overwrites it, and reads only what batches before
it wrote, so a batch that is repeated after a failure leaves the same rows once.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tripstream.operators.pairing import settled_events, tagged
from tripstream.plans import HOT_ROWS
from tripstream.streaming.sinks import start_batches

#: Batches between two snapshots of what waits: a batch reads one snapshot and fewer than this many changes. Must stay as it
#: is for the life of a store.
SNAPSHOT_EVERY = 20
_PAIR, _STATE = "pair", "state"


def _layout(events: StructType) -> StructType:
    return StructType([
        StructField("ride_id", LongType()), StructField("ride", events["ride"].dataType), StructField("fare", events["fare"].dataType),
        StructField("kind", StringType()), StructField("batch", LongType()),
    ])


def _written(spark: SparkSession, store: str, layout: StructType) -> DataFrame:
    return spark.read.schema(layout).parquet(f"{store}/batches")


def _states(spark: SparkSession, store: str, covered: int, number: int, layout: StructType) -> DataFrame:
    """(ride_id, ride, fare, batch) of ids in the snapshot before batch `covered` and in each batch from there to before
    `number`; ride and fare both null: nothing waits any more."""
    columns = ["ride_id", "ride", "fare", "batch"]
    reader = spark.read.schema(layout).option("basePath", f"{store}/batches")
    since = [f"{store}/batches/batch={n}" for n in range(covered, number)]
    changes = reader.parquet(*since).filter(F.col("kind") == _STATE) if since else spark.createDataFrame([], layout)
    if not covered:
        return changes.select(columns)
    kept = StructType([f for f in layout if f.name in columns])
    return spark.read.schema(kept).parquet(f"{store}/snapshots/before={covered}").unionByName(changes.select(columns))


def _latest(states: DataFrame) -> DataFrame:
    """One row for each id with which something waits."""
    last = states.groupBy("ride_id").agg(F.max_by(F.struct("ride", "fare", "batch"), "batch").alias("last"))
    return last.select("ride_id", "last.*").filter("ride IS NOT NULL OR fare IS NOT NULL")


def settle_batch(events: DataFrame, number: int, store: str, min_rows: int = HOT_ROWS) -> None:
    """Settles one micro-batch of tagged events against what waits, and writes its pairs and the new states of its ids.

    The events are read three times (for their ids, for hot ids, to settle them): a micro-batch is files, so nothing is kept in
    memory. Changes are as many as the batch has ids; what waits for other ids is read by its id column alone, and not written.
    """
    spark, layout = events.sparkSession, _layout(events.schema)
    covered = number // SNAPSHOT_EVERY * SNAPSHOT_EVERY
    if number and number == covered:
        before = _states(spark, store, number - SNAPSHOT_EVERY, number, layout)
        _latest(before).write.mode("overwrite").parquet(f"{store}/snapshots/before={number}")
    touched = events.select("ride_id").distinct()
    held = _latest(_states(spark, store, covered, number, layout).join(touched, "ride_id", "left_semi")).select(
        "ride_id", F.coalesce("ride.event_time", "fare.event_time").alias("event_time"), F.col("ride").isNotNull().alias("is_ride"),
        "ride", "fare", F.lit(0).alias("round"),
    )
    done = settled_events(held.unionByName(events.withColumn("round", F.lit(1))), min_rows=min_rows)
    paired, waits = F.col("place") % 2 == 1, F.col("place") % 2 == 0
    pair = F.struct(*(F.coalesce(c, f"prior_{c}").alias(c) for c in ("ride", "fare")), F.lit(_PAIR).alias("kind"))
    state = F.struct(*(F.when(waits, F.col(c)).alias(c) for c in ("ride", "fare")), F.lit(_STATE).alias("kind"))
    rows = F.filter(F.array(F.when(paired, pair), F.when(F.col("last"), state)), lambda r: r.isNotNull())
    done.select("ride_id", F.inline(rows)).write.mode("overwrite").partitionBy("kind").parquet(f"{store}/batches/batch={number}")


def start_store(events: DataFrame, store: str, checkpoint: str, min_rows: int = HOT_ROWS, **sink) -> StreamingQuery:
    """Settles a stream of tagged events into a store; `sink` holds arguments of `start_batches`."""
    nothing = events.sparkSession.createDataFrame([], _layout(events.schema))
    nothing.write.mode("append").partitionBy("batch", "kind").parquet(f"{store}/batches")
    return start_batches(events, lambda batch, number: settle_batch(batch, number, store, min_rows), checkpoint, **sink)


def start_paired_batches(
    rides: DataFrame, fares: DataFrame, store: str, checkpoint: str, min_rows: int = HOT_ROWS, **sink
) -> StreamingQuery:
    """Pairs two streams into a store. Arrival order is that of `rides_fares_stream`: by micro-batch, then as on tables."""
    return start_store(tagged(rides, fares), store, checkpoint, min_rows, **sink)


def read_pairs(spark: SparkSession, store: str, events: StructType) -> DataFrame:
    """(ride_id, ride, fare) of all pairs so far; `events` is the layout that `tagged` gives."""
    return _written(spark, store, _layout(events)).filter(F.col("kind") == _PAIR).select("ride_id", "ride", "fare")


def read_states(spark: SparkSession, store: str, events: StructType, before: int | None = None) -> DataFrame:
    """(ride_id, ride, fare) of what waits, now or before a batch: past states stay in the store."""
    states = _written(spark, store, _layout(events)).filter(F.col("kind") == _STATE)
    if before is not None:
        states = states.filter(F.col("batch") < before)
    return _latest(states.select("ride_id", "ride", "fare", "batch")).select("ride_id", "ride", "fare")
