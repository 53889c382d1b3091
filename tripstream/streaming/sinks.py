"""Running a stream into files, and reading results and kept state back."""

import threading
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commits write what changed, not a snapshot of the store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A join keeps its four tables in one store a partition, not in four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
# A run that stops once it has caught up ends before Spark takes snapshots by the way, and the next run would replay the changes of all
# runs before it, row by row. So its commits write snapshots. Nor does it look up each row before a write only to count rows.
_CATCHING_UP = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# Fixed value: the interval between checkpoints of a running stream.
CHECKPOINT_INTERVAL = "10 seconds"
#: Which input moves the watermark where there are several.
SLOWEST, FASTEST = "slowest", "fastest"
_POLICY = {SLOWEST: "min", FASTEST: "max"}
# Held while a session bears a query's settings, so that threads don't take over each other's.
_STARTING = threading.Lock()


def start_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = CHECKPOINT_INTERVAL,
    until_caught_up: bool = False,
    partition_by: str | None = None,
    state_partitions: int | None = None,
    idle_batches: bool = True,
    time_moved_by: str = SLOWEST,
    wider_layouts: bool = False,
) -> StreamingQuery:
    """Appends `stream` to parquet files in `path`, exactly once.

    Progress and state are committed to `checkpoint`, a folder on shared storage, with every
    micro-batch; a query started again on that folder goes on where the last one stopped.
    `until_caught_up` takes in all that has landed and stops; its commits write snapshots of the state, so that the next run needn't replay
    what this one changed, and its progress reports don't count the rows kept. `partition_by` writes a folder per
    value, so that one outcome tag can be read without the others. `state_partitions` overrides
    the session's shuffle partitions; a checkpoint keeps the number it began with. Batches without
    input let time move on; with state that lives for a span of processing time they never end, so
    such a stream needs `idle_batches=False` to catch up and stop.

    `time_moved_by` says which of several inputs moves the watermark: the slowest, so that no input's records are behind
    it, or the fastest, so that an input which falls silent does not hold up time (nor what waits for it to pass), at the price
    that its records may come behind the watermark once it speaks again. A checkpoint keeps the choice it began with.

    With `wider_layouts` the kept state is written in a form that tells its columns by name (Avro), so a query deployed again on
    this checkpoint may have records with further columns: what was kept before comes back with null in them. Column names must
    then be letters, digits and underscores. Without it such a query fails at its start; a checkpoint keeps the form it began with. Files written before
    lack the further columns, so results are best read with the wider schema given.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _start(stream.sparkSession, writer, checkpoint, interval, until_caught_up, state_partitions, idle_batches, time_moved_by, wider_layouts)


def start_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str = CHECKPOINT_INTERVAL,
    until_caught_up: bool = False,
    state_partitions: int | None = None,
    idle_batches: bool = True,
    time_moved_by: str = SLOWEST,
    wider_layouts: bool = False,
) -> StreamingQuery:
    """Hands each micro-batch with its number to `write`, which is called again for a batch that has failed: what it
    writes must depend on the number so that it replaces the first attempt. Other arguments are those of `start_sink`."""
    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    return _start(stream.sparkSession, writer, checkpoint, interval, until_caught_up, state_partitions, idle_batches, time_moved_by, wider_layouts)


def start_tagged_sinks(stream: DataFrame, tag: str, paths: dict[str, str], checkpoint: str, **sink) -> StreamingQuery:
    """Writes the records of each tag to a table of their own, each exactly once, without the tag.

    A micro-batch is worked out once and kept for its writes. In every table it owns one folder, which it overwrites when it is
    repeated: a batch that fails between two tables adds no row twice. Records with another tag, or none, are left out.
    """
    def write(batch: DataFrame, number: int) -> None:
        kept = batch.filter(F.col(tag).isin(*paths)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for value, path in paths.items():
                kept.filter(F.col(tag) == value).drop(tag).write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            kept.unpersist()

    return start_batches(stream, write, checkpoint, **sink)


def _start(
    spark: SparkSession, writer: DataStreamWriter, checkpoint: str, interval: str, until_caught_up: bool,
    state_partitions: int | None, idle_batches: bool, time_moved_by: str, wider_layouts: bool,
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if until_caught_up else writer.trigger(processingTime=interval)
    settings = {**_STATE, "spark.sql.streaming.multipleWatermarkPolicy": _POLICY[time_moved_by]}
    if until_caught_up:
        settings |= _CATCHING_UP
    if wider_layouts:
        settings["spark.sql.streaming.stateStore.encodingFormat"] = "avro"
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if not idle_batches:
        settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    # A query keeps the settings it was started under; the session gets its own ones back.
    with _STARTING:
        before = {name: spark.conf.get(name, None) for name in settings}
        for name, value in settings.items():
            spark.conf.set(name, value)
        try:
            return writer.start()
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


class DroppedRows(StreamingQueryListener):
    """Keeps what a session's queries drop as late: a row for each micro-batch with input and stateful operator.

    Rows go to parquet files in `path`, each batch to a folder of its own, which it overwrites if it is repeated. They are written when
    Spark reports the batch, after its commit: a driver lost between the two loses that batch's counts, not its rows. An operator counts the rows
    that reach it; in front of an aggregation these are groups of late records, one for each key and window of a batch.
    """

    LAYOUT = "query string, batch long, input_rows long, operator int, name string, dropped long"

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._lock, self._ended = threading.Lock(), {}
        self.failure: Exception | None = None

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        rows = [
            (str(batch.id), batch.batchId, batch.numInputRows, n, kept.operatorName, kept.numRowsDroppedByWatermark)
            for n, kept in enumerate(batch.stateOperators)
        ]
        if not any(r[2] or r[5] for r in rows):
            return
        try:
            table = self._spark.createDataFrame(rows, self.LAYOUT).coalesce(1)
            table.write.mode("overwrite").parquet(f"{self._path}/of={batch.id}/at={batch.batchId}")
        except Exception as error:  # Spark only logs what a listener raises
            self.failure = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def await_counts(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Returns once `query` has stopped and all its batches are counted: reports come after a query's end."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of query {query.id} was not reported in {seconds} s")
        if self.failure is not None:
            raise self.failure


@contextmanager
def counting_dropped(spark: SparkSession, path: str):
    """Counts what is dropped by queries started within the block, into `path`; `await_counts` before leaving it."""
    listener = DroppedRows(spark, path)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def read_dropped(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch, input_rows, operator, name, dropped) as `DroppedRows` has kept them."""
    return spark.read.schema(DroppedRows.LAYOUT).option("recursiveFileLookup", "true").parquet(path)


def read_waiting(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(ride_id, ride, fare) waiting in the state of a stopped pairing stream, at its end or at the end of an earlier batch.

    Spark keeps the states of the last hundred batches, unless `spark.sql.streaming.minBatchesToRetain` says otherwise.
    """
    state = _state_reader(spark, batch).option("stateVarName", "waiting").load(checkpoint)
    if "list_element" in state.columns:
        return state.select("list_element.*").filter("is_ride IS NOT NULL").select("ride_id", "ride", "fare")
    return state.select("key.ride_id", "value.ride", "value.fare")


def read_timers(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(ride_id, due) for each timer set in a stopped expiring stream, at its end or at the end of an earlier batch.

    They are kept with what waits, by buckets of ids, of which Spark has one timer each. A timer fires with the first batch whose watermark has reached it. More timers than waiting records mean that some were left
    behind by records since replaced.
    """
    state = _state_reader(spark, batch).option("stateVarName", "waiting").load(checkpoint).select("list_element.*")
    return state.select("ride_id", F.explode("timers").alias("at")).select("ride_id", F.timestamp_millis("at").alias("due"))


def _state_reader(spark: SparkSession, batch: int | None) -> DataFrameReader:
    reader = spark.read.format("statestore")
    return reader if batch is None else reader.option("batchId", batch)
