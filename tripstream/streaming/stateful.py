"""Arrival-order pairing on streams with keyed state and event-time timers.

Both operators take one shuffle and keep at most one waiting record per id. State lives
in the RocksDB store, on local disk with durable checkpoints, so its size is not bound by memory.
An id's rows of one micro-batch are sorted by the task that holds the id's state, on disk where they
are many: the rules depend on order, so an id cannot be shared between tasks.

Each call to the store is a message to another process and back, and the expiring pairing would need some for every record and every
timer. So it keeps ids by buckets: a bucket's ids are read, settled and written together, and a bucket has one timer.
"""

from collections.abc import Callable, Iterator
from itertools import chain, groupby, islice
from typing import Any

from pyspark.serializers import CPickleSerializer
from pyspark.shuffle import ExternalSorter
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tripstream.operators.pairing import tagged, unplaced
from tripstream.schemas import MATCHED, UNMATCHED_FARE, UNMATCHED_RIDE

_REPLACE, _EMIT = "replace", "emit"
_PAIR = Row("ride_id", "ride", "fare")
_OUTCOME = Row("outcome", "ride_id", "ride", "fare")
# Rows of one id sorted without looking at memory; worker memory in MB from where a sort spills.
_SMALL_GROUP = 10_000
_SORT_MEMORY = 1024
# Ids of the expiring pairing that share a list of state are those of one bucket of so many; a list goes to the store in parts.
BUCKETS = 4096
_LIST_PART = 10_000


def _stamped(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """`tagged` with the event time in microseconds as `at`; event_time carries the watermark."""
    return tagged(rides, fares).withColumn("at", F.unix_micros("event_time"))


def _spark_order(value: Any) -> tuple:
    """Sorts as Spark does: nulls first, NaN last, structs and arrays part by part; maps by their entries in order."""
    if value is None:
        return (0,)
    if isinstance(value, dict):
        return 1, sorted([_spark_order(k), _spark_order(v)] for k, v in value.items())
    if isinstance(value, (tuple, list)):
        return 1, [_spark_order(v) for v in value]
    if isinstance(value, float) and value != value:
        return (2,)
    return 1, value


def _arrival(row: Row) -> tuple:
    # The record itself makes the order total, as in the batch form.
    return row.at, not row.is_ride, _spark_order(row.ride if row.is_ride else row.fare)


def _id_and_arrival(row: Row) -> tuple:
    return row.ride_id, _arrival(row)


def _in_order(rows: Iterator[Row], order: Callable[[Row], tuple] = _arrival) -> Iterator[Row]:
    first = list(islice(rows, _SMALL_GROUP))
    if len(first) < _SMALL_GROUP:
        return iter(sorted(first, key=order))
    sorter = ExternalSorter(_SORT_MEMORY, CPickleSerializer())
    return iter(sorter.sorted(chain(first, rows), key=order))


def _waiting_schema(events: DataFrame) -> StructType:
    return StructType([
        StructField("is_ride", BooleanType()),
        StructField("at", LongType()),
        StructField("ride", events.schema["ride"].dataType),
        StructField("fare", events.schema["fare"].dataType),
    ])


def _result_schema(events: DataFrame, *first: StructField) -> StructType:
    return StructType([
        *first,
        StructField("ride_id", LongType()),
        StructField("ride", events.schema["ride"].dataType),
        StructField("fare", events.schema["fare"].dataType),
    ])


class _Waiting:
    """The waiting record of one id, read once and written once per micro-batch."""

    def __init__(self, state: Any):
        self._state = state
        self._stored = self.record = state.get()

    def save(self) -> None:
        if self.record is self._stored:
            return
        if self.record is None:
            self._state.clear()
        else:
            self._state.update(self.record)


def _pair(waiting: tuple, row: Row) -> tuple:
    return (row.ride, waiting[3]) if row.is_ride else (waiting[2], row.fare)


class PairingProcessor(StatefulProcessor):
    """Rides and fares of one id: the waiting record pairs with the next of the other kind."""

    def __init__(self, waiting_schema: StructType, ttl_ms: int | None):
        self._schema = waiting_schema
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._waiting = handle.getValueState("waiting", self._schema, self._ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        slot = _Waiting(self._waiting)
        for row in _in_order(rows):
            if slot.record is not None and slot.record[0] != row.is_ride:
                yield _PAIR(key[0], *_pair(slot.record, row))
                slot.record = None
            else:
                slot.record = (row.is_ride, row.at, row.ride, row.fare)
        slot.save()

    def handleInitialState(self, key: Any, initialState: Any, timerValues: Any) -> None:
        row = initialState
        self._waiting.update((row.is_ride, row.at, row.ride, row.fare))

    def close(self) -> None:
        pass


class _Open:
    """What is open for one id: its waiting record, if any, and when its timers are due, in milliseconds."""

    def __init__(self, record: tuple | None = None, due: Any = ()):
        self.record, self.due = record, set(due)


class ExpiringProcessor(StatefulProcessor):
    """As above, for a bucket of ids; a record still waiting when the watermark passes its time is unmatched.

    A waiting record sets a timer at its own event time and a match deletes it. A record that is
    replaced leaves its timer behind, and any timer that fires gives up whatever is waiting then. Timers are kept with
    their id; the store has one for the bucket, when the first of them is due.
    """

    def __init__(self, open_schema: StructType, on_duplicate: str):
        self._schema = open_schema
        self._emit_replaced = on_duplicate == _EMIT

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", self._schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        ids = self._read()
        first_due = _first_due(ids)
        for ride_id, own in groupby(_in_order(rows, _id_and_arrival), key=lambda row: row.ride_id):
            yield from self._settled(ride_id, ids.setdefault(ride_id, _Open()), own)
        self._write(ids)
        now_due = _first_due(ids)
        if now_due != first_due:
            if first_due is not None:
                self._handle.deleteTimer(first_due)
            if now_due is not None:
                self._handle.registerTimer(now_due)

    def _settled(self, ride_id: int, held: _Open, rows: Iterator[Row]) -> Iterator[Row]:
        for row in rows:
            if held.record is not None and held.record[0] != row.is_ride:
                held.due.discard(held.record[1] // 1000)
                yield _OUTCOME(MATCHED, ride_id, *_pair(held.record, row))
                held.record = None
                continue
            if held.record is not None and self._emit_replaced:
                yield _unmatched(ride_id, held.record)
            held.record = (row.is_ride, row.at, row.ride, row.fare)
            held.due.add(row.at // 1000)

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[Row]:
        now, ids = timerValues.getCurrentWatermarkInMs(), self._read()
        for ride_id, held in ids.items():
            left = {due for due in held.due if due > now}
            if len(left) == len(held.due):
                continue
            if held.record is not None:
                yield _unmatched(ride_id, held.record)
            held.record, held.due = None, left
        self._write(ids)
        # The timer that fired is deleted by Spark.
        now_due = _first_due(ids)
        if now_due is not None:
            self._handle.registerTimer(now_due)

    def _read(self) -> dict[int, _Open]:
        return {
            ride_id: _Open(None if is_ride is None else (is_ride, at, _as_came(ride), _as_came(fare)), due)
            for ride_id, is_ride, at, ride, fare, due in self._waiting.get()
        }

    def _write(self, ids: dict[int, _Open]) -> None:
        nothing = (None,) * 4
        kept = ((n, *(held.record or nothing), sorted(held.due)) for n, held in ids.items() if held.record or held.due)
        part = list(islice(kept, _LIST_PART))
        if not part:
            self._waiting.clear()
            return
        self._waiting.put(part)
        while part := list(islice(kept, _LIST_PART)):
            self._waiting.appendList(part)

    def close(self) -> None:
        pass


def _as_came(record: Row | None) -> dict | None:
    """A record read from a list of state in the form in which it came, which alone can be written again."""
    return None if record is None else record.asDict(True)


def _first_due(ids: dict[int, _Open]) -> int | None:
    return min((due for held in ids.values() for due in held.due), default=None)


def _unmatched(ride_id: int, held: tuple) -> Row:
    return _OUTCOME(UNMATCHED_RIDE if held[0] else UNMATCHED_FARE, ride_id, held[2], held[3])


def rides_fares_stream(
    rides: DataFrame, fares: DataFrame, ttl_ms: int | None = None, begun: DataFrame | None = None
) -> DataFrame:
    """Stream of (ride_id, ride, fare).

    A record without partner waits for ever, unless `ttl_ms` bounds its stay in processing time. `begun` is a table of
    (ride_id, ride, fare) that already wait when the first micro-batch comes, at most one an id, as `pairing.waiting_of`
    gives them: a history kept as a table goes on as a stream. A query that goes on from a checkpoint has its own state and ignores it.
    """
    events = _stamped(rides, fares)
    waiting = None
    if begun is not None:
        waiting = begun.select(
            "ride_id", F.col("ride").isNotNull().alias("is_ride"),
            F.unix_micros(F.coalesce("ride.event_time", "fare.event_time")).alias("at"), "ride", "fare",
        ).groupBy("ride_id")
    return events.groupBy("ride_id").transformWithState(
        PairingProcessor(_waiting_schema(events), ttl_ms),
        _result_schema(events),
        "append",
        "None" if ttl_ms is None else "ProcessingTime",
        waiting,
    )


def enrichment_stream(
    rides: DataFrame, fares: DataFrame, on_duplicate: str = _REPLACE, buckets: int = BUCKETS
) -> DataFrame:
    """Stream of (outcome, ride_id, ride, fare) from two watermarked streams.

    A record that comes behind the watermark is taken in like any other, and is given up with the same micro-batch if
    its partner isn't there. A record without id or time has no place in any history and is unmatched at once.
    `on_duplicate="replace"` loses a waiting record when another of its kind takes its place;
    "emit" puts it out as unmatched.

    Ids share `buckets` lists of state, of which a micro-batch reads and writes those that its records touch, so what is open in one
    bucket must fit a task's memory. The number must stay as it is for the life of a checkpoint.
    """
    if on_duplicate not in (_REPLACE, _EMIT):
        raise ValueError(f"on_duplicate must be {_REPLACE!r} or {_EMIT!r}: {on_duplicate!r}")
    # Without its event-time column, the operator drops nothing as late; `at` holds the time, and timers follow the watermark.
    events = _stamped(rides, fares).drop("event_time")
    bucket = F.pmod(F.xxhash64("ride_id"), F.lit(buckets)).alias("bucket")
    open_schema = StructType([
        StructField("ride_id", LongType()), *_waiting_schema(events), StructField("timers", ArrayType(LongType())),
    ])
    expiring = events.select(bucket, "*").groupBy("bucket").transformWithState(
        ExpiringProcessor(open_schema, on_duplicate),
        _result_schema(events, StructField("outcome", StringType())),
        "append",
        "EventTime",
    )
    outcome = F.when(F.col("is_ride"), UNMATCHED_RIDE).otherwise(UNMATCHED_FARE).alias("outcome")
    return expiring.unionByName(unplaced(rides, fares).select(outcome, "ride_id", "ride", "fare"))
