"""Playing tables as streams, in event-time order: the harness behind the catalog's stream queries."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripstream.plans import new_folder
from tripstream.schemas import MAX_DELAY
from tripstream.sources import read_stream
from tripstream.streaming.sinks import start_sink

#: Fixed value: spans of event time that land one after the other. They set the steps of the watermark, and with them who
#: expires, so the number is the same for any table; the SQL of the stream queries uses it too.
SLICES = 4


class Replay:
    """Feeds named tables to one streaming query, slice after slice of event time.

    Each table is worked out once and kept as files, from which the slices are taken. The span between the first and last event is cut into SLICES equal ones. Each slice is written where the query looks
    for files, and the query takes it in from its checkpoint and stops: only a query that starts after a slice has landed
    sees all of it, of both inputs, as one micro-batch. `late` says which rows land a slice after their time; `start` and `sink` how the query is started; `after` is an earlier
    replay, on whose folders this one goes on. Rows without a time land with the first slice. Tables without rows give an empty result.
    """

    def __init__(
        self,
        inputs: dict[str, DataFrame],
        build: Callable[..., DataFrame],
        max_delay: str | None = MAX_DELAY,
        partition_by: str | None = None,
        late: Column | None = None,
        start: Callable[..., StreamingQuery] = start_sink,
        after: "Replay | None" = None,
        **sink,
    ):
        self.inputs = inputs
        self.spark = next(iter(inputs.values())).sparkSession
        self.folder = after.folder if after else new_folder(self.spark, "replay")
        self.results = f"{self.folder}/results"
        self.checkpoint = f"{self.folder}/checkpoint"
        #: Rows without a time, by input, once played.
        self.untimed: dict[str, int] = {}
        self._build, self._max_delay, self._late = build, max_delay, late
        self._start, self._sink = start, sink if partition_by is None else {**sink, "partition_by": partition_by}

    def run(self) -> DataFrame:
        """Plays everything and returns what the query put out."""
        self.play()
        return self.spark.read.schema(self.stream().schema).parquet(self.results)

    def play(self) -> None:
        at = F.unix_micros("event_time")
        tables = {name: self._staged(name, df) for name, df in self.inputs.items()}
        span = [F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.when(at.isNull(), 1)).alias("untimed")]
        found = {name: df.agg(*span).first() for name, df in tables.items()}
        self.untimed = {name: f["untimed"] for name, f in found.items()}
        first = min((f["first"] for f in found.values() if f["first"] is not None), default=0)
        length = max((f["last"] for f in found.values() if f["last"] is not None), default=0) - first + 1
        behind = F.lit(0) if self._late is None else F.coalesce(self._late, F.lit(False)).cast("int")
        part = F.coalesce(F.least(slice_of(at, first, length, SLICES) + behind, F.lit(SLICES - 1)), F.lit(0))
        for number in range(SLICES):
            for name, df in tables.items():
                df.filter(part == number).write.mode("append").parquet(f"{self.folder}/landed/{name}")
            self._start(self.stream(), self.results, self.checkpoint, until_caught_up=True, **self._sink).awaitTermination()

    def _staged(self, name: str, df: DataFrame) -> DataFrame:
        path = new_folder(self.spark, f"staged-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stream(self) -> DataFrame:
        return self._build(**{
            name: read_stream(self.spark, f"{self.folder}/landed/{name}", df.schema, max_delay=self._max_delay)
            for name, df in self.inputs.items()
        })


def slice_of(at: Column, first: int, length: int, count: int) -> Column:
    """Number of the equal span of time that holds `at`."""
    return F.floor((at - first) * count / F.lit(length)).cast("int")
