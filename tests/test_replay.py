"""The harness of the stream queries, and folders for derived data."""

import pytest
from pyspark.sql import functions as F

from tests.streams import RECORD, at_second
from tripstream import plans
from tripstream.operators.filters import ride_starts
from tripstream.plans import storage
from tripstream.replay import SLICES, Replay
from tripstream.streaming.stateful import enrichment_stream


def test_rows_without_time_are_fed_and_counted(spark):
    rows = [(n, True, at_second(n) if n % 3 else None) for n in range(30)]
    rides = spark.createDataFrame(rows, "ride_id long, is_start boolean, event_time timestamp")
    replay = Replay({"rides": rides}, ride_starts, max_delay=None)
    assert sorted(r.ride_id for r in replay.run().collect()) == list(range(30))
    assert replay.untimed == {"rides": 10}


def test_empty_tables_give_an_empty_result(spark):
    empty = spark.createDataFrame([], RECORD)
    found = Replay({"rides": empty, "fares": empty}, enrichment_stream).run()
    assert found.columns == ["outcome", "ride_id", "ride", "fare"] and found.count() == 0


def test_results_do_not_depend_on_the_files_of_a_slice(spark):
    rows = [(n % 17, at_second(n * 31 % 4000), n) for n in range(240)]
    found = []
    for files in (1, 5):
        events = spark.createDataFrame(rows, RECORD).repartition(files, "no")
        inputs = {"rides": events.filter("no % 2 = 0"), "fares": events.filter("no % 2 = 1")}
        result = Replay(inputs, enrichment_stream, late=F.expr("no % 7 = 0")).run()
        found.append(sorted(map(repr, result.collect())))
    assert found[0] == found[1] and found[0] and SLICES == 4


def test_a_table_is_worked_out_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    table = spark.createDataFrame([(n % 5, at_second(n * 31), n) for n in range(40)], RECORD)
    rides = table.mapInArrow(counted, table.schema).withColumn("is_start", F.lit(True))
    assert Replay({"rides": rides}, ride_starts, max_delay=None).run().count() == 40 and read.value == 40


def test_folders_on_a_cluster_need_a_setting(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://somewhere:7077", "app-1"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.new_folder(Session(), "slices")


def test_derived_folders_can_be_removed(spark):
    setting = spark.sparkContext.getCheckpointDir()
    path = plans.new_folder(spark, "table")
    spark.range(3).write.parquet(path)
    assert spark.sparkContext.getCheckpointDir() == setting
    plans.remove_derived(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)
