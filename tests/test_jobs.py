"""The four analyses on landing folders."""

import pytest

from tests.streams import at_second
from tripstream.functions import Box
from tripstream.operators.enrichment import side_output
from tripstream.schemas import FARE, RIDE
from tripstream.streaming import jobs


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    inside, outside = (0.5, 0.5), (3.0, 0.5)
    rides = [
        (1, True, at_second(60), *inside, *inside),
        (1, False, at_second(600), *inside, *inside),
        (2, True, at_second(90), *inside, *outside),
        (1000, True, at_second(100), *inside, *inside),
        (3, True, at_second(9000), *outside, *outside),
    ]
    fares = [
        (1, 7, at_second(70), 1.5), (2, 8, at_second(95), 2.5), (1000, 8, at_second(101), 0.5),
        (4, 7, at_second(9000), 0.0),
    ]
    spark.createDataFrame(rides, RIDE).write.json(f"{folder}/rides")
    spark.createDataFrame(fares, FARE).write.json(f"{folder}/fares")
    return str(folder)


def run(spark, landed, start, *inputs, out, **options):
    paths = [f"{landed}/{name}" for name in inputs]
    query = start(
        spark, *paths, f"{out}/results", f"{out}/checkpoint",
        source={"fmt": "json", "max_bytes": 64_000_000}, until_caught_up=True, **options,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/results")


def test_ride_cleansing(spark, landed, tmp_path):
    found = run(spark, landed, jobs.start_ride_cleansing, "rides", out=tmp_path, box=Box(0, 0, 1, 1))
    assert sorted((r.ride_id, r.is_start) for r in found.collect()) == [(1, False), (1, True), (1000, True)]


def test_hourly_tips(spark, landed, tmp_path):
    found = run(spark, landed, jobs.start_hourly_tips, "fares", out=tmp_path)
    assert [(r.driver_id, r.total_tips) for r in found.collect()] == [(8, 3.0)]


def test_rides_and_fares(spark, landed, tmp_path):
    found = run(spark, landed, jobs.start_rides_and_fares, "rides", "fares", out=tmp_path)
    assert sorted((r.ride_id, r.fare.tip) for r in found.collect()) == [(1, 1.5), (2, 2.5), (1000, 0.5)]


def test_expiring_state(spark, landed, tmp_path):
    found = run(spark, landed, jobs.start_expiring_state, "rides", "fares", out=tmp_path)
    assert [r.ride_id for r in side_output(found, "unmatched_fare").collect()] == [1000]
    assert sorted(r.ride_id for r in side_output(found, "matched").collect()) == [1, 2]
