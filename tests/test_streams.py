"""Built-in streaming operators: tips, late data, filters and interval joins."""

import os

from tests.streams import RECORD, Player, at_second
from tripstream.functions import Box
from tripstream.operators.filters import ride_cleansing, ride_starts_sampled
from tripstream.operators.tips import hourly_tips_max, tips_per_driver_hour
from tripstream.schemas import FARE, RIDE
from tripstream.sources import read_stream
from tripstream.streaming.sinks import counting_dropped, read_dropped, start_sink
from tripstream.streaming.interval import (
    rides_fares_within_stream,
    unmatched_fares_within_stream,
)


def test_hourly_tips_drop_and_count_late_rows(spark, tmp_path):
    fare = "ride_id long, driver_id long, event_time timestamp, tip double"
    assert spark.createDataFrame([], fare).schema == FARE
    player = Player(spark, tmp_path, hourly_tips_max, {"fares": fare})
    on_time = [(1, 7, at_second(10), 2.5), (2, 8, at_second(20), 2.0), (3, 8, at_second(3599), 0.5)]
    player.land("fares", on_time + [(4, 7, at_second(3700), 1.0)])
    player.advance()
    late = [(5, 7, at_second(3700 - 161), 99.0)]
    more = [(6, 9, at_second(3600), 5.0), (7, 9, at_second(7300), 0.1)]
    player.land("fares", late + more)
    player.advance()
    found = [tuple(r) for r in player.results().selectExpr(
        "(unix_seconds(window_end) - unix_seconds(timestamp'2024-01-01 00:00:00Z')) / 3600",
        "driver_id", "total_tips",
    ).collect()]
    # Drivers 7 and 8 tie in the first hour. The late fare belongs to it and is gone.
    assert sorted(found) == [(1.0, 7, 2.5), (2.0, 9, 5.0)]
    dropped = [s["numRowsDroppedByWatermark"] for p in player.progress for s in p["stateOperators"]]
    assert sum(dropped) == 1


def test_stream_equals_table_for_closed_windows(spark, tmp_path):
    fare = "ride_id long, driver_id long, event_time timestamp, tip double"
    rows = [(n, n % 5, at_second(n * 97), float(n % 11)) for n in range(300)]
    player = Player(spark, tmp_path, tips_per_driver_hour, {"fares": fare})
    for part in (rows[:150], rows[150:]):
        player.land("fares", part)
        player.advance()
    table = tips_per_driver_hour(spark.createDataFrame(rows, fare))
    closed = table.filter(f"unix_seconds(window_end) <= {int(rows[-1][2].timestamp()) - 60}")
    assert sorted(player.results().collect()) == sorted(closed.collect())
    assert closed.count() < table.count()


def test_filters_on_a_stream(spark, tmp_path):
    ride = (
        "ride_id long, is_start boolean, event_time timestamp, start_lon double, start_lat double, "
        "end_lon double, end_lat double"
    )
    assert spark.createDataFrame([], ride).schema == RIDE
    box = Box(-1, -1, 1, 1)
    player = Player(
        spark, tmp_path, lambda rides: ride_starts_sampled(ride_cleansing(rides, box)),
        {"rides": ride}, max_delay=None,
    )
    player.land("rides", [
        (1, True, at_second(1), 0.0, 0.0, 1.0, 1.0),
        (2, False, at_second(1), 0.0, 0.0, 1.0, 1.0),
        (1000, True, at_second(1), 0.0, 0.0, 1.0, 1.0),
        (4, True, at_second(1), 0.0, 0.0, 1.5, 1.0),
    ])
    player.advance()
    assert [r.ride_id for r in player.results().collect()] == [1]


def test_interval_joins(spark, tmp_path):
    rides = [(1, at_second(100), 1), (2, at_second(100), 2), (4, at_second(9000), 4)]
    fares = [(1, at_second(130), 11), (2, at_second(131), 12), (3, at_second(5), 13), (4, at_second(9010), 14)]
    for name, build, expected in (
        ("pairs", rides_fares_within_stream, [(1, 11), (4, 14)]),
        ("lone", unmatched_fares_within_stream, [12, 13]),
    ):
        player = Player(
            spark, tmp_path / name, lambda rides, fares: build(rides, fares, 30),
            {"rides": RECORD, "fares": RECORD},
        )
        player.land("rides", rides)
        player.land("fares", fares)
        player.advance()
        rows = player.results().collect()
        found = sorted((r.ride.no, r.fare.no) for r in rows) if name == "pairs" else sorted(r.no for r in rows)
        assert found == expected


def test_dropped_rows_are_kept_by_batch(spark, tmp_path):
    fare = "ride_id long, driver_id long, event_time timestamp, tip double"
    player = Player(spark, tmp_path, hourly_tips_max, {"fares": fare})
    hour = 3600
    files = [
        [(1, 7, at_second(10), 1.0), (2, 7, at_second(3 * hour), 1.0)],
        # Behind the watermark: driver 7 twice in one hour, driver 8 in two hours; driver 9 comes in time.
        [(3, 7, at_second(20), 9.0), (4, 7, at_second(30), 9.0), (5, 8, at_second(40), 9.0), (6, 8, at_second(hour + 5), 9.0), (7, 9, at_second(3 * hour + 9), 1.0)],
        [(8, 9, at_second(9 * hour), 1.0)],
    ]
    with counting_dropped(spark, f"{tmp_path}/dropped") as listener:
        for rows in files:
            player.land("fares", rows)
            stream = read_stream(spark, f"{tmp_path}/in/fares", FARE)
            query = start_sink(hourly_tips_max(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint", until_caught_up=True)
            listener.await_counts(query)
    kept = read_dropped(spark, f"{tmp_path}/dropped")
    assert kept.select("query").distinct().count() == 1
    batches = kept.groupBy("batch").agg({"input_rows": "max", "dropped": "sum"}).orderBy("batch").collect()
    assert [tuple(r)[1:] in ((2, 0), (5, 3), (1, 0)) for r in batches] == [True] * 3
    assert sum(r["sum(dropped)"] for r in batches) == 3


def test_runs_that_catch_up_keep_snapshots_and_can_go_on_for_ever(spark, tmp_path):
    player = Player(
        spark, tmp_path, lambda rides, fares: rides_fares_within_stream(rides, fares, 100), {"rides": RECORD, "fares": RECORD}
    )
    for step in range(3):
        player.land("rides", [(n, at_second(50 * n), n) for n in range(20 * step, 20 * step + 20)])
        player.land("fares", [(n, at_second(50 * n + 60), n) for n in range(20 * step - 1, 20 * step + 19) if n >= 0])
        player.advance()
    kept = [f for _, _, files in os.walk(f"{tmp_path}/checkpoint/state") for f in files if not f.startswith(".")]
    # Nothing for the next run to replay, and one store a partition.
    assert any(f.endswith(".zip") for f in kept) and not any(f.endswith(".changelog") for f in kept)
    assert not any("keyWithIndex" in d for _, folders, _ in os.walk(f"{tmp_path}/checkpoint/state") for d in folders)
    streams = {n: read_stream(spark, f"{tmp_path}/in/{n}", player.results().select("ride.*").schema) for n in player.schemas}
    query = start_sink(player.build(**streams), f"{tmp_path}/out", f"{tmp_path}/checkpoint", interval="0 seconds")
    try:
        player.land("fares", [(59, at_second(3010), 59)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.ride.no for r in player.results().collect()) == list(range(60))


def test_fares_left_over_across_runs_that_catch_up(spark, tmp_path):
    player = Player(
        spark, tmp_path, lambda rides, fares: unmatched_fares_within_stream(rides, fares, 100), {"rides": RECORD, "fares": RECORD}
    )
    # Even ids have a ride, the last of each run one run later than its fare.
    for step in range(3):
        player.land("rides", [(n, at_second(50 * n + 20), n) for n in range(20 * step - 2, 20 * step + 18, 2) if n >= 0])
        player.land("fares", [(n, at_second(50 * n), n) for n in range(20 * step, 20 * step + 20)])
        player.advance()
    player.land("rides", [(58, at_second(2920), 58), (1000, at_second(100_000), 1000)])
    player.land("fares", [(1001, at_second(100_000), 1001)])
    player.advance()
    assert sorted(r.no for r in player.results().collect()) == list(range(1, 60, 2))
    kept = [f for _, _, files in os.walk(f"{tmp_path}/checkpoint/state") for f in files if not f.startswith(".")]
    assert any(f.endswith(".zip") for f in kept) and not any(f.endswith(".changelog") for f in kept)
