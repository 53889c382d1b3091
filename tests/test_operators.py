"""Filters, tips, enrichment and registries on small tables."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.streams import at_second
from tripstream.functions import Box
from tripstream.operators import enrichment, filters, registry, tips
from tripstream.schemas import STATION
from tripstream.sources import read_stations, write_stations


def test_ride_cleansing(spark):
    box = Box(west=-1.0, south=-2.0, east=1.0, north=2.0)
    inside, outside = (0.0, 0.0), (5.0, 0.0)
    cases = [
        (1, True, inside, inside, True),
        (2, False, inside, inside, True),
        (3, True, inside, outside, False),
        (4, True, outside, inside, False),
        (5, True, (-1.0, -2.0), (1.0, 2.0), True),
        (6, True, (-1.0, 2.0), (1.0, -2.0), True),
        (7, True, (None, 0.0), inside, False),
        (8, True, inside, (0.0, None), False),
        (9, True, inside, (0.0, 2.0000001), False),
    ]
    rows = [(i, s, *a, *b) for i, s, a, b, _ in cases]
    rides = spark.createDataFrame(
        rows, "ride_id long, is_start boolean, start_lon double, start_lat double, end_lon double, end_lat double"
    )
    kept = {r.ride_id for r in filters.ride_cleansing(rides, box).collect()}
    assert kept == {c[0] for c in cases if c[4]}


def test_sampled_starts(spark):
    rows = [(i, s) for i in (0, 999, 1000, 1001, -1000) for s in (True, False)]
    rides = spark.createDataFrame(rows + [(5, None)], "ride_id long, is_start boolean")
    assert sorted(r.ride_id for r in filters.ride_starts(rides).collect()) == [-1000, 0, 999, 1000, 1001]
    assert sorted(r.ride_id for r in filters.ride_starts_sampled(rides).collect()) == [999, 1001]


def test_tips(spark):
    fares = spark.createDataFrame(
        [(4, at_second(0), 1.0), (3, at_second(3599), 1.0), (3, at_second(3600), 0.25),
         (-(2**63), at_second(3601), 0.25), (9, at_second(3 * 3600), 7.0)],
        "driver_id long, event_time timestamp, tip double",
    )
    assert tips.tips_per_driver_hour(fares).count() == 5
    best = tips.hourly_tips_max(fares).orderBy("window_end").collect()
    assert [(r.driver_id, r.total_tips) for r in best] == [(3, 1.0), (-(2**63), 0.25), (9, 7.0)]
    hours = [r.h for r in tips.hourly_tips_max(fares).selectExpr("hour(window_end) AS h").collect()]
    assert sorted(hours) == [1, 2, 4]


def records(spark, rows):
    return spark.createDataFrame(rows, "ride_id long, event_time timestamp, no long")


def test_outcomes_keep_every_record(spark):
    rides = records(spark, [(1, at_second(1), 1), (2, at_second(2), 2), (None, at_second(3), 3)])
    fares = records(spark, [(1, at_second(1), 11), (4, at_second(2), 14), (None, at_second(3), 13)])
    found = enrichment.enrichment_outcomes(rides, fares)
    rows = {(r.outcome, r.ride_id, r.ride and r.ride.no, r.fare and r.fare.no) for r in found.collect()}
    assert rows == {
        ("matched", 1, 1, 11), ("unmatched_ride", 2, 2, None), ("unmatched_ride", None, 3, None),
        ("unmatched_fare", 4, None, 14), ("unmatched_fare", None, None, 13),
    }
    lone = enrichment.side_output(found, "unmatched_fare").select("fare.no").collect()
    anti = enrichment.unmatched_fares(rides, fares).select("no").collect()
    assert sorted(lone) == sorted(anti)
    assert sorted(r.no for r in enrichment.unmatched_rides(rides, fares).collect()) == [2, 3]


@pytest.mark.parametrize("bound", [1, 7, 1000])
def test_unmatched_within_on_repeating_ids(spark, bound):
    draw = random.Random(bound)

    def drawn(n):
        return [(0 if draw.random() < 0.4 else draw.randrange(20), at_second(draw.randrange(-400, 400)), i)
                for i in range(n)]

    rides, fares = drawn(60), drawn(200)
    fares += [(None, at_second(0), 1000), (0, None, 1001)]
    expected = {
        no for k, t, no in fares
        if k is None or t is None
        or not any(k == rk and abs((t - rt).total_seconds()) <= bound for rk, rt, _ in rides)
    }
    found = enrichment.unmatched_fares_within(records(spark, rides), records(spark, fares), bound)
    assert found.columns == ["ride_id", "event_time", "no"]
    assert {r.no for r in found.collect()} == expected


STATIONS = [
    (2, "A (x/y, @z)", 37.329732, -121.90178200000001, 27, "P", date(2013, 8, 6)),
    (51, 'B "q"', 1.0, 2.0, 11, "Q", date(2013, 12, 31)),
    (39, "C", 1.5, 2.5, 15, "Q", date(2014, 1, 1)),
]


def test_station_files_with_either_line_end(spark, tmp_path):
    table = spark.createDataFrame(STATIONS, STATION)
    write_stations(table.coalesce(1), f"{tmp_path}/lf")
    (text,) = [p.read_text() for p in (tmp_path / "lf").glob("part-*.csv")]
    assert "8/6/2013" in text and "12/31/2013" in text
    (tmp_path / "crlf.csv").write_bytes(text.replace("\n", "\r\n").encode())
    lf, crlf = read_stations(spark, f"{tmp_path}/lf"), read_stations(spark, f"{tmp_path}/crlf.csv")
    assert sorted(lf.collect()) == sorted(table.collect())
    assert registry.registry_intersect(lf, crlf).count() == 3
    assert registry.registry_except(lf, crlf).count() == 0


def test_bad_station_date_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(STATION.fieldNames()) + "\n1,a,1.0,2.0,11,P,2013-08-06\n")
    with pytest.raises(Exception, match="2013-08-06|MALFORMED|FAILFAST"):
        read_stations(spark, str(path)).collect()


def test_station_header_and_bad_rows_are_checked_when_pruned(spark, tmp_path):
    names = STATION.fieldNames()
    (tmp_path / "swapped.csv").write_text(",".join([*names[:2], "long", "lat", *names[4:]]) + "\n1,a,1.0,2.0,11,P,8/6/2013\n")
    with pytest.raises(Exception, match="header|FAILED_READ_FILE|swapped.csv"):
        read_stations(spark, f"{tmp_path}/swapped.csv").collect()
    (tmp_path / "bad.csv").write_text(",".join(names) + "\n1,a,1.0,2.0,11,P,2013-08-06\n")
    with pytest.raises(Exception, match="2013-08-06|MALFORMED|FAILFAST"):
        read_stations(spark, f"{tmp_path}/bad.csv").select("id").collect()


def test_totals_do_not_depend_on_order(spark):
    rows = [(1, at_second(n), v) for n, v in enumerate([0.1, 0.2, 0.3, 1e15, -1e15, 0.00005])]
    rows += [(2, at_second(9), float("nan")), (2, at_second(9), 1.0)]
    schema = "driver_id long, event_time timestamp, tip double"
    for drawn in (rows, rows[::-1], rows[3:] + rows[:3]):
        found = tips.tips_per_driver_hour(spark.createDataFrame(drawn, schema).repartition(4))
        assert sorted((r.driver_id, r.total_tips) for r in found.collect()) == [(1, 0.6001), (2, 1.0)]


def test_unmatched_within_zero_and_negative_bounds(spark):
    rides = records(spark, [(1, at_second(5), 1)])
    fares = records(spark, [(1, at_second(5), 11), (1, at_second(6), 12)])
    assert [r.no for r in enrichment.unmatched_fares_within(rides, fares, 0).collect()] == [12]
    with pytest.raises(ValueError):
        enrichment.unmatched_fares_within(rides, fares, -1)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_set_operations_match_sparks_own(spark, monkeypatch):
    draw = random.Random(3)

    def drawn(n):
        return spark.createDataFrame(
            [(draw.choice([None, 1, 2, 3, 4]), draw.choice([None, "x", "y"])) for _ in range(n)],
            "id int, name string",
        )

    left, right = drawn(40), drawn(8)
    assert bag(registry.registry_union_all(left, right)) == bag(left.unionAll(right))
    assert bag(registry.registry_union(left, right)) == bag(left.union(right).distinct())
    assert bag(registry.registry_intersect(left, right)) == bag(left.intersect(right))
    assert bag(registry.registry_except(left, right)) == bag(left.subtract(right))
    assert bag(registry.registry_except_all(left, right)) == bag(left.exceptAll(right))
    monkeypatch.setattr(registry, "_CHUNK", 2)
    assert bag(registry.registry_except_all(left, right)) == bag(left.exceptAll(right))


def test_renumbered(spark):
    old = spark.createDataFrame(
        [(1, "a", None), (2, "b", 1.0), (3, "b", 1.0), (4, "c", 2.0)], "id int, name string, lat double"
    )
    new = spark.createDataFrame(
        [(91, "a", None), (2, "b", 1.0), (93, "b", 1.0), (4, "c", 2.0), (95, "d", 2.0)],
        "id int, name string, lat double",
    )
    assert bag(registry.registry_renumbered(old, new)) == [(1, 91), (2, 93), (3, 2)]


AWKWARD = ("ride_id long, event_time timestamp, aside long, bucket long, at long, record string, known_id long, near string, fare string,"
           " near_id long, __aside long, fare_at long, fare_bucket long, tags map<string,array<map<int,double>>>")


def awkward(spark, ids, **tags):
    rows = [(i, None if i == 7 else at_second(n), 5, 6, 7, "r", 8, "n", "f", 9, 1, 2, 3, {"a": [{n: 1.0}]}) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, AWKWARD)


def test_joins_bear_maps_and_every_name(spark):
    rides, fares = awkward(spark, [1, 2, None, None, 5]), awkward(spark, [1, 3, None, 7, 5])
    found = {(r.outcome, r.ride_id) for r in enrichment.enrichment_outcomes(rides, fares).collect()}
    assert found == {("matched", 1), ("matched", 5), ("unmatched_ride", 2), ("unmatched_ride", None), ("unmatched_fare", 3), ("unmatched_fare", None), ("unmatched_fare", 7)}
    for left, lone in ((enrichment.unmatched_fares(rides, fares), fares), (enrichment.unmatched_fares_within(rides, fares, 10), fares), (enrichment.unmatched_rides(rides, fares), rides)):
        assert left.schema == lone.schema
        expected = [r for r in lone.collect() if r.ride_id not in (1, 5)]
        assert sorted(left.collect(), key=repr) == sorted(expected, key=repr)
