import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.models import replay_pairing
from tripstream.operators import pairing
from tripstream.plans import HotKeys, find_hot_keys

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def frames(spark, events):
    """(key, at, is_ride, id) -> rides, fares."""
    rows = [(k, T0 + timedelta(microseconds=at), r, i) for k, at, r, i in events]
    df = spark.createDataFrame(rows, "ride_id long, event_time timestamp, is_ride boolean, no long")
    df = df.repartition(5, "no")
    return df.filter("is_ride").drop("is_ride"), df.filter("NOT is_ride").drop("is_ride")


def in_order(events):
    return sorted(events, key=lambda e: (e[1], not e[2], e[3]))


def got(pairs, waiting):
    found = [(r.ride_id, r.ride.no, r.fare.no) for r in pairs.collect()]
    rest = {r.ride_id: (r.ride is not None, (r.ride or r.fare).no) for r in waiting.collect()}
    return sorted(found), rest


CASES = {
    "RF": ([(0, 1)], None),
    "FR": ([(1, 0)], None),
    "RRF": ([(1, 2)], None),
    "RFF": ([(0, 1)], 2),
    "RFRF": ([(0, 1), (2, 3)], None),
    "FFRR": ([(2, 1)], 3),
}


def test_small_histories(spark):
    ids = {key: history for key, history in enumerate(CASES)}
    rides, fares = frames(
        spark, [(k, n, kind == "R", n) for k, h in ids.items() for n, kind in enumerate(h)]
    )
    found, rest = got(
        pairing.rides_fares_pairs(rides, fares), pairing.rides_fares_waiting(rides, fares)
    )
    assert found == sorted((k, *pair) for k, h in ids.items() for pair in CASES[h][0])
    assert {k: no for k, (_, no) in rest.items()} == {
        k: CASES[h][1] for k, h in ids.items() if CASES[h][1] is not None
    }


def random_events(seed, rows, keys, hot_share, instants):
    """Shuffled events; `hot_share` of them on key 0; few instants make many ties."""
    draw = random.Random(seed)
    return [
        (0 if draw.random() < hot_share else draw.randrange(1, keys),
         draw.randrange(instants), draw.random() < 0.5, n)
        for n in range(rows)
    ]


@pytest.mark.parametrize("seed,instants", [(1, 100_000), (2, 40), (3, 1)])
def test_random_histories_with_a_hot_id(spark, seed, instants):
    events = random_events(seed, 3000, 60, 1 / 3, instants)
    pairs, waiting, lost = replay_pairing(in_order(events))
    rides, fares = frames(spark, events)

    hot = find_hot_keys(pairing.tagged(rides, fares), "ride_id", min_rows=100)
    assert hot.keys == [0]
    for chosen in (hot, HotKeys([], 0, 1), HotKeys([0, 1, 2, 3], 1200, 30)):
        found, rest = got(
            pairing.rides_fares_pairs(rides, fares, chosen),
            pairing.rides_fares_waiting(rides, fares, chosen),
        )
        assert found == sorted(pairs)
        assert rest == waiting
    assert 2 * len(pairs) + len(waiting) + len(lost) == len(events)


@pytest.mark.parametrize("limit", [23, 800])
def test_hot_ids_with_patterns_across_slices(spark, limit):
    patterns = ["RF", "R", "RRF", "FFRRRF"]
    events = [
        (k, n, p[n % len(p)] == "R", 1000 * k + n) for k, p in enumerate(patterns) for n in range(400)
    ]
    pairs, waiting, _ = replay_pairing(events)
    rides, fares = frames(spark, events)
    hot = HotKeys([0, 1, 2, 3], 1600, limit)
    found, rest = got(
        pairing.rides_fares_pairs(rides, fares, hot), pairing.rides_fares_waiting(rides, fares, hot)
    )
    assert found == sorted(pairs)
    assert rest == waiting


def test_many_copies_of_a_record_on_a_hot_id(spark):
    events = random_events(4, 200, 5, 0.5, 50)
    events += [(0, 25, True, 900)] * 300 + [(0, 25, False, 901)] * 200 + [(0, 40, False, 902)] * 2
    pairs, waiting, _ = replay_pairing(in_order(events))
    rides, fares = frames(spark, events)
    hot = HotKeys([0], 600, 60)
    found, rest = got(
        pairing.rides_fares_pairs(rides, fares, hot), pairing.rides_fares_waiting(rides, fares, hot)
    )
    assert found == sorted(pairs)
    assert rest == waiting


def test_a_hot_id_s_records_come_out_as_they_went_in(spark):
    draw = random.Random(12)
    rows = [(0, T0 + timedelta(seconds=n // 2), draw.choice([0.0, -0.0, float("nan")]), n) for n in range(200)]
    fares = spark.createDataFrame(rows, "ride_id long, event_time timestamp, tip double, no long")
    rides = fares.filter("no % 3 = 0").drop("tip")
    found = [
        sorted((r.ride.no, r.fare.no, str(r.fare.tip)) for r in pairing.rides_fares_pairs(rides, fares, hot).collect())
        for hot in (HotKeys([], 0, 1), HotKeys([0], 260, 40))
    ]
    assert found[0] == found[1] and any(tip == "-0.0" for _, _, tip in found[0])


def test_one_settling_gives_pairs_and_waiting_records(spark):
    rides, fares = frames(spark, random_events(21, 400, 9, 0.4, 80))
    events = pairing.settled(rides, fares, HotKeys([0], 160, 30))
    both = got(pairing.pairs_of(events), pairing.waiting_of(events))
    assert both == got(pairing.rides_fares_pairs(rides, fares), pairing.rides_fares_waiting(rides, fares))


def test_records_without_id_or_time_pair_with_nothing(spark):
    rides, fares = frames(spark, [(None, 1, True, 1), (None, 2, False, 2), (4, 3, True, 3)])
    fares = fares.unionByName(
        spark.range(1).select(
            F.lit(4).cast("long").alias("ride_id"), F.lit(None).cast("timestamp").alias("event_time"),
            F.lit(9).cast("long").alias("no"),
        )
    )
    assert pairing.rides_fares_pairs(rides, fares).count() == 0
    assert {r.is_ride: r["count"] for r in pairing.unplaced(rides, fares).groupBy("is_ride").count().collect()} == {True: 1, False: 2}
    assert [r.ride.no for r in pairing.rides_fares_waiting(rides, fares).collect()] == [3]


def test_hot_ids_need_many_rows(spark):
    df = spark.range(1000).select(F.lit(1).alias("ride_id"))
    assert find_hot_keys(df, "ride_id").keys == []
    assert find_hot_keys(df, "ride_id", min_rows=10).keys == [1]


def test_unique_ids_join_as_they_pair(spark):
    events = [(k, k * 10 + s, kind, 2 * k + s) for k in range(50) for s, kind in ((0, True), (1, False))]
    rides, fares = frames(spark, [e for e in events if e[3] % 7])
    joined = pairing.rides_fares_join(rides, fares)
    paired = pairing.rides_fares_pairs(rides, fares)
    assert sorted(joined.collect()) == sorted(paired.collect())


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_hot_records_that_differ_in_microseconds_stay_apart(spark, kind):
    rides = spark.range(3).select(
        F.lit(0).cast("long").alias("ride_id"), F.lit(T0).alias("event_time"),
        F.expr("timestamp_micros(1700000000000001 + id)").cast(kind).alias("started"),
    )
    fares = rides.where(F.col("started").cast("timestamp") == F.expr("timestamp_micros(1700000000000003)"))
    found = [
        [sorted(map(str, f(rides, fares, hot).collect())) for f in (pairing.rides_fares_pairs, pairing.rides_fares_waiting)]
        for hot in (HotKeys([], 0, 1), HotKeys([0], 4, 2))
    ]
    assert found[0] == found[1] and len(found[0][0]) == 1


def test_records_with_maps_are_ordered_by_their_entries(spark):
    kind = "ride_id long, event_time timestamp, tags map<string,array<map<int,string>>>, no long"
    rides = spark.createDataFrame([(1, T0, {"b": None, "a": [{1: "x"}]}, 1), (1, T0, {"a": [{1: "y"}], "b": None}, 2), (1, T0, None, 3)], kind)
    fares = spark.createDataFrame([(1, T0, {"c": []}, 4)], kind)
    for hot in (None, HotKeys([1], 4, 1)):
        found, rest = got(pairing.rides_fares_pairs(rides, fares, hot), pairing.rides_fares_waiting(rides, fares, hot))
        assert found == [(1, 2, 4)] and rest == {}
