import os
import random

import pytest

from pyspark.sql import Row

from tests.models import replay_expiry, replay_pairing
from tests.streams import Player, T0, at_second, land_events, outcomes, pairing_player
from tests.test_pairing import frames, in_order, random_events
from tripstream.operators import pairing
from tripstream.operators.enrichment import side_output
from tripstream.sources import read_stream
from tripstream.streaming.sinks import FASTEST, SLOWEST, read_timers, read_waiting, start_tagged_sinks
from tripstream.streaming import stateful
from tripstream.streaming.stateful import enrichment_stream, rides_fares_stream

S = 1_000_000


def timed_files(seed, files, rows, keys, span):
    """Files of shuffled events; each file's times follow the previous file's."""
    draw = random.Random(seed)
    return [
        [(draw.randrange(keys), k * span + draw.randrange(span), draw.random() < 0.5, k * rows + n)
         for n in range(rows)]
        for k in range(files)
    ]


def test_pairs_and_waiting_records_match_the_model(spark, tmp_path):
    files = timed_files(5, 3, 150, 25, 100 * S)
    ordered = [e for f in files for e in sorted(f, key=lambda e: (e[1], not e[2], e[3]))]
    pairs, waiting, _ = replay_pairing(ordered)
    player = pairing_player(spark, tmp_path, rides_fares_stream, max_delay=None)
    for rows in files:
        land_events(player, rows)
        player.advance()
    found = [(r.ride_id, r.ride.no, r.fare.no) for r in player.results().collect()]
    assert sorted(found) == sorted(pairs)
    # Records come back as they went in, to the microsecond.
    at = {e[3]: e[1] for e in ordered}
    fare_times = player.results().selectExpr("fare.no", "unix_micros(fare.event_time) % 86400000000 AS us")
    assert all(r.us == at[r.no] for r in fare_times.collect())
    kept = read_waiting(spark, f"{tmp_path}/checkpoint").collect()
    assert {r.ride_id: (r.ride is not None, (r.ride or r.fare).no) for r in kept} == waiting


def test_one_run_over_all_files_equals_restarts_between_them(spark, tmp_path):
    files = timed_files(6, 3, 60, 12, 100 * S)
    found = []
    for folder, restart in (("whole", False), ("restarted", True)):
        player = pairing_player(spark, tmp_path / folder, rides_fares_stream, max_delay=None)
        for rows in files:
            land_events(player, rows)
            if restart:
                player.advance()
        if not restart:
            player.advance(max_files=1)
            assert sum(p["numInputRows"] > 0 for p in player.progress) == 3
        found.append(sorted((r.ride.no, r.fare.no) for r in player.results().collect()))
    assert found[0] == found[1] and found[0]


def test_time_to_live_keeps_fresh_records(spark, tmp_path):
    player = pairing_player(
        spark, tmp_path, lambda rides, fares: rides_fares_stream(rides, fares, ttl_ms=3_600_000),
        max_delay=None, idle_batches=False,
    )
    land_events(player, [(1, 1 * S, True, 1), (2, 1 * S, True, 2)])
    player.advance()
    land_events(player, [(1, 2 * S, False, 3)])
    player.advance()
    assert [(r.ride.no, r.fare.no) for r in player.results().collect()] == [(1, 3)]


def seconds(*rows):
    return [(k, round(t * S), kind == "R", n) for k, kind, t, n in rows]


EXPIRY = [
    seconds((1, "R", 1, 1), (2, "F", 2, 2), (5, "F", 10, 3), (5, "F", 20, 4)),
    seconds((1, "F", 1.5, 5), (3, "R", 100, 6)),
    seconds((2, "R", 2.5, 7), (9, "R", 300, 8)),
    seconds((9, "F", 300, 9), (8, "R", 900, 10)),
]


def test_expiry_small_case_and_side_outputs(spark, tmp_path):
    player = pairing_player(spark, tmp_path, enrichment_stream, partition_by="outcome")
    for rows in EXPIRY:
        land_events(player, rows)
        player.advance()
    found = outcomes(player.results())
    assert found == sorted(
        [
            ("matched", 1, 1, 5), ("matched", 2, 7, 2), ("matched", 9, 8, 9),
            ("unmatched_fare", 5, None, 4), ("unmatched_ride", 3, 6, None),
        ],
        key=repr,
    )
    assert found == sorted(replay_expiry(EXPIRY, 60_000)[0], key=repr)
    lone = side_output(player.results(), "unmatched_fare")
    assert [r.fare.no for r in lone.collect()] == [4]
    assert "PartitionFilters: [isnotnull(outcome" in lone._jdf.queryExecution().toString()


@pytest.mark.parametrize("on_duplicate", ["replace", "emit"])
def test_random_expiry_matches_the_model(spark, tmp_path, on_duplicate):
    files = timed_files(7, 3, 120, 30, 150 * S)
    expected, waiting = replay_expiry(files, 60_000, on_duplicate == "emit")
    player = pairing_player(
        spark, tmp_path, lambda rides, fares: enrichment_stream(rides, fares, on_duplicate)
    )
    for rows in files:
        land_events(player, rows)
        player.advance()
    assert outcomes(player.results()) == sorted(expected, key=repr)
    tags = {o[0] for o in expected}
    assert tags == {"matched", "unmatched_ride", "unmatched_fare"} and waiting


@pytest.mark.parametrize("on_duplicate", ["replace", "emit"])
def test_late_records_match_the_model(spark, tmp_path, on_duplicate):
    files = timed_files(17, 4, 90, 25, 150 * S)
    for k in range(3):  # every eighth record of a file comes with the next one, far behind the watermark
        late = files[k][::8]
        files[k] = [e for e in files[k] if e not in late]
        files[k + 1] = files[k + 1] + late
    expected, _ = replay_expiry(files, 60_000, on_duplicate == "emit")
    player = pairing_player(
        spark, tmp_path, lambda rides, fares: enrichment_stream(rides, fares, on_duplicate)
    )
    for rows in files:
        land_events(player, rows)
        player.advance()
    assert outcomes(player.results()) == sorted(expected, key=repr)
    dropped = [s["numRowsDroppedByWatermark"] for p in player.progress for s in p["stateOperators"]]
    assert sum(dropped) == 0


def test_records_without_id_or_time_are_unmatched_at_once(spark, tmp_path):
    player = pairing_player(spark, tmp_path, enrichment_stream)
    player.land("rides", [(None, at_second(1), 1), (4, None, 2), (5, at_second(9), 3)])
    player.land("fares", [(None, at_second(1), 11), (5, at_second(10), 13)])
    player.advance()
    assert outcomes(player.results()) == sorted(
        [("unmatched_ride", None, 1, None), ("unmatched_ride", 4, 2, None), ("unmatched_fare", None, None, 11), ("matched", 5, 3, 13)],
        key=repr,
    )


def test_ties_are_ordered_as_on_tables(spark):
    values = [None, float("nan"), 2.0, -1.0, float("inf")]
    table = spark.createDataFrame([(v, (v,)) for v in values], "v double, s struct<x: double>")
    for column in ("v", "s"):
        rows = [r[0] for r in table.select(column).orderBy(column).collect()]
        assert repr(sorted(rows[::-1], key=stateful._spark_order)) == repr(rows)


def test_unknown_duplicate_rule(spark):
    with pytest.raises(ValueError):
        enrichment_stream(None, None, on_duplicate="drop")


def test_large_groups_are_sorted_outside_memory(monkeypatch):
    draw = random.Random(8)
    rows = [
        Row(at=draw.randrange(500), is_ride=kind, ride=Row(no=n) if kind else None,
            fare=None if kind else Row(no=n))
        for n, kind in ((n, draw.random() < 0.5) for n in range(25_000))
    ]
    monkeypatch.setattr(stateful, "_SORT_MEMORY", 1)
    assert list(stateful._in_order(iter(rows))) == sorted(rows, key=stateful._arrival)
    assert list(stateful._in_order(iter(rows[:99]))) == sorted(rows[:99], key=stateful._arrival)


def test_timers_and_past_states_can_be_read(spark, tmp_path):
    player = pairing_player(spark, tmp_path, enrichment_stream)
    land_events(player, [(1, 10_000_000, False, 1), (1, 20_000_000, False, 2), (2, 15_000_000, True, 3), (3, 900_000_000, True, 4)])
    player.advance()
    land_events(player, [(2, 16_000_000, False, 5), (4, 30_000_000, False, 6)])
    player.advance()
    checkpoint = f"{player.folder}/checkpoint"

    def timers(batch=None):
        return sorted((r.ride_id, r.due.timestamp()) for r in read_timers(spark, checkpoint, batch).collect())

    def held(batch=None):
        return sorted((r.ride_id, (r.ride or r.fare).no) for r in read_waiting(spark, checkpoint, batch).collect())

    # The fare that was replaced has left its timer behind; a match deletes its own.
    first = [(k, T0.timestamp() + s) for k, s in ((1, 10), (1, 20), (2, 15), (3, 900))]
    assert timers(0) == first and held(0) == [(1, 2), (2, 3), (3, 4)]
    assert timers() == sorted([t for t in first if t[0] != 2] + [(4, T0.timestamp() + 30)]) and held() == [(1, 2), (3, 4), (4, 6)]


@pytest.mark.parametrize(("moved_by", "expected"), [(SLOWEST, []), (FASTEST, [("unmatched_fare", 1, None, 1), ("unmatched_fare", 2, None, 2)])])
def test_the_fastest_input_can_move_time(spark, tmp_path, moved_by, expected):
    player = pairing_player(spark, tmp_path, enrichment_stream, time_moved_by=moved_by)
    land_events(player, [(9, 0, True, 0), (1, 1_000_000, False, 1)])
    player.advance()
    # Rides are silent from here on.
    land_events(player, [(2, 500_000_000, False, 2), (3, 900_000_000, False, 3)])
    player.advance()
    out = [o for o in outcomes(player.results()) if o[0] == "unmatched_fare"]
    assert out == expected


def test_a_stream_begun_from_a_tables_remainder_goes_on(spark, tmp_path):
    events = random_events(21, 600, 40, 0.1, 500)
    early, late = (in_order([e for e in events if (e[1] < 250) == first]) for first in (True, False))
    done = pairing.settled(*frames(spark, early))
    waiting = pairing.waiting_of(done)
    player = pairing_player(spark, tmp_path, lambda rides, fares: rides_fares_stream(rides, fares, begun=waiting), max_delay=None)
    for part in (late[:200], late[200:]):  # the second start goes on from the checkpoint
        land_events(player, part)
        player.advance()
    pairs, rest, _ = replay_pairing(early + late)
    got = [(r.ride_id, r.ride.no, r.fare.no) for df in (pairing.pairs_of(done), player.results()) for r in df.collect()]
    assert sorted(got) == sorted(pairs)
    assert {r.ride_id: (r.ride is not None, (r.ride or r.fare).no) for r in read_waiting(spark, f"{player.folder}/checkpoint").collect()} == rest


def test_tags_go_to_tables_of_their_own_once(spark, tmp_path):
    tags = {t: f"{tmp_path}/{t}" for t in ("unmatched_fare", "unmatched_ride")}
    player = pairing_player(spark, tmp_path, enrichment_stream)
    land_events(player, [(1, 10_000_000, False, 1), (2, 15_000_000, True, 3), (3, 900_000_000, True, 4), (3, 900_000_000, False, 5)])
    streams = {n: read_stream(spark, f"{player.folder}/in/{n}", spark.createDataFrame([], s).schema) for n, s in player.schemas.items()}
    fails = iter([True])

    class Failing(dict):
        def items(self):  # the second table's write of the first batch with rows fails once
            for n, (value, path) in enumerate(super().items()):
                if n and os.path.exists(f"{tags['unmatched_fare']}/batch=1") and next(fails, False):
                    raise RuntimeError("fails between two tables")
                yield value, path

    for paths in (Failing(tags), tags):
        query = start_tagged_sinks(enrichment_stream(**streams), "outcome", paths, f"{tmp_path}/tagged", until_caught_up=True)
        try:
            query.awaitTermination()
            assert paths is tags
        except Exception as error:
            assert "between two tables" in str(error)
    for tag, expected in (("unmatched_fare", [(1, None, 1)]), ("unmatched_ride", [(2, 3, None)])):
        rows = spark.read.parquet(tags[tag]).collect()
        assert [(r.ride_id, r.ride and r.ride.no, r.fare and r.fare.no) for r in rows] == expected


WIDER = "ride_id long, event_time timestamp, no long, note string, more array<int>"


@pytest.mark.parametrize("build", [rides_fares_stream, enrichment_stream])
def test_a_deployment_with_wider_records_goes_on_from_the_checkpoint(spark, tmp_path, build):
    early = seconds((1, "R", 1, 1), (2, "R", 200, 2), (3, "F", 300, 3), (6, "F", 310, 4))
    player = pairing_player(spark, tmp_path, build, wider_layouts=True)
    land_events(player, early)
    player.advance()
    wider = Player(spark, tmp_path, build, {**player.schemas, "fares": WIDER}, wider_layouts=True)
    wider.land("rides", [(3, at_second(301), 5)])
    wider.land("fares", [(2, at_second(302), 6, "new", [7]), (5, at_second(303), 7, "waits", None)])
    wider.advance()
    layout = f"ride_id long, ride struct<{player.schemas['rides'].replace(' ', ':').replace(',:', ',')}>, fare struct<{WIDER.replace(' ', ':').replace(',:', ',')}>"
    found = spark.read.schema(layout).parquet(f"{tmp_path}/out")
    pairs = sorted((r.ride_id, r.ride.no, r.fare.no, r.fare.note, r.fare.more) for r in found.collect() if r.ride and r.fare)
    assert pairs == [(2, 2, 6, "new", [7]), (3, 5, 3, None, None)]
    held = {r.ride_id: r.fare and tuple(r.fare)[2:] for r in read_waiting(spark, f"{tmp_path}/checkpoint").collect()}
    assert held[5] == (7, "waits", None) and held[6] == (4, None, None)
    if build is enrichment_stream:
        timers = [(r.ride_id, r.due.timestamp() - T0.timestamp()) for r in read_timers(spark, f"{tmp_path}/checkpoint").collect()]
        assert sorted(timers) == [(5, 303), (6, 310)]


def test_wider_records_need_the_state_kept_by_name(spark, tmp_path):
    player = pairing_player(spark, tmp_path, rides_fares_stream)
    land_events(player, seconds((1, "R", 1, 1)))
    player.advance()
    wider = Player(spark, tmp_path, rides_fares_stream, {**player.schemas, "fares": WIDER})
    wider.land("fares", [(1, at_second(2), 2, "new", None)])
    with pytest.raises(Exception, match="STATE_STORE_VALUE_SCHEMA_NOT_COMPATIBLE"):
        wider.advance()


def test_state_kept_by_name_gives_the_same_rows(spark, tmp_path):
    files = timed_files(31, 3, 80, 20, 150 * S)
    expected, _ = replay_expiry(files, 60_000)
    player = pairing_player(spark, tmp_path, enrichment_stream, wider_layouts=True)
    for rows in files:
        land_events(player, rows)
        player.advance()
    assert outcomes(player.results()) == sorted(expected, key=repr)


@pytest.mark.parametrize("buckets", [1, 64])
def test_ids_that_share_a_bucket_keep_their_records_and_timers(spark, tmp_path, monkeypatch, buckets):
    files = timed_files(41, 4, 120, 60, 150 * S)
    expected, waiting = replay_expiry(files, 60_000)
    player = pairing_player(spark, tmp_path, lambda rides, fares: enrichment_stream(rides, fares, buckets=buckets))
    for rows in files:
        land_events(player, rows)
        player.advance()
    assert outcomes(player.results()) == sorted(expected, key=repr)
    # What lies in state while others of its bucket are written comes back as it went in, to the microsecond.
    at = {e[3]: e[1] for rows in files for e in rows}
    found = [r for side in ("ride", "fare") for r in player.results().selectExpr(f"{side}.no", f"unix_micros({side}.event_time) % 86400000000 AS us").collect() if r.no is not None]
    assert found and all(r.us == at[r.no] for r in found)


class _Calls:
    """Stands in for the store and counts the calls to it."""

    def __init__(self):
        self.calls, self.rows, self.timers = 0, [], set()

    def __getattr__(self, name):
        def call(*arguments):
            self.calls += 1
            if name == "getListState":
                return self
            if name == "get":
                return iter(self.rows)
            if name in ("put", "appendList"):
                self.rows = [*(self.rows if name == "appendList" else []), *arguments[0]]
            elif name == "clear":
                self.rows = []
            else:
                {"registerTimer": self.timers.add, "deleteTimer": self.timers.discard}[name](*arguments)

        return call


def test_calls_to_the_store_do_not_grow_with_ids_and_records():
    store = _Calls()
    processor = stateful.ExpiringProcessor(None, "replace")
    processor.init(store)
    rows = [Row(ride_id=n % 500, at=n * S, is_ride=n % 3 == 0, ride=None, fare=None) for n in range(5000)]
    out = list(processor.handleInputRows((0,), iter(rows), None))
    assert out and len(store.rows) == 500 and store.calls <= 5
    assert store.timers == {min(due for row in store.rows for due in row[5])}
