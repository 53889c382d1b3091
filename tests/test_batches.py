"""Pairing by micro-batches as tables, against the sequential model."""

import os

import pytest

from tests.models import replay_pairing
from tests.streams import land_events, pairing_player
from tests.test_pairing import in_order, random_events
from tripstream.operators import pairing
from tripstream.streaming import batches
from tripstream.streaming.sinks import start_batches


def played(spark, folder, files, min_rows=50, write=None):
    """Lands files one by one, each taken in by a query started on the same store; the layout of events."""
    player = pairing_player(spark, folder, pairing.tagged)
    store = f"{folder}/store"

    def start(events, store, checkpoint, **sink):
        if write is None:
            return batches.start_store(events, store, checkpoint, min_rows, **sink)
        return start_batches(events, write, checkpoint, **sink)

    for rows in files:
        if rows or not os.path.exists(f"{folder}/in"):
            land_events(player, rows)
        streams = {n: spark.readStream.schema(spark.createDataFrame([], s).schema).parquet(f"{folder}/in/{n}") for n, s in player.schemas.items()}
        events = pairing.tagged(**streams)
        start(events, store, f"{folder}/checkpoint", until_caught_up=True).awaitTermination()
    return store, events.schema


def found_in(spark, store, layout, before=None):
    pairs = sorted((r.ride_id, r.ride.no, r.fare.no) for r in batches.read_pairs(spark, store, layout).collect())
    waiting = {r.ride_id: (r.ride is not None, (r.ride or r.fare).no) for r in batches.read_states(spark, store, layout, before).collect()}
    return pairs, waiting


def cut(events, parts):
    """Files in which some events come after later ones: arrival goes by file first."""
    size = len(events) // parts + 1
    return [events[i : i + size] for i in range(0, len(events), size)]


@pytest.mark.parametrize("every", [2, 20])
def test_a_hot_id_in_batches_matches_the_model(spark, tmp_path, monkeypatch, every):
    monkeypatch.setattr(batches, "SNAPSHOT_EVERY", every)
    files = cut(random_events(11, 1500, 40, 1 / 3, 90), 5)
    history = [e for rows in files for e in in_order(rows)]
    store, layout = played(spark, tmp_path, files)
    pairs, waiting, _ = replay_pairing(history)
    assert found_in(spark, store, layout) == (sorted(pairs), waiting)
    # Past states can be read, too.
    earlier = replay_pairing([e for rows in files[:3] for e in in_order(rows)])[1]
    assert found_in(spark, store, layout, before=3)[1] == earlier


def test_a_batch_that_is_repeated_leaves_its_rows_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "SNAPSHOT_EVERY", 2)
    files = cut(random_events(12, 600, 30, 1 / 3, 60), 3)
    done = []

    def twice(events, number):
        batches.settle_batch(events, number, f"{tmp_path}/store", 40)
        done.append(number)
        if done.count(number) == 1 and number:
            raise RuntimeError("fails after its rows are written")

    for rows in [[*files[:1]], [files[1]], [], [files[2]], []]:
        try:
            store, layout = played(spark, tmp_path, rows or [[]], write=twice)
        except Exception as error:
            assert "fails after" in str(error)
    assert done == [0, 1, 1, 2, 2]
    layout = pairing.tagged(*(spark.read.parquet(f"{tmp_path}/in/{n}") for n in ("rides", "fares"))).schema
    pairs, waiting, _ = replay_pairing([e for rows in files for e in in_order(rows)])
    assert found_in(spark, f"{tmp_path}/store", layout) == (sorted(pairs), waiting)


def test_nothing_landed(spark, tmp_path):
    store, layout = played(spark, tmp_path, [[]])
    assert found_in(spark, store, layout) == ([], {})
