"""Stored registries compared by their trees of digests."""

import random

import pytest
from pyspark.sql import functions as F

from tripstream.operators import digests, registry

KIND = "id int, row string, bucket double, copies array<int>"


def bag(frame):
    return sorted(map(repr, frame.collect()))


def stored(frame, path, buckets=20):
    digests.write_digested(frame, str(path), buckets)
    return str(path)


def test_equals_the_plain_difference_with_repeats_and_nulls(spark, tmp_path, monkeypatch):
    draw = random.Random(6)
    odd = [None, 0.0, -0.0, float("nan"), 1.5]

    def drawn(n):
        rows = [(draw.choice([None, 1, 2]), draw.choice([None, "x", "y"]), draw.choice(odd), draw.choice([None, [], [None, 1], [1, None]])) for _ in range(n)]
        return spark.createDataFrame(rows + [(7, "hot", 1.0, None)] * n, KIND)

    left, right = drawn(120), drawn(60)
    paths = stored(left, tmp_path / "left"), stored(right, tmp_path / "right")
    monkeypatch.setattr(registry, "_CHUNK", 9)
    for a, b, x, y in ((*paths, left, right), (*paths[::-1], right, left)):
        found = digests.except_all_stored(spark, a, b)
        assert bag(found) == bag(registry.registry_except_all(x, y)) and found.columns == left.columns
    assert digests.differing_buckets(spark, paths[0], stored(left.repartition(7), tmp_path / "again")) == []


def test_rows_that_swap_a_null_differ(spark, tmp_path):
    kind = "a string, b string, c array<string>"
    one = spark.createDataFrame([("x", None, [None, "z"])], kind)
    for n, row in enumerate([(None, "x", [None, "z"]), ("x", None, ["z", None])]):
        paths = stored(one, tmp_path / f"one{n}", 1), stored(spark.createDataFrame([row], kind), tmp_path / f"two{n}", 1)
        assert digests.differing_buckets(spark, *paths) == [0]
        assert bag(digests.except_all_stored(spark, *paths)) == bag(one)


def test_empty_sides_and_unlike_layouts(spark, tmp_path):
    some, none = spark.range(50).toDF("id"), spark.range(0).toDF("id")
    paths = stored(some, tmp_path / "some"), stored(none, tmp_path / "none")
    assert bag(digests.except_all_stored(spark, *paths)) == bag(some)
    assert digests.except_all_stored(spark, *paths[::-1]).count() == 0
    assert digests.except_all_stored(spark, paths[1], stored(none, tmp_path / "none2")).count() == 0
    with pytest.raises(ValueError):
        digests.except_all_stored(spark, paths[0], stored(some, tmp_path / "other", 8))
    with pytest.raises(ValueError):
        digests.except_all_stored(spark, paths[0], stored(some.toDF("no"), tmp_path / "names"))
    with pytest.raises(ValueError):
        stored(some.select(F.create_map("id", "id").alias("m")), tmp_path / "maps")


def test_only_buckets_that_differ_are_read(spark, tmp_path):
    old = spark.range(40_000).selectExpr("id", "concat('station ', id) AS name", "id % 90 / 7 AS lat")
    # One row in ten thousand has another name: 4 rows, in at most 8 of 64 buckets.
    new = old.withColumn("name", F.when(F.col("id") % 10_000 == 0, F.concat("name", F.lit("*"))).otherwise(F.col("name")))
    paths = stored(old, tmp_path / "old", 64), stored(new, tmp_path / "new", 64)
    found = digests.except_all_stored(spark, *paths)
    assert sorted(r.id for r in found.collect()) == [*range(0, 40_000, 10_000)]
    buckets = digests.differing_buckets(spark, *paths)
    sizes = {int(p.parent.name.split("=")[1]): p.stat().st_size for p in (tmp_path / "old" / "rows").rglob("*.parquet")}
    read = sum(sizes[b] for b in buckets)
    assert 1 <= len(buckets) <= 8 and len(sizes) == 64 and read < 0.2 * sum(sizes.values())
    assert "PartitionFilters: [bucket" in found._jdf.queryExecution().toString()
    print(f"bytes read: {read} of {sum(sizes.values())}")
