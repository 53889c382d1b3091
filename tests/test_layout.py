"""Filters of keys and layouts of tables."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.streams import at_second
from tripstream.functions import Box
from tripstream.operators import enrichment, filters
from tripstream.plans import members, write_bucketed, write_by_place

BOX = Box(-0.5, -0.5, 0.5, 0.5)
RIDE = "ride_id long, is_start boolean, start_lon double, start_lat double, end_lon double, end_lat double"
PLACES = ["start_lon", "start_lat", "end_lon", "end_lat"]


@pytest.mark.parametrize("max_words", [1, 40, 1 << 20])
def test_a_filter_holds_every_key_and_few_others(spark, max_words):
    keys = spark.range(0, 200).selectExpr("id * 7 AS ride_id").unionByName(spark.createDataFrame([(None,), (0,)], "ride_id long"))
    found = members(keys, "ride_id", max_words)
    if max_words == 1:
        assert found is None  # far too many keys for 64 bits
        return
    asked = spark.range(0, 20_000).selectExpr("CASE WHEN id > 0 THEN id - 1 END AS ride_id", "1 AS word", "2 AS bits", "3 AS row")
    rows = found.may_hold(asked, "ride_id", "held").collect()
    assert len(rows) == 20_000 and rows[0].word == 1 and rows[0].bits == 2 and rows[0].row == 3
    held = {r.ride_id for r in rows if r.held}
    assert held >= {7 * i for i in range(200)} and None not in held
    assert len(held) < 200 + 0.06 * 20_000


@pytest.mark.parametrize("max_words", [1, 1 << 20])
def test_filtered_unmatched_fares_equal_plain_ones(spark, max_words):
    draw = random.Random(4)
    kind = "ride_id long, event_time timestamp, record string, aside string, tags map<string,int>"

    def records(n, span):
        return spark.createDataFrame(
            [(draw.randrange(span) if draw.random() < 0.9 else None, at_second(i), "r", "a", {"x": i}) for i in range(n)], kind)

    rides, fares = records(400, 900), records(1500, 3000)
    found = enrichment.unmatched_fares_filtered(rides, fares, max_words)
    assert found.schema == fares.schema
    assert sorted(found.collect(), key=repr) == sorted(enrichment.unmatched_fares(rides, fares).collect(), key=repr)
    none = rides.limit(0)
    assert enrichment.unmatched_fares_filtered(none, fares).count() == 1500
    assert enrichment.unmatched_fares_filtered(rides, fares.limit(0)).count() == 0


def placed(spark, n):
    def at(seed):
        return F.rand(seed) * 4 - 2

    rides = spark.range(n).select(F.col("id").alias("ride_id"), (F.col("id") % 2 == 0).alias("is_start"), *(at(i).alias(c) for i, c in enumerate(PLACES)))
    hot = spark.range(n // 2).select((F.col("id") + n).alias("ride_id"), F.lit(True).alias("is_start"), *(F.lit(0.25).alias(c) for c in PLACES))
    odd = spark.createDataFrame([(-1, True, None, 0.0, 0.0, 0.0), (-2, True, float("nan"), 0.0, 0.0, 0.0), (-3, False, float("inf"), 0.0, 0.0, 0.0)], RIDE)
    return odd.unionByName(rides).unionByName(hot)


def row_groups(path):
    """Row groups in all, those that the region filter has to read, and the rows of the largest file."""
    total = read = 0
    sizes = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        sizes.append(meta.num_rows)
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            total += 1
            read += all(not s.has_min_max or (s.max >= low and s.min <= high) for s, low, high in (
                (columns[c], *((BOX.west, BOX.east) if c.endswith("lon") else (BOX.south, BOX.north))) for c in PLACES))
    return total, read, max(sizes)


def test_row_groups_outside_a_region_are_skipped(spark, tmp_path):
    rides, plain, by_place = placed(spark, 40_000), f"{tmp_path}/plain", f"{tmp_path}/placed"
    rides.repartition(16).write.parquet(plain)
    write_by_place(spark.read.parquet(plain), by_place, PLACES, 16, row_group_bytes=32_768)
    answers = [sorted(r.ride_id for r in filters.ride_cleansing(spark.read.parquet(p), BOX).collect()) for p in (plain, by_place)]
    assert answers[0] == answers[1] and len(answers[0]) > 20_000
    assert spark.read.parquet(by_place).columns == rides.columns and spark.read.parquet(by_place).count() == 60_003
    (all_plain, read_plain, _), (all_placed, read_placed, largest) = row_groups(plain), row_groups(by_place)
    assert read_plain >= 0.9 * all_plain
    # A third of the rows lie at one place inside the region; they are shared among files.
    assert read_placed <= 0.65 * all_placed and largest < 2 * 60_003 / 16
    print(f"row groups read: {read_plain} of {all_plain} before, {read_placed} of {all_placed} after")


def test_bucketed_tables_keep_rows_and_spread_those_without_a_key(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN id % 700 END AS ride_id", "timestamp_seconds(id) AS event_time", "id AS no", "map('a', id) AS tags")
    table = write_bucketed(rows, "bucketed_test", f"{tmp_path}/t", 4)
    try:
        assert sorted(table.drop("tags").collect(), key=repr) == sorted(rows.drop("tags").collect(), key=repr)
        per_file = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/t/*.parquet")]
        assert max(per_file) < 1000  # the thousand rows without a key come from several tasks
        # Equal ids lie in one bucket, so an aggregation by id needs no exchange.
        assert "Exchange" not in table.groupBy("ride_id").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP TABLE bucketed_test")
