"""Difference of two stored registries by a tree of digests, so that only the buckets that differ are read.

A registry is stored as its distinct rows with their numbers of copies, in a folder for each bucket of row hashes. Beside it lies a
small tree: for every bucket, and for every FANOUT nodes of a level up to one root, the number of rows and the sums of two 64-bit hashes.
Sums don't depend on order, and copies count, so equal bags have equal digests. Two sides compare their trees from the root downwards.
Different bags have equal digests only if rows, and both sums, agree by chance. Rows that are equal but written differently
(-0.0 inside an array) cost a reading at most: whatever buckets are read, the difference of what they hold is exact.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from tripstream.functions.ordering import holds_map
from tripstream.operators.registry import repeated

FANOUT = 16
#: Buckets of a registry unless told otherwise. Each is a folder, and a row of the tree's lowest level.
BUCKETS = 256


def _hash(row: str, kind: StructType, seed: int) -> Column:
    """Hash of a row column; nulls count by their place, and nested values as text, since Spark's hash skips nulls."""
    parts = []
    for field in kind:
        value = F.col(row).getField(field.name)
        nested = isinstance(field.dataType, (ArrayType, StructType))
        parts += [F.to_json(F.struct(value), {"ignoreNullFields": "false"}) if nested else value, value.isNull()]
    return F.xxhash64(F.lit(seed), *parts)


def write_digested(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Stores `df` with its tree of digests in `path`, a folder that must not exist yet.

    Copies are counted before anything is shuffled, so a row that makes up a third of `df` is one row of one bucket. Map
    columns can't be compared by Spark and are refused, as by the other set operations.
    """
    if any(holds_map(f.dataType) for f in df.schema):
        raise ValueError("maps can't be compared")
    counted = df.select(F.struct("*").alias("row")).groupBy("row").agg(F.count("*").alias("copies"))
    bucket = F.pmod(_hash("row", df.schema, 1), F.lit(buckets)).cast("int")
    counted.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/rows")
    df.limit(0).write.parquet(f"{path}/layout")
    stored = _rows(df.sparkSession, path)
    wide = [(F.col("copies") * _hash("row", df.schema, s).cast("decimal(20,0)")).cast("decimal(38,0)") for s in (1, 2)]
    # One row a bucket, however large the registry.
    level = depth = math.ceil(math.log(max(buckets, 2), FANOUT))
    leaves = stored.groupBy(F.col("bucket").cast("long").alias("node")).agg(
        F.sum("copies").cast("decimal(38,0)").alias("copies"), F.sum(wide[0]).alias("one"), F.sum(wide[1]).alias("two")
    ).withColumn("level", F.lit(depth)).withColumn("buckets", F.lit(buckets))
    leaves.coalesce(1).write.parquet(f"{path}/digests/level={depth}")
    while level:
        below = df.sparkSession.read.parquet(f"{path}/digests/level={level}")
        level -= 1
        below.groupBy(F.floor(F.col("node") / FANOUT).cast("long").alias("node")).agg(
            *(F.sum(c).cast("decimal(38,0)").alias(c) for c in ("copies", "one", "two"))
        ).withColumn("level", F.lit(level)).withColumn("buckets", F.lit(buckets)).coalesce(1).write.parquet(f"{path}/digests/level={level}")


def _columns(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(f"{path}/layout").schema


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """(row, copies, bucket) of a stored registry, which may be empty."""
    schema = StructType().add("row", _columns(spark, path)).add("copies", LongType()).add("bucket", IntegerType())
    return spark.read.schema(schema).parquet(f"{path}/rows")


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.parquet(f"{path}/digests/level={level}")


def differing_buckets(spark: SparkSession, left: str, right: str) -> list[int]:
    """Buckets whose digests differ between two stored registries, found from the root downwards; at most all buckets.

    Registries whose layouts have different numbers of buckets can't be compared.
    """
    counts = [_level(spark, path, 0).select("buckets").first() for path in (left, right)]
    known = {row.buckets for row in counts if row}
    if len(known) > 1:
        raise ValueError("the registries are stored in different numbers of buckets")
    if not known:
        return []
    depth = math.ceil(math.log(max(*known, 2), FANOUT))
    nodes = [0]
    for level in range(depth + 1):
        sides = [
            _level(spark, path, level).filter(F.col("node").isin(nodes)).select("node", *(
                (F.col(c) * sign).cast("decimal(38,0)").alias(c) for c in ("copies", "one", "two")))
            for path, sign in ((left, 1), (right, -1))
        ]
        apart = sides[0].unionByName(sides[1]).groupBy("node").agg(*(F.sum(c).alias(c) for c in ("copies", "one", "two")))
        found = [r.node for r in apart.filter("copies <> 0 OR one <> 0 OR two <> 0").select("node").collect()]
        if not found or level == depth:
            return sorted(found)
        nodes = [n * FANOUT + i for n in found for i in range(FANOUT)]


def changes(spark: SparkSession, left: str, right: str) -> DataFrame:
    """(row, change) for each distinct row of which `left` has more copies than `right` (change > 0), or fewer (< 0).

    Reads the buckets that differ and no others; they are picked when the result is built.
    """
    kinds = [_columns(spark, path) for path in (left, right)]
    if [(f.name, f.dataType) for f in kinds[0]] != [(f.name, f.dataType) for f in kinds[1]]:
        raise ValueError("the registries have different columns")
    buckets = differing_buckets(spark, left, right)
    sides = [
        _rows(spark, path).filter(F.col("bucket").isin(buckets)).select("row", (F.col("copies") * sign).alias("copies"))
        for path, sign in ((left, 1), (right, -1))
    ]
    return sides[0].unionByName(sides[1]).groupBy("row").agg(F.sum("copies").alias("change")).filter("change <> 0")


def except_all_stored(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Rows of `left` with as many copies as it has more than `right`, as `registry_except_all` of the tables they were stored from."""
    surplus = changes(spark, left, right).filter("change > 0")
    columns = surplus.schema["row"].dataType.fieldNames()
    return repeated(surplus, F.col("change")).select(*(F.col("row").getField(c).alias(c) for c in columns))
