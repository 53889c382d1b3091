"""Set operations on whole rows of two registries of equal layout.

Each is one shuffle keyed by the whole row with partial aggregation, so however often a row is
repeated, a task sends it once. Grouping takes nulls as equal, as the SQL set operations do.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CHUNK = 1_000_000


def registry_union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right)


def registry_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of both sides with their number of copies in each."""
    sides = left.withColumn("__left", F.lit(1)).unionByName(right.withColumn("__left", F.lit(0)))
    return sides.groupBy(left.columns).agg(
        F.sum("__left").alias("__in_left"), F.sum(1 - F.col("__left")).alias("__in_right")
    )


def registry_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    both = (F.col("__in_left") > 0) & (F.col("__in_right") > 0)
    return _counted(left, right).filter(both).select(left.columns)


def registry_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of `left` that `right` lacks."""
    only_left = (F.col("__in_left") > 0) & (F.col("__in_right") == 0)
    return _counted(left, right).filter(only_left).select(left.columns)


def registry_except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of `left` with as many copies as it has more than `right`."""
    surplus = _counted(left, right).filter("__in_left > __in_right")
    return repeated(surplus, F.col("__in_left") - F.col("__in_right")).select(left.columns)


def repeated(rows: DataFrame, copies: Column) -> DataFrame:
    """Each row as often as `copies` says. A row with very many copies is written out by several tasks, not by the one that has it."""
    counted = rows.withColumn("__copies", copies)
    few = counted.filter(F.col("__copies") <= _CHUNK)
    many = (
        counted.filter(F.col("__copies") > _CHUNK)
        .withColumn("__from", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1, F.lit(_CHUNK))))
        .withColumn("__copies", F.least(F.col("__copies") - F.col("__from"), F.lit(_CHUNK)))
        .repartition(*rows.columns, "__from")
    )
    return few.unionByName(many.drop("__from")).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))


def registry_renumbered(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """(old_id, new_id) for rows of `new` that equal a row of `old` in every column but the id.

    Where `old` lists a place more than once, its smallest id stands for it (the largest, if the
    new id is that smallest one). So a row of `new` is reported once, and no group of copies is
    multiplied out.
    """
    # One key column for grouping and join, so that the shuffle of the one serves the other. A bare floating-point number in
    # it would be normalized anew by the join; as text, with -0.0 made 0.0 first, it is taken as it is.
    place = F.struct(*[
        (F.col(c) + F.lit(0.0)).cast("string").alias(c) if kind in ("double", "float") else F.col(c)
        for c, kind in old.dtypes if c != key
    ])
    known = old.select(place.alias("known_place"), F.col(key).alias("known_id")).groupBy("known_place").agg(
        F.min("known_id").alias("low"), F.max("known_id").alias("high")
    )
    listed = new.select(place.alias("place"), F.col(key).alias("new_id"))
    old_id = F.when(F.col("low") != F.col("new_id"), F.col("low")).otherwise(F.col("high"))
    return (
        listed.join(known, F.col("place") == F.col("known_place"))
        .select(old_id.alias("old_id"), "new_id")
        .filter("old_id <> new_id")
    )
