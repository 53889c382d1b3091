"""Layouts in which tables are written so that later queries move or read less."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.functions.ordering import holds_map


def morton(columns: list[str], bounds: dict[str, tuple[float, float]]) -> Column:
    """Position on a curve that keeps near what is near in all columns: the bits of the scaled values, interleaved.

    Values beyond the bounds count as the bound; nulls and NaN come first.
    """
    depth = 62 // len(columns)
    code = F.lit(0).cast("long")
    for j, name in enumerate(columns):
        low, high = bounds[name]
        value = F.when(F.isnan(name), None).otherwise(F.col(name))
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - low) / ((high - low) or 1.0)))
        step = F.coalesce((share * (2**depth - 1)).cast("long"), F.lit(0).cast("long"))
        for i in range(depth):
            code = code.bitwiseOR(F.shiftleft(F.shiftright(step, i).bitwiseAND(F.lit(1).cast("long")), i * len(columns) + j))
    return code


def write_by_place(df: DataFrame, path: str, columns: list[str], files: int, row_group_bytes: int | None = None) -> None:
    """Writes `df` as parquet in Morton order of the given floating-point columns.

    Row groups then span small boxes, and a filter by a rectangle skips those whose statistics lie outside. The order is
    by range partitions: a place that holds very many rows is shared among files by a hash of the rows.
    """
    found = df.agg(*(f(F.when(~F.isnan(c), F.col(c))).alias(f"{c} {n}") for c in columns for f, n in ((F.min, "low"), (F.max, "high")))).first()
    bounds = {c: (found[f"{c} low"] or 0.0, found[f"{c} high"] or 0.0) for c in columns}
    hashed = F.xxhash64(*(F.col(f.name) for f in df.schema if not holds_map(f.dataType)))
    order = df.select(F.struct("*").alias("row"), morton(columns, bounds).alias("code"), hashed.alias("tie"))
    writer = order.repartitionByRange(files, "code", "tie").sortWithinPartitions("code", "tie").select("row.*").write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "ride_id") -> DataFrame:
    """Writes `df` as a table bucketed by `key` and returns it. Tables with equal buckets join, and group by the key, without a shuffle.

    Each bucket is one file, sorted by the key. Rows without a key, which join with nothing, all belong to one bucket; they are
    written by all tasks, so that none of them gets long.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    spread = F.pmod(F.xxhash64(*(F.col(f.name) for f in df.schema if not holds_map(f.dataType))), F.lit(buckets)).cast("int")
    dealt = df.repartitionById(buckets, F.when(F.col(key).isNull(), spread).otherwise(bucket))
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
