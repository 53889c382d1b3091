from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripstream.schemas import MAX_DELAY


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A bounded table of rides or fares."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_delay: str | None = MAX_DELAY,
    max_bytes: int | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """An unbounded stream of the files that land in folder `path`.

    `max_delay` is the out-of-order bound: the watermark trails the newest `event_time` by it
    (None for streams whose operators use no event time). `max_bytes` or `max_files`, of which
    Spark takes one, bounds a micro-batch, and with it the rows any one key can have in it.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(path)
    return stream.withWatermark("event_time", max_delay) if max_delay else stream
