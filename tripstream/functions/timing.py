from pyspark.sql import Column
from pyspark.sql import functions as F


def as_event_time(column: str | Column) -> Column:
    """Timestamp without zone -> instant in the session time zone, as watermarks require."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp")


def bucket_start(micros: Column, width: int) -> Column:
    """First microsecond of the `width`-microsecond bucket holding `micros`, before 1970 too."""
    return micros - F.pmod(micros, F.lit(width))
