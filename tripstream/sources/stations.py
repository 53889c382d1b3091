from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstream.schemas import STATION

# The station files' layout.
_CSV = {"header": True, "dateFormat": "M/d/yyyy"}


def read_stations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Station CSV, LF or CRLF line ends. A header that differs from the layout fails the scan, and so does a malformed row,
    whichever columns are read of it."""
    rows = spark.read.csv(path, schema=STATION, mode="FAILFAST", enforceSchema=False, **_CSV)
    # Columns that nothing asks for aren't parsed, and a fault in them isn't seen; this asks for all of them and is always true.
    return rows.where(F.length(F.concat_ws("", *STATION.fieldNames())) >= 0)


def write_stations(stations: DataFrame, path: str, line_end: str = "\n") -> None:
    stations.select(STATION.fieldNames()).write.csv(path, lineSep=line_end, **_CSV)
