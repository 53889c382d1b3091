"""Tables, streams and station files as DataFrames."""

from tripstream.sources.stations import read_stations, write_stations
from tripstream.sources.tables import read_stream, read_table

__all__ = ["read_stations", "read_stream", "read_table", "write_stations"]
