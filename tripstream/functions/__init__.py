"""Column-to-Column building blocks."""

from tripstream.functions.geo import Box, in_box
from tripstream.functions.ordering import orderable
from tripstream.functions.timing import as_event_time, bucket_start

__all__ = ["Box", "as_event_time", "bucket_start", "in_box", "orderable"]
