"""A number for every row of a table, the same in every scan of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalspark.session import materialize


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``row``: different for all rows, whatever their values.  Written once, as later scans must
    find the same numbers."""
    return materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
