"""P13 on the stored table: expired dates leave it, nothing is rewritten.

A reading lives for ``days`` after it was written (by default: after its time).
A date folder whose last row's time is up is deleted as a whole; the rows of the
one date that the limit cuts are left to ``readings_within_retention``, which
every reader applies anyway.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ntz_literal
from ..session import Folder, sub_folders
from .transforms import RETENTION_DAYS

DATE = "reading_date"


def expired_dates(spark: SparkSession, path: str, as_of, days: int = RETENTION_DAYS, written_at: str | None = None) -> list[dt.date]:
    """Dates whose every reading has expired at ``as_of``.  By the readings' time the folder names tell; a column with
    the write time is read alone, one figure a date (a missing write time never expires)."""
    cutoff = ntz_literal(as_of) - F.make_dt_interval(days=F.lit(days))
    table = spark.read.parquet(path)
    if written_at is None:
        limit = spark.sql("SELECT 1 AS one").select(F.to_date(cutoff)).first()[0]
        return sorted(d for d in _folders(spark, path) if d < limit)
    last = table.where(F.col(DATE).isNotNull()).groupBy(DATE).agg(F.max(written_at).alias("last"), F.count_if(F.col(written_at).isNull()).alias("unknown"))
    return sorted(r[0] for r in last.where((F.col("last") <= cutoff) & (F.col("unknown") == 0)).select(DATE).collect())


def _folders(spark: SparkSession, path: str) -> dict[dt.date, Folder]:
    """The date folders of a table; the folder of rows without a time isn't among them."""
    named = [(f.name.removeprefix(f"{DATE}="), f) for f in sub_folders(spark, path) if f.name.startswith(f"{DATE}=")]
    return {dt.date.fromisoformat(name): f for name, f in named if name[0].isdigit()}


def drop_expired(spark: SparkSession, path: str, as_of, days: int = RETENTION_DAYS, written_at: str | None = None) -> list[dt.date]:
    """Delete the folders of expired dates and return the dates; files of other dates are not touched."""
    folders = _folders(spark, path)
    gone = [d for d in expired_dates(spark, path, as_of, days, written_at) if d in folders]
    for day in gone:
        folders[day].delete()
    return gone
