"""K5: keyed upsert (last write wins), as a set-based job.

The incoming batch is reduced to its newest row per key first (a window with
``row_number() = 1``; Spark adds a partial WindowGroupLimit before the
exchange).  That reduced batch is written once below the shared checkpoint
folder and counted from the written table, so it is computed once and its
lineage is cut.  The base table is then filtered by a left-anti join against
the incoming keys and the survivors are unioned with the incoming rows.

The anti join is where scale is decided: the base may be the whole table.

- Up to ``broadcast_keys`` incoming keys (and at most ``BROADCAST_BYTES`` of
  measured key data) are broadcast, so the base is filtered where it is read
  and never shuffled.
- Above that bound, when the key determines a partition of the base (a
  reading's key holds its timestamp, so its date), only base rows of the
  partitions the batch touches can be replaced.  The touched partition values
  are counted and broadcast (a date set is small); base rows of other
  partitions pass through that broadcast filter unshuffled, and only the rows
  of touched partitions go through the shuffled (sort-merge) anti join.  A
  stream of new readings touches a day or two, so the shuffle covers those
  days, not the table.
- Otherwise the anti join is a sort-merge join over the whole base; AQE splits
  skewed partitions.  Correct at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import fits_broadcast, written_and_counted


def latest_per_key(df: DataFrame, keys=S.READING_KEY, order=("seq",)) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# Up to this many incoming keys are broadcast to every task of the base scan
# (3 key columns: about 100 bytes a key, so ~50 MB at the bound).
BROADCAST_KEYS = 500_000
# The date partition of the stored reading table, and how many dates a filter may list.
PARTITION = "reading_date"
MOST_DATES = 1_000
# Up to this many touched partition values (dates) are broadcast (~1 MB).
BROADCAST_PARTS = 100_000


def reading_date() -> Column:
    """The partition of a reading: its date, derived from the key."""
    return F.to_date(F.col("reading_timestamp"))


def upsert(base: DataFrame, incoming: DataFrame, keys=S.READING_KEY, seq="seq",
           broadcast_keys: int = BROADCAST_KEYS, part: Column | None = None,
           broadcast_parts: int = BROADCAST_PARTS) -> DataFrame:
    """Rows of ``base`` whose key is not in ``incoming``, plus the newest
    incoming row per key.  ``seq`` (a column or a tuple of columns) orders
    writes inside the batch; the result carries base's columns.  ``part`` is
    an expression over key columns naming the base partition a key lies in
    (e.g. ``reading_date()``); it narrows the shuffle of a large batch.  A base
    with the column ``reading_date`` (and a batch that has it too) is read in two
    parts by partition filters: untouched dates, which pass, and touched ones."""
    order = (seq,) if isinstance(seq, str) else tuple(seq)
    cols = [c for c in base.columns if c not in order]
    stored = PARTITION in base.columns
    # dates are days of a calendar, so the set of them is small; it comes with the size, from one job
    newest, n_keys, key_bytes, *dates = written_and_counted(latest_per_key(incoming, keys, order).select(*cols), "upsert-batch", measure=keys,
                                                            also=[F.collect_set(PARTITION)] if stored else [])
    incoming_keys = newest.select(*keys)
    if stored:
        # the stored table: dates that the batch doesn't touch are a partition filter away
        dates = sorted(dates[0])
        if len(dates) <= MOST_DATES:
            on = F.col(PARTITION).isin(dates) if dates else F.lit(False)
            keys_side = F.broadcast(incoming_keys) if fits_broadcast(n_keys, key_bytes, broadcast_keys) else incoming_keys
            kept = base.where(on).join(keys_side, list(keys), "left_anti").select(*cols)
            rest = base.where(~F.coalesce(on, F.lit(False))).select(*cols)
            return rest.unionByName(kept).unionByName(newest)
    if fits_broadcast(n_keys, key_bytes, broadcast_keys):  # proven bound before broadcasting
        kept = base.join(F.broadcast(incoming_keys), list(keys), "left_anti")
    elif part is not None:
        kept = _anti_join_touched(base, incoming_keys, keys, part, broadcast_parts)
    else:
        kept = base.join(incoming_keys, list(keys), "left_anti")
    # null-safe keys: a NULL in a key column never matches, so such rows stay
    return kept.select(*cols).unionByName(newest)


def _anti_join_touched(base: DataFrame, incoming_keys: DataFrame, keys, part: Column,
                       broadcast_parts: int) -> DataFrame:
    """``base`` anti-joined with ``incoming_keys``, shuffling only the base rows
    of partitions that some incoming key lies in."""
    parts = incoming_keys.select(part.alias("_part")).distinct()
    if parts.count() > broadcast_parts:  # no proven bound: whole-base shuffle join
        return base.join(incoming_keys, list(keys), "left_anti")
    touched = F.broadcast(parts)
    b = base.withColumn("_part", part)
    # a row whose partition is NULL has a NULL key column, so it never matches: it stays untouched
    untouched = b.join(touched, "_part", "left_anti")
    candidates = b.join(touched, "_part", "left_semi")
    kept = candidates.join(incoming_keys.withColumn("_part", part), ["_part", *keys], "left_anti")
    return untouched.unionByName(kept).drop("_part")
