"""T6 and T7 as a consumer closes its windows: by the messages themselves, not on the clock's minutes.

A consumer's window opens with its first message, takes in messages in order,
and closes with the first one that is ``length`` or more after the opening;
that message is the last of its window, and its time opens the next one.  Each
topic partition has a consumer of its own, so partitions run side by side.

State per partition: the opening, the counts so far, and the abnormal readings
by patient and metric.  A timer closes a window whose end the watermark has
passed without a message; the next message then opens a new one.  A task holds
what one partition brings in one micro-batch (bounded by the source's
``maxOffsetsPerTrigger``) and the alerts of one open window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.columns import event_time, pct, wall_clock_utc
from .operators import ALERT_MIN
from .sources import DEFAULT_WATERMARK

FIRST_TIME, LAST_TIME = "1678-01-01", "2262-01-01"
STATE = "opened long, readings long, abnormal long, patients array<string>, metrics array<string>, counts array<long>"
CLOSED = ("partition int, opened long, closed long, closed_by string, readings long, abnormal long, "
          "alerts array<struct<patient_id: string, metric_type: string, n: long>>")


def live_windows(readings: DataFrame, seconds: int = 60, delay: str = DEFAULT_WATERMARK) -> DataFrame:
    """One row for each closed window: partition, opened, closed, closed_by (message or timer), readings, abnormal,
    alerts (abnormal readings by patient and metric).  ``readings``: a stream with partition, offset, patient_id,
    metric_type, is_abnormal and reading_timestamp; its watermark stands ``delay`` behind the newest of these."""
    length = seconds * 1_000_000

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        opened, total, abnormal, found = None, 0, 0, Counter()
        if state.exists:
            opened, total, abnormal, patients, metrics, counts = state.get
            found = Counter(dict(zip(zip(patients, metrics), counts)))
        closed = []

        def close(at: int, by: str) -> None:
            closed.append((key[0], opened, at, by, total, abnormal, [(p, m, n) for (p, m), n in sorted(found.items(), key=str)]))

        if state.hasTimedOut:
            close(opened + length, "timer")
            state.remove()
        else:
            rows = pd.concat(list(parts)).sort_values(["at", "offset"], kind="stable")
            at = rows["at"].to_numpy(np.int64)
            flags = rows["flag"].to_numpy(bool)
            patients, metrics = rows["patient_id"].to_numpy(object), rows["metric_type"].to_numpy(object)
            first = 0
            while first < len(at):
                if opened is None:
                    opened = int(at[first])
                # the first message that is late enough ends the window and belongs to it
                late = np.flatnonzero(at[first:] >= opened + length)[:1]
                end = first + int(late[0]) + 1 if len(late) else len(at)
                here = np.flatnonzero(flags[first:end]) + first
                total, abnormal = total + end - first, abnormal + len(here)
                found.update(zip(patients[here], metrics[here]))
                if len(late):
                    close(int(at[end - 1]), "message")
                    opened, total, abnormal, found = int(at[end - 1]), 0, 0, Counter()
                first = end
            passed = state.getCurrentWatermarkMs()
            if opened + length <= passed * 1000:
                if total:
                    close(opened + length, "timer")
                state.remove()
            else:
                names = list(found)
                state.update((opened, total, abnormal, [p for p, _ in names], [m for _, m in names], [found[k] for k in names]))
                state.setTimeoutTimestamp(-(-(opened + length) // 1000))
        yield pd.DataFrame([(p, o, c, by, n, a, [{"patient_id": x, "metric_type": m, "n": k} for x, m, k in alerts])
                            for p, o, c, by, n, a, alerts in closed if n],
                           columns=["partition", "opened", "closed", "closed_by", "readings", "abnormal", "alerts"])

    flag = F.coalesce(F.col("is_abnormal"), F.lit(False)).alias("flag")
    # pandas holds times in nanoseconds: the watermark's column stays in their range, the windows use microseconds
    time = event_time("reading_timestamp")
    held = F.least(F.greatest(time, F.lit(FIRST_TIME).cast("timestamp")), F.lit(LAST_TIME).cast("timestamp"))
    stream = (readings.select("partition", "offset", held.alias("event_time"), F.unix_micros(time).alias("at"), "patient_id", "metric_type", flag)
              .withWatermark("event_time", delay))
    out = stream.groupBy("partition").applyInPandasWithState(advance, CLOSED, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumns({c: wall_clock_utc(F.timestamp_micros(c)) for c in ("opened", "closed")})


def live_totals(closed: DataFrame) -> DataFrame:
    """T7 of closed windows."""
    return closed.select("partition", "opened", "closed", "closed_by", "readings", "abnormal", pct("abnormal", "readings").alias("abnormal_rate_pct"))


def live_alerts(closed: DataFrame, least: int = ALERT_MIN) -> DataFrame:
    """T6 of closed windows: patients with ``least`` abnormal readings or more, and how many of each metric."""
    one = closed.select("partition", "opened", "closed", F.explode("alerts").alias("a")).select("partition", "opened", "closed", "a.*")
    total = one.groupBy("partition", "opened", "patient_id").agg(F.sum("n").alias("total_abnormal")).where(F.col("total_abnormal") >= least)
    return one.join(total, ["partition", "opened", "patient_id"]).select("partition", "opened", "closed", "patient_id", "total_abnormal", "metric_type",
                                                                          F.col("n").alias("metric_count"))
