"""Batch sinks (K3, K4, K7) and the reading-table writer.

All writes go through Spark's committers (task output is committed only when
the job succeeds), so a lost executor re-runs its tasks without leaving
partial files behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..sources.readers import PIPE_COLUMNS


def write_readings_table(readings: DataFrame, path: str, mode: str = "overwrite",
                         partitions: int | None = None) -> None:
    """The reading table: Parquet partitioned by reading date, rows clustered by
    (date, patient, time).  Range partitioning on (date, patient, time) samples
    the keys; the time as last key lets a boundary fall inside one patient's
    day, so even a single (date, patient) holding a third of all rows is split
    over many tasks and files instead of one.  Sorted files give tight min/max
    statistics for patient lookups."""
    df = readings.withColumn("reading_date", F.to_date("reading_timestamp"))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, "reading_date", "patient_id", "reading_timestamp")
       .sortWithinPartitions("reading_date", "patient_id", "reading_timestamp")
       .write.mode(mode).partitionBy("reading_date").parquet(path))


def write_patients_table(patients: DataFrame, path: str, partitions: int | None = None) -> None:
    """Patient documents as Parquet, range-partitioned and sorted by id, so that
    file and row-group statistics narrow a lookup to one id."""
    n = partitions or int(patients.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (patients.repartitionByRange(n, "patient_id").sortWithinPartitions("patient_id")
     .write.mode("overwrite").parquet(path))


def write_readings_csv(readings: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """K3: overwrite a CSV export with a header line per file."""
    cols = columns or S.READING_COLUMNS
    (readings.select(*cols).write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def write_pipe_text(readings: DataFrame, path: str) -> None:
    """A psql-style text export (banner, rule, rows, footer) of six columns."""
    spark = readings.sparkSession
    cells = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if c == "reading_timestamp"
             else F.lower(F.col(c).cast("string")) if c == "is_abnormal"
             else F.col(c).cast("string") for c in PIPE_COLUMNS]
    body = readings.select(F.concat_ws(" | ", *[F.concat(F.lit(" "), c) for c in cells]).alias("value"))
    banner = spark.createDataFrame([(" " + " | ".join(PIPE_COLUMNS),), ("-" * 60 + "+" + "-" * 20,)], "value string")
    footer = readings.agg(F.format_string("(%d rows)", F.count(F.lit(1))).alias("value"))
    banner.unionByName(body).unionByName(footer).write.mode("overwrite").text(path)


def append_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K4: add report documents, one folder per ``report_date``.  A report of a date that is there already takes its
    place (dynamic partition overwrite), other dates stay: a run that is repeated leaves one document a date."""
    (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_date")
     .format(fmt).save(path))


def append_patients(patients: DataFrame, path: str, fmt: str = "json") -> None:
    """K7: bulk-insert patient documents (append)."""
    w = patients.write.mode("append").format(fmt)
    if fmt == "json":
        w = w.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
    w.save(path)
