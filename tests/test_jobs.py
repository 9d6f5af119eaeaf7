"""The command-line jobs run on derived data (called as functions: ``main``
stops its session, which would end the shared test session)."""

import argparse

import pytest

from conftest import SF_SMALL
from vitalspark import jobs
from vitalspark.session import work_path
from vitalspark.sinks.files import write_readings_table
from vitalspark.sources import fixtures as X


def test_statistics_and_last_readings_jobs(spark, capsys):
    table, reports = work_path(spark, "readings"), work_path(spark, "reports")
    write_readings_table(X.load_readings(spark, SF_SMALL), table)
    jobs.statistics(spark, argparse.Namespace(readings=table, format="parquet", reports=reports,
                                              report_date="2024-01-31", day=None))
    rep = spark.read.parquet(reports)
    assert rep.count() == 1 and rep.first().summary.total_readings == X.load_readings(spark, SF_SMALL).count()
    # the report built from the statistics rollup equals the report built from the readings
    from vitalspark.operators.report import daily_report
    direct = daily_report(X.load_readings(spark, SF_SMALL), "2024-01-31", "2024-01-31 00:00:00").first()
    got = rep.first()
    for part in ("summary", "metric_statistics", "abnormality_rates", "high_risk_patients"):
        assert got[part] == direct[part], part
    jobs.last_readings(spark, argparse.Namespace(readings=table, patient="P000007", n=5, metric=None))
    out = capsys.readouterr().out
    assert "== metric summary" in out and "P000007" in out


def test_risk_update_job(spark, capsys):
    patients, scores, out = work_path(spark, "p"), work_path(spark, "s"), work_path(spark, "o")
    X.load_patients(spark, SF_SMALL).write.parquet(patients)
    X.risk_updates(spark, SF_SMALL).drop("seq").write.parquet(scores)
    jobs.risk_update(spark, argparse.Namespace(patients=patients, patients_format="parquet", updates=scores, out=out))
    assert spark.read.parquet(out).count() == X.load_patients(spark, SF_SMALL).count()
    assert "score_changed" in capsys.readouterr().out
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):  # a second run doubles nothing
        jobs.risk_update(spark, argparse.Namespace(patients=patients, patients_format="parquet", updates=scores, out=out))


def test_document_update_jobs(spark):
    patients = work_path(spark, "p")
    X.load_patients(spark, SF_SMALL).write.parquet(patients)
    for job, updates in ((jobs.profile_update, X.profile_updates), (jobs.notes_update, X.note_updates)):
        batch, out = work_path(spark, "u"), work_path(spark, "o")
        updates(spark, SF_SMALL).write.parquet(batch)
        job(spark, argparse.Namespace(patients=patients, patients_format="parquet", updates=batch, out=out, updated_at="2024-02-01 00:00:00"))
        docs = spark.read.parquet(out)
        assert docs.count() == X.load_patients(spark, SF_SMALL).count() and docs.where("last_updated IS NOT NULL").count() > 0


def test_route_job(spark):
    from vitalspark.plans import stream_queries as Q
    out = work_path(spark, "routed")
    jobs.route(spark, argparse.Namespace(source=Q.write_messages(spark, SF_SMALL), out=out, checkpoints=work_path(spark, "c"),
                                         max_files_per_trigger=None, available_now=True, trigger="1 second"))
    r = X.load_readings(spark, SF_SMALL)
    assert spark.read.parquet(f"{out}/all").count() == r.count()
    assert spark.read.parquet(f"{out}/abnormal").count() == r.where("is_abnormal").count()


def test_report_of_one_day(spark, capsys):
    table, reports = work_path(spark, "readings"), work_path(spark, "reports")
    write_readings_table(X.load_readings(spark, SF_SMALL), table)
    jobs.statistics(spark, argparse.Namespace(readings=table, format="parquet", reports=reports, report_date="2024-01-31", day="2024-01-10"))
    n = X.load_readings(spark, SF_SMALL).where("date(reading_timestamp) = '2024-01-10'").count()
    assert spark.read.parquet(reports).first().summary.total_readings == n
    assert f"|{n} " in capsys.readouterr().out.split("== overall")[1]


def test_callers_settings_win():
    from pyspark import SparkConf
    given = SparkConf(loadDefaults=False).set("spark.master", "yarn").set("spark.sql.shuffle.partitions", "77")
    conf = jobs.session_conf(given)
    assert "spark.sql.shuffle.partitions" not in conf and "spark.master" not in conf
    assert conf["spark.sql.files.maxPartitionBytes"] == str(128 * 1024 * 1024)
    assert "spark.sql.files.maxPartitionBytes" not in jobs.session_conf(SparkConf(loadDefaults=False))


def test_kafka_options_bound_a_batch():
    from vitalspark.streaming.sources import kafka_options
    assert kafka_options("b", "t", max_offsets=5)["maxOffsetsPerTrigger"] == "5" and "maxOffsetsPerTrigger" not in kafka_options("b", "t")


def test_stream_jobs_start_with_one_state_partition_per_slot(spark):
    from vitalspark.session import use_stream_partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert use_stream_partitions(spark) == spark.sparkContext.defaultParallelism
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
        assert use_stream_partitions(spark, 3) == 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_store_jobs(spark, capsys):
    """Documents into a store, three update batches in place, an insert that is refused."""
    patients, store = work_path(spark, "p"), work_path(spark, "store")
    X.load_patients(spark, SF_SMALL).write.parquet(patients)
    jobs.store_create(spark, argparse.Namespace(patients=patients, patients_format="parquet", store=store, buckets=8))
    for batch, (job, updates) in enumerate([(jobs.profile_update, X.profile_updates), (jobs.notes_update, X.note_updates), (jobs.risk_update, X.risk_updates)], 1):
        path = work_path(spark, "u")
        updates(spark, SF_SMALL).write.parquet(path)
        job(spark, argparse.Namespace(store=store, batch=batch, updates=path, updated_at="2024-02-01 00:00:00"))
    from vitalspark.operators import patient_tables as PT
    from vitalspark.operators.document_store import DocumentStore
    flat = PT.flatten(DocumentStore(spark, store).tables())
    assert flat.count() == X.load_patients(spark, SF_SMALL).count() and flat.where("notes > 0").count() > 0
    jobs.patients_insert(spark, argparse.Namespace(store=store, patients=patients, patients_format="parquet", batch=4))
    out = capsys.readouterr().out
    assert "score_changed" in out and "duplicate:patient_id" in out
    assert DocumentStore(spark, store).tables().documents.count() == flat.count()
    with pytest.raises(ValueError):
        jobs.notes_update(spark, argparse.Namespace(store=store, batch=None, updates=patients))


def test_lookup_figures_and_expiry_jobs(spark, capsys):
    table, lookup, states, reports = (work_path(spark, n) for n in ("readings", "lookup", "states", "reports"))
    write_readings_table(X.load_readings(spark, SF_SMALL), table)
    jobs.lookup_table(spark, argparse.Namespace(readings=table, out=lookup, buckets=4))
    for given in ({"readings": table}, {"lookup": lookup}):
        jobs.last_readings(spark, argparse.Namespace(patient="P000007", n=5, metric=None, **given))
    first, second = [x for x in capsys.readouterr().out.split("only showing")[0].split("+\n") if "P0" in x][:2]
    assert first == second
    jobs.day_figures(spark, argparse.Namespace(readings=table, states=states, day=None))
    jobs.statistics(spark, argparse.Namespace(states=states, first=None, last=None, day=None, reports=reports, report_date="2024-01-31"))
    assert spark.read.parquet(reports).first().summary.total_readings == X.load_readings(spark, SF_SMALL).count()
    jobs.expire(spark, argparse.Namespace(table=table, as_of="2024-04-15 00:00:00", days=90, written_at=None))
    assert "dropped 2024-01-01" in capsys.readouterr().out
    assert spark.read.parquet(table).count() < X.load_readings(spark, SF_SMALL).count()


def test_live_alerts_and_ingest_jobs(spark):
    from vitalspark.plans import stream_queries as Q
    from vitalspark.streaming import sinks as K
    src, out, table = Q.write_messages(spark, SF_SMALL), work_path(spark, "live"), work_path(spark, "table")
    common = dict(source=src, checkpoints=work_path(spark, "c"), max_files_per_trigger=None, available_now=True, trigger="1 second", state_partitions=4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        jobs.live_alerts(spark, argparse.Namespace(out=out, seconds=86400, watermark="2 minutes", **common))
        jobs.ingest(spark, argparse.Namespace(table=table, once_within="1 hour", **common))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert spark.read.parquet(out).count() > 0
    assert K.read_ingested(spark, table).count() == X.load_readings(spark, SF_SMALL).count()
