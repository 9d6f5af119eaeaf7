"""Metamorphic checks: figures that must agree across groupings, and sinks
whose source reads back exactly what was written."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vitalspark import schemas as S
from vitalspark.operators import stats
from vitalspark.operators.report import daily_report
from vitalspark.session import work_path
from vitalspark.sinks.files import append_patients, write_pipe_text, write_readings_csv
from vitalspark.sources import fixtures as X
from vitalspark.sources.readers import PIPE_COLUMNS, read_patient_documents, read_pipe_text, read_readings_csv


def _sum(df, col):
    return df.agg(F.sum(col)).first()[0]


def _same_rows(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_totals_agree_across_groupings(spark):
    r = X.load_readings(spark, SF_SMALL)
    total, abnormal = r.count(), r.filter(F.col("is_abnormal")).count()
    overall = stats.overall_summary(r).first()
    assert overall.total_readings == total and overall.total_abnormal == abnormal
    for df, n, a in ((stats.metric_summary(r), "total_readings", "abnormal_count"),
                     (stats.patient_summary(r), "total_readings", "abnormal_readings"),
                     (stats.abnormality_rates(r), "total", "abnormal"),
                     (stats.device_activity(r, top=None), "total_readings", "abnormal_readings"),
                     (stats.hourly_distribution(r), "readings_count", "abnormal_count")):
        assert _sum(df, n) == total and _sum(df, a) == abnormal
    assert overall.total_patients == stats.patient_summary(r).count()
    assert overall.total_devices == stats.device_activity(r, top=None).count()
    assert overall.high_risk_patients == stats.high_risk_patients(r, limit=None).count()


def test_report_summary_equals_overall_summary(spark):
    r = X.load_readings(spark, SF_SMALL)
    summary = daily_report(r, "2024-02-01", "2024-02-01 06:00:00").select("summary.*").first().asDict()
    overall = stats.overall_summary(r, on_rounded=False).first().asDict()
    assert summary == overall


def test_csv_write_then_read_is_identity(spark):
    r = X.load_readings(spark, SF_SMALL)
    path = work_path(spark, "csv")
    write_readings_csv(r, path)
    _same_rows(read_readings_csv(spark, path).select(*S.READING_COLUMNS), r.select(*S.READING_COLUMNS))


def test_pipe_text_write_then_read_is_identity(spark):
    r = X.load_readings(spark, SF_SMALL)
    path = work_path(spark, "pipe")
    write_pipe_text(r, path)
    _same_rows(read_pipe_text(spark, path).select(*PIPE_COLUMNS), r.select(*PIPE_COLUMNS))


def test_documents_write_then_read_is_identity(spark):
    docs = X.load_patients(spark, SF_SMALL)
    path = work_path(spark, "docs")
    append_patients(docs, path)
    back = read_patient_documents(spark, path)
    assert back.schema.simpleString() == docs.schema.simpleString()
    _same_rows(back, docs)


def test_one_scan_sections_equal_the_single_section_queries(spark):
    from conftest import SF_ORACLE
    r = X.load_readings(spark, SF_ORACLE)
    sections = stats.statistics_sections(r)
    direct = {"metric_summary": stats.metric_summary(r), "patient_summary_top": stats.patient_summary_top(r),
              "high_risk_patients": stats.high_risk_patients(r), "abnormality_rates": stats.abnormality_rates(r),
              "device_activity": stats.device_activity(r), "hourly_distribution": stats.hourly_distribution(r),
              "overall_summary": stats.overall_summary(r)}
    assert set(sections) == set(direct)
    for k, d in direct.items():
        assert sections[k].columns == d.columns, k
        assert [tuple(x) for x in sections[k].collect()] == [tuple(x) for x in d.collect()], k
