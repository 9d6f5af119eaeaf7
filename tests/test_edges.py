"""Hand-built edge rows (FIXTURES.md §4) for the batch operators."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from vitalspark import schemas as S
from vitalspark.functions.columns import patient_key, round_half_up
from vitalspark.operators import documents as D
from vitalspark.operators import recent, stats, transforms
from vitalspark.operators.upsert import upsert
from vitalspark.sources.fixtures import metric_dim

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def reading(pid="P000001", t=T0, metric="click", value=50.0, abnormal=False, device="DEV_1",
            lo=3.0, hi=120.0, unit="bpm"):
    return (pid, t, metric, value, unit, device, abnormal, lo, hi)


@pytest.fixture
def mk(spark):
    def make(rows):
        return spark.createDataFrame(rows, S.READING_SCHEMA)
    return make


def test_empty_frame(mk):
    empty = mk([])
    assert stats.metric_summary(empty).count() == 0
    row = stats.overall_summary(empty).collect()[0]
    assert (row.total_readings, row.total_patients, row.high_risk_patients, row.total_devices,
            row.total_abnormal, row.overall_abnormal_rate) == (0, 0, 0, 0, 0, 0.0)


def test_one_reading_has_null_stddev(mk):
    row = stats.metric_summary(mk([reading(value=72.0)])).collect()[0]
    assert row.total_readings == 1 and row.std_dev is None and row.avg_value == 72.0


def test_null_flag_counts_as_normal_and_null_value(mk):
    df = mk([reading(abnormal=None), reading(t=T0 + dt.timedelta(minutes=1), abnormal=True, value=None)])
    row = stats.metric_summary(df).collect()[0]
    assert row.abnormal_count == 1 and row.total_readings == 2 and row.avg_value == 50.0  # avg skips NULL
    assert transforms.abnormal_readings(df).count() == 1


def test_exactly_twenty_percent_is_not_high_risk(mk):
    rows = [reading(pid="P1", t=T0 + dt.timedelta(minutes=i), abnormal=(i == 0)) for i in range(5)]
    rows += [reading(pid="P2", t=T0 + dt.timedelta(minutes=i), abnormal=(i < 2)) for i in range(5)]
    df = mk(rows)
    assert [r.patient_id for r in stats.high_risk_patients(df).collect()] == ["P2"]
    assert [r.patient_id for r in stats.high_risk_patients(df, on_rounded=False).collect()] == ["P2"]
    assert stats.overall_summary(df).collect()[0].high_risk_patients == 1


def test_score_exactly_seventy_is_high_risk(spark):
    from vitalspark.sources.fixtures import nest_patients
    flat = spark.createDataFrame(
        [("P1", "a", dt.date(1980, 1, 1), "M", "x", "1", "e", "O+", 70, None, 1),
         ("P2", "b", dt.date(1980, 1, 1), "F", "x", "2", "e", "O+", 69, 50, 2)],
        "patient_id string, name string, date_of_birth date, gender string, condition string, phone string, "
        "email string, blood_type string, risk_score int, prev_score int, c_custkey long")
    p = nest_patients(flat)
    assert [r.patient_id for r in recent.high_risk_by_score(p).collect()] == ["P1"]
    ov = stats.risk_overview(p).collect()[0]
    assert (ov.total_patients, ov.high_risk_count, ov.avg_risk_score, ov.high_risk_percentage) == (2, 1, 69.5, 50.0)


def test_risk_overview_empty_is_null_not_error(spark):
    from vitalspark.sources.fixtures import nest_patients
    flat = spark.createDataFrame([], "patient_id string, name string, date_of_birth date, gender string, "
                                     "condition string, phone string, email string, blood_type string, "
                                     "risk_score int, prev_score int, c_custkey long")
    ov = stats.risk_overview(nest_patients(flat)).collect()[0]
    assert ov.total_patients == 0 and ov.avg_risk_score is None and ov.high_risk_percentage is None
    assert stats.next_patient_index(nest_patients(flat)).collect()[0].next_index == 100000


def test_recent_abnormal_boundary_is_excluded(mk):
    as_of = dt.datetime(2024, 1, 31)
    df = mk([reading(t=as_of - dt.timedelta(hours=24), abnormal=True),
             reading(t=as_of - dt.timedelta(hours=23, minutes=59), abnormal=True)])
    got = transforms.recent_abnormal(df, as_of).collect()
    assert len(got) == 1 and got[0].reading_timestamp == as_of - dt.timedelta(hours=23, minutes=59)


def test_value_equal_to_threshold_is_normal(spark, mk):
    df = mk([reading(value=120.0), reading(t=T0 + dt.timedelta(seconds=1), value=2.9),
             reading(t=T0 + dt.timedelta(seconds=2), value=3.0)]).drop("is_abnormal")
    out = {r.value: (r.is_abnormal, r.threshold_violated)
           for r in transforms.classify_readings(df, metric_dim(spark)).collect()}
    assert out == {120.0: (False, None), 2.9: (True, "threshold_min"), 3.0: (False, None)}


def test_equal_times_order_by_metric(mk):
    df = mk([reading(metric="view"), reading(metric="click"), reading(t=T0 - dt.timedelta(1), metric="error")])
    got = [r.metric_type for r in recent.last_n_readings(df, "P000001", 2).collect()]
    assert got == ["click", "view"]
    w3 = {(r.metric_type, r.reading_rank) for r in recent.last_n_all_patients(df, 2).collect()}
    assert w3 == {("click", 1), ("view", 2)}


def test_patient_key_matches_uuid5(spark):
    ids = ["P000001", "P123456", "P999999", "abc", "P-000001", str(uuid.uuid4())]
    df = spark.createDataFrame([(i,) for i in ids], "patient_id string")
    got = {r.patient_id: r.k for r in df.select("patient_id", patient_key("patient_id").alias("k")).collect()}
    for i in ids:
        want = i if "-" in i else str(uuid.uuid5(uuid.NAMESPACE_DNS, i))
        assert got[i] == want


def test_round_half_up_ignores_float_noise(spark):
    df = spark.createDataFrame([(1.0249999999999999,), (1.0250000000000001,), (-0.125,), (2.675,)], "x double")
    assert [r.y for r in df.select(round_half_up("x", 2).alias("y")).collect()] == [1.03, 1.03, -0.13, 2.68]


def test_parse_reading_time_forms(spark):
    df = spark.createDataFrame([("2024-01-05T10:11:12.500000Z",), ("2024-01-05T10:11:12.5",),
                                ("2024-01-05 10:11:12",), ("2024-01-05T10:11:12+00:00",),
                                ("2024-01-05T10:11:12+02:00",), ("junk",), (None,)], "reading_timestamp string")
    got = [r.reading_timestamp for r in transforms.parse_reading_time_col(df).collect()]
    assert got == [dt.datetime(2024, 1, 5, 10, 11, 12, 500000), dt.datetime(2024, 1, 5, 10, 11, 12, 500000),
                   dt.datetime(2024, 1, 5, 10, 11, 12), dt.datetime(2024, 1, 5, 10, 11, 12),
                   dt.datetime(2024, 1, 5, 8, 11, 12), None, None]


def test_malformed_split(spark):
    good = '{"patient_id": "P1", "reading_timestamp": "2024-01-01T00:00:00", "metric_type": "click", "value": 1.0}'
    df = spark.createDataFrame([(bytearray(good.encode()), T0, 1), (bytearray(b"{bad"), T0, 2),
                                (bytearray(b"[1,2]"), T0, 3), (None, T0, 4)],
                               "value binary, timestamp timestamp, offset long")
    ok, bad = transforms.malformed_split(df)
    assert [r.offset for r in ok.collect()] == [1]
    assert sorted(r.offset for r in bad.collect()) == [2, 3, 4]


def test_upsert_last_write_wins_and_is_idempotent(mk):
    base = mk([reading(value=1.0), reading(metric="view", value=2.0)]).withColumn("seq", F.lit(0).cast("long"))
    inc = (mk([reading(value=10.0), reading(value=11.0), reading(metric="error", value=5.0)])
           .withColumn("seq", F.array_position(F.array(F.lit(10.0), F.lit(11.0), F.lit(5.0)), F.col("value"))))
    once = upsert(base, inc)
    got = {(r.metric_type, r.value) for r in once.collect()}
    assert got == {("click", 11.0), ("view", 2.0), ("error", 5.0)}
    twice = upsert(once.withColumn("seq", F.lit(0).cast("long")), inc)
    assert {(r.metric_type, r.value) for r in twice.collect()} == got


def _docs(spark, history=None):
    from vitalspark.sources.fixtures import nest_patients
    flat = spark.createDataFrame(
        [("P1", "a", dt.date(1980, 1, 1), "M", "x", "+1", "e", "O+", 50, history, 1)],
        "patient_id string, name string, date_of_birth date, gender string, condition string, phone string, "
        "email string, blood_type string, risk_score int, prev_score int, c_custkey long")
    return nest_patients(flat)


def test_risk_update_on_null_history_and_empty_factors(spark):
    docs = _docs(spark, None)
    upd = spark.createDataFrame(
        [("P1", 1, 60, ["a"], T0), ("P1", 2, 65, [], T0 + dt.timedelta(1)), ("P9", 1, 10, ["z"], T0)],
        S.RISK_UPDATE_SCHEMA)
    out = D.update_risk_scores(docs, upd).collect()[0]
    assert out.risk_score == 65
    assert [(h.score, h.factors) for h in out.risk_score_history] == [(60, ["a"])]
    assert out.last_updated == T0 + dt.timedelta(1)
    rep = {r.patient_id: (r.matched, r.modified, r.score_changed) for r in D.risk_match_report(docs, upd).collect()}
    assert rep == {"P1": (True, True, True), "P9": (False, False, False)}
    counts = D.history_counts(docs).collect()[0]
    assert (counts.history_entries, counts.notes) == (0, 0)


def test_profile_and_notes(spark):
    docs = _docs(spark, 40)
    prof = spark.createDataFrame([("P1", 2, "+2"), ("P1", 1, "+3"), ("P1", 3, None)], S.PROFILE_UPDATE_SCHEMA)
    out = D.update_profiles(docs, prof, "2024-02-01 00:00:00").collect()[0]
    assert out.personal_info.contact.phone == "+2" and out.personal_info.contact.email == "e"
    notes = spark.createDataFrame([("P1", 2, "d2", "n2", T0), ("P1", 1, "d1", "n1", T0)], S.NOTE_UPDATE_SCHEMA)
    out = D.add_medical_notes(docs, notes).collect()[0]
    assert [n.note for n in out.medical_notes] == ["n1", "n2"]
    twice = D.add_medical_notes(D.add_medical_notes(docs, notes), notes).collect()[0]
    assert len(twice.medical_notes) == 4


def test_validation_reasons(spark):
    from vitalspark.sources.fixtures import nest_patients
    flat = spark.createDataFrame(
        [("P1", None, dt.date(1980, 1, 1), "X", "x", "+1", "e", "Z+", 101, None, 1)],
        "patient_id string, name string, date_of_birth date, gender string, condition string, phone string, "
        "email string, blood_type string, risk_score int, prev_score int, c_custkey long")
    r = transforms.validate_patients(nest_patients(flat)).collect()[0]
    assert not r.is_valid
    assert r.reasons == ["missing:personal_info.name", "enum:personal_info.gender", "enum:medical_info.blood_type",
                         "range:risk_score"]


def test_csv_by_name_and_strict_order(spark):
    from vitalspark.session import work_path
    from vitalspark.sinks.files import write_readings_csv
    from vitalspark.sources.readers import read_readings_csv
    df = spark.createDataFrame([reading(), reading(metric="view", value=7.5, abnormal=True)], S.READING_SCHEMA)
    ordered, reversed_ = work_path(spark, "csv"), work_path(spark, "csv")
    write_readings_csv(df, ordered)
    write_readings_csv(df, reversed_, columns=list(reversed(S.READING_COLUMNS)))
    want = sorted(map(tuple, df.collect()))
    assert sorted(map(tuple, read_readings_csv(spark, reversed_).collect())) == want
    assert sorted(map(tuple, read_readings_csv(spark, ordered, strict_order=True).collect())) == want
    with pytest.raises(Exception, match="(?i)header|CSV"):
        read_readings_csv(spark, reversed_, strict_order=True).collect()


def test_pipe_text_keeps_only_well_formed_rows(spark):
    from vitalspark.session import work_path
    from vitalspark.sources.readers import read_pipe_text
    path = work_path(spark, "pipe")
    lines = [" patient_id | reading_timestamp | metric_type | value | unit | is_abnormal",
             "------------+-------------------+-------------+-------+------+------------",
             " P1 | 2024-01-05 10:00:00.000000 | click | 72.5 | bpm | False",
             " P2 | 2024-01-05 11:00:00 | view | not-a-number | mmHg | true",
             " P3 | 2024-01-05 12:00:00 | view",
             " P4 | 2024-01-05 13:00:00 | error | 3 | breaths/min | TRUE ",
             "",
             "(4 rows)"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = sorted(map(tuple, read_pipe_text(spark, path).collect()))
    assert got == [("P1", dt.datetime(2024, 1, 5, 10), "click", 72.5, "bpm", False),
                   ("P4", dt.datetime(2024, 1, 5, 13), "error", 3.0, "breaths/min", True)]


def _direct_sections(r):
    return {"metric_summary": stats.metric_summary(r), "patient_summary_top": stats.patient_summary_top(r),
            "high_risk_patients": stats.high_risk_patients(r), "abnormality_rates": stats.abnormality_rates(r),
            "device_activity": stats.device_activity(r), "hourly_distribution": stats.hourly_distribution(r),
            "overall_summary": stats.overall_summary(r)}


def test_one_scan_sections_on_edge_rows(mk):
    later = T0 + dt.timedelta(hours=3)
    for rows in ([], [reading(value=72.0)],
                 [reading(abnormal=None), reading(t=later, abnormal=True, value=None),
                  reading(pid="P000002", metric="view", value=1.5, abnormal=True, device="DEV_2"),
                  reading(pid="P000002", t=later, metric="view", value=None, device="DEV_2"),
                  reading(pid="P000002", t=later, metric="error", value=7.25, device="DEV_1")]):
        r = mk(rows)
        sections = stats.statistics_sections(r)
        for k, d in _direct_sections(r).items():
            assert sections[k].columns == d.columns, k
            assert [tuple(x) for x in sections[k].collect()] == [tuple(x) for x in d.collect()], k


def test_long_ids_are_never_cut(spark):
    """Ids above a million, a milliard and a billion stay apart, on both sides."""
    import duckdb
    from vitalspark.plans.sql_fixtures import padded
    from vitalspark.sources.fixtures import pad_id
    ids = [7, 999_999, 1_234_567, 1_234_568, 10 ** 9 + 1, 10 ** 12 + 1, 10 ** 12 + 2]
    ours = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").select(pad_id("P", F.col("i"), 6)).collect()]
    theirs = [r[0] for r in duckdb.sql(f"SELECT 'P' || {padded('i')} FROM (SELECT unnest({ids}) AS i)").fetchall()]
    assert ours == theirs == [f"P{i:06d}" for i in ids]


def test_no_checkpoint_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from vitalspark.session import ensure_checkpoint_dir
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"):
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(fake)


def test_csv_headers(spark):
    from vitalspark.session import work_path
    from vitalspark.sinks.files import write_readings_csv
    from vitalspark.sources.readers import read_readings_csv
    import glob
    import shutil
    path = work_path(spark, "csv")
    r = spark.createDataFrame([("P1", None, "m", 1.0, "u", "d", True, 0.0, 2.0)], S.READING_SCHEMA)
    write_readings_csv(r, path, columns=list(reversed(S.READING_COLUMNS)))
    assert read_readings_csv(spark, path).first().value == 1.0
    write_readings_csv(r, path + "-b")
    shutil.copy(glob.glob(path + "-b/part-*.csv")[0], path + "/other.csv")
    with pytest.raises(Exception, match="CSV header|schema"):
        read_readings_csv(spark, path).collect()
    write_readings_csv(r, path + "-c", columns=S.READING_COLUMNS[:-1])
    with pytest.raises(ValueError, match="threshold_max"):
        read_readings_csv(spark, path + "-c")


def test_report_average_leaves_out_missing_values(spark):
    from vitalspark.operators.report import daily_report
    rows = [("P1", dt.datetime(2024, 1, 1, h), "m", v, "u", None if h == 1 else "d", False, 0.0, 2.0) for h, v in enumerate((10.0, None, 20.0))]
    r = spark.createDataFrame(rows, S.READING_SCHEMA)
    rep = daily_report(r, "2024-01-01", "2024-01-01 00:00:00").first()
    assert rep.metric_statistics[0].avg_value == stats.metric_summary(r).first().avg_value == 15.0
    # a missing device is no device, in every form of the summary
    sec = stats.statistics_sections(r)["overall_summary"].first()
    assert rep.summary.total_devices == stats.overall_summary(r).first().total_devices == sec.total_devices == 1


def test_scores_of_one_time_need_an_order(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("P1", 5, ["f"], at), ("P1", 7, ["f"], at)]
    df = spark.createDataFrame(rows, "patient_id string, new_score int, factors array<string>, at timestamp_ntz")
    patients = spark.createDataFrame([], S.PATIENT_SCHEMA)
    with pytest.raises(ValueError, match="seq"):
        D.bulk_risk_update(patients, df)


def test_classify_with_the_devices_own_table(spark):
    from vitalspark.sources.fixtures import vital_signs_dim
    dim = vital_signs_dim(spark)
    d = dim.first()
    rows = [("P1", dt.datetime(2024, 1, 1), d.metric_type, float(d.threshold_max) + 1, "u", "d", None, None, None)]
    got = transforms.classify_readings(spark.createDataFrame(rows, S.READING_SCHEMA), dim.select("metric_type", "threshold_min", "threshold_max", "unit")).first()
    assert got.is_abnormal and got.threshold_violated == "threshold_max"
