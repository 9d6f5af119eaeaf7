"""Command-line jobs: the batch report, the alert streams, ingest, routing,
compaction, document updates and last-N lookups, each a Spark application.

    python -m vitalspark.jobs statistics --readings PATH [--format parquet|csv|pipe] --reports PATH
    python -m vitalspark.jobs alerts --source PATH|kafka --out PATH [--bootstrap HOST:PORT --topic T]
    python -m vitalspark.jobs ingest --source PATH|kafka --table PATH
    python -m vitalspark.jobs compact --table PATH
    python -m vitalspark.jobs route --source PATH|kafka --out PATH
    python -m vitalspark.jobs live-alerts --source PATH|kafka --out PATH [--seconds 60]
    python -m vitalspark.jobs store-create --patients PATH --store NEW_PATH
    python -m vitalspark.jobs patients-insert --store PATH --patients PATH --batch N
    python -m vitalspark.jobs risk-update|profile-update|notes-update --store PATH --updates PATH --batch N
    python -m vitalspark.jobs risk-update|profile-update|notes-update --patients PATH --updates PATH --out NEW_PATH
    python -m vitalspark.jobs lookup-table --readings PATH --out NEW_PATH
    python -m vitalspark.jobs last-readings --readings PATH|--lookup PATH --patient ID [--metric M] [-n 20]
    python -m vitalspark.jobs day-figures --readings TABLE --states PATH [--day D ...]
    python -m vitalspark.jobs statistics --states PATH [--first D --last D] --reports PATH
    python -m vitalspark.jobs expire --table PATH [--as-of T --days 90 --written-at COLUMN]

Checkpoints go below ``spark.checkpoint.dir`` (``--checkpoints`` overrides).
"""

from __future__ import annotations

import argparse
import datetime as dt
import hashlib
import os

from pyspark import SparkConf
from pyspark.sql import SparkSession

from .functions.columns import status_label
from .operators import daily_states, lookup, recent, stats
from .operators import documents as D
from .operators.document_store import DocumentStore
from .operators.report import daily_report, readings_of_day
from .operators.retention import drop_expired
from .operators.transforms import RETENTION_DAYS, classify_readings
from .session import BATCH_CONF, CLUSTER_CONF, ensure_checkpoint_dir, materialize, use_stream_partitions
from .sinks.files import append_patients, append_report
from .sources import readers as R
from .sources.fixtures import vital_signs_dim
from .streaming import live_windows as W
from .streaming import operators as T
from .streaming import sinks as K
from .streaming.sources import (kafka_options, message_stream, read_stream, readings_from_messages,
                                with_watermark)


def session_conf(given: SparkConf) -> dict[str, str]:
    """Our defaults (those for a cluster unless the master is local), without what the caller has set."""
    master = given.get("spark.master", "local[*]")
    conf = dict(BATCH_CONF if master.startswith("local") else CLUSTER_CONF)
    conf["spark.master"] = master
    return {k: v for k, v in conf.items() if not given.contains(k)}


def _session(app: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    for k, v in session_conf(SparkConf()).items():
        b = b.config(k, v)
    return b.getOrCreate()


def _readings(spark, path, fmt):
    if fmt == "csv":
        return R.read_readings_csv(spark, path)
    if fmt == "pipe":
        return R.read_pipe_text(spark, path)
    return R.read_readings_table(spark, path)


def _messages(spark, args):
    if args.source == "kafka":
        return read_stream(spark, "kafka", kafka_options(args.bootstrap, args.topic, args.starting, args.max_offsets_per_trigger))
    return message_stream(spark, args.source, args.max_files_per_trigger)


def _ckpt(spark, args, name, output):
    """The checkpoint of one query over one output: two jobs of a kind never share one."""
    root = args.checkpoints or ensure_checkpoint_dir(spark)
    return os.path.join(root, name, hashlib.sha256(os.path.normpath(output).encode()).hexdigest()[:16])


def statistics(spark, args):
    """Q5: hospital-wide statistics, printed, and the report document appended,
    of all readings or (``--day``) of one date.  The readings are scanned once,
    into the written groups; every section and the report derive from them.
    With ``--states`` they derive from the figures of each day (``day-figures``),
    and no reading is read."""
    if getattr(args, "states", None):
        r, groups = None, materialize(daily_states.merged_groups(spark, args.states, args.first or args.day, args.last or args.day), "figure-groups")
    else:
        r = _readings(spark, args.readings, args.format)
        groups = stats.written_groups(readings_of_day(r, args.day) if args.day else r, stats.STATISTICS_SETS)
    sec = stats.statistics_sections(groups=groups)
    for title, key, n in (("metric summary", "metric_summary", 20),
                          ("patients with the highest abnormal %", "patient_summary_top", 10),
                          ("high-risk patients (> 20 %)", "high_risk_patients", 20),
                          ("abnormality rates", "abnormality_rates", 20),
                          ("most active devices", "device_activity", 10),
                          ("hourly distribution", "hourly_distribution", 24),
                          ("overall", "overall_summary", 1)):
        print(f"\n== {title}")
        sec[key].show(n, truncate=False)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    report = daily_report(r, args.report_date or now.date().isoformat(), now.isoformat(sep=" "), groups=groups)
    append_report(report, args.reports)


def alerts(spark, args):
    """Q4: live abnormal feed, per-metric window alerts, window statistics."""
    use_stream_partitions(spark, args.state_partitions)
    out = args.out
    parsed = readings_from_messages(_messages(spark, args))
    if getattr(args, "classify", False):    # messages without a flag: by the devices' metric table (stream-static join)
        parsed = classify_readings(parsed, vital_signs_dim(spark))
    qs = {}
    if args.parse_once:  # one read and parse of the source, shared by the three queries
        qs["parse"], parsed = K.parse_once(spark, parsed, os.path.join(out, "readings"), _ckpt(spark, args, "parse", out),
                                           trigger={"processingTime": "5 seconds"})
    readings = with_watermark(parsed, args.watermark)
    qs |= {
        "feed": K.start_append(T.abnormal_feed(readings), os.path.join(out, "feed"), _ckpt(spark, args, "feed", out),
                               trigger={"processingTime": "10 seconds"}, name="abnormal_feed"),
        "alerts": K.start_update(T.tumbling_metric_alerts(readings, args.window), os.path.join(out, "alerts"),
                                 _ckpt(spark, args, "alerts", out), trigger={"processingTime": "15 seconds"},
                                 name="metric_alerts"),
        "statistics": K.start_append(T.window_statistics(readings, args.window), os.path.join(out, "statistics"),
                                     _ckpt(spark, args, "statistics", out), trigger={"processingTime": "20 seconds"},
                                     name="window_statistics"),
    }
    K.run_all(spark, qs, wait="any")


def ingest(spark, args):
    """Q1 at scale: continuous ingest into the reading table (last write wins)."""
    use_stream_partitions(spark, args.state_partitions)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    K.stream_to_table(_messages(spark, args), args.table, _ckpt(spark, args, "ingest", args.table), trigger,
                      once_within=args.once_within).awaitTermination()


def live_alerts(spark, args):
    """Q4 as a consumer sees it: windows that open with a message and close with the first one ``--seconds`` later."""
    use_stream_partitions(spark, args.state_partitions)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    closed = W.live_windows(readings_from_messages(_messages(spark, args)), args.seconds, args.watermark)
    K.start_append(closed, args.out, _ckpt(spark, args, "live-alerts", args.out), trigger).awaitTermination()


def store_create(spark, args):
    DocumentStore.create(R.read_patient_documents(spark, args.patients, args.patients_format), args.store, args.buckets)


def patients_insert(spark, args):
    """K7 with P15 and P16: valid documents with new ids enter the store, the others are kept with their reasons."""
    told = DocumentStore(spark, args.store).insert(R.read_patient_documents(spark, args.patients, args.patients_format), args.batch)
    told.groupBy("accepted", "reasons").count().orderBy("accepted", "reasons").show(100, truncate=False)


def lookup_table(spark, args):
    lookup.write_lookup_table(R.read_readings_table(spark, args.readings), args.out, args.buckets)


def day_figures(spark, args):
    """A1-A8 by day: the figures of the named dates (all, if none is) from their partitions of the reading table."""
    days = [dt.date.fromisoformat(d) for d in args.day] if args.day else None
    daily_states.write_days(R.read_readings_table(spark, args.readings), args.states, days)


def expire(spark, args):
    """Drop the dates of a reading table whose readings have all expired."""
    now = args.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    gone = drop_expired(spark, args.table, now, args.days, args.written_at)
    print("dropped", ", ".join(map(str, gone)) or "nothing")


def compact(spark, args):
    print("compacted up to batch", K.compact_ingested(spark, args.table))


def _rewritten(spark, args, change):
    """Read patient documents, change them, and write them as a new folder (an existing one is refused)."""
    patients = R.read_patient_documents(spark, args.patients, args.patients_format)
    change(patients, spark.read.parquet(args.updates)).write.mode("errorifexists").parquet(args.out)


def _store(spark, args) -> DocumentStore | None:
    """The store that an update job changes in place; None if it writes a new folder."""
    if not getattr(args, "store", None):
        return None
    if args.batch is None:
        raise ValueError("an update of a store needs the number of its batch")
    return DocumentStore(spark, args.store)


def risk_update(spark, args):
    """Q6: apply a score table to every patient; in the store, or as a new folder of documents."""
    store = _store(spark, args)
    if store:
        store.update_scores(spark.read.parquet(args.updates), args.batch).show(truncate=False)
        return recent.ranked_high_risk(store.tables().documents).show(truncate=False)
    patients = R.read_patient_documents(spark, args.patients, args.patients_format)
    docs, summary = D.bulk_risk_update(patients, spark.read.parquet(args.updates))
    docs.write.mode("errorifexists").parquet(args.out)
    summary.show(truncate=False)
    recent.ranked_high_risk(spark.read.parquet(args.out)).show(truncate=False)


def profile_update(spark, args):
    """Q3: phone changes (patient_id, seq, phone)."""
    at = args.updated_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    store = _store(spark, args)
    if store:
        return store.update_profiles(spark.read.parquet(args.updates), at, args.batch)
    _rewritten(spark, args, lambda p, u: D.update_profiles(p, u, at))


def notes_update(spark, args):
    """Q3: medical notes (patient_id, seq, at, doctor, note)."""
    store = _store(spark, args)
    if store:
        return store.add_notes(spark.read.parquet(args.updates), args.batch)
    _rewritten(spark, args, D.add_medical_notes)


def route(spark, args):
    """All readings to one table, abnormal ones to a second as well."""
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    K.start_route(readings_from_messages(_messages(spark, args)), os.path.join(args.out, "all"),
                  os.path.join(args.out, "abnormal"), _ckpt(spark, args, "route", args.out), trigger).awaitTermination()


def last_readings(spark, args):
    """Q2: newest readings of one patient, with the status label."""
    if getattr(args, "lookup", None):
        out = lookup.lookup_last_n(spark, args.lookup, args.patient, args.n, args.metric)
    else:
        out = recent.last_n_readings(R.read_readings_table(spark, args.readings), args.patient, args.n, args.metric)
    out.withColumn("status", status_label()).show(args.n, truncate=False)


def main(argv=None):
    p = argparse.ArgumentParser(prog="vitalspark.jobs")
    p.add_argument("--checkpoints", default=None)
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("statistics")
    given = s.add_mutually_exclusive_group(required=True)
    given.add_argument("--readings")
    given.add_argument("--states", help="figures of each day in place of readings")
    s.add_argument("--format", default="parquet", choices=["parquet", "csv", "pipe"])
    s.add_argument("--first", default=None)
    s.add_argument("--last", default=None)
    s.add_argument("--reports", required=True)
    s.add_argument("--report-date", default=None)
    s.add_argument("--day", default=None, help="only readings of this date")

    for name in ("alerts", "ingest", "route", "live-alerts"):
        a = sub.add_parser(name)
        a.add_argument("--source", required=True, help="message folder, or 'kafka'")
        a.add_argument("--bootstrap", default="localhost:9092")
        a.add_argument("--topic", default="patient.monitoring.raw")
        a.add_argument("--starting", default="latest" if "alerts" in name else "earliest")
        a.add_argument("--max-files-per-trigger", type=int, default=None)
        a.add_argument("--max-offsets-per-trigger", type=int, default=None if name == "alerts" else 10_000_000,
                       help="bound of a micro-batch from the topic, also of the first one after a long stop")
        a.add_argument("--state-partitions", type=int, default=None,
                       help="shuffle partitions at the first start (default: the cluster's task slots)")
        if name == "alerts":
            a.add_argument("--out", required=True)
            a.add_argument("--window", default="1 minute")
            a.add_argument("--watermark", default="2 minutes")
            a.add_argument("--classify", action="store_true", help="flag the readings by the devices' metric table")
            a.add_argument("--parse-once", action="store_true",
                           help="read and parse the source once into OUT/readings; the three queries read that")
        else:
            a.add_argument("--table" if name == "ingest" else "--out", required=True)
            a.add_argument("--trigger", default="10 seconds")
            a.add_argument("--available-now", action="store_true")
        if name == "ingest":
            a.add_argument("--once-within", default=None, help="don't write messages again that are delivered again within this time")
        if name == "live-alerts":
            a.add_argument("--seconds", type=int, default=60)
            a.add_argument("--watermark", default="2 minutes")

    c = sub.add_parser("compact")
    c.add_argument("--table", required=True)

    for name in ("risk-update", "profile-update", "notes-update"):
        u = sub.add_parser(name)
        given = u.add_mutually_exclusive_group(required=True)
        given.add_argument("--store", help="a document store, changed in place")
        given.add_argument("--patients", help="a folder of documents; the changed ones go to --out")
        u.add_argument("--batch", type=int, default=None, help="number of the batch, with --store")
        u.add_argument("--patients-format", default="parquet")
        u.add_argument("--updates", "--scores", dest="updates", required=True)
        u.add_argument("--out", help="a new folder, with --patients")
        if name == "profile-update":
            u.add_argument("--updated-at", default=None)

    for name in ("store-create", "patients-insert"):
        d = sub.add_parser(name)
        d.add_argument("--store", required=True)
        d.add_argument("--patients", required=True)
        d.add_argument("--patients-format", default="parquet")
        if name == "store-create":
            d.add_argument("--buckets", type=int, default=64)
        else:
            d.add_argument("--batch", type=int, required=True)

    t = sub.add_parser("lookup-table")
    t.add_argument("--readings", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--buckets", type=int, default=lookup.BUCKETS)

    f = sub.add_parser("day-figures")
    f.add_argument("--readings", required=True)
    f.add_argument("--states", required=True)
    f.add_argument("--day", nargs="*", default=None)

    x = sub.add_parser("expire")
    x.add_argument("--table", required=True)
    x.add_argument("--as-of", default=None)
    x.add_argument("--days", type=int, default=RETENTION_DAYS)
    x.add_argument("--written-at", default=None)

    q = sub.add_parser("last-readings")
    given = q.add_mutually_exclusive_group(required=True)
    given.add_argument("--readings")
    given.add_argument("--lookup", help="a lookup table")
    q.add_argument("--patient", required=True)
    q.add_argument("--metric", default=None)
    q.add_argument("-n", type=int, default=20)

    args = p.parse_args(argv)
    if getattr(args, "patients", None) and "update" in args.job and not args.out:
        p.error("--patients needs --out")
    spark = _session(f"vitalspark-{args.job}")
    try:
        {"statistics": statistics, "alerts": alerts, "ingest": ingest, "compact": compact,
         "risk-update": risk_update, "profile-update": profile_update, "notes-update": notes_update, "route": route,
         "last-readings": last_readings, "live-alerts": live_alerts, "store-create": store_create, "patients-insert": patients_insert,
         "lookup-table": lookup_table, "day-figures": day_figures, "expire": expire}[args.job](spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
