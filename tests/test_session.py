"""The folder for intermediate tables: the session's setting where there is one, else one of our own on a local master."""

import os
import subprocess
import sys
import textwrap

from conftest import ROOT


def run(body, master="local[1]", conf=()):
    options = "".join(f".config({k!r}, {v!r})" for k, v in conf)
    script = textwrap.dedent(f"""
        from pyspark.sql import SparkSession
        from vitalspark.session import ensure_checkpoint_dir, materialize, work_path
        spark = SparkSession.builder.master({master!r}).config("spark.ui.enabled", "false"){options}.getOrCreate()
        """) + textwrap.dedent(body)
    # no defaults of the machine's own
    env = {**os.environ, "PYTHONPATH": ROOT, "SPARK_CONF_DIR": os.path.join(ROOT, "tests", "no-such-conf")}
    return subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=120)


def test_without_the_setting_on_a_local_master():
    done = run("""
        first = ensure_checkpoint_dir(spark)
        assert first and ensure_checkpoint_dir(spark) == first and work_path(spark, "x").startswith(first)
        assert materialize(spark.range(3), "numbers").count() == 3
        print("fine")
        """)
    assert "fine" in done.stdout, done.stderr[-2000:]


def test_the_setting_is_read(tmp_path):
    done = run("print('found', work_path(spark, 'x'))", conf=[("spark.checkpoint.dir", str(tmp_path))])
    assert f"found {tmp_path}/vitalspark/x/" in done.stdout, done.stderr[-2000:]
