"""Flags and windows must not depend on the JVM's zone: run a separate
Spark JVM in America/New_York and compare with DuckDB (UTC semantics)."""

import json
import os
import subprocess
import sys

import duckdb
from conftest import ROOT, SF_SMALL

from __spark_entry__ import oracle_sql

SCRIPT = r"""
import json, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.extraJavaOptions", "-Duser.timezone=America/New_York")
         .getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from __spark_entry__ import queries
q = queries()
flags = [[r.event_id, r.is_peak_hour, r.is_weekend] for r in q["q06_enrich_flags"](spark, {sf!r}).collect()]
wins = [[r.window_start.isoformat(), r.store_id, r.zone_id, r.visitor_count]
        for r in q["q07_traffic_stats"](spark, {sf!r}).collect()]
print("RESULT" + json.dumps({{"flags": flags, "windows": wins}}))
"""


def test_results_independent_of_jvm_time_zone():
    env = dict(os.environ, TZ="America/New_York", PYSPARK_PYTHON=sys.executable)
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT, sf=SF_SMALL)],
        capture_output=True, text=True, env=env, timeout=600,
    )
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    got = json.loads(line[0][len("RESULT"):])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    flags = con.execute(f"SELECT event_id, is_peak_hour, is_weekend FROM ({oracle_sql()['q06_enrich_flags']})").fetchall()
    assert sorted(map(tuple, got["flags"])) == sorted(flags)
    wins = con.execute(
        f"SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%S'), store_id, zone_id, visitor_count "
        f"FROM ({oracle_sql()['q07_traffic_stats']})").fetchall()
    assert sorted(map(tuple, got["windows"])) == sorted(wins)
