"""Counts of written stages, one-scan suites, and the feed in one pass."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from placeframe.operators import check_accepted_values, check_not_null, check_unique, run_suite
from placeframe.sources import page_record_lines, staged_page_lines

RETRY = """
import sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from placeframe.plans import standin as si
from placeframe.plans.enrichment import run_enrichment
from placeframe.session import build_session, fresh_dir
spark = build_session("local[2,4]", shuffle_partitions=4)
raw = si.raw_locations(spark, {sf!r}).repartition(4)

def flaky(batches):  # every task dies once, after its rows
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

weather = si.weather_records(spark, {sf!r})
failing = raw.mapInArrow(flaky, raw.schema)
got = run_enrichment(failing, weather, fresh_dir(spark, "o"), stage_dir=fresh_dir(spark, "s"))
want = run_enrichment(raw, weather, fresh_dir(spark, "o"))
assert spark.sparkContext.statusTracker is not None
print("SAME" if got == want else (got, want), got)
"""


def test_counts_are_right_after_every_task_was_repeated():
    from tests.conftest import SF_SMALL

    code = RETRY.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), sf=SF_SMALL)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.stdout.startswith("SAME"), done.stdout + done.stderr[-2000:]
    assert "'raw_locations': {'n': 150}" in done.stdout


def test_suite_scans_a_model_once(spark, scratch):
    rows = [(i % 7 or None, f"k{i % 5}", None if i % 3 else "x", float(i)) for i in range(60)]
    spark.createDataFrame(rows, "a long, b string, c string, d double").write.parquet(scratch)
    df = spark.read.parquet(scratch)
    unique = [("m", c) for c in "abcd"]
    not_null = [("m", c) for c in "abcd"]
    accepted = [("m", "b", ("k0", "k1")), ("m", "c", ("x",)), ("m", "d", (1.0,))]
    report = run_suite({"m": df}, unique, not_null, accepted)
    got = {(r.column_name, r.test): (r.failures, r.status) for r in report.collect()}
    want = {(c, "unique"): check_unique(df, c).count() for c in "abcd"}
    want |= {(c, "not_null"): check_not_null(df, c).count() for c in "abcd"}
    want |= {(c, "accepted_values"): check_accepted_values(df, c, v).count() for _, c, v in accepted}
    assert got == {k: (n, "pass" if n == 0 else "fail") for k, n in want.items()}
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert {(r.test, r.failures) for r in run_suite({"m": df.limit(0)}, unique, not_null, accepted).collect()} == {(t, 0) for t in ("unique", "not_null", "accepted_values")}


def test_feed_in_one_pass(spark, scratch):
    import pytest

    bodies = ['[{"id":1},{"id":2,"more":{"x":[1]}}]', '[{"id":3}]', "[]", "{oops", '[{"id":9}]', "[]"]
    pages = spark.createDataFrame(list(enumerate(bodies, 1)), "page long, body string")
    pages.write.parquet(f"{scratch}/pages")
    read = spark.read.parquet(f"{scratch}/pages")
    one = staged_page_lines(read, f"{scratch}/staged")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, page_record_lines(read).collect())) == [(1, '{"id":1}'), (1, '{"id":2,"more":{"x":[1]}}'), (2, '{"id":3}')]
    assert not any("/pages/" in f for f in one.inputFiles())  # the pages aren't read again
    with pytest.raises(Exception, match="page 4 holds no JSON array"):
        staged_page_lines(read.filter("page <> 3"), f"{scratch}/staged-2").collect()
    with pytest.raises(Exception, match="page 1 holds no JSON array"):
        staged_page_lines(spark.createDataFrame([(1, None), (2, "[]")], "page long, body string"), f"{scratch}/staged-3").collect()
    assert staged_page_lines(read.limit(0), f"{scratch}/staged-4").collect() == []
    twice = staged_page_lines(read.withColumn("body", F.lit("[]")), f"{scratch}/staged-5")
    assert twice.collect() == []
