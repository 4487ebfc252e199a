"""Plan-shape assertions: pushdown, pruning, no Python in the plan, the
fact join broadcasts the written summary."""

import io
from contextlib import redirect_stdout


from placeframe.plans.registry import QUERIES
from placeframe.operators import clean_locations
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_reach_the_scan(spark, scratch):
    from placeframe.plans import standin

    standin.raw_locations(spark, SF_SMALL).write.parquet(scratch)
    df = clean_locations(spark.read.parquet(scratch)).select("brewery_id", "state")
    p = plan_of(df)
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters")][0]
    for f in ("IsNotNull(name)", "IsNotNull(state)", "Or(EqualTo(country,United States),IsNull(country))"):
        assert f in pushed
    assert "ReadSchema: struct<id:string,name:string,state:string,country:string>" in p


def test_no_python_or_cross_join_in_any_key(spark):
    for key, fn in QUERIES.items():
        p = plan_of(fn(spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (key, bad)


def test_fact_broadcasts_measured_summary(spark):
    p = plan_of(QUERIES["fact_location_weather"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p
    assert "SortMergeJoin" not in p


def test_top_groups_is_take_ordered(spark):
    df = QUERIES["top_groups"](spark, SF_SMALL)
    df.collect()
    assert "TakeOrderedAndProject" in plan_of(df)


def test_window_filter_pushed_below_daily_aggregate(spark):
    p = plan_of(QUERIES["trailing_window"](spark, SF_SMALL))
    # the date filter is applied to raw events before the per-day shuffle:
    # its node number is below that of the first (partial) aggregate
    import re

    sections = re.split(r"\n\((\d+)\) ", p)
    nodes = {int(sections[i]): sections[i + 1] for i in range(1, len(sections) - 1, 2)}
    filt = min(n for n, body in nodes.items() if body.startswith("Filter") and "date_sub" in body)
    first_agg = min(n for n, body in nodes.items() if body.startswith("HashAggregate"))
    assert filt < first_agg


def test_window_bounds_reach_the_reader(spark, scratch):
    import datetime as dt

    from placeframe.operators import trailing_window

    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), i) for i in range(31)]
    spark.createDataFrame(days, "obs_date date, v int").write.parquet(scratch)
    df = trailing_window(spark.read.parquet(scratch), "obs_date", as_of="2024-01-20")
    assert df.count() == 8
    pushed = [x for x in plan_of(df).splitlines() if "PushedFilters" in x][0]
    assert "GreaterThanOrEqual(obs_date,2024-01-13)" in pushed and "LessThanOrEqual(obs_date,2024-01-20)" in pushed
