"""Plan guards for every registered query: no cross / nested-loop joins, no
Python UDF evaluation, no hinted broadcasts, and filters / column pruning
reaching the Parquet scan."""

import pytest

import __spark_entry__ as E
from marketlake.operators import indicators as ind
from marketlake.plans import standins as si
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_forbidden_operators(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = plan_of(df)
    for node in FORBIDDEN:
        assert node not in plan, (name, node)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in logical.lower() and "BROADCAST" not in logical


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["latest_n"](spark, SF_SMALL)
    plan = plan_of(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_bucketed_indicators_exchanges(spark):
    c = si.candles(si.events(spark, SF_SMALL))
    plan = plan_of(ind.add_indicators(c, strategy="bucketed", bucket_rows=64))
    # bars aggregate (x2: reused), dedup (x2: reused), (series, day) (x2: reused),
    # day totals by series, bucket window
    assert "hashpartitioning(symbol#" in plan
    assert plan.count("Exchange hashpartitioning") <= 8
