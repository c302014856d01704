"""Plan guards for every registered query: no row-at-a-time Python UDF, no
Cartesian product or nested-loop join, Python only where it is meant to be."""

import pytest
from conftest import SF001

from trafficlens.plans.queries import QUERIES as QS

PYTHON_MODELS = {"model_scores", "isolation_scores"}
BUILT_AT_CALL = {"csv_roundtrip_clean", "stream_gap_sessions", "stream_tumbling_value", "stream_classify", "stream_late_rows", "raw_csv",
                 "stream_attach_signals", "stream_upsert_feed"}


@pytest.mark.parametrize("name", sorted(QS))
def test_plan_shape(spark, name):
    df = QS[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad
    assert "MapInArrow" not in plan and "RoundRobinPartitioning" not in plan
    assert ("MapInPandas" in plan) == (name in PYTHON_MODELS)
    if name not in BUILT_AT_CALL:
        assert "Scan parquet" in plan or "Scan ExistingRDD" in plan  # reads the driver tables


def files_read(df):
    """Files of each scan after running the query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, out = [plan], []
    while todo:
        p = todo.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            p = p.executedPlan()
        if "Stage" in p.getClass().getSimpleName() and "CodegenExec" not in p.getClass().getSimpleName():
            todo.append(p.plan())
        todo += [p.children().apply(i) for i in range(p.children().size())]
        m = p.metrics()
        if "Scan parquet" in p.nodeName() and m.contains("numFiles"):
            out.append((p.metadata().apply("PartitionFilters"), m.apply("numFiles").value()))
    return out


def test_date_range_reads_only_its_folders(spark):
    from trafficlens.plans import queries as Q

    hits = Q._by_day(spark, SF001)
    every = files_read(hits.select("event_id"))[0][1]
    (filters, own), = files_read(Q.scan_date_range(hits, "2024-01-05", "2024-01-06").select("event_id"))
    assert "event_date" in filters and ">= 2024-01-05" in filters and own <= 2 * 4 < every


def test_days_found_at_run_time_prune_folders(spark):
    """Dynamic pruning: the days come from a filter on the other table."""
    from trafficlens.plans import queries as Q
    from trafficlens.session import scratch_path

    hits = Q._by_day(spark, SF001)
    path = scratch_path(spark, "t-days")
    spark.sql("SELECT DATE '2024-01-05' AS event_date, 1 AS n UNION ALL SELECT DATE '2024-01-09', 2 UNION ALL SELECT DATE '2024-01-10', 9").write.parquet(path)
    out = Q.scan_days(hits, spark.read.parquet(path).where("n < 5")).select("event_id", "event_date")
    assert {str(r.event_date) for r in out.select("event_date").distinct().collect()} == {"2024-01-05", "2024-01-09"}
    pruned = [(f, n) for f, n in files_read(out) if "dynamicpruning" in f]
    assert len(pruned) == 1 and pruned[0][1] <= 2 * 4


def test_shards_outside_the_range_are_not_listed(spark):
    from trafficlens.plans import queries as Q

    out = Q.q_scan_date_shards(spark, SF001)
    files = {f.rsplit("shard=", 1)[1][:8] for f in out.inputFiles()}
    assert files and min(files) >= "20240105" and max(files) <= "20240120"
