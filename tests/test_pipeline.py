"""End to end: a date-partitioned nested export through the whole job."""

import glob
import json

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from trafficlens import schemas
from trafficlens.operators import sessionize as S
from trafficlens.plans.pipeline import run
from trafficlens.sources import fixtures as FX
from trafficlens.sources.tables import read_events


@pytest.fixture(scope="module")
def export(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("export") / "events")
    FX.ga_events(spark, SF001).write.partitionBy("event_date").parquet(path)
    return path


def test_schema_declared(spark, export):
    ev = read_events(spark, export, schema=schemas.GA_EVENTS)
    assert ev.schema.simpleString() == schemas.GA_EVENTS.simpleString()
    assert S.sessions_from_events(ev).schema.simpleString() == schemas.SESSIONS.simpleString()


def test_partition_pruning_and_pushdown(spark, export):
    ev = read_events(spark, export, schema=schemas.GA_EVENTS)
    s = S.sessions_from_events(ev, "2024-01-05", "2024-01-20")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "event_date#" in plan and ">= 2024-01-05" in plan and "<= 2024-01-20" in plan
    assert "PushedFilters: [In(event_name" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan  # no Python UDF
    # every hit of the range is kept
    flat = FX.ga_events(spark, SF001)
    assert s.count() == S.sessions_from_events(flat, "2024-01-05", "2024-01-20").count()


def test_pipeline_run(spark, export, tmp_path):
    ev = read_events(spark, export, schema=schemas.GA_EVENTS)
    out = run(spark, ev, str(tmp_path / "out"), signals=FX.signals(spark, SF001))
    n = out.classified.count()
    assert n == 364
    assert spark.read.option("header", True).csv(out.paths["cleaned_csv"]).count() == out.cleaned.count()
    assert spark.read.parquet(out.paths["payload"]).count() == n
    files = glob.glob(out.paths["summary"] + "/*.json")
    doc = json.loads(open(files[0]).read().splitlines()[0])
    assert doc["sessions"]["total_raw"] == n
    assert doc["sessions"]["total_cleaned"] + doc["sessions"]["bots_removed"] == n
    att = spark.read.parquet(out.paths["attribution"])
    assert att.count() >= 1
    panel = spark.read.parquet(out.paths["weekly_panel"])
    assert panel.select("geo").distinct().count() == 1 and panel.count() % 4 == 0
    assert set(out.classified.select("edge_score_source").distinct().toPandas().edge_score_source) == {"MEASURED", "IMPUTED"}


def test_pipeline_sample(spark, export, tmp_path):
    from trafficlens.config import PipelineConfig

    ev = read_events(spark, export, schema=schemas.GA_EVENTS)
    out = run(spark, ev, str(tmp_path / "out2"), cfg=PipelineConfig(n_sessions=100))
    assert out.classified.count() == 100
    assert out.classified.where(F.col("edge_score_source") == "MEASURED").count() == 0


def test_unlabelled_rows_carry_unknown_label(spark, export, tmp_path):
    from trafficlens.config import UNKNOWN_LABEL

    ev = read_events(spark, export, schema=schemas.GA_EVENTS)
    out = run(spark, ev, str(tmp_path / "out3"))
    assert {r[0] for r in out.classified.select("raw_traffic_label").distinct().collect()} == {UNKNOWN_LABEL}


def test_score_with_external_model(spark):
    """Arbitrary Python model applied in Arrow batches (mapInPandas-style path)."""
    from trafficlens.operators.classify import score_with_model

    df = FX.session_signals(spark, SF001)

    def predict(pdf):
        return ["Human" if s >= 0.62 else "bot" for s in pdf["edge_score"]]

    out = score_with_model(df, predict)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan
    n_h = out.where(F.col("prediction") == "Human").count()
    assert n_h == df.where(F.col("edge_score") >= 0.62).count()


def test_command_line(spark, export, tmp_path):
    from trafficlens.__main__ import main

    paths = main(["--events", export, "--out", str(tmp_path / "cli"), "--start", "2024-01-05", "--end", "2024-01-20"])
    assert spark.read.parquet(paths["payload"]).count() == 201  # DuckDB count of sessions in the range


def test_date_shards(spark, tmp_path):
    from trafficlens.sources.tables import read_date_shards

    base = tmp_path / "shards"
    ev = FX.ga_events(spark, SF001)
    for day in ("2024-01-04", "2024-01-05", "2024-01-07", "2024-01-09"):
        ev.where(F.col("event_date") == day).drop("event_date").write.parquet(str(base / f"events_{day.replace('-', '')}"))
    got = read_date_shards(spark, str(base), "2024-01-05", "2024-01-08")
    assert {str(r[0]) for r in got.select("event_date").distinct().collect()} == {"2024-01-05", "2024-01-07"}
    assert got.count() == ev.where(F.col("event_date").isin("2024-01-05", "2024-01-07")).count()
    assert S.sessions_from_events(got).count() > 0


def test_labelled_run_draws_and_spend(spark, export, tmp_path):
    """Labels kept through sessionising, accuracy and recall, posterior ROI and observed spend."""
    ev = read_events(spark, export, schema=schemas.GA_EVENTS)
    label = F.when(F.col("event_id") % 3 == 0, "Human").when(F.col("event_id") % 3 == 1, "Ad_Fraud")
    out = run(spark, ev.withColumn("raw_traffic_label", label), str(tmp_path / "out4"), labelled=True,
              draws=FX.roi_draws(spark, SF001), spend=FX.media_spend(spark, SF001).withColumn("geo", F.lit("national")))
    read = lambda k: spark.read.parquet(out.paths[k])
    right = out.classified.where(F.col("traffic_class") == F.col("raw_traffic_label")).count()
    acc = read("accuracy").first()
    assert acc.n == 364 and acc.accuracy == round(right / 364, 4)
    assert {r.true_class for r in read("recall").collect()} == {"Human", "LLM_Scraper", "Ad_Fraud"}
    assert read("top_sources").count() == 5 and read("edge_score_range").count() == 1
    assert read("channel_spend").count() >= 1 and read("panel_roi").count() >= 1
    assert all(r.posterior_used for r in read("roi_override").collect())
    doc = json.loads(open(glob.glob(out.paths["summary"] + "/*.json")[0]).read().splitlines()[0])
    assert doc["attribution"]["status"] == "posterior" and doc["attribution"]["media_spend_source"] == "observed" and doc["attribution"]["n_weeks_data"] >= 4
    assert all(c["posterior_used"] for c in doc["attribution"]["channels"])


def test_command_line_shards(spark, tmp_path):
    from trafficlens.__main__ import main

    base = tmp_path / "shards"
    ev = FX.ga_events(spark, SF001).withColumn("raw_traffic_label", F.lit("Human"))
    for day in ("2024-01-04", "2024-01-05", "2024-01-07"):
        ev.where(F.col("event_date") == day).drop("event_date").write.parquet(str(base / f"events_{day.replace('-', '')}"))
    paths = main(["--events", str(base), "--out", str(tmp_path / "cli2"), "--start", "2024-01-05", "--end", "2024-01-08",
                  "--shards", "--labelled"])
    want = S.sessions_from_events(ev, "2024-01-05", "2024-01-07").where(F.col("event_timestamp") >= "2024-01-05").count()
    assert 0 < spark.read.parquet(paths["payload"]).count() <= want
    assert spark.read.parquet(paths["accuracy"]).first().n == spark.read.parquet(paths["payload"]).count()


def test_export_without_event_id(spark):
    ev = FX.ga_events(spark, SF001)
    a, b = S.sessions_from_events(ev), S.sessions_from_events(ev.drop("event_id"))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_exact_medians(spark):
    import statistics

    from trafficlens.operators.classify import exact_medians

    vals = [float(i * i % 7919) / 3 for i in range(3001)] + [None, float("nan")]
    df = spark.createDataFrame([(v, 5.0 if v and v > 100 else None) for v in vals], "a double, b double")
    for n in (3003, 10, 4):
        part = df.limit(n)
        seen = [r.a for r in part.collect() if r.a is not None and r.a == r.a]
        got = exact_medians(part, {"a": F.col("a"), "none": F.lit(None)})
        assert got == {"a": statistics.median(seen), "none": None}
