"""The whole job: sessionise -> enrich -> classify -> clean -> attribute ->
summarise, writing every output to storage.

The classified sessions feed six outputs, so they are checkpointed once to
the shared checkpoint folder (``spark.checkpoint.dir``): later stages read
that copy instead of re-running the scan and the session shuffle, and a lost
executor only costs the stage that was running.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import channels as CH
from ..operators import classify as CL
from ..operators import clean as CN
from ..operators import panel as P
from ..operators import report as R
from ..operators import sessionize as S
from ..operators import signals as SG
from ..operators import user_map as UM
from ..session import apply_defaults, ensure_checkpoint_dir
from ..sources import sinks
from ..sources.tables import require_rows


@dataclass
class Outputs:
    classified: DataFrame
    cleaned: DataFrame
    attribution: DataFrame
    summary: DataFrame
    paths: dict


def run(spark: SparkSession, events: DataFrame, out_dir: str, signals: DataFrame | None = None,
        cfg: C.PipelineConfig = C.PipelineConfig(), labelled: bool = False, draws: DataFrame | None = None,
        spend: DataFrame | None = None, channel_map: DataFrame | None = None) -> Outputs:
    """Run the pipeline on a hit-level event DataFrame (export schema).

    ``labelled``: the hits carry ``raw_traffic_label``, the class of their
    session; accuracy and recall are written. ``draws`` (channel, roi):
    posterior ROI. ``spend`` (geo, week, channel, spend): observed media spend,
    which the panel's KPI is fitted on. ``channel_map`` (key, name, priority): the
    user's own channels, of which sessions and value are reported."""
    apply_defaults(spark)
    ensure_checkpoint_dir(spark)
    sessions = S.normalize_sessions(S.sessions_from_events(events, cfg.date_start, cfg.date_end, label=CL.LABEL if labelled else None))
    if cfg.n_sessions:
        sessions = S.sample_sessions(sessions, cfg.n_sessions, cfg.sample_seed)
    enriched = SG.enrich(sessions, signals, cfg.tiers)
    if not labelled and CL.LABEL not in enriched.columns:
        enriched = enriched.withColumn(CL.LABEL, F.lit(C.UNKNOWN_LABEL))
    classified = CL.classify_sessions(enriched, cfg.thresholds)
    # reliable checkpoint on shared storage: cuts lineage, survives executor loss
    classified = require_rows(classified.checkpoint(eager=True), "session query")
    return publish(classified, out_dir, cfg, labelled, draws=draws, spend=spend, channel_map=channel_map)


def publish(classified: DataFrame, out_dir: str, cfg: C.PipelineConfig = C.PipelineConfig(),
            labelled: bool = False, data_source: str = "hit-level event export", draws: DataFrame | None = None,
            spend: DataFrame | None = None, channel_map: DataFrame | None = None) -> Outputs:
    """Write all outputs of an already classified session table."""
    out = out_dir.rstrip("/")
    paths = {
        "raw_csv": f"{out}/raw_sessions_csv",
        "cleaned_csv": f"{out}/cleaned_sessions_csv",
        "payload": f"{out}/vbb_upload_payload",
        "attribution": f"{out}/channel_attribution",
        "summary": f"{out}/summary_json",
    }
    sinks.write_csv(classified, paths["raw_csv"])
    cleaned = CN.cleaned_sessions(classified)
    sinks.write_csv(cleaned, paths["cleaned_csv"])
    sinks.write_parquet(CN.vbb_upload_payload(classified), paths["payload"])
    attribution = CH.channel_attribution(classified)
    sinks.write_parquet(attribution, paths["attribution"])
    paths["weekly_panel"] = f"{out}/weekly_channel_panel"
    panel = P.weekly_channel_panel(cleaned, geo_col=cfg.panel_geo, start=cfg.date_start, end=cfg.date_end)
    sinks.write_parquet(panel, paths["weekly_panel"])
    reports = {"top_sources": S.top_sources(classified, cfg.top_sources), "edge_score_range": SG.edge_score_range(classified),
               "channel_spend": CH.channel_spend(classified)}
    if draws is not None:
        reports["roi_override"] = P.roi_override(classified, draws)
    if spend is not None:
        reports["panel_roi"] = P.panel_roi(panel, spend)
        reports["panel_roi_joint"] = P.panel_roi_joint(panel, spend)
    if channel_map is not None:
        reports["user_channels"] = CH.channel_stats(UM.with_channel_of_table(classified, channel_map))
    if labelled:
        reports["accuracy"] = CL.classification_accuracy(classified)
        reports["recall"] = CL.per_class_recall(classified)
    for name, df in reports.items():
        paths[name] = f"{out}/{name if name != 'recall' else 'per_class_recall'}"
        sinks.write_parquet(df, paths[name])
    summary = R.summary_document(classified, mode="labelled" if labelled else "batch", days=cfg.daily_days,
                                 data_source=data_source, draws=draws,
                                 media_spend_source="observed" if spend is not None else "derived from ROAS")
    sinks.write_json(summary, paths["summary"])
    return Outputs(classified, cleaned, attribution, summary, paths)
