"""Configuration of the traffic-quality pipeline.

Everything a deployment may want to change lives here: lookup tables,
classifier thresholds, the event allow-list, sizes of windows and gaps.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values. These must equal the published behaviour for identical
# results; they are stated here plainly, in their natural order.
# --------------------------------------------------------------------------

# Event names kept before sessionisation.
EVENT_ALLOWLIST = (
    "page_view",
    "session_start",
    "scroll",
    "click",
    "user_engagement",
    "purchase",
    "add_to_cart",
    "view_item",
)

# Event names counted as clicks and as scrolls.
CLICK_EVENTS = ("click", "user_engagement")
SCROLL_EVENTS = ("scroll",)

# Defaults used when a nested field is missing.
DEFAULT_SOURCE = "(direct)"
DEFAULT_MEDIUM = "(none)"
DEFAULT_COUNTRY = "Unknown"
DEFAULT_DEVICE = "desktop"
DEFAULT_PAGE = "/"
DEFAULT_VELOCITY = 1.0

# Conversion value per exact, case-sensitive source / medium.
CONV_VALUES = (
    ("google / cpc", 150.00),
    ("meta / paid_social", 120.00),
    ("bing / cpc", 90.00),
    ("direct / (none)", 200.00),
    ("programmatic / display", 60.00),
    ("(direct) / (none)", 200.00),
    ("google / organic", 180.00),
)
DEFAULT_CONV_VALUE = 100.00

# Channel display name by lower-cased substring, tried in this order.
CHANNEL_NAMES = (
    ("google / cpc", "Google Ads"),
    ("meta / paid_social", "Meta Ads"),
    ("bing / cpc", "Bing Ads"),
    ("programmatic / display", "Display"),
    ("direct / (none)", "Direct"),
    ("(direct) / (none)", "Direct"),
    ("google / organic", "Organic"),
    ("google / organic search", "Organic"),
)
OTHER_CHANNEL = "Other"

# Paid channels, in reporting order.
PAID_CHANNELS = ("Google Ads", "Meta Ads", "Bing Ads", "Display")

# Assumed return on ad spend per paid channel.
CHANNEL_ROAS = (
    ("Google Ads", 4.0),
    ("Meta Ads", 3.2),
    ("Bing Ads", 3.5),
    ("Display", 2.5),
)
DEFAULT_ROAS = 3.0

# Cost per click used for "spend saved".
CPC_USD = 2.40

# Class labels.
HUMAN = "Human"
SCRAPER = "LLM_Scraper"
FRAUD = "Ad_Fraud"
CLASSES = (HUMAN, SCRAPER, FRAUD)

# Insight text by bot inflation percent (>= 40, >= 20, else).
INSIGHT_HIGH = "High bot inflation -- calibrated lift significantly below raw"
INSIGHT_MODERATE = "Moderate bot inflation -- calibrated view recommended for bidding"
INSIGHT_LOW = "Low bot contamination -- raw signal relatively reliable"
INSIGHT_HIGH_AT = 40.0
INSIGHT_MODERATE_AT = 20.0

# Per-class feature ranges published with the architecture brief
# (edge score, velocity, duration, mouse moves); used by the profile match.
# (class, feature, low, high); open ends are None.
FEATURE_PROFILES = (
    (HUMAN, "edge_score", 0.65, None),
    (HUMAN, "event_velocity_per_sec", 1.0, 5.0),
    (HUMAN, "session_duration_sec", 45.0, 600.0),
    (HUMAN, "mouse_move_events", 20.0, 250.0),
    (SCRAPER, "edge_score", 0.15, 0.48),
    (SCRAPER, "event_velocity_per_sec", 8.0, 35.0),
    (SCRAPER, "session_duration_sec", 0.0, 6.0),
    (SCRAPER, "mouse_move_events", 0.0, 0.0),
    (FRAUD, "edge_score", None, 0.20),
    (FRAUD, "event_velocity_per_sec", 30.0, 80.0),
    (FRAUD, "session_duration_sec", 0.0, 3.0),
    (FRAUD, "mouse_move_events", 0.0, 0.0),
)

# Known automated user-agent signatures (case-insensitive regex).
BOT_UA_PATTERN = r"(?i)(gptbot|claudebot|bot/|crawler|spider|headless)"

# Model features, in order.
FEATURES = (
    "edge_score",
    "event_velocity_per_sec",
    "session_duration_sec",
    "mouse_move_events",
)

# Ground-truth label written on unlabelled (real) traffic.
UNKNOWN_LABEL = "UNKNOWN (real data)"

# Provenance labels of enrichment columns.
MEASURED = "MEASURED"
IMPUTED = "IMPUTED"


@dataclass(frozen=True)
class Thresholds:
    """Classifier cascade limits (first match wins)."""

    fraud_score: float = 0.20
    fraud_velocity: float = 20.0
    scraper_score: float = 0.48
    scraper_velocity: float = 8.0
    scraper_duration: float = 10.0
    human_score: float = 0.55
    human_velocity: float = 5.0
    human_duration: float = 30.0
    human_score_any: float = 0.62
    scraper_score_any: float = 0.38


@dataclass(frozen=True)
class TierRules:
    """Behaviour tiers that choose the imputed edge score."""

    engaged_duration: float = 30.0
    engaged_velocity: float = 5.0
    bursty_duration: float = 2.0
    bursty_velocity: float = 15.0
    display_keys: tuple = ("programmatic", "display")
    # Mean of the Beta(a, b) distribution per tier: a / (a + b).
    engaged_beta: tuple = (8, 2)
    bursty_display_beta: tuple = (1, 8)
    bursty_beta: tuple = (2, 6)
    mixed_beta: tuple = (5, 4)
    mouse_floor: int = 5
    mouse_low_share: float = 0.3
    mouse_high_share: float = 0.8
    mouse_cap: int = 300


@dataclass(frozen=True)
class SignatureRules:
    """Bot signature flags."""

    low_score: float = 0.4
    high_velocity: float = 15.0
    short_duration: float = 5.0


# Starting centres of the k-means query, one per class, in the order of FEATURES.
KMEANS_START = ((0.8, 1.0, 60.0, 100.0), (0.4, 12.0, 30.0, 0.0), (0.1, 18.0, 90.0, 0.0))


# The columns of the cleaned export, in order; those present are kept.
EXPORT_COLUMNS = (
    "client_id", "event_timestamp", "source_medium", "geo_country", "device_category",
    "landing_page", "edge_score", "session_duration_sec", "event_velocity_per_sec",
    "page_scroll_depth_pct", "click_events", "scroll_events", "mouse_move_events",
    "traffic_class", "conversion_value_usd",
)


@dataclass(frozen=True)
class PipelineConfig:
    date_start: str | None = None
    date_end: str | None = None
    sample_seed: str = "42"
    n_sessions: int | None = None
    session_gap: str = "30 minutes"
    session_span: str = "5 minutes"
    watermark: str = "1 hour"
    cadence_window: str = "1 minute"
    tumbling_window: str = "1 hour"
    training_days: int = 30
    daily_days: int = 7
    top_sources: int = 5
    panel_geo: str | None = None  # None: one geo named "national"
    thresholds: Thresholds = field(default_factory=Thresholds)
    tiers: TierRules = field(default_factory=TierRules)
