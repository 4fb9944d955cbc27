"""Business rules: coordinate bounds, bucket thresholds and data-quality limits.

All operators take a ``Rules`` instance, so the thresholds live in one place
and are actually used (bounds, buckets and gate limits are never repeated as
literals in operator code).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the reference pipeline's business rules for
# the results to agree.
#   coordinate bounds         lat in [-34.0, 6.0], lng in [-74.0, -28.0]
#   delivery speed buckets    FAST <= 7, NORMAL <= 14, SLOW <= 30, else VERY_SLOW,
#                             unknown days -> UNKNOWN
#   late severity buckets     MINOR <= 3, MODERATE <= 7, SEVERE <= 14, else CRITICAL
#   data-quality limits       max null rate 5.0 %, min key match 95.0 %,
#                             max delivery days 365
#   late-rate bands           > 15 HIGH, > 8 MEDIUM, else LOW
#   timestamp text format     yyyy-MM-dd HH:mm:ss
#   lineage tag               OLIST_BRONZE_v1
#   delivered status value    delivered
#   missing-delivery reasons  DATA_QUALITY_ISSUE (delivered status), NOT_YET_DELIVERED
# ---------------------------------------------------------------------------
LAT_MIN = -34.0
LAT_MAX = 6.0
LNG_MIN = -74.0
LNG_MAX = -28.0
SPEED_STEPS = (("FAST", 7), ("NORMAL", 14), ("SLOW", 30))
SPEED_OVER = "VERY_SLOW"
SPEED_UNKNOWN = "UNKNOWN"
SEVERITY_STEPS = (("MINOR", 3), ("MODERATE", 7), ("SEVERE", 14))
SEVERITY_OVER = "CRITICAL"
MAX_NULL_RATE_PCT = 5.0
MIN_MATCH_RATE_PCT = 95.0
MAX_DELIVERY_DAYS = 365
LATE_RATE_BANDS = (("HIGH", 15.0), ("MEDIUM", 8.0))
LATE_RATE_BAND_ELSE = "LOW"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
LENIENT_TIMESTAMP_FORMATS = ("yyyy-M-d H:m:s", "yyyy-M-d H:m:s.SSS")
LINEAGE_TAG = "OLIST_BRONZE_v1"
DELIVERED = "delivered"
NULL_REASON_DATA_QUALITY = "DATA_QUALITY_ISSUE"
NULL_REASON_NOT_DELIVERED = "NOT_YET_DELIVERED"


@dataclass(frozen=True)
class Rules:
    lat_min: float = LAT_MIN
    lat_max: float = LAT_MAX
    lng_min: float = LNG_MIN
    lng_max: float = LNG_MAX
    speed_steps: tuple = SPEED_STEPS
    speed_over: str = SPEED_OVER
    speed_unknown: str = SPEED_UNKNOWN
    severity_steps: tuple = SEVERITY_STEPS
    severity_over: str = SEVERITY_OVER
    max_null_rate_pct: float = MAX_NULL_RATE_PCT
    min_match_rate_pct: float = MIN_MATCH_RATE_PCT
    max_delivery_days: int = MAX_DELIVERY_DAYS
    late_rate_bands: tuple = LATE_RATE_BANDS
    late_rate_band_else: str = LATE_RATE_BAND_ELSE
    timestamp_formats: tuple = (TIMESTAMP_FORMAT,)
    lineage_tag: str = LINEAGE_TAG
    delivered_status: str = DELIVERED
    null_reason_data_quality: str = NULL_REASON_DATA_QUALITY
    null_reason_not_delivered: str = NULL_REASON_NOT_DELIVERED
    # Other ways in which the original's lenient parser reads a timestamp (compat mode).
    lenient_timestamp_formats: tuple = LENIENT_TIMESTAMP_FORMATS
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if not (self.lat_min < self.lat_max and self.lng_min < self.lng_max):
            raise ValueError("coordinate bounds must be ordered")
        for steps in (self.speed_steps, self.severity_steps):
            uppers = [u for _, u in steps]
            if uppers != sorted(uppers) or len(set(uppers)) != len(uppers):
                raise ValueError(f"bucket thresholds must increase: {steps}")
        if not (0 < self.max_null_rate_pct < 100 and 0 < self.min_match_rate_pct < 100):
            raise ValueError("data-quality percentages must lie in (0, 100)")
        if self.max_delivery_days <= 0:
            raise ValueError("max_delivery_days must be positive")


DEFAULT_RULES = Rules()
