"""Run parameters and their defaults."""

from __future__ import annotations

# Defaults of the public run parameters.
DEFAULTS = {
    "date_spine_start": "2020-01-01",
    "date_spine_end": "2026-12-31",
    "halloween_analysis_start_date": "2023-01-01",
    "min_satisfaction_rating": 3,
    "lookback_days": 90,
    "spend_tier_high": 300,
    "spend_tier_mid": 100,
    "dev_lookback_days": 3,
    "drift_mode": "baseline",
    "cluster_columns": ["visit_date", "ticket_type"],
    "dev_row_limit": None,
    "use_new_pricing_model": False,
    "strict_validation": False,
    "exception_mode": "safe",
    "environment": "dev",
    "daily_revenue_start": "2024-01-01",
    "as_of": None,
}


def with_defaults(params: dict | None = None) -> dict:
    unknown = set(params or {}) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    return {**DEFAULTS, **(params or {})}
