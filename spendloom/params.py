"""Tolerances of the alert rules and two scale settings."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Alert tolerances (fixed default values).
    pacing_tolerance_pct: float = 10.0
    reconciliation_tolerance_pct: float = 2.0
    cpa_spike_ratio: float = 1.3
    cpa_spike_min_conversions: float = 20
    # A campaign-day with at least this many plan or platform rows is joined in slices of so many.
    hot_key_rows: int = 1_000_000
    # Slices of a hot client, and so copies of a client's one row, in a salted join.
    salts: int = 64
