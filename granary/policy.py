"""Business rules as one immutable object: vocabularies, limits, scales, weights and actions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping


@dataclass(frozen=True)
class Scale:
    """Ordered ``(comparison, bound, label)`` steps; the first that holds wins."""

    steps: tuple[tuple[str, float, str], ...]
    otherwise: str

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(label for _, _, label in self.steps) + (self.otherwise,)


def _frozen(**items) -> Mapping:
    return MappingProxyType(dict(items))


# The four unit-count scales, each with its own treatment of the bounds.
FOUR_TIER = Scale((("<=", 2, "CRITICAL"), ("<=", 5, "LOW"), ("<=", 10, "MODERATE")), "GOOD")
STOCK_OUT = Scale((("==", 0, "OUT_OF_STOCK"), ("<=", 5, "CRITICAL"), ("<=", 10, "LOW")), "AVAILABLE")
STRICT = Scale((("==", 0, "OUT_OF_STOCK"), ("<", 5, "CRITICAL"), ("<", 10, "LOW")), "AVAILABLE")
RECORD = Scale((("<=", 0, "CRITICAL"), ("<=", 5, "LOW"), ("<=", 20, "NORMAL")), "GOOD")


@dataclass(frozen=True)
class Policy:
    # Vocabularies.
    groups: tuple[str, ...] = ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-")
    watch_list: tuple[str, ...] = ("O-", "AB-", "B-", "A-")
    donation_statuses: tuple[str, ...] = ("Completed", "Cancelled", "Pending", "Rejected")
    counted_status: str = "Completed"
    count_only_completed: bool = True
    eligibility: tuple[str, ...] = ("Eligible", "Temporarily Ineligible", "Inactive", "Unknown")
    components: tuple[str, ...] = ("RBC", "Plasma", "Platelets")
    movement_types: tuple[str, ...] = (
        "DONATION", "ISSUE", "TRANSFER_IN", "TRANSFER_OUT", "EXPIRY", "ADJUSTMENT",
    )
    inflow_types: tuple[str, ...] = ("DONATION", "TRANSFER_IN", "ADJUSTMENT")
    shelf_days: Mapping[str, int] = field(
        default_factory=lambda: _frozen(RBC=42, Plasma=365, Platelets=5)
    )
    status_words: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: _frozen(
            Completed=("COMPLETED", "COMPLETE", "SUCCESSFUL", "SUCCESS"),
            Cancelled=("CANCELLED", "CANCELED"),
            Pending=("PENDING",),
            Rejected=("REJECTED",),
        )
    )
    # Patterns that turn the sign written as a word into a symbol, in order.
    code_rules: tuple[tuple[str, str], ...] = (
        (r"POSITIVE", "+"), (r"\bPOS\b", "+"), (r"NEGATIVE", "-"), (r"\bNEG\b", "-"), (r"\s+", ""),
    )

    # Limits.
    age_range: tuple[int, int] = (18, 65)
    units_range: tuple[int, int] = (1, 5)
    latitude_range: tuple[float, float] = (-90.0, 90.0)
    longitude_range: tuple[float, float] = (-180.0, 180.0)

    # Scales and the lookups keyed by their labels.
    four_tier: Scale = FOUR_TIER
    stock_out: Scale = STOCK_OUT
    strict: Scale = STRICT
    record: Scale = RECORD
    tier_actions: Mapping[str, str] = field(
        default_factory=lambda: _frozen(
            CRITICAL="Urgent donor mobilization required",
            LOW="Targeted donation campaign recommended",
            MODERATE="Continue monitoring",
            GOOD="No immediate action required",
        )
    )
    tier_priority: Mapping[str, int] = field(
        default_factory=lambda: _frozen(CRITICAL=100, LOW=75, MODERATE=40, GOOD=10)
    )
    spread_discount_cap: int = 10
    severity: Mapping[str, int] = field(
        default_factory=lambda: _frozen(OUT_OF_STOCK=3, CRITICAL=2, LOW=1, AVAILABLE=0)
    )

    # Ledger scoring.
    expiring_soon_days: int = 3
    demand_floor: float = 0.1
    trend_days: int = 30
    surplus_units: int = 5
    weights: Mapping[str, float] = field(
        default_factory=lambda: _frozen(stock=0.40, coverage=0.30, expiry=0.15, trend=0.15)
    )
    stock_points: tuple[tuple[str, float, int], ...] = (
        ("==", 0, 100), ("<=", 5, 90), ("<=", 10, 60), ("<=", 20, 30),
    )
    coverage_points: tuple[tuple[str, float, int], ...] = (("<", 1.0, 100), ("<", 3.0, 70), ("<", 7.0, 35))
    calm_points: int = 10
    unknown_demand_points: int = 50
    expiry_points: Mapping[str, int] = field(default_factory=lambda: _frozen(EXPIRED=100, EXPIRING_SOON=60))
    priority_bands: Scale = Scale(
        (("<=", 20, "HEALTHY"), ("<=", 40, "MONITOR"), ("<=", 60, "LOW"), ("<=", 80, "CRITICAL")), "EMERGENCY"
    )
    priority_actions: Mapping[str, str] = field(
        default_factory=lambda: _frozen(
            EMERGENCY="Urgent donor mobilization and inter-bank transfer required immediately.",
            CRITICAL="Initiate transfer from a nearby bank with surplus and launch a targeted donation campaign.",
            LOW="Schedule a targeted donation campaign within the next few days.",
            MONITOR="Continue monitoring; no immediate action required.",
            HEALTHY="No action required.",
        )
    )
    expiry_order: tuple[str, ...] = ("VALID", "EXPIRING_SOON", "EXPIRED")
    priority_order: tuple[str, ...] = ("EMERGENCY", "CRITICAL", "LOW", "MONITOR", "HEALTHY")

    # The day that stands for "today".
    as_of: dt.date = dt.date(2026, 1, 1)


DEFAULT_POLICY = Policy()
