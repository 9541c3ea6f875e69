"""A three-week engagement in which every alert rule has one campaign that breaks it.

Flight 3 to 23 March 2025. Platforms and web report to the 19th, the CRM to the 18th. A sound
campaign spends its plan evenly; each other one departs from that in the fields it names.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from spendloom.schemas import EXTRACTS, GATE
from spendloom.sources.extracts import stamp_loaded

START, END = date(2025, 3, 3), date(2025, 3, 23)
PLATFORM_TO, CRM_TO = date(2025, 3, 19), date(2025, 3, 18)
FLIGHT = [START + timedelta(days=i) for i in range((END - START).days + 1)]
REPORTED = [d for d in FLIGHT if d <= PLATFORM_TO]
LOADED = datetime(2025, 3, 20, 4, 30, 0)
DAILY = 600.0
CEILING = 250_000.0


@dataclass(frozen=True)
class Campaign:
    name: str
    channel: str
    approval: str | None
    daily_spend: float = DAILY
    budget: float = DAILY * len(FLIGHT)
    late_claims: float = 24.0  # platform conversions a day, over the last three days
    blind_day: date | None = None  # a day without sessions
    booked_share: float = 1.0
    kpi: str = "cpa_backend"

    def claims(self, day: date) -> float:
        return self.late_claims if PLATFORM_TO - day < timedelta(days=3) else 24.0

    def sessions(self, day: date) -> int:
        return 0 if day == self.blind_day else 400


MEADOW = Campaign("meadow", "video", "AP-1")
QUARRY = Campaign("quarry", "video", "AP-1", budget=9_000.0)
FERRY = Campaign("ferry", "video", "AP-1", budget=11_400.0, kpi="cpm")
TUNDRA = Campaign("tundra", "audio", "AP-2", daily_spend=420.0)
LANTERN = Campaign("lantern", "audio", "AP-2", late_claims=12.0)
BEACON = Campaign("beacon", "audio", "AP-2", blind_day=date(2025, 3, 12))
ORCHARD = Campaign("orchard", "audio", "AP-2", booked_share=0.9)
KILN = Campaign("kiln", "maps", "AP-3")
HARBOUR = Campaign("harbour", "maps", None)
CAMPAIGNS = (MEADOW, QUARRY, FERRY, TUNDRA, LANTERN, BEACON, ORCHARD, KILN, HARBOUR)

# Approved amounts: AP-3 covers less than the campaign under it.
APPROVALS = {"AP-1": ("video", 60_000.0), "AP-2": ("audio", 60_000.0), "AP-3": ("maps", 12_000.0)}

# Rule and campaign (for a breach: the approval) of every alert there should be.
EXPECTED_ALERTS = {
    ("overspend", "quarry"),
    ("budget_exhaustion", "quarry"),
    ("budget_exhaustion", "ferry"),
    ("pacing_deviation", "tundra"),
    ("cpa_spike", "lantern"),
    ("tracking_break", "beacon"),
    ("reconciliation", "orchard"),
    ("unapproved_spend", "harbour"),
    ("approval_breach", "AP-3"),
}


def _days_of(c: Campaign, client: str) -> dict[str, list[tuple]]:
    plan = [(client, d, c.name, c.channel, DAILY, c.kpi, 55.0, False) for d in FLIGHT]
    delivered = [
        (client, f"net_{c.channel}", d, c.name, c.channel, 30_000, 500, c.daily_spend, c.claims(d),
         2.5 * c.daily_spend, False)
        for d in REPORTED
    ]
    web = [(client, d, "net", "paid", c.name, c.sessions(d), False) for d in REPORTED]
    orders = [
        (client, f"{c.name}/{d:%d}/{n}", d, c.name, 80.0, n < 4, False)
        for d in REPORTED if d <= CRM_TO for n in range(10)
    ]
    booked = [(client, c.name, round(c.daily_spend * c.booked_share, 2), f"{d}") for d in REPORTED]
    return {"plan_daily": plan, "platform_daily": delivered, "web_sessions": web,
            "crm_orders": orders, "gate_spend": booked}


def _terms(client: str) -> dict[str, list[tuple]]:
    span = (f"{START}", f"{END}")
    freshness = {"ad_platforms": PLATFORM_TO, "web_analytics": PLATFORM_TO, "crm": CRM_TO, "plan": END}
    return {
        "source_freshness": [(client, source, day, False) for source, day in freshness.items()],
        "gate_engagement": [(client, "EUR", CEILING)],
        "gate_campaigns": [
            (client, c.name, c.approval, c.channel, c.budget, DAILY, *span, "live")
            for c in CAMPAIGNS if c.approval
        ],
        "gate_requests": [
            (client, rid, "*", channel, amount, amount, *span, 5_000.0, "APPROVED", f"All {channel}",
             "2025-02-24T10:15:00+00:00", "2025-02-25T16:40:00+00:00")
            for rid, (channel, amount) in APPROVALS.items()
        ],
    }


def _rows(client: str) -> dict[str, list[tuple]]:
    out = _terms(client)
    for campaign in CAMPAIGNS:
        for name, rows in _days_of(campaign, client).items():
            out.setdefault(name, []).extend(rows)
    return out


def schema_of(name: str):
    if name in GATE:
        return GATE[name]
    return T.StructType([T.StructField("client", T.StringType()), *EXTRACTS[name].fields])


def raw_tables(spark: SparkSession, clients=("demo",), only=None, change=None):
    """Raw tables; ``only`` empties all others, ``change(name, rows)`` edits the rows."""
    made = [_rows(c) for c in clients]
    out = {}
    for name in (*EXTRACTS, *GATE):
        rows = [r for m in made for r in m[name]] if only is None or name in only else []
        if change is not None:
            rows = change(name, rows)
        out[name] = stamp_loaded(spark.createDataFrame(rows, schema_of(name)), LOADED)
    return out
