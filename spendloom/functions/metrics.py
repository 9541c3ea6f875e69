"""The only place where a ratio metric is defined.

Platform metrics use the ad platforms' own conversion counts. Backend metrics use CRM
orders. CPA (backend) and CAC divide the spend of CRM-covered days only; ROAS (backend)
divides all spend, which is how the metric has always been reported.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``num / den`` in double; null where the denominator is zero or null."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def cpm(spend="spend", impressions="impressions") -> Column:
    return safe_div(_col(spend) * 1000, impressions)


def ctr(clicks="clicks", impressions="impressions") -> Column:
    return safe_div(clicks, impressions)


def cpc(spend="spend", clicks="clicks") -> Column:
    return safe_div(spend, clicks)


def cvr(orders="backend_orders", sessions="sessions") -> Column:
    return safe_div(orders, sessions)


def cpa(spend, conversions) -> Column:
    return safe_div(spend, conversions)


def roas(revenue, spend="spend") -> Column:
    return safe_div(revenue, spend)


def cac(spend="spend_backend_window", new_customers="new_customers") -> Column:
    return safe_div(spend, new_customers)


def metric_columns() -> dict[str, Column]:
    """All nine metrics, for ``withColumns`` on a frame that has the base measures."""
    return {
        "cpm": cpm(),
        "ctr": ctr(),
        "cpc": cpc(),
        "cvr": cvr(),
        "cpa_platform": cpa("spend", "platform_conversions"),
        "cpa_backend": cpa("spend_backend_window", "backend_orders"),
        "roas_platform": roas("platform_revenue"),
        "roas_backend": roas("backend_revenue"),
        "cac": cac(),
    }


METRICS = tuple(
    "cpm ctr cpc cvr cpa_platform cpa_backend roas_platform roas_backend cac".split()
)
