"""One SQL text per registered query, over the given tables."""

from __future__ import annotations

import re

# The alert texts, written out here so that a wrong one is seen.
TEXTS = {
    "overspend": "Platform spend of {spend} is above the campaign budget of {budget}. Pause or decrease now.",
    "budget_exhaustion": "At the last 7 days' average run-rate the budget runs out about {days} day(s) before the "
    "flight ends. Lower the daily budget to spread it, or accept the early finish.",
    "pacing_deviation": "Spend is {pacing}% against plan to date (tolerance {tolerance}%).",
    "cpa_spike": "Platform CPA over the last 3 days is {last} against {prior} for the 7 days before (x{ratio}).",
    "tracking_break": "No web sessions recorded on {day} despite {clicks} platform clicks. Check the pixel, tag and UTMs.",
    "reconciliation": "Ledger spend differs from platform spend by {pct}% ({difference}). Reconcile against the invoice.",
    "unapproved_spend": "Spend of {spend} on a campaign the execution service never launched, so no approval covers it. "
    "If it was set up directly in the platform, pause it and raise a Spend Approval Request; if it is ours, add it to the campaign map.",
    "approval_breach": "Committed or live daily budget is above what {request} approved. The gate should make this "
    "impossible: investigate.",
}

METRICS = "cpm ctr cpc cvr cpa_platform cpa_backend roas_platform roas_backend cac"
DELIVERY = "impressions clicks spend platform_conversions platform_revenue"
BACKEND = "sessions backend_orders backend_revenue new_customers spend_backend_window"
PACING, RECON, SPIKE_RATIO, SPIKE_MIN = 10.0, 2.0, 1.1, 3


def div(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) <> 0 THEN CAST({num} AS double) / CAST({den} AS double) END)"


def metrics(t: str = "") -> str:
    c = lambda name: f"{t}{name}"
    return ", ".join(
        f"{expr} AS {name}"
        for name, expr in {
            "cpm": div(f"({c('spend')} * 1000)", c("impressions")),
            "ctr": div(c("clicks"), c("impressions")),
            "cpc": div(c("spend"), c("clicks")),
            "cvr": div(c("backend_orders"), c("sessions")),
            "cpa_platform": div(c("spend"), c("platform_conversions")),
            "cpa_backend": div(c("spend_backend_window"), c("backend_orders")),
            "roas_platform": div(c("platform_revenue"), c("spend")),
            "roas_backend": div(c("backend_revenue"), c("spend")),
            "cac": div(c("spend_backend_window"), c("new_customers")),
        }.items()
    )


WHOLE = {"impressions", "clicks", "sessions", "backend_orders", "new_customers"}


def xs(expr: str, window: str = "") -> str:
    """A money sum as decimals, so that the order of adding doesn't show."""
    return f"CAST(sum(CAST({expr} AS decimal(24, 6))) {window} AS double)"


def sums(names: str) -> str:
    return ", ".join(
        f"CAST(sum({n}) AS bigint) AS {n}" if n in WHOLE else f"{xs(n)} AS {n}"
        for n in names.split()
    )


def text(rule: str, **values: str) -> str:
    """The alert text as SQL concatenation."""
    parts = re.split(r"\{(\w+)\}", TEXTS[rule])
    return " || ".join(
        values[p] if i % 2 else "'" + p.replace("'", "''") + "'" for i, p in enumerate(parts) if p
    )


def shown(x: str, places: int = 0) -> str:
    return f"CAST(round({x}, {places}) AS varchar)"


EVENTS = """
log AS (
  SELECT 'c' || (user_id % 3) AS client, 'cmp_' || (user_id % 30) AS campaign,
         'ch_' || (user_id % 5) AS channel, user_id % 30 AS n, user_id % 5 AS ch,
         'SAR-' || (user_id % 3) || '-' || (user_id % 5) AS rid,
         CAST(ts AS date) AS date, ts, event_id, event_type, value,
         CAST(round(value * 100) AS bigint) AS c
  FROM events),
calendar AS (
  SELECT client, min(date) AS first_day, max(date) AS last_day FROM log GROUP BY client),
budgets AS (
  SELECT b.*, budget // date_diff('day', first_day, last_day + 3) AS daily, first_day AS starts, last_day + 3 AS ends FROM (
    SELECT client, campaign, channel, n, ch, rid,
           CAST(sum(c) FILTER (event_type IN ('view', 'click')) AS bigint)
             * CASE n % 10 WHEN 0 THEN 90 WHEN 1 THEN 105 WHEN 2 THEN 111 ELSE 130 END // 100 AS budget
    FROM log GROUP BY client, campaign, channel, n, ch, rid) b JOIN calendar USING (client)),
raw_platform AS (
  SELECT client, 'src_' || ch AS source, date, campaign, channel,
         1000 * count(*) FILTER (event_type = 'view') AS impressions,
         100 * count(*) FILTER (event_type = 'click') AS clicks,
         coalesce(sum(c) FILTER (event_type IN ('view', 'click')), 0)::double / 100 AS spend,
         (count(*) FILTER (event_type IN ('purchase', 'signup')))::double AS platform_conversions,
         coalesce(sum(c) FILTER (event_type = 'purchase'), 0)::double / 100 AS platform_revenue,
         true AS is_synthetic
  FROM log GROUP BY client, ch, date, campaign, channel),
raw_web AS (
  SELECT client, date, 'src_' || ch AS utm_source, 'cpc' AS utm_medium, campaign,
         CASE WHEN n = 7 AND day(date) BETWEEN 25 AND 26 THEN 0 ELSE 60 END::bigint AS sessions,
         true AS is_synthetic
  FROM log WHERE event_type = 'click'),
raw_crm AS (
  SELECT client, 'ord_' || event_id AS order_id, date, campaign, value AS revenue,
         event_id % 3 <> 0 AS new_customer, true AS is_synthetic
  FROM log WHERE event_type = 'purchase'),
raw_plan AS (
  SELECT client, CAST(d.day AS date) AS date, campaign, channel, daily::double / 100 AS planned_spend,
         CASE WHEN ch <= 2 THEN 'cpa_backend' WHEN ch = 3 THEN 'cpm' ELSE 'reach' END AS kpi,
         (ch * 10 + 40)::double AS kpi_target, true AS is_synthetic
  FROM (SELECT *, unnest(generate_series(starts, ends, INTERVAL 1 DAY)) AS day FROM budgets) d
  WHERE n <> 13),
raw_freshness AS (
  SELECT client, s.source, last_day + s.n AS data_as_of, true AS is_synthetic
  FROM calendar, (VALUES ('ad_platforms', 0), ('web_analytics', 0), ('crm', -1), ('plan', 3)) s(source, n)
  WHERE NOT (client = 'c2' AND s.source = 'crm')),
raw_campaigns AS (
  SELECT client, campaign, rid AS request_id, channel, budget::double / 100 AS budget,
         daily::double / 100 AS daily_budget, starts AS start_date, ends AS end_date,
         CASE WHEN n % 7 = 0 THEN 'paused' ELSE 'live' END AS status
  FROM budgets WHERE n <> 17),
raw_requests AS (
  SELECT client, rid AS request_id, CASE WHEN rid = 'SAR-0-0' THEN 'cmp_0' ELSE '*' END AS campaign_scope, channel,
         (b * 125 // 100)::double / 100 AS requested_amount,
         CASE status WHEN 'APPROVED' THEN (b * CASE rid WHEN 'SAR-1-2' THEN 80 ELSE 120 END // 100)::double / 100
              ELSE 0 END::double AS approved_amount,
         starts AS start_date, ends AS end_date,
         (d * 110 // 100)::double / 100 AS daily_cap, status, 'Envelope for ' || channel AS summary,
         TIMESTAMP '2023-12-20 09:00:00' AS requested_at,
         CASE WHEN status <> 'PENDING' THEN TIMESTAMP '2023-12-21 10:30:00' END AS decided_at
  FROM (SELECT client, channel, rid, CAST(sum(budget) AS bigint) AS b, CAST(sum(daily) AS bigint) AS d,
               min(starts) AS starts, max(ends) AS ends,
               CASE rid WHEN 'SAR-2-1' THEN 'PENDING' WHEN 'SAR-1-4' THEN 'REJECTED' ELSE 'APPROVED' END AS status
        FROM budgets WHERE n <> 17 GROUP BY client, channel, rid)),
raw_engagement AS (
  SELECT client, CASE client WHEN 'c2' THEN 'USD' ELSE 'INR' END AS currency,
         (CAST(sum(budget) AS bigint) * 115 // 100)::double / 100 AS ceiling
  FROM budgets WHERE n <> 17 GROUP BY client),
raw_spend AS (
  SELECT client, campaign, date,
         (CASE WHEN campaign = 'cmp_11' THEN CAST(round(spend * 100) AS bigint) * 96 // 100
               ELSE CAST(round(spend * 100) AS bigint) END)::double / 100 AS ledger_spend
  FROM raw_platform WHERE campaign <> 'cmp_17')"""

LINEITEM = """
sup AS (
  SELECT s_suppkey AS k, 'client_' || (s_suppkey % 5) AS client, 'sup_' || s_suppkey AS campaign,
         'ch_' || (s_suppkey % 7) AS channel
  FROM supplier),
lines AS (
  SELECT client, campaign, channel, k, l_orderkey, l_linenumber, CAST(l_shipdate AS date) AS date,
         CAST(l_quantity AS bigint) AS q, CAST(round(l_extendedprice * 100) AS bigint) AS c, l_extendedprice, l_returnflag
  FROM lineitem JOIN sup ON l_suppkey = k),
raw_platform AS (
  SELECT client, 'network' AS source, date, campaign, channel, k,
         CAST(sum(q) * 1000 AS bigint) AS impressions, CAST(sum(q) * 10 AS bigint) AS clicks,
         sum(c)::double / 100 AS spend, count(*)::double AS platform_conversions,
         (sum(c) * 2)::double / 100 AS platform_revenue, false AS is_synthetic
  FROM lines GROUP BY client, date, campaign, channel, k),
raw_web AS (
  SELECT client, date, campaign, CASE WHEN l_returnflag = 'R' THEN 0 ELSE q * 8 END AS sessions FROM lines),
raw_crm AS (
  SELECT client, 'ord_' || o_orderkey AS order_id, CAST(o_orderdate AS date) AS date, campaign,
         o_totalprice AS revenue, o_custkey % 3 <> 0 AS new_customer
  FROM orders LEFT JOIN (
    SELECT l_orderkey, client, campaign,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, k) AS pos FROM lines) x
    ON x.l_orderkey = o_orderkey AND x.pos = 1),
calendar AS (SELECT client, min(date) AS first_day, max(date) AS last_day FROM lines GROUP BY client),
raw_plan AS (
  SELECT client, CAST(d.day AS date) AS date, campaign, channel, 30000::double AS planned_spend,
         CASE WHEN k % 2 = 0 THEN 'cpa_backend' ELSE 'cpm' END AS kpi, 25000::double AS kpi_target,
         false AS is_synthetic
  FROM (SELECT sup.*, unnest(generate_series(last_day - 119, last_day, INTERVAL 1 DAY)) AS day FROM sup JOIN calendar USING (client)) d),
raw_freshness AS (
  SELECT client, s.source, last_day + s.n AS data_as_of, false AS is_synthetic
  FROM calendar, (VALUES ('ad_platforms', -21), ('web_analytics', -21), ('crm', -23)) s(source, n)),
raw_campaigns AS (
  SELECT client, campaign, 'SAR-' || client || '-' || channel AS request_id, channel,
         25000000::double AS budget, 30000::double AS daily_budget, DATE '1995-01-01' AS start_date,
         DATE '2001-12-31' AS end_date, 'live' AS status
  FROM sup WHERE k % 17 <> 0),
raw_requests AS (
  SELECT client, request_id, '*' AS campaign_scope, channel, count(*) * 26000000::double AS requested_amount,
         count(*) * 26000000::double AS approved_amount, DATE '1995-01-01' AS start_date,
         DATE '2001-12-31' AS end_date, count(*) * 31000::double AS daily_cap, 'APPROVED' AS status,
         'Envelope for ' || channel AS summary, TIMESTAMP '1994-12-01 00:00:00' AS requested_at,
         TIMESTAMP '1994-12-02 00:00:00' AS decided_at
  FROM raw_campaigns GROUP BY client, request_id, channel),
raw_engagement AS (
  SELECT client, 'USD' AS currency, count(*) * 26000000::double AS ceiling
  FROM raw_campaigns GROUP BY client),
raw_spend AS (SELECT client, campaign, date, l_extendedprice AS ledger_spend FROM lines WHERE k % 17 <> 0)"""

_DAY = "x.client = s.client AND x.date = s.date AND x.campaign = s.campaign"


def _of_day(value: str, source: str) -> str:
    return f"coalesce((SELECT {value} FROM {source} x WHERE {_DAY}), 0)"


MODELS = f"""
coverage AS (
  SELECT client,
         (SELECT max(data_as_of) FROM raw_freshness x WHERE x.client = k.client AND x.source = 'ad_platforms') AS platform_as_of,
         (SELECT max(data_as_of) FROM raw_freshness x WHERE x.client = k.client AND x.source = 'web_analytics') AS web_as_of,
         (SELECT max(data_as_of) FROM raw_freshness x WHERE x.client = k.client AND x.source = 'crm') AS crm_as_of
  FROM (SELECT DISTINCT client FROM raw_freshness) k),
spine AS (
  SELECT DISTINCT client, date, campaign, channel
  FROM (SELECT client, date, campaign, channel FROM raw_plan
        UNION ALL BY NAME SELECT client, date, campaign, channel FROM raw_platform)),
base AS (
  SELECT s.client, s.date, s.campaign, s.channel,
         (SELECT x.request_id FROM raw_campaigns x WHERE x.client = s.client AND x.campaign = s.campaign) AS request_id,
         p.kpi, p.kpi_target, coalesce(p.planned_spend, 0) AS planned_spend,
         a.platform_as_of >= s.date AS has_platform_data, a.crm_as_of >= s.date AS has_crm_data,
         a.web_as_of >= s.date AS has_web_data,
         coalesce(d.impressions, 0) AS impressions, coalesce(d.clicks, 0) AS clicks,
         coalesce(d.spend, 0) AS spend, coalesce(d.platform_conversions, 0) AS platform_conversions,
         coalesce(d.platform_revenue, 0) AS platform_revenue,
         CAST({_of_day("sum(sessions)", "raw_web")} AS bigint) AS any_sessions,
         {_of_day("count(*)", "raw_crm")} AS any_orders,
         {_of_day(xs("revenue"), "raw_crm")} AS any_revenue,
         {_of_day("count(*) FILTER (new_customer)", "raw_crm")} AS any_new,
         {_of_day(xs("ledger_spend"), "raw_spend")} AS ledger_spend,
         coalesce(d.is_synthetic, p.is_synthetic, false) AS is_synthetic
  FROM spine s
  LEFT JOIN coverage a ON a.client = s.client
  LEFT JOIN raw_plan p ON p.client = s.client AND p.date = s.date AND p.campaign = s.campaign
  LEFT JOIN raw_platform d ON d.client = s.client AND d.date = s.date AND d.campaign = s.campaign),
gated AS (
  SELECT * EXCLUDE (any_sessions, any_orders, any_revenue, any_new, has_web_data),
         CASE WHEN has_web_data THEN any_sessions END AS sessions,
         CASE WHEN has_crm_data THEN any_orders END AS backend_orders,
         CASE WHEN has_crm_data THEN any_revenue END AS backend_revenue,
         CASE WHEN has_crm_data THEN any_new END AS new_customers,
         CASE WHEN has_crm_data THEN spend ELSE 0 END AS spend_backend_window
  FROM base),
fact AS (SELECT *, {metrics()} FROM gated),
refday AS (SELECT client, max(CASE WHEN has_platform_data THEN date END) AS d FROM fact GROUP BY client),
totals AS (
  SELECT client, campaign, channel, request_id,
         arg_min(kpi, date) FILTER (kpi IS NOT NULL) AS kpi,
         arg_min(kpi_target, date) FILTER (kpi_target IS NOT NULL) AS kpi_target,
         {xs("planned_spend")} AS planned_spend_flight,
         {xs("CASE WHEN has_platform_data THEN planned_spend END")} AS planned_spend_to_date,
         {sums(f"{DELIVERY} {BACKEND} ledger_spend")},
         count(*) FILTER (has_platform_data = false) AS days_remaining,
         bool_or(is_synthetic) AS is_synthetic
  FROM fact GROUP BY client, campaign, channel, request_id),
rate AS (
  SELECT f.client, f.campaign, min(spend) AS low_daily, {xs("spend")} / count(*) AS mean_daily, max(spend) AS high_daily
  FROM fact f JOIN refday r ON r.client = f.client
  WHERE has_platform_data AND date_diff('day', f.date, r.d) < 7 GROUP BY f.client, f.campaign),
camp AS (
  SELECT t.*, r.mean_daily, g.budget, g.daily_budget, g.status, g.start_date, g.end_date,
         {div("t.spend", "g.budget")} AS budget_used,
         {div("t.spend", "planned_spend_to_date")} - 1 AS pacing_vs_plan,
         least(g.budget, t.spend + days_remaining * low_daily) AS forecast_spend_low,
         least(g.budget, t.spend + days_remaining * mean_daily) AS forecast_spend_base,
         least(g.budget, t.spend + days_remaining * high_daily) AS forecast_spend_high,
         g.budget < t.spend + days_remaining * high_daily AS would_exceed_budget_uncapped,
         {metrics("t.")},
         CASE WHEN kpi = 'cpa_backend' THEN {div("spend_backend_window", "backend_orders")}
              WHEN kpi = 'cpm' THEN {div("(t.spend * 1000)", "impressions")} END AS kpi_actual
  FROM totals t
  LEFT JOIN raw_campaigns g ON g.client = t.client AND g.campaign = t.campaign
  LEFT JOIN rate r ON r.client = t.client AND r.campaign = t.campaign),
chan AS (
  SELECT *, {div("spend", "planned_spend_to_date")} - 1 AS pacing_vs_plan, {metrics()} FROM (
    SELECT client, channel, count(*) AS campaigns, {xs("budget")} AS budget,
           {xs("planned_spend_to_date")} AS planned_spend_to_date, {sums(f"{DELIVERY} {BACKEND}")},
           {sums("forecast_spend_low forecast_spend_base forecast_spend_high")}
    FROM camp GROUP BY client, channel)),
chan_day AS (
  SELECT *, {metrics()} FROM (
    SELECT client, date, channel, {xs("planned_spend")} AS planned_spend, {sums(f"{DELIVERY} {BACKEND}")},
           bool_or(is_synthetic) AS is_synthetic
    FROM fact WHERE has_platform_data GROUP BY client, date, channel)),
funnel AS (
  SELECT *, {div("clicks", "impressions")} AS ctr, {div("sessions", "clicks")} AS click_to_session,
         {div("orders", "sessions")} AS cvr, {div("(spend * 1000)", "impressions")} AS cpm,
         {div("spend", "clicks")} AS cpc, {div("spend", "orders")} AS cpa_backend,
         {div("revenue", "spend")} AS roas_backend, {div("spend", "new_customers")} AS cac
  FROM (
    SELECT client, CASE WHEN grouping(channel) = 1 THEN 'All channels' ELSE channel END AS level,
           {sums("impressions clicks sessions new_customers spend")},
           CAST(sum(backend_orders) AS bigint) AS orders, {xs("backend_revenue")} AS revenue
    FROM fact WHERE has_crm_data GROUP BY GROUPING SETS ((client, channel), (client)))),
recon AS (
  SELECT client, campaign, channel, request_id, spend AS platform_spend, ledger_spend,
         spend - ledger_spend AS difference, {div("(spend - ledger_spend)", "spend")} AS difference_pct,
         CASE WHEN spend <> 0 THEN abs((spend - ledger_spend) / spend) * 100 <= {RECON} ELSE true END AS within_tolerance
  FROM camp),
appr AS (
  SELECT *, approved_amount - platform_spend AS remaining_of_approval,
         {div("platform_spend", "approved_amount")} AS approval_used
  FROM (
    SELECT r.*,
           (SELECT count(*) FROM raw_campaigns g WHERE g.client = r.client AND g.request_id = r.request_id) AS campaigns,
           coalesce((SELECT {xs("budget")} FROM raw_campaigns g
                     WHERE g.client = r.client AND g.request_id = r.request_id), 0) AS committed,
           coalesce((SELECT {xs("daily_budget")} FROM raw_campaigns g
                     WHERE g.client = r.client AND g.request_id = r.request_id AND status = 'live'), 0) AS live_daily_budget,
           coalesce((SELECT {xs("spend")} FROM fact f
                     WHERE f.client = r.client AND f.request_id = r.request_id), 0) AS platform_spend,
           coalesce((SELECT {xs("ledger_spend")} FROM fact f
                     WHERE f.client = r.client AND f.request_id = r.request_id), 0) AS ledger_spend
    FROM raw_requests r)),
win AS (
  SELECT *, {div("s3", "c3")} AS cpa_last3, c3 AS conv_last3, {div("s7", "c7")} AS cpa_prior7 FROM (
    SELECT f.client, f.campaign, f.channel,
           {xs("CASE WHEN gap < 3 THEN spend END")} AS s3, {xs("CASE WHEN gap < 3 THEN platform_conversions END")} AS c3,
           {xs("CASE WHEN gap >= 3 THEN spend END")} AS s7, {xs("CASE WHEN gap >= 3 THEN platform_conversions END")} AS c7
    FROM (SELECT fact.*, date_diff('day', fact.date, r.d) AS gap
          FROM fact JOIN refday r ON r.client = fact.client) f
    WHERE has_platform_data AND gap < 10 GROUP BY f.client, f.campaign, f.channel)),
hits AS (
  SELECT client, 'overspend' AS rule, 'act' AS severity, campaign, channel,
         {text("overspend", spend=shown("spend"), budget=shown("budget"))} AS detail, spend AS value, budget AS threshold
  FROM camp WHERE spend > budget
  UNION ALL
  SELECT client, 'budget_exhaustion', 'review', campaign, channel,
         {text("budget_exhaustion", days=shown("early", 1))}, early, 1
  FROM (SELECT *, days_remaining - (budget - spend) / nullif(mean_daily, 0) AS early FROM camp WHERE mean_daily > 0)
  WHERE early >= 1
  UNION ALL
  SELECT client, 'pacing_deviation', CASE WHEN abs(pacing_vs_plan) > 2 * {PACING} / 100.0 THEN 'act' ELSE 'review' END,
         campaign, channel,
         {text("pacing_deviation", pacing=shown("pacing_vs_plan * 100", 1), tolerance=f"'{PACING}'")},
         pacing_vs_plan, {PACING} / 100.0
  FROM camp WHERE abs(pacing_vs_plan) > {PACING} / 100.0
  UNION ALL
  SELECT client, 'cpa_spike', 'review', campaign, channel,
         {text("cpa_spike", last=shown("cpa_last3"), prior=shown("cpa_prior7"), ratio=shown("cpa_last3 / cpa_prior7", 2))},
         cpa_last3, cpa_prior7 * {SPIKE_RATIO}::double
  FROM win WHERE cpa_last3 > cpa_prior7 * {SPIKE_RATIO}::double AND conv_last3 >= {SPIKE_MIN}
  UNION ALL
  SELECT client, 'tracking_break', 'act', campaign, channel,
         {text("tracking_break", day="strftime(date, '%Y-%m-%d')", clicks="CAST(clicks AS varchar)")}, sessions, NULL
  FROM fact WHERE has_platform_data AND clicks >= 100 AND sessions = 0
  UNION ALL
  SELECT client, 'reconciliation', 'review', campaign, channel,
         {text("reconciliation", pct=shown("difference_pct * 100", 1), difference=shown("difference"))},
         difference_pct, {RECON} / 100.0
  FROM recon WHERE within_tolerance = false
  UNION ALL
  SELECT client, 'unapproved_spend', 'act', campaign, channel,
         {text("unapproved_spend", spend=shown("spend"))}, spend, 0
  FROM camp WHERE spend > 0 AND request_id IS NULL
  UNION ALL
  SELECT client, 'approval_breach', 'act', request_id, channel,
         {text("approval_breach", request="request_id")}, committed, approved_amount
  FROM appr WHERE status = 'APPROVED'
    AND (committed > approved_amount OR live_daily_budget > daily_cap OR platform_spend > approved_amount)),
alerts AS (
  SELECT h.* REPLACE (CAST(value AS double) AS value, CAST(threshold AS double) AS threshold),
         (SELECT d FROM refday r WHERE r.client = h.client) AS data_as_of
  FROM hits h),
overview AS (
  SELECT e.client, e.currency, e.ceiling,
         (SELECT sum(approved_amount) FROM raw_requests r WHERE r.client = e.client AND status = 'APPROVED') AS approved,
         (SELECT count(*) FROM raw_requests r WHERE r.client = e.client AND status = 'PENDING') AS pending_requests,
         a.* EXCLUDE (client), e.ceiling - a.spend AS remaining_of_ceiling,
         {div("a.spend", "a.planned_spend_to_date")} - 1 AS pacing_vs_plan, {metrics("a.")},
         (SELECT platform_as_of FROM coverage x WHERE x.client = e.client) AS platform_as_of,
         (SELECT crm_as_of FROM coverage x WHERE x.client = e.client) AS crm_as_of,
         (SELECT count(*) FROM alerts x WHERE x.client = e.client) AS open_alerts
  FROM raw_engagement e LEFT JOIN (
    SELECT client, {xs("budget")} AS committed,
           {sums("planned_spend_to_date planned_spend_flight forecast_spend_low forecast_spend_base forecast_spend_high")},
           {sums(f"{DELIVERY} {BACKEND} ledger_spend")},
           {div("sum(CASE WHEN kpi = 'cpa_backend' THEN kpi_target * backend_orders END)",
                "sum(CASE WHEN kpi = 'cpa_backend' THEN backend_orders END)")} AS target_cpa_backend,
           {div("sum(CASE WHEN kpi = 'cpa_backend' THEN spend_backend_window END)",
                "sum(CASE WHEN kpi = 'cpa_backend' THEN backend_orders END)")} AS actual_cpa_backend,
           min(start_date) AS flight_start, max(end_date) AS flight_end, bool_or(is_synthetic) AS is_synthetic
    FROM camp GROUP BY client) a ON a.client = e.client),
trend AS (
  SELECT client, date, {xs("planned", "OVER w")} AS plan_cum, CASE WHEN reported THEN {xs("spent", "OVER w")} END AS spend_cum
  FROM (SELECT client, date, {xs("planned_spend")} AS planned, {xs("spend")} AS spent, bool_or(has_platform_data) AS reported
        FROM fact GROUP BY client, date)
  WINDOW w AS (PARTITION BY client ORDER BY date))"""

GATE = """
standing AS (
  SELECT client, currency, ceiling, approved, committed, spent, round(ceiling - approved, 2) AS unapproved_headroom,
         round(ceiling - spent, 2) AS remaining_of_ceiling
  FROM (SELECT e.*,
               coalesce((SELECT sum(approved_amount) FROM raw_requests r WHERE r.client = e.client AND status = 'APPROVED'), 0) AS approved,
               coalesce((SELECT sum(budget) FROM raw_campaigns g WHERE g.client = e.client), 0) AS committed,
               coalesce((SELECT sum(ledger_spend) FROM raw_spend s WHERE s.client = e.client), 0) AS spent
        FROM raw_engagement e)),
acts AS (
  SELECT client, event_id AS action_id,
         (['launch', 'increase_budget', 'extend_flight', 'decrease_budget', 'pause', 'boost'])[event_id % 6 + 1] AS type,
         CASE WHEN event_id % 5 = 0 THEN 'new_' || (event_id % 40) ELSE campaign END AS campaign,
         CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '' WHEN event_id % 17 = 0 THEN 'SAR-9-9' ELSE rid END AS request_id,
         CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'ch_9' ELSE channel END AS channel,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE (c * 60)::double / 100 END AS budget,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE c::double / 100 END AS daily_budget,
         CASE WHEN event_id % 29 = 0 THEN last_day + 14 END AS end_on,
         CASE WHEN event_id % 31 = 0 THEN last_day + 9 ELSE date END AS today
  FROM log JOIN calendar USING (client) WHERE event_type = 'signup'),
asked AS (
  SELECT a.*, g.budget AS g_budget, g.daily_budget AS g_daily, g.channel AS g_channel, g.start_date AS g_start,
         g.end_date AS g_end, g.campaign IS NOT NULL AS launched,
         coalesce(nullif(a.request_id, ''), g.request_id) AS rid
  FROM acts a LEFT JOIN raw_campaigns g ON g.client = a.client AND g.campaign = a.campaign),
weighed AS (
  SELECT a.client, action_id, type, a.campaign, a.rid, a.today, launched, g_budget, g_daily,
         r.status, r.campaign_scope AS scope, r.channel AS r_channel, r.approved_amount, r.daily_cap,
         r.start_date AS r_start, r.end_date AS r_end,
         coalesce(a.channel, g_channel) AS channel, coalesce(a.budget, 0) AS budget,
         coalesce(a.daily_budget, g_daily, 0) AS daily, coalesce(g_start, r.start_date) AS starts,
         coalesce(end_on, g_end, r.end_date) AS ends,
         round(coalesce((SELECT sum(budget) FROM raw_campaigns o WHERE o.client = a.client AND o.request_id = a.rid
                         AND o.campaign <> a.campaign), 0), 2) AS committed_elsewhere,
         round(coalesce((SELECT sum(daily_budget) FROM raw_campaigns o WHERE o.client = a.client AND o.request_id = a.rid
                         AND o.campaign <> a.campaign AND o.status = 'live'), 0), 2) AS live_daily_elsewhere
  FROM asked a LEFT JOIN raw_requests r ON r.client = a.client AND r.request_id = a.rid),
judged AS (
  SELECT *, CASE
    WHEN type IN ('pause', 'decrease_budget') THEN NULL
    WHEN type = 'boost' THEN 'unknown_action'
    WHEN status IS NULL THEN 'no_request'
    WHEN status <> 'APPROVED' THEN 'not_approved'
    WHEN today > r_end THEN 'expired'
    WHEN type <> 'launch' AND NOT launched THEN 'not_launched'
    WHEN type = 'launch' AND launched THEN 'already_exists'
    WHEN channel IS DISTINCT FROM r_channel THEN 'channel_mismatch'
    WHEN scope <> '*' AND scope <> campaign THEN 'campaign_out_of_scope'
    WHEN starts < r_start OR ends > r_end THEN 'outside_approved_dates'
    WHEN type = 'extend_flight' THEN NULL
    WHEN budget <= 0 OR daily <= 0 THEN 'budget_not_positive'
    WHEN type = 'increase_budget' AND budget <= g_budget AND daily <= g_daily THEN 'not_an_increase'
    WHEN committed_elsewhere + budget > approved_amount THEN 'over_approved_amount'
    WHEN live_daily_elsewhere + daily > daily_cap THEN 'over_daily_cap' END AS reason
  FROM weighed),
done AS (
  SELECT client, campaign, ts_s AS "at", event_id AS seq,
         CASE WHEN event_id % 16 = 3 THEN 'pause'
              ELSE (['increase_budget', 'decrease_budget', 'extend_flight'])[event_id % 3 + 1] END AS type,
         value, CASE WHEN event_id % 4 <> 1 THEN (c // 10)::double / 100 END AS daily, date
  FROM (SELECT *, date_trunc('second', ts) AS ts_s FROM log) WHERE event_type = 'view'),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY client, campaign ORDER BY "at", seq) AS pos FROM done),
replayed AS (
  SELECT k.client, k.campaign, k.rid AS request_id, k.channel,
         coalesce((SELECT arg_max(value, pos) FROM ordered o WHERE o.client = k.client AND o.campaign = k.campaign
                   AND type IN ('increase_budget', 'decrease_budget')), 1000) AS budget,
         least(coalesce((SELECT daily FROM ordered o WHERE o.client = k.client AND o.campaign = k.campaign AND o.pos = k.set_at), 50),
               (SELECT min(daily) FROM ordered o WHERE o.client = k.client AND o.campaign = k.campaign
                AND type = 'decrease_budget' AND o.pos > k.set_at)) AS daily_budget,
         (SELECT first_day FROM calendar x WHERE x.client = k.client) AS start_date,
         coalesce((SELECT arg_max(date, pos) FROM ordered o WHERE o.client = k.client AND o.campaign = k.campaign
                   AND type = 'extend_flight'), (SELECT last_day + 3 FROM calendar x WHERE x.client = k.client)) AS end_date,
         CASE WHEN EXISTS (SELECT 1 FROM ordered o WHERE o.client = k.client AND o.campaign = k.campaign AND type = 'pause')
              THEN 'paused' ELSE 'live' END AS status
  FROM (SELECT b.client, b.campaign, b.channel, b.rid,
               coalesce((SELECT max(pos) FROM ordered o WHERE o.client = b.client AND o.campaign = b.campaign
                         AND type = 'increase_budget' AND daily IS NOT NULL), 0) AS set_at
        FROM (SELECT DISTINCT client, campaign, channel, rid FROM log) b) k),
audited AS (
  SELECT client, CASE event_type
           WHEN 'view' THEN 'action_executed' WHEN 'click' THEN 'spend_recorded' WHEN 'purchase' THEN 'request_created'
           WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN 'request_modified_and_approved' ELSE 'request_approved' END
           ELSE CASE event_id % 4 WHEN 2 THEN 'decision_refused_stale_message' WHEN 3 THEN 'decision_refused_bad_key'
                ELSE 'action_blocked' END END AS event,
         CASE WHEN event_type = 'error' AND event_id % 4 < 2
              THEN (['expired', 'over_daily_cap', 'unknown_action'])[event_id % 3 + 1] END AS reason,
         date_trunc('second', ts) AS "at", event_id AS seq
  FROM log
  UNION ALL
  SELECT client, 'action_executed', NULL, TIMESTAMP '2023-12-31 00:00:00', -1 FROM (SELECT DISTINCT client, campaign FROM log)),
ads AS (
  SELECT client, date, n, (n + 100)::varchar AS platform_id, 'Net | ' || campaign AS platform_name,
         CASE WHEN n = 29 THEN 'google_ads_other'
              ELSE (['paid_search', 'performance_max', 'online_video', 'display', 'google_ads_other'])[ch + 1] END AS channel,
         impressions, clicks, spend, CASE WHEN n % 4 = 0 THEN 0 ELSE platform_conversions END AS platform_conversions,
         CASE WHEN n % 4 = 0 THEN 0 ELSE platform_revenue END AS platform_revenue
  FROM (SELECT *, CAST(substring(campaign, 5) AS integer) AS n, CAST(substring(channel, 4) AS integer) AS ch FROM raw_platform)),
ads_in AS (SELECT * FROM ads WHERE impressions > 0 AND date BETWEEN (SELECT max(date) FROM log) - 13 AND (SELECT max(date) FROM log)),
ads_named AS (
  SELECT *, n < 20 AND n <> 5 AS is_mapped, CASE WHEN n < 20 AND n <> 5 THEN 'agency_' || n ELSE platform_name END AS campaign
  FROM ads_in),
ads_extract AS (
  SELECT client, 'google_ads' AS source, date, campaign, channel, impressions, clicks, spend, platform_conversions,
         platform_revenue, false AS is_synthetic FROM ads_named)"""

# The gate, decision by decision (recursive): the state of a client is what it has approved and for which requests.
APPROVALS_REPLAYED = """
WITH RECURSIVE signups AS (
  SELECT 'c' || (user_id % 3) AS client, event_id, ts, value, CAST(round(value * 100) AS bigint) AS c
  FROM events WHERE event_type = 'signup'),
decided AS (
  SELECT client, CASE WHEN event_id % 13 = 0 THEN 'NONE-' ELSE 'RQ-' END || event_id AS request_id,
         date_trunc('second', ts) AS "at", event_id * 2 + again.i AS seq, event_id % 13 = 0 AS unknown,
         CASE WHEN event_id % 13 = 0 AND event_id % 9 <> 0 AND event_id % 6 <> 0 AND event_id % 5 = 0 THEN NULL
              WHEN event_id % 9 = 0 THEN -c WHEN event_id % 6 = 0 THEN 2 * c ELSE c END AS cents,
         CASE WHEN event_id % 13 <> 0 THEN c END AS asked, event_id % 19 = 0 AS no_cap, c // 10 AS cap_asked, event_id % 4 = 0 AS chat,
         false AS rejects
  FROM signups, (SELECT unnest([0, 1]) AS i) again WHERE again.i = 0 OR event_id % 7 = 0),
queue AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY client ORDER BY "at", seq) AS bigint) AS pos FROM decided),
ceilings AS (SELECT client, CAST(sum(c) AS bigint) * 60 // 100 AS ceiling FROM signups GROUP BY client),
walk AS (
  SELECT client, 0::bigint AS pos, 0::bigint AS total, []::varchar[] AS granted,
         NULL::varchar AS reason FROM ceilings
  UNION ALL
  SELECT client, pos, CASE WHEN reason IS NULL AND NOT rejects THEN total + cents ELSE total END,
         CASE WHEN reason IS NULL THEN list_append(granted, request_id) ELSE granted END, reason
  FROM (SELECT q.client, q.pos, w.total, w.granted, q.cents, q.request_id, q.rejects,
               CASE WHEN unknown THEN 'no_request'
                    WHEN list_contains(w.granted, q.request_id) THEN 'already_decided'
                    WHEN rejects THEN NULL
                    WHEN q.cents <= 0 THEN 'amount_not_positive'
                    WHEN no_cap OR cap_asked <= 0 THEN 'cap_not_positive'
                    WHEN chat AND q.cents > asked THEN 'raised_from_chat'
                    WHEN w.total + q.cents > k.ceiling THEN 'over_ceiling' END AS reason
        FROM walk w JOIN queue q ON q.client = w.client AND q.pos = w.pos + 1 JOIN ceilings k ON k.client = q.client)),
audited_decisions AS (
  SELECT q.client, q.request_id, q."at", q.seq, q.rejects, round(q.cents::double / 100, 6) AS approved,
         CASE WHEN no_cap THEN 0 WHEN NOT unknown THEN round(cap_asked::double / 100, 6) END AS cap,
         round(w.total::double / 100, 6) AS running_approved,
         NOT unknown AND (q.cents <> q.asked OR (no_cap AND cap_asked <> 0)) AS modified, w.reason IS NULL AS valid, w.reason
  FROM queue q JOIN walk w ON w.client = q.client AND w.pos = q.pos)
"""

FACT_DOUBLES = (
    "kpi_target planned_spend spend platform_conversions platform_revenue backend_revenue "
    f"spend_backend_window ledger_spend {METRICS}"
)
TOTALS = (
    "kpi_target planned_spend_flight planned_spend_to_date spend platform_conversions "
    "platform_revenue backend_revenue spend_backend_window ledger_spend"
)
FORECAST = "forecast_spend_low forecast_spend_base forecast_spend_high"
CAMP = f"{TOTALS} mean_daily budget daily_budget budget_used pacing_vs_plan {FORECAST} {METRICS} kpi_actual"
MONEY = "spend platform_conversions platform_revenue backend_revenue spend_backend_window"
ADS_MONEY = "spend platform_conversions platform_revenue"
POSITION = "ceiling approved committed spent unapproved_headroom remaining_of_ceiling"
REQUEST = "requested_amount approved_amount daily_cap"
APPROVALS = f"{REQUEST} committed live_daily_budget platform_spend ledger_spend remaining_of_approval approval_used"


def _rounded(body: str, doubles: str) -> str:
    if not doubles:
        return body
    # Ratios of equal sums are equal doubles, and aren't rounded.
    places = ", ".join(
        f"{c}::double AS {c}" if c in METRICS.split() else f"round(CAST({c} AS double), 6) AS {c}" for c in doubles.split()
    )
    return f"SELECT * REPLACE ({places}) FROM ({body})"


def _on(source: str, body: str, doubles: str = "") -> str:
    world = {"events": f"{EVENTS},{MODELS},{GATE}", "lineitem": f"{LINEITEM},{MODELS}"}[source]
    return f"WITH {world}\n{_rounded(body, doubles)}"


_LOADED = "TIMESTAMP '2024-01-31 06:00:00'"
_FRESH = f"SELECT client, source, data_as_of, {_LOADED} AS loaded_at, is_synthetic FROM raw_freshness"

# Model -> (its SQL, its double columns).
_MODELS = {
    "fct_performance_daily": ("SELECT * FROM fact", FACT_DOUBLES),
    "mart_campaign_performance": ("SELECT * FROM camp", CAMP),
    "mart_channel_performance": (
        "SELECT * FROM chan", f"budget planned_spend_to_date {MONEY} {FORECAST} pacing_vs_plan {METRICS}"
    ),
    "mart_channel_daily": ("SELECT * FROM chan_day", f"planned_spend {MONEY} {METRICS}"),
    "mart_funnel": (
        "SELECT * FROM funnel",
        "spend revenue ctr click_to_session cvr cpm cpc cpa_backend roas_backend cac",
    ),
    "mart_reconciliation": ("SELECT * FROM recon", "platform_spend ledger_spend difference difference_pct"),
    "mart_approvals": ("SELECT * FROM appr", APPROVALS),
    "mart_freshness": (_FRESH, ""),
    "mart_alerts": ("SELECT * FROM alerts", "value threshold"),
    "mart_exec_overview": (
        "SELECT * FROM overview",
        "ceiling approved committed spend ledger_spend planned_spend_to_date planned_spend_flight "
        f"{FORECAST} platform_conversions platform_revenue backend_revenue spend_backend_window "
        f"target_cpa_backend actual_cpa_backend remaining_of_ceiling pacing_vs_plan {METRICS}",
    ),
}

# What each report is sorted by.
_REPORT_ORDER = {
    "mart_campaign_performance": "client, channel NULLS LAST, campaign NULLS LAST, request_id NULLS LAST",
    "mart_channel_performance": "client, spend DESC NULLS LAST, channel NULLS LAST",
    "mart_channel_daily": "client, date, channel NULLS LAST",
    "mart_funnel": "client, level = 'All channels' DESC, spend DESC NULLS LAST, level NULLS LAST",
    "mart_approvals": "client, request_id",
    "mart_alerts": "client, severity, rule, campaign NULLS LAST, channel NULLS LAST, detail",
    "mart_reconciliation": "client, campaign NULLS LAST, channel NULLS LAST, request_id NULLS LAST",
    "mart_freshness": "client, source",
    "mart_exec_overview": "client",
}

_CLAIM = f"""
SELECT client, channel, claimed AS platform_conversions, orders AS crm_orders,
       round({div("claimed", "orders")}, 2) AS over_claim_ratio
FROM (SELECT client, channel, sum(platform_conversions) AS claimed, CAST(sum(backend_orders) AS bigint) AS orders
      FROM fact WHERE has_crm_data GROUP BY client, channel)"""

_WEEKS = f"""
SELECT client, week, channel, CAST(round(spent) AS double) AS spend, claimed AS platform_conversions,
       round({div("spent", "claimed")}) AS cpa_platform, orders AS backend_orders,
       round({div("covered", "orders")}) AS cpa_backend
FROM (SELECT client, date - CAST(isodow(date) - 1 AS integer) AS week, channel,
             sum(CAST(spend AS decimal(24, 6))) AS spent,
             sum(CAST(spend_backend_window AS decimal(24, 6))) AS covered, sum(platform_conversions) AS claimed,
             CAST(sum(backend_orders) AS bigint) AS orders
      FROM fact WHERE has_platform_data GROUP BY ALL)"""


def statements() -> dict[str, str]:
    out: dict[str, str] = {}

    def put(name: str, body: str, doubles: str = "", source: str = "events") -> None:
        out[name] = _on(source, body, doubles)

    counts = {
        "platform_daily": "raw_platform", "web_sessions": "raw_web", "crm_orders": "raw_crm",
        "plan_daily": "raw_plan", "source_freshness": "raw_freshness",
        "gate_engagement": "raw_engagement", "gate_requests": "raw_requests",
        "gate_campaigns": "raw_campaigns", "gate_spend": "raw_spend",
    }
    put(
        "load_counts",
        " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {t}" for n, t in counts.items()),
    )
    put("extract_csv_rows", "SELECT * FROM raw_platform", ADS_MONEY)
    put("landed_platform_rows", "SELECT * FROM raw_platform", ADS_MONEY)
    landed = {n: t for n, t in counts.items() if n in ("platform_daily", "web_sessions", "source_freshness")}
    put(
        "landed_counts",
        " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {t}" for n, t in landed.items())
        + " UNION ALL SELECT 'crm_orders', 0 UNION ALL SELECT 'plan_daily', 0",
    )
    put("state_engagement", "SELECT client, currency, ceiling FROM raw_engagement", "ceiling")
    put(
        "state_requests",
        "SELECT client, request_id AS id, campaign_scope AS campaign, channel, requested_amount AS amount, "
        "approved_amount, strftime(start_date, '%Y-%m-%d') AS start, strftime(end_date, '%Y-%m-%d') AS \"end\", "
        "daily_cap, status, summary, strftime(requested_at, '%Y-%m-%dT%H:%M:%S+00:00') AS requested_at, "
        "strftime(decided_at, '%Y-%m-%dT%H:%M:%S+00:00') AS decided_at FROM raw_requests",
        "amount approved_amount daily_cap",
    )
    put(
        "state_campaigns",
        "SELECT client, campaign, request_id, channel, budget, daily_budget, "
        "strftime(start_date, '%Y-%m-%d') AS start, strftime(end_date, '%Y-%m-%d') AS \"end\", status FROM raw_campaigns",
        "budget daily_budget",
    )
    put(
        "state_spend",
        "SELECT client, campaign, ledger_spend AS amount, strftime(date, '%Y-%m-%d') AS date FROM raw_spend",
        "amount",
    )
    put("stg_platform_daily", "SELECT * RENAME (source AS platform) FROM raw_platform", ADS_MONEY)
    put("stg_web_sessions", "SELECT * FROM raw_web")
    put("stg_crm_orders", "SELECT * FROM raw_crm", "revenue")
    put("stg_plan_daily", "SELECT * FROM raw_plan", "planned_spend kpi_target")
    put("stg_source_freshness", _FRESH)
    put("stg_gate_engagement", "SELECT * FROM raw_engagement", "ceiling")
    put("stg_gate_requests", "SELECT * FROM raw_requests", REQUEST)
    put("stg_gate_campaigns", "SELECT * FROM raw_campaigns", "budget daily_budget")
    put("stg_gate_spend", "SELECT * FROM raw_spend", "ledger_spend")
    put("as_of_dates", "SELECT * FROM coverage")
    put("reporting_context", "SELECT coverage.*, refday.d AS ref_date FROM coverage JOIN refday USING (client)")
    put(
        "daily_activity",
        "SELECT client, date, campaign, CAST(sum(s) AS bigint) AS sessions, CAST(sum(o) AS bigint) AS backend_orders, "
        f"{xs('r')} AS backend_revenue, CAST(sum(w) AS bigint) AS new_customers, {xs('l')} AS ledger_spend FROM ("
        "SELECT client, date, campaign, sessions AS s, NULL AS o, NULL AS r, NULL AS w, NULL AS l FROM raw_web UNION ALL "
        "SELECT client, date, campaign, NULL, 1, revenue, new_customer::integer, NULL FROM raw_crm UNION ALL "
        "SELECT client, date, campaign, NULL, NULL, NULL, NULL, ledger_spend FROM raw_spend) GROUP BY client, date, campaign",
        "backend_revenue ledger_spend",
    )
    put("campaign_day_spine", "SELECT * FROM spine")
    for name, (body, doubles) in _MODELS.items():
        put(name, body, doubles)
        put(f"{name}_lineitem", body, doubles, "lineitem")
        if name in _REPORT_ORDER:
            place = f"row_number() OVER (ORDER BY {_REPORT_ORDER[name]}) AS position"
            put(f"report_{name[5:]}", f"SELECT *, {place} FROM ({body})", doubles)
    # The same models over the saved fact, and after a restatement of it.
    for name in ("fct_performance_daily", "mart_campaign_performance", "mart_channel_performance", "mart_funnel",
                 "mart_channel_daily", "mart_reconciliation", "mart_approvals"):
        put(f"{name}_stored", *_MODELS[name])
    put("fct_performance_daily_restated", *_MODELS["fct_performance_daily"])
    put("mart_campaign_performance_one_client", *_MODELS["mart_campaign_performance"])
    put(
        "save_counts",
        " UNION ALL ".join(
            f"SELECT '{name}' AS model, count(*) AS rows, "
            + ("count(*) - count(spend) AS no_spend, " + xs("spend") + " AS spend" if "spend" in doubles.split()
               else "NULL::bigint AS no_spend, NULL::double AS spend")
            + f" FROM ({body})"
            for name, (body, doubles) in _MODELS.items()
        ),
        "spend",
    )
    put("campaign_totals", "SELECT * FROM totals", TOTALS)
    put("campaign_run_rate", "SELECT * FROM rate", "low_daily mean_daily high_daily")
    put(
        "cpa_windows",
        "SELECT client, campaign, channel, cpa_last3, conv_last3, cpa_prior7 FROM win",
        "cpa_last3 conv_last3 cpa_prior7",
    )
    for rule in TEXTS:
        put(f"alert_{rule}", f"SELECT * FROM alerts WHERE rule = '{rule}'", "value threshold")
    put("spend_trend", "SELECT * FROM trend", "plan_cum spend_cum")
    put("report_spend_trend", "SELECT *, row_number() OVER (ORDER BY client, date) AS position FROM trend", "plan_cum spend_cum")
    put("spend_trend_lineitem", "SELECT * FROM trend", "plan_cum spend_cum", "lineitem")
    put("platform_over_claim", _CLAIM, "platform_conversions over_claim_ratio")
    weeks = "spend platform_conversions cpa_platform cpa_backend"
    put("channel_by_week", _WEEKS, weeks)
    put("channel_by_week_lineitem", _WEEKS, weeks, "lineitem")
    put("answer_provenance", "SELECT client, platform_as_of, crm_as_of, (SELECT bool_or(is_synthetic) FROM raw_freshness f WHERE f.client = coverage.client) AS synthetic FROM coverage")
    put(
        "ads_account_ids",
        "SELECT client, id AS account_id, length(id) = 10 AS is_valid FROM "
        "(SELECT client, regexp_replace('123-456-789' || substring(client, 2), '[^0-9]', '', 'g') AS id FROM raw_engagement)",
    )
    put(
        "ads_extraction_window",
        "SELECT client, (SELECT max(date) FROM log) - 13 AS start, (SELECT max(date) FROM log) AS \"end\" FROM raw_engagement",
    )
    put(
        "ads_report_rows",
        "SELECT client, platform_id AS id, platform_name AS name, strftime(date, '%Y-%m-%d') AS date, "
        "CAST(CAST(round(spend * 100) AS bigint) * 10000 AS varchar) AS \"costMicros\" FROM ads",
    )
    put(
        "ads_rows_in_window",
        "SELECT client, date, platform_id, platform_name, channel, impressions, clicks, spend, "
        "platform_conversions, platform_revenue FROM ads_in",
        ADS_MONEY,
    )
    put("ads_platform_extract", "SELECT * FROM ads_extract", ADS_MONEY)
    put("ads_unmapped_campaigns", "SELECT DISTINCT client, platform_name FROM ads_named WHERE NOT is_mapped")
    put(
        "ads_extract_summary",
        "SELECT e.client, count(x.date) AS rows, (SELECT max(date) FROM log) - 13 AS start, (SELECT max(date) FROM log) AS \"end\", "
        "coalesce(sum(x.spend), 0) AS spend, 'Asia/Kolkata' AS account_time_zone "
        "FROM raw_engagement e LEFT JOIN ads_extract x ON x.client = e.client GROUP BY e.client",
        "spend",
    )
    put(
        "freshness_upsert",
        "SELECT client, source, data_as_of, is_synthetic FROM raw_freshness WHERE source <> 'ad_platforms' "
        "UNION ALL SELECT client, 'ad_platforms', (SELECT max(date) FROM log), false FROM raw_engagement",
    )
    columns = "client, source, date, campaign, channel, impressions, clicks, spend, platform_conversions, platform_revenue, is_synthetic"
    put(
        "restated_platform",
        f"SELECT {columns} FROM raw_platform WHERE date < (SELECT max(date) FROM log) - 13 OR date > (SELECT max(date) FROM log) "
        f"UNION ALL SELECT {columns} FROM ads_extract",
        ADS_MONEY,
    )
    put("approved_total", "SELECT client, approved FROM standing", "approved")
    put(
        "ledger_spent",
        "SELECT client, campaign, sum(ledger_spend) AS spent FROM raw_spend GROUP BY client, campaign",
        "spent",
    )
    put("ledger_position", "SELECT * FROM standing", POSITION)
    put("pending_requests", "SELECT * FROM raw_requests WHERE status = 'PENDING'", REQUEST)
    put("request_by_id", "SELECT * FROM raw_requests WHERE client = 'c1' AND request_id = 'SAR-1-2'", REQUEST)
    put(
        "campaigns_over_budget",
        "SELECT g.client, g.campaign, g.budget, s.spent FROM raw_campaigns g JOIN "
        "(SELECT client, campaign, sum(ledger_spend) AS spent FROM raw_spend GROUP BY client, campaign) s "
        "ON s.client = g.client AND s.campaign = g.campaign WHERE s.spent > g.budget",
        "budget spent",
    )
    put(
        "budget_line",
        "SELECT r.client, request_id, requested_amount, ceiling, approved, spent, "
        "ceiling - approved - requested_amount AS headroom_after "
        "FROM raw_requests r JOIN standing p ON p.client = r.client WHERE status = 'PENDING'",
        "requested_amount ceiling approved spent headroom_after",
    )
    put(
        "authorise_actions",
        "SELECT client, action_id, type, campaign, rid AS request_id, reason IS NULL AS allowed, reason, "
        "committed_elsewhere, live_daily_elsewhere FROM judged",
        "committed_elsewhere live_daily_elsewhere",
    )
    put(
        "check_requests",
        "SELECT client, proposal_id, reason IS NULL AS valid, reason FROM ("
        "SELECT l.client, event_id AS proposal_id, CASE WHEN c <= 0 OR event_id % 11 = 0 THEN 'not_positive' "
        "WHEN event_id % 13 = 0 THEN 'start_after_end' WHEN approved + c > ceiling THEN 'over_ceiling' END AS reason "
        "FROM log l JOIN standing p ON p.client = l.client WHERE event_type = 'purchase')",
    )
    out["check_approvals"] = f"{APPROVALS_REPLAYED} SELECT * EXCLUDE (rejects) FROM audited_decisions"
    # The same log with every 11th decision a rejection.
    rejecting = APPROVALS_REPLAYED.replace("false AS rejects", "event_id % 11 = 0 AS rejects")
    out["check_decisions"] = (
        f"{rejecting} SELECT client, request_id, \"at\", seq, CASE WHEN rejects THEN 'reject' ELSE 'approve' END AS decision, "
        "running_approved, valid, reason FROM audited_decisions"
    )
    out["request_state_decided"] = f"""{rejecting}
SELECT s.client, 'RQ-' || s.event_id AS request_id, s.value AS requested_amount,
       CASE WHEN d.seq IS NULL THEN 'PENDING' WHEN d.rejects THEN 'REJECTED' ELSE 'APPROVED' END AS status,
       CASE WHEN d.seq IS NULL OR d.rejects THEN 0 ELSE d.approved END AS approved_amount,
       CASE WHEN d.seq IS NULL OR d.rejects THEN (s.c // 10)::double / 100 ELSE d.cap END AS daily_cap, d."at" AS decided_at
FROM signups s LEFT JOIN audited_decisions d ON d.client = s.client AND d.request_id = 'RQ-' || s.event_id AND d.valid"""
    put(
        "check_pauses",
        "SELECT client, action_id, campaign, launched AS valid, CASE WHEN NOT launched THEN 'no_campaign' END AS reason "
        "FROM asked WHERE type = 'pause'",
    )
    put(
        "check_ledger_entries",
        "SELECT client, entry_id, campaign, reason IS NULL AS valid, reason, CASE WHEN reason IS NULL THEN amount END AS booked FROM ("
        "SELECT e.client, entry_id, e.campaign, amount, CASE WHEN g.campaign IS NULL THEN 'no_campaign' WHEN amount IS NULL THEN 'no_amount' "
        "WHEN strange THEN 'unreadable_date' END AS reason FROM (SELECT client, event_id AS entry_id, "
        "CASE WHEN event_id % 6 = 0 THEN 'new_' || (event_id % 40) ELSE campaign END AS campaign, "
        "CASE WHEN event_id % 35 <> 0 THEN c::double / 100 END AS amount, event_id % 25 = 0 AS strange "
        "FROM log WHERE event_type = 'click') e LEFT JOIN raw_campaigns g ON g.client = e.client AND g.campaign = e.campaign)",
        "booked",
    )
    out["request_state_replay"] = f"""{APPROVALS_REPLAYED}
SELECT s.client, 'RQ-' || s.event_id AS request_id, s.value AS requested_amount,
       CASE WHEN d.seq IS NULL THEN 'PENDING' ELSE 'APPROVED' END AS status, coalesce(d.approved, 0) AS approved_amount,
       coalesce(d.cap, (s.c // 10)::double / 100) AS daily_cap, d."at" AS decided_at
FROM signups s LEFT JOIN audited_decisions d ON d.client = s.client AND d.request_id = 'RQ-' || s.event_id AND d.valid"""
    put(
        "check_decreases",
        "SELECT client, action_id, campaign, reason IS NULL AS valid, reason, "
        "CASE WHEN reason IS NULL THEN least(g_daily, coalesce(daily_budget, g_daily)) END AS daily_budget_after FROM ("
        "SELECT a.*, CASE WHEN NOT launched THEN 'no_campaign' WHEN budget IS NULL OR budget > g_budget THEN 'raises_budget' "
        "WHEN budget < coalesce((SELECT round(sum(ledger_spend), 2) FROM raw_spend s "
        "WHERE s.client = a.client AND s.campaign = a.campaign), 0) THEN 'below_spent' END AS reason "
        "FROM asked a WHERE type = 'decrease_budget')",
        "daily_budget_after",
    )
    put("campaign_state_replay", "SELECT * FROM replayed", "budget daily_budget")
    put("campaign_state_from_log", "SELECT * FROM replayed", "budget daily_budget")
    put(
        "audit_positions",
        "SELECT client, event, count(*) AS events, min(line) AS first_line, max(line) AS last_line, CAST(sum(line) AS bigint) AS lines "
        'FROM (SELECT client, event, row_number() OVER (PARTITION BY client ORDER BY "at", seq) AS line FROM audited) GROUP BY ALL',
    )
    put("audit_counts", "SELECT client, event, reason, count(*) AS events FROM audited GROUP BY ALL")
    put(
        "refused_decisions",
        "SELECT client, event, count(*) AS refused FROM audited WHERE event LIKE 'decision_refused%' GROUP BY ALL",
    )
    put(
        "requests_to_send",
        "SELECT client, request_id FROM raw_requests WHERE status = 'PENDING' AND client <> 'c1' AND request_id NOT LIKE '%3'",
    )
    put(
        "pending_request_owner",
        "SELECT 7::bigint AS user_id, request_id, count(*) AS clients, "
        "CASE WHEN count(*) = 1 THEN min(client) END AS client "
        "FROM raw_requests WHERE status = 'PENDING' AND client <> 'c1' GROUP BY request_id",
    )
    put(
        "ambiguous_request_owner",
        "SELECT 7::bigint AS user_id, id AS request_id, count(*) AS clients, CASE WHEN count(*) = 1 THEN min(client) END AS client "
        "FROM (SELECT client, regexp_replace(request_id, 'SAR-[0-9]+-', 'SAR-') AS id FROM raw_requests WHERE client <> 'c1') "
        "WHERE NOT (client = 'c2' AND id = 'SAR-1') GROUP BY id",
    )
    put(
        "ads_rows_without_account",
        f"SELECT client, count(*) AS rows, {xs('spend')} AS spend FROM ads WHERE client = 'c2' AND impressions > 0 GROUP BY client",
        "spend",
    )
    put("ads_currency_mismatches", "SELECT client, 'EUR' AS currency, currency AS expected FROM raw_engagement WHERE client = 'c1'")
    put(
        "duplicate_campaign_days",
        "SELECT client, date, campaign, count(*) AS n FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE day(date) % 10 = 3) "
        "GROUP BY client, date, campaign HAVING count(*) > 1",
    )
    out["duplicate_order_lines"] = (
        "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"
    )
    checked = ("date", "campaign", "spend", "sessions", "backend_orders")
    put(
        "null_counts",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM fact" for c in checked
        ),
    )
    put("null_rows", "SELECT client, date, campaign FROM fact WHERE backend_orders IS NULL")
    put(
        "spend_agreement",
        "SELECT client, extract, campaigns, channels, channel_days, overview, "
        "greatest(extract, campaigns, channels, channel_days, overview) - least(extract, campaigns, channels, channel_days, overview) < 0.005 AS agree FROM "
        "(SELECT client, round(sum(spend), 2) AS extract FROM raw_platform GROUP BY client) JOIN "
        "(SELECT client, round(sum(spend), 2) AS campaigns FROM camp GROUP BY client) USING (client) JOIN "
        "(SELECT client, round(sum(spend), 2) AS channels FROM chan GROUP BY client) USING (client) JOIN "
        "(SELECT client, round(sum(spend), 2) AS channel_days FROM chan_day GROUP BY client) USING (client) JOIN "
        "(SELECT client, round(spend, 2) AS overview FROM overview) USING (client)",
        "extract campaigns channels channel_days overview",
    )
    put(
        "budget_agreement",
        "SELECT o.client, o.ceiling = p.ceiling AS ceiling_agrees, round(o.approved, 2) = round(p.approved, 2) AS approved_agrees, "
        "round(o.committed, 2) = round(p.committed, 2) AS committed_agrees, o.approved <= o.ceiling AS approved_within_ceiling "
        "FROM overview o JOIN standing p ON p.client = o.client",
    )
    put(
        "backend_after_coverage",
        "SELECT f.client, f.date, f.campaign FROM fact f JOIN coverage a ON a.client = f.client "
        "WHERE f.date > a.crm_as_of - 2 AND (backend_orders IS NOT NULL OR spend_backend_window <> 0)",
    )
    put(
        "forecast_out_of_order",
        "SELECT client, campaign FROM camp WHERE forecast_spend_base > forecast_spend_low + 1e-6 "
        "OR forecast_spend_low > forecast_spend_high + 1e-6 OR forecast_spend_high > budget + 1e-6",
    )
    put(
        "mixed_provenance",
        "SELECT client, count(*) FILTER (is_synthetic) AS synthetic, count(*) FILTER (NOT is_synthetic) AS real "
        "FROM (SELECT client, NOT (source = 'plan' AND client <> 'c1') AS is_synthetic FROM raw_freshness) GROUP BY client HAVING bool_or(is_synthetic) AND bool_or(NOT is_synthetic)",
    )
    out["ads_platform_extract_landed"] = out["ads_platform_extract"]
    return out
