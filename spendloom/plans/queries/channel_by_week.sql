-- question: What did each channel spend and bring in per ISO week?
-- period: ISO weeks of the flight, up to the last day the platforms cover
-- source: core.fct_performance_daily
-- metrics: Platform CPA divides all spend by claimed conversions, backend CPA the spend of CRM-covered days by orders
-- note: summed as decimals, so the order of adding never shows, and rounded once
-- caveats: Each platform claims for itself. The last week can be cut short, and the CRM is a day late.
WITH weekly AS (
    SELECT client, CAST(date_trunc('week', date) AS date) AS week, channel,
           sum(CAST(spend AS decimal(24, 6))) AS spent,
           sum(CAST(spend_backend_window AS decimal(24, 6))) AS spent_covered,
           sum(platform_conversions) AS claimed, sum(backend_orders) AS orders
    FROM core.fct_performance_daily
    WHERE has_platform_data
    GROUP BY ALL
)
SELECT client, week, channel, CAST(round(spent) AS double) AS spend, claimed AS platform_conversions,
       round(CAST(spent AS double) / nullif(claimed, 0)) AS cpa_platform, orders AS backend_orders,
       round(CAST(spent_covered AS double) / nullif(orders, 0)) AS cpa_backend
FROM weekly
ORDER BY client, week NULLS LAST, channel NULLS LAST
