-- question: Per channel, how many conversions do the platforms claim for each order in the CRM?
-- period: Days the CRM covers
-- source: core.fct_performance_daily
-- metrics: Conversions that the platforms report, divided by the orders the CRM holds for the same campaigns
-- caveats: Two platforms may count one order. A ratio says nothing about what an ad caused.
SELECT client, channel, claimed AS platform_conversions, orders AS crm_orders,
       round(claimed / nullif(orders, 0), 2) AS over_claim_ratio
FROM (
    SELECT client, channel, sum(platform_conversions) AS claimed, sum(backend_orders) AS orders
    FROM core.fct_performance_daily
    WHERE has_crm_data
    GROUP BY client, channel
)
ORDER BY over_claim_ratio DESC NULLS LAST
