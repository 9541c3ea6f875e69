"""Declared schemas of every input. All money is in the client's currency, as double."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _schema(columns: str) -> T.StructType:
    """A flat schema from "name type, ..." (built without a running session)."""
    pairs = (c.split(" ") for c in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Extract name -> columns of its file. The client is not a column of the file.
EXTRACTS: dict[str, T.StructType] = {
    "platform_daily": _schema(
        "source string, date date, campaign string, channel string, impressions bigint, "
        "clicks bigint, spend double, platform_conversions double, platform_revenue double, "
        "is_synthetic boolean"
    ),
    "web_sessions": _schema(
        "date date, utm_source string, utm_medium string, utm_campaign string, "
        "sessions bigint, is_synthetic boolean"
    ),
    "crm_orders": _schema(
        "order_id string, order_date date, utm_campaign string, revenue double, "
        "new_customer boolean, is_synthetic boolean"
    ),
    "plan_daily": _schema(
        "date date, campaign string, channel string, planned_spend double, kpi string, "
        "kpi_target double, is_synthetic boolean"
    ),
    "source_freshness": _schema("source string, data_as_of date, is_synthetic boolean"),
}

# Approval-gate tables, flattened from one nested state document per client.
GATE: dict[str, T.StructType] = {
    "gate_engagement": _schema("client string, currency string, ceiling double"),
    "gate_requests": _schema(
        "client string, id string, campaign string, channel string, amount double, "
        "approved_amount double, start string, end string, daily_cap double, status string, "
        "summary string, requested_at string, decided_at string"
    ),
    "gate_campaigns": _schema(
        "client string, campaign string, request_id string, channel string, budget double, "
        "daily_budget double, start string, end string, status string"
    ),
    "gate_spend": _schema("client string, campaign string, amount double, date string"),
}

RAW_TABLES = (*EXTRACTS, *GATE)

# Nested inputs, as DDL.
STATE = (
    "client string, currency string, ceiling double, seq bigint, "
    "requests map<string, struct<id:string, campaign:string, channel:string, amount:double, "
    "start:string, end:string, daily_cap:double, summary:string, requested_by:string, "
    "requested_at:string, status:string, approved_amount:double, decided_at:string, "
    "note:string, detail:map<string,string>, nonces:map<string,string>>>, "
    "campaigns map<string, struct<request_id:string, channel:string, budget:double, "
    "daily_budget:double, start:string, end:string, status:string>>, "
    "spend array<struct<campaign:string, amount:double, date:string>>, "
    "channels map<string, struct<user_id:bigint, chat_id:bigint>>"
)

ACTION = (
    "struct<type:string, campaign:string, request_id:string, channel:string, budget:double, "
    "daily_budget:double, start:string, end:string>"
)

# One line of the append-only audit log; a field an event does not carry is null.
AUDIT = (
    "client string, seq bigint, at string, actor string, event string, "
    "request_id string, amount double, channel string, campaign string, "
    "approved_amount double, daily_cap double, via string, user_id bigint, "
    f"reason string, date string, note string, action {ACTION}"
)

# A landed ads report: a file holds a list of batches, each with result rows.
ADS_BATCHES = (
    "results array<struct<"
    "campaign:struct<id:string, name:string, advertisingChannelType:string, status:string>, "
    "metrics:struct<impressions:string, clicks:string, costMicros:string, "
    "conversions:string, conversionsValue:string>, "
    "segments:struct<date:string>>>"
)
ADS_ACCOUNTS = (
    "results array<struct<customer:struct<id:string, currencyCode:string, timeZone:string>>>"
)
