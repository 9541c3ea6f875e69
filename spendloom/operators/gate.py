"""The approval gate and its budget ledger, as batch operators over many clients' tables.

Inputs are the staged gate tables, proposed actions (`schemas.ACTION` plus client, id and
day) and audit events. Money totals are summed as decimals, so they are exact and do not
depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendloom.functions.values import money, zero_if_null
from spendloom.operators import approvals
from spendloom.operators.joins import lookup, lookup_of_many
from spendloom.sources.scratch import written

# Action kinds and the scope that covers every campaign.
SPEND_ACTIONS = ("launch", "increase_budget", "extend_flight")
SAFE_ACTIONS = ("pause", "decrease_budget")
ANY_CAMPAIGN = "*"


def exact(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(20,2)")


def total(value: Column | str) -> Column:
    """An exact money sum, as double; 0 for no rows."""
    return F.coalesce(F.sum(exact(value)), F.lit(0)).cast("double")


def present(text: str) -> Column:
    """An empty string stands for a missing one."""
    return F.nullif(F.col(text), F.lit(""))


def first_broken(*rules: tuple[Column, str]) -> Column:
    """Code of the first rule not known to hold (a null counts as broken); null when all hold."""
    return F.coalesce(*(F.when(~F.coalesce(rule, F.lit(False)), code) for rule, code in rules))


# ---------------------------------------------------------------- ledger


def approved_total(requests: DataFrame) -> DataFrame:
    granted = F.when(F.col("status") == "APPROVED", F.col("approved_amount"))
    return requests.groupBy("client").agg(total(granted).alias("approved"))


def spent(ledger: DataFrame, by_campaign: bool = False) -> DataFrame:
    keys = ["client", "campaign"] if by_campaign else ["client"]
    return ledger.groupBy(*keys).agg(total("ledger_spend").alias("spent"))


def ledger_position(
    engagement: DataFrame, requests: DataFrame, campaigns: DataFrame, ledger: DataFrame
) -> DataFrame:
    committed = campaigns.groupBy("client").agg(total("budget").alias("committed"))
    rows = engagement.select("client", "currency", "ceiling")
    for part in (approved_total(requests), committed, spent(ledger)):
        rows = rows.join(part, "client", "left")
    rows = rows.withColumns({c: zero_if_null(c) for c in ("approved", "committed", "spent")})
    return rows.withColumns(
        {
            "unapproved_headroom": money(F.col("ceiling") - F.col("approved")),
            "remaining_of_ceiling": money(F.col("ceiling") - F.col("spent")),
        }
    )


def pending_requests(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("status") == "PENDING")


def request_by_id(requests: DataFrame, client: str, request_id: str) -> DataFrame:
    return requests.filter((F.col("client") == client) & (F.col("request_id") == request_id))


def campaigns_over_budget(campaigns: DataFrame, ledger: DataFrame) -> DataFrame:
    return (
        campaigns.select("client", "campaign", "budget")
        .join(spent(ledger, by_campaign=True), ["client", "campaign"])
        .filter(F.col("spent") > F.col("budget"))
    )


def budget_line(requests: DataFrame, position: DataFrame) -> DataFrame:
    """What an approver sees next to a pending request: the ceiling and what would be left."""
    return pending_requests(requests).join(
        position.select("client", "ceiling", "approved", "spent"), "client", "left"
    ).select(
        "client", "request_id", "requested_amount", "ceiling", "approved", "spent",
        (F.col("ceiling") - F.col("approved") - F.col("requested_amount")).alias("headroom_after"),
    )


# ---------------------------------------------------------------- checks


def commitments(campaigns: DataFrame) -> DataFrame:
    """Per request: all budgets, paused ones too, and the daily budgets of live campaigns."""
    live = F.when(F.col("status") == "live", F.col("daily_budget"))
    return campaigns.groupBy("client", "request_id").agg(
        F.sum(exact("budget")).alias("all_committed"),
        F.sum(exact(live)).alias("all_live_daily"),
    )


def authorise(
    actions: DataFrame, campaigns: DataFrame, requests: DataFrame, salts: int = 16
) -> DataFrame:
    """Each proposed action against its approval: ``allowed`` and the first failing reason.

    ``actions``: client, action_id, type, campaign, request_id, channel, budget,
    daily_budget, start, end, today. All actions are checked against one snapshot; the state
    after running them is `replay`. Whatever is not known to be allowed is refused.
    """
    have = campaigns.select(
        "client", "campaign",
        F.lit(True).alias("launched"),
        F.col("request_id").alias("c_request"), F.col("channel").alias("c_channel"),
        F.col("budget").alias("c_budget"), F.col("daily_budget").alias("c_daily"),
        F.col("start_date").alias("c_start"), F.col("end_date").alias("c_end"),
        F.col("status").alias("c_status"),
    )
    rows = lookup(actions, have, ["client", "campaign"], ["action_id"], salts).withColumn(
        "rid", F.coalesce(present("request_id"), present("c_request"))
    )
    terms = requests.select(
        "client", F.col("request_id").alias("rid"),
        F.col("channel").alias("r_channel"), F.col("campaign_scope").alias("r_scope"),
        F.col("status").alias("r_status"), F.col("approved_amount").alias("r_approved"),
        F.col("daily_cap").alias("r_cap"),
        F.col("start_date").alias("r_start"), F.col("end_date").alias("r_end"),
    ).join(
        commitments(campaigns).withColumnRenamed("request_id", "rid"), ["client", "rid"], "left"
    )
    rows = lookup(rows, terms, ["client", "rid"], ["action_id"], salts)

    kind, launched = F.col("type"), F.coalesce("launched", F.lit(False))
    # Missing fields fall back to the campaign, then to the request; a budget does not.
    channel = F.coalesce(present("channel"), present("c_channel"))
    start = F.coalesce(present("start").try_cast("date"), "c_start", "r_start")
    end = F.coalesce(present("end").try_cast("date"), "c_end", "r_end")
    readable = lambda c: present(c).isNull() | present(c).try_cast("date").isNotNull()
    budget = money(F.coalesce("budget", F.lit(0.0)))
    daily = money(F.coalesce("daily_budget", "c_daily", F.lit(0.0)))
    # Others under the request = the request's total without this campaign's own share.
    own = launched & (F.col("c_request") == F.col("rid"))
    own_live = own & (F.col("c_status") == "live")

    def others(all_of: str, mine: Column, is_mine: Column) -> Column:
        without = zero_if_null(all_of) - zero_if_null(F.when(is_mine, exact(mine)))
        return without.cast("double")

    committed = others("all_committed", F.col("c_budget"), own)
    live_daily = others("all_live_daily", F.col("c_daily"), own_live)
    raised = (budget > F.col("c_budget")) | (daily > F.col("c_daily"))
    in_scope = F.col("r_scope").eqNullSafe(F.lit(ANY_CAMPAIGN)) | F.col("r_scope").eqNullSafe(
        F.col("campaign")
    )
    dates_only = kind == "extend_flight"
    # In order: what must hold, and the reason when it does not (or is not known to).
    reason = first_broken(
        (kind.isin(*SPEND_ACTIONS), "unknown_action"),
        (F.col("r_status").isNotNull(), "no_request"),
        (F.col("r_status") == "APPROVED", "not_approved"),
        (F.col("today") <= F.col("r_end"), "expired"),
        ((kind == "launch") | launched, "not_launched"),
        ((kind != "launch") | ~launched, "already_exists"),
        (channel.eqNullSafe(F.col("r_channel")), "channel_mismatch"),
        (in_scope, "campaign_out_of_scope"),
        (readable("start") & readable("end"), "unreadable_date"),
        ((start >= F.col("r_start")) & (end <= F.col("r_end")), "outside_approved_dates"),
        (dates_only | ((budget > 0) & (daily > 0)), "budget_not_positive"),
        ((kind != "increase_budget") | raised, "not_an_increase"),
        (dates_only | (committed + budget <= F.col("r_approved")), "over_approved_amount"),
        (dates_only | (live_daily + daily <= F.col("r_cap")), "over_daily_cap"),
    )
    reason = F.when(kind.isin(*SAFE_ACTIONS), F.lit(None)).otherwise(reason)
    return rows.select(
        "client", "action_id", "type", "campaign", F.col("rid").alias("request_id"),
        reason.isNull().alias("allowed"), reason.alias("reason"),
        committed.alias("committed_elsewhere"), live_daily.alias("live_daily_elsewhere"),
    )


def check_requests(proposals: DataFrame, position: DataFrame, salts: int = 16) -> DataFrame:
    """May a spend request be filed? ``proposals``: client, proposal_id, amount, daily_cap,
    start, end; ``position``: the ledger position."""
    amount, cap = money(F.col("amount")), money(F.col("daily_cap"))
    room = position.select("client", "ceiling", "approved")
    rows = lookup(proposals, room, ["client"], ["proposal_id"], salts)
    reason = first_broken(
        ((amount > 0) & (cap > 0), "not_positive"),
        (F.col("start").try_cast("date") <= F.col("end").try_cast("date"), "start_after_end"),
        (F.col("approved") + amount <= F.col("ceiling"), "over_ceiling"),
    )
    return rows.select(
        "client", "proposal_id", reason.isNull().alias("valid"), reason.alias("reason")
    )


def check_approvals(
    decisions: DataFrame, requests: DataFrame, engagement: DataFrame, salts: int = 16, most: int = approvals.MOST
) -> DataFrame:
    """Recorded approvals, replayed: would the gate have taken each one, given those before it?

    ``decisions``: client, request_id, at, seq, approved_amount and daily_cap (null: as
    requested), via (null: not from a chat); ``requests``: client, request_id, requested_amount,
    daily_cap. A refused decision changes nothing: neither the approved total nor its request.
    ``running_approved`` is the total after the decision. Decisions on unknown requests stay in
    the result. A column ``decision`` may say "reject": a rejection decides its request, takes nothing of the
    ceiling and needs no amount; the column stays in the result. What doesn't depend on the order is decided in columns; the rest in stretches of a client's log
    (`approvals.accepted`), so that no task holds a client with more than ``most`` open decisions.
    """
    asked = requests.select(
        "client", "request_id", "requested_amount", F.col("daily_cap").alias("requested_cap")
    )
    has_kind = "decision" in decisions.columns
    rejects = F.coalesce(F.col("decision") == "reject", F.lit(False)) if has_kind else F.lit(False)
    kind = ["decision"] if has_kind else []
    rows = lookup_of_many(decisions, asked, ["client", "request_id"], ["seq"], most)
    rows = (
        lookup(rows, engagement.select("client", "ceiling"), ["client"], ["seq"], salts)
        .withColumn("approved", money(F.coalesce("approved_amount", "requested_amount")))
        .withColumn("cap", money(F.coalesce("daily_cap", "requested_cap")))
    )
    raised = (F.col("approved") > F.col("requested_amount")) | (F.col("cap") > F.col("requested_cap"))
    changed = (F.col("approved") != F.col("requested_amount")) | (F.col("cap") != F.col("requested_cap"))
    reason = first_broken(
        (F.col("requested_amount").isNotNull(), "no_request"),
        (rejects | (F.col("approved") > 0), "amount_not_positive"),
        (rejects | (F.col("cap") > 0), "cap_not_positive"),
        (rejects | F.col("via").isNull() | ~raised, "raised_from_chat"),
        (F.col("ceiling").isNotNull(), "no_engagement"),
    )
    cents = lambda c: F.coalesce(F.round(F.col(c) * 100).cast("bigint"), F.lit(0))
    known = written(
        rows.select(
            "client", "request_id", "at", "seq", *kind, F.when(~rejects, F.col("approved")).alias("approved"),
            F.when(~rejects, F.col("cap")).alias("cap"), (~rejects & F.coalesce(changed, F.lit(False))).alias("modified"),
            reason.alias("broken"), F.when(rejects, 0).otherwise(cents("approved")).alias("cents"),
        )
    )
    room = engagement.select("client", cents("ceiling").alias("room"))
    taken = approvals.accepted(known.where("broken is null"), room, salts, most).select(
        "client", "request_id", F.col("at").alias("t_at"), F.col("seq").alias("t_seq"), F.col("cents").alias("t_cents")
    )
    # A request has one accepted decision at most.
    rows = known.join(taken, ["client", "request_id"], "left")
    is_taken = F.coalesce((F.col("at") == F.col("t_at")) & (F.col("seq") == F.col("t_seq")), F.lit(False))
    rows = rows.withColumn("adds", F.when(is_taken, F.col("t_cents")).otherwise(0))
    verdict = (
        F.when((F.coalesce("broken", F.lit("")) != "no_request") & approvals.before("t_", ""), "already_decided")
        .when(F.col("broken").isNotNull(), F.col("broken"))
        .when(~is_taken, "over_ceiling")
    )
    return approvals.running(written(rows.withColumn("reason", verdict)), "adds", "total").select(
        "client", "request_id", "at", "seq", *kind, "approved", "cap", (F.col("total") / 100).alias("running_approved"),
        "modified", F.col("reason").isNull().alias("valid"), "reason",
    )


def request_states(requests: DataFrame, audited: DataFrame) -> DataFrame:
    """Requests after their recorded decisions (`check_approvals`): approved with the amount and
    cap that were granted, rejected, or still pending. A request has at most one valid decision."""
    rejected = F.col("decision") == "reject" if "decision" in audited.columns else F.lit(False)
    granted = audited.filter("valid").select(
        "client", "request_id", F.col("approved").alias("_amount"), F.col("cap").alias("_cap"),
        F.col("at").alias("decided_at"), F.coalesce(rejected, F.lit(False)).alias("_rejected"),
    )
    status = F.when(F.col("_rejected"), "REJECTED").when(F.col("decided_at").isNotNull(), "APPROVED").otherwise("PENDING")
    return requests.join(granted, ["client", "request_id"], "left").select(
        "client", "request_id", "requested_amount", status.alias("status"),
        F.coalesce("_amount", F.lit(0.0)).alias("approved_amount"),
        F.coalesce("_cap", "daily_cap").alias("daily_cap"), "decided_at",
    )


def check_decreases(
    actions: DataFrame, campaigns: DataFrame, ledger: DataFrame, salts: int = 16
) -> DataFrame:
    """Budget decreases: the campaign exists, the budget does not rise, and it stays at or above
    what was spent. ``daily_budget_after`` never rises either."""
    have = campaigns.select(
        "client", "campaign", F.col("budget").alias("c_budget"), F.col("daily_budget").alias("c_daily")
    ).join(spent(ledger, by_campaign=True), ["client", "campaign"], "left")
    rows = lookup(
        actions.filter(F.col("type") == "decrease_budget"),
        have, ["client", "campaign"], ["action_id"], salts,
    )
    new = money(F.col("budget"))
    reason = first_broken(
        (F.col("c_budget").isNotNull(), "no_campaign"),
        (new <= F.col("c_budget"), "raises_budget"),
        (new >= zero_if_null("spent"), "below_spent"),
    )
    after = F.least("c_daily", money(F.coalesce("daily_budget", "c_daily")))
    return rows.select(
        "client", "action_id", "campaign", reason.isNull().alias("valid"), reason.alias("reason"),
        F.when(reason.isNull(), after).alias("daily_budget_after"),
    )


def check_pauses(actions: DataFrame, campaigns: DataFrame, salts: int = 16) -> DataFrame:
    """Pauses: the campaign exists."""
    have = campaigns.select("client", "campaign", F.lit(True).alias("known"))
    rows = lookup(actions.filter(F.col("type") == "pause"), have, ["client", "campaign"], ["action_id"], salts)
    reason = first_broken((F.col("known"), "no_campaign"))
    return rows.select("client", "action_id", "campaign", reason.isNull().alias("valid"), reason.alias("reason"))


def check_ledger_entries(entries: DataFrame, campaigns: DataFrame, salts: int = 16) -> DataFrame:
    """Spend to be booked: the campaign exists and the day can be read. ``entries``: client, entry_id, campaign,
    amount, date (text). ``booked`` is the amount that goes into the ledger."""
    have = campaigns.select("client", "campaign", F.lit(True).alias("known"))
    rows = lookup(entries, have, ["client", "campaign"], ["entry_id"], salts)
    reason = first_broken(
        (F.col("known"), "no_campaign"),
        (F.col("amount").isNotNull(), "no_amount"),
        (F.col("date").try_cast("date").isNotNull(), "unreadable_date"),
    )
    return rows.select(
        "client", "entry_id", "campaign", reason.isNull().alias("valid"), reason.alias("reason"),
        F.when(reason.isNull(), money(F.col("amount"))).alias("booked"),
    )


# ---------------------------------------------------------------- audit log


# An event's place and a value in one whole number, of which a hash aggregate can take the largest: seconds, then
# sequence number, then the value, each with so many digits. 0 stands for no value.
SEQ_DIGITS, VALUE_DIGITS = 13, 14
_ZERO_MONEY, _ZERO_DAY = 5 * 10**13, 10**7
_WIDE = "decimal(38,0)"


def _within(number: Column, digits: int, what: str) -> Column:
    """The number, if it is 0 or more and has so many digits at most; any other fails the job."""
    bad = F.raise_error(F.concat(F.lit(f"{what} out of range: "), number.cast("string")))
    return F.when((number < 0) | (number >= 10**digits), bad.cast("bigint")).otherwise(number)


def _place() -> Column:
    """(at, seq) as one number; times have one-second resolution and sequence numbers start at -1."""
    at = _within(F.unix_seconds(F.col("at").cast("timestamp")), 11, "time")
    seq = _within(F.col("seq") + 1, SEQ_DIGITS, "sequence number")
    return (at.cast("decimal(11,0)") * F.lit(10**SEQ_DIGITS).cast("decimal(14,0)") + seq.cast("decimal(13,0)")).cast("decimal(24,0)")


def _coded_money(c: str) -> Column:
    cents = F.round(F.col(c) * 100).cast("bigint") + _ZERO_MONEY
    return F.coalesce(_within(cents, VALUE_DIGITS, "money"), F.lit(0))


def _coded_day(c: str) -> Column:
    return F.coalesce(F.unix_date(present(c).try_cast("date")).cast("bigint") + _ZERO_DAY, F.lit(0))


def _value(packed: str) -> Column:
    code = F.pmod(F.col(packed), F.lit(10**VALUE_DIGITS).cast("decimal(15,0)")).cast("bigint")
    return F.nullif(code, F.lit(0))


def _order(packed: str) -> Column:
    """The place in a packed number, to compare with those of other fields."""
    return F.floor(F.col(packed) / F.lit(10**VALUE_DIGITS).cast("decimal(15,0)"))


def replay(executed: DataFrame, requests: DataFrame, salts: int = 16) -> DataFrame:
    """Campaign state after all executed actions. ``executed``: client, at, seq, action struct.

    Every field is decided by the last event that sets it, except the daily budget: a launch
    or increase sets it, a decrease only lowers it. So it is the last value set, lowered to
    the least decrease after that. Places and values are packed into numbers, so one hash aggregate with
    map-side partial results finds all last values: a campaign's log is never gathered or sorted. The terms of a
    launch that are text are keys of that aggregate, and a window over a campaign's few launches picks the last.
    """
    key = ["client", "campaign"]
    kind = F.col("action.type")
    events = executed.select(
        "client", F.col("action.campaign").alias("campaign"), kind.alias("kind"), _place().alias("place"),
        *(F.col(f"action.{c}").alias(c) for c in ("request_id", "channel", "start", "end")),
        money(F.col("action.budget")).alias("budget"),
        money(F.col("action.daily_budget")).alias("daily_budget"),
    )
    launch, raised = F.col("kind") == "launch", F.col("kind") == "increase_budget"
    lowers = F.col("kind") == "decrease_budget"
    sets_daily = (launch | raised) & F.col("daily_budget").isNotNull()
    packed = lambda value: (F.col("place") * F.lit(10**VALUE_DIGITS).cast("decimal(15,0)")).cast(_WIDE) + value.cast(_WIDE)
    last = lambda value, where: F.max(F.when(where, packed(value).cast(_WIDE)))
    fields = {
        "launched": (F.lit(0), launch),
        "launch_start": (_coded_day("start"), launch),
        "launch_end": (_coded_day("end"), launch),
        "extended_to": (_coded_day("end"), F.col("kind") == "extend_flight"),
        "budget_set": (_coded_money("budget"), launch | raised | lowers),
        "daily_set": (_coded_money("daily_budget"), sets_daily),
        "paused": (F.lit(0), F.col("kind") == "pause"),
    }
    terms_of = {"launch_request": F.when(launch, F.col("request_id")), "launch_channel": F.when(launch, F.col("channel"))}
    per_launch = events.withColumns(terms_of).groupBy(*key, *terms_of).agg(
        *(last(value, where).alias(name) for name, (value, where) in fields.items())
    )
    of_campaign = W.partitionBy(*key)
    state = (
        per_launch.withColumn("own", F.col("launched"))
        .withColumns({name: F.max(name).over(of_campaign) for name in fields})
        .where(F.col("own") == F.col("launched"))
        .withColumn("daily_place", _order("daily_set").cast("decimal(24,0)"))
    )
    lowered = (
        lookup(
            events.filter(lowers & F.col("daily_budget").isNotNull()),
            state.select(*key, "daily_place"), key, ["place"], salts, how="inner",
        )
        .filter(F.col("place") > F.col("daily_place"))
        .groupBy(*key)
        .agg(F.min("daily_budget").alias("lowered_to"))
    )
    terms = requests.select(
        "client", "request_id", F.col("start_date").alias("r_start"), F.col("end_date").alias("r_end")
    )
    amount = lambda c: (_value(c) - _ZERO_MONEY) / 100
    day = lambda c: F.date_from_unix_date((_value(c) - _ZERO_DAY).cast("int"))
    return (
        state.withColumnsRenamed({"launch_request": "request_id", "launch_channel": "channel"})
        .join(lowered, key, "left")
        .join(terms, ["client", "request_id"], "left")
        .select(
            *key, "request_id", "channel", amount("budget_set").alias("budget"),
            F.least(amount("daily_set"), "lowered_to").alias("daily_budget"),
            F.coalesce(day("launch_start"), "r_start").alias("start_date"),
            F.coalesce(day("extended_to"), day("launch_end"), "r_end").alias("end_date"),
            F.when(F.col("paused") > F.col("launched"), "paused").otherwise("live").alias("status"),
        )
    )


def audit_counts(audit: DataFrame) -> DataFrame:
    """Events by type, and blocked actions by reason as well."""
    blocked = F.when(F.col("event") == "action_blocked", F.col("reason"))
    return audit.groupBy("client", "event", blocked.alias("reason")).agg(F.count("*").alias("events"))


def refused_decisions(audit: DataFrame) -> DataFrame:
    refused = F.col("event").startswith("decision_refused")
    return audit.filter(refused).groupBy("client", "event").agg(F.count("*").alias("refused"))


# ---------------------------------------------------------------- approval messages


def requests_to_send(messages: DataFrame) -> DataFrame:
    """Pending requests of clients with a bound approver and no message out yet."""
    return messages.filter(
        (F.col("status") == "PENDING")
        & F.col("is_bound")
        & F.nullif(F.col("nonce"), F.lit("")).isNull()
    ).select("client", "request_id")


def pending_owner(messages: DataFrame) -> DataFrame:
    """For each user and request id: the one client where it is pending for that user, or the
    number of clients it could be."""
    return (
        messages.filter((F.col("status") == "PENDING") & F.col("user_id").isNotNull())
        .groupBy("user_id", "request_id")
        .agg(F.count("*").alias("clients"), F.min("client").alias("first_client"))
        .select(
            "user_id", "request_id", "clients",
            F.when(F.col("clients") == 1, F.col("first_client")).alias("client"),
        )
    )


def claim_owner(owners: DataFrame, user_id: int, request_id: str) -> DataFrame:
    """Strict lookup of one request: no client, or several, is an error."""
    hits = owners.filter((F.col("user_id") == user_id) & (F.col("request_id") == request_id))
    clients = F.coalesce(F.max("clients"), F.lit(0))
    problem = F.when(clients == 0, f"no pending {request_id} for this user").otherwise(
        f"{request_id} is pending for several clients; name one"
    )
    return hits.agg(
        F.when(clients == 1, F.max("client")).otherwise(F.raise_error(problem)).alias("client")
    )


