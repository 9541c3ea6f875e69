"""The approval gate: each reason, the ledger, and replay against a plain fold."""

import random
from datetime import date, datetime, timedelta

import pytest

from spendloom.operators import approvals, gate
from spendloom.sources.state import request_messages

CAMPAIGNS = "client string, campaign string, request_id string, channel string, budget double, " \
    "daily_budget double, start_date date, end_date date, status string"  # fmt: skip
REQUESTS = "client string, request_id string, campaign_scope string, channel string, " \
    "requested_amount double, approved_amount double, start_date date, end_date date, " \
    "daily_cap double, status string"  # fmt: skip
ACTIONS = "client string, action_id bigint, type string, campaign string, request_id string, " \
    "channel string, budget double, daily_budget double, start string, end string, today date"  # fmt: skip
# A winter flight: an envelope for radio, under which one campaign runs and one was stopped.
OPENS, CLOSES, TODAY = date(2028, 1, 17), date(2028, 3, 5), date(2028, 2, 9)
GRANTED, CAP = 64_000.0, 1_900.0
RUNS, RUNS_DAILY, STOPPED = 41_500.0, 1_150.0, 6_500.0
ROOM, DAILY_ROOM = GRANTED - RUNS - STOPPED, CAP - RUNS_DAILY


def _request(rid="R", status="APPROVED", approved=GRANTED, scope="*"):
    return ("acme", rid, scope, "radio", GRANTED, approved, OPENS, CLOSES, CAP, status)


def _campaign(name="lighthouse", rid="R", budget=RUNS, daily=RUNS_DAILY, status="live", end=CLOSES):
    return ("acme", name, rid, "radio", budget, daily, OPENS, end, status)


def _launch(**change):
    action = dict(type="launch", campaign="canal", request_id="R", channel="radio",
                  budget=9_000.0, daily_budget=400.0, start=None, end=None, today=TODAY)
    return {**action, **change}


def _raise(**change):
    blank = dict(type="increase_budget", campaign="lighthouse", request_id=None, channel=None, daily_budget=None)
    return _launch(**{**blank, "budget": RUNS + 500, **change})


LATE = date(2028, 3, 6)
CASES = {
    "fits": (_launch(), None),
    "takes all the room": (_launch(budget=ROOM), None),
    "more than the room": (_launch(budget=ROOM + 1), "over_approved_amount"),
    "takes all of the cap": (_launch(daily_budget=DAILY_ROOM), None),  # what is stopped spends nothing a day
    "more than the cap": (_launch(daily_budget=DAILY_ROOM + 0.01), "over_daily_cap"),
    "a raise counts its own budget once": (_raise(budget=GRANTED - STOPPED), None),
    "a raise beyond": (_raise(budget=GRANTED - STOPPED + 1), "over_approved_amount"),
    "a raise of the day alone": (_raise(budget=RUNS, daily_budget=RUNS_DAILY + 50), None),
    "a raise that raises nothing": (_raise(budget=RUNS), "not_an_increase"),
    "a raise of nobody": (_raise(campaign="canal", request_id="R", channel="radio"), "not_launched"),
    "a raise without a budget": (_raise(budget=None), "budget_not_positive"),
    "a day worth nothing": (_launch(daily_budget=0.0), "budget_not_positive"),
    "there already": (_launch(campaign="lighthouse"), "already_exists"),
    "a pause asks nobody": (_launch(type="pause", request_id=None), None),
    "nor does a decrease, ever": (_launch(type="decrease_budget", request_id=None, today=date(2031, 1, 1)), None),
    "some other action": (_launch(type="boost"), "unknown_action"),
    "no action at all": (_launch(type=None), "unknown_action"),
    "without a request": (_launch(request_id=None), "no_request"),
    "with an empty one": (_launch(request_id=""), "no_request"),
    "with one that isn't there": (_launch(request_id="Z"), "no_request"),
    "undecided": (_launch(request_id="PEND"), "not_approved"),
    "turned down": (_launch(request_id="REJ"), "not_approved"),
    "the day after": (_launch(today=LATE), "expired"),
    "the last day": (_launch(today=CLOSES), None),
    "in print": (_launch(channel="print"), "channel_mismatch"),
    "anywhere": (_launch(channel=None), "channel_mismatch"),
    "meant for another": (_launch(request_id="ONE"), "campaign_out_of_scope"),
    "meant for this one": (_launch(request_id="ONE", campaign="only"), None),
    "ends late": (_launch(end=str(LATE)), "outside_approved_dates"),
    "starts early": (_launch(start="2028-01-16"), "outside_approved_dates"),
    "prolonged too far": (_raise(type="extend_flight", end=str(LATE)), "outside_approved_dates"),
    "prolonged, no budget named": (_raise(type="extend_flight", end="2028-03-01", budget=None), None),
}


def test_authorise_gives_the_first_reason(spark):
    campaigns = spark.createDataFrame(
        [_campaign(), _campaign("pier", budget=STOPPED, daily=5_000.0, status="paused")], CAMPAIGNS
    )
    requests = spark.createDataFrame(
        [_request(), _request("PEND", "PENDING", 0.0), _request("REJ", "REJECTED", 0.0),
         _request("ONE", scope="only")], REQUESTS,
    )
    columns = [c.strip().split(" ")[0] for c in ACTIONS.split(",")][2:]
    rows = [("acme", i, *(a[c] for c in columns)) for i, (a, _) in enumerate(CASES.values())]
    out = gate.authorise(spark.createDataFrame(rows, ACTIONS), campaigns, requests, salts=3)
    got = {r.action_id: (r.allowed, r.reason) for r in out.collect()}
    want = {i: (reason is None, reason) for i, (_, reason) in enumerate(CASES.values())}
    names = list(CASES)
    assert {names[i]: v for i, v in got.items()} == {names[i]: v for i, v in want.items()}


def test_unknown_approval_terms_are_refused(spark):
    campaigns = spark.createDataFrame([], CAMPAIGNS)
    requests = spark.createDataFrame([_request(approved=None)], REQUESTS)
    columns = [c.strip().split(" ")[0] for c in ACTIONS.split(",")][2:]
    action = spark.createDataFrame([("acme", 1, *(_launch()[c] for c in columns))], ACTIONS)
    assert gate.authorise(action, campaigns, requests).collect()[0].reason == "over_approved_amount"


def _ledger_frames(spark):
    engagement = spark.createDataFrame(
        [("acme", "INR", 500_000.0), ("idle", "USD", 10.0)], "client string, currency string, ceiling double"
    )
    requests = spark.createDataFrame(
        [_request(), _request("P", "PENDING", 0.0), _request("J", "REJECTED", 31_000.0)], REQUESTS
    )
    campaigns = spark.createDataFrame([_campaign(), _campaign("small", budget=10.0)], CAMPAIGNS)
    spend = spark.createDataFrame(
        [("acme", "lighthouse", TODAY, 12_500.0), ("acme", "small", TODAY, 0.1)] + [("acme", "small", TODAY, 1.1)] * 9,
        "client string, campaign string, date date, ledger_spend double",
    )
    return engagement, requests, campaigns, spend


def test_ledger_position(spark):
    rows = {r.client: r for r in gate.ledger_position(*_ledger_frames(spark)).collect()}
    a = rows["acme"]
    assert (a.approved, a.committed, a.spent) == (GRANTED, RUNS + 10, 12_510.0)
    assert (a.unapproved_headroom, a.remaining_of_ceiling) == (500_000.0 - GRANTED, 487_490.0)
    assert (rows["idle"].approved, rows["idle"].remaining_of_ceiling) == (0.0, 10.0)


def test_over_budget_is_strict_and_sums_are_exact(spark):
    _, _, campaigns, spend = _ledger_frames(spark)
    # 0.1 + 9 x 1.1 is exactly the budget of 10, so it is not over
    assert gate.campaigns_over_budget(campaigns, spend).count() == 0


def test_pending_and_budget_line(spark):
    frames = _ledger_frames(spark)
    assert [r.request_id for r in gate.pending_requests(frames[1]).collect()] == ["P"]
    line = gate.budget_line(frames[1], gate.ledger_position(*frames)).collect()
    assert [(r.request_id, r.headroom_after) for r in line] == [("P", 500_000.0 - 2 * GRANTED)]
    assert gate.request_by_id(frames[1], "acme", "J").count() == 1


def test_check_requests(spark):
    position = gate.ledger_position(*_ledger_frames(spark))
    rows = [
        ("acme", 1, 436_000.0, 10.0, "2026-11-01", "2026-11-30"), ("acme", 2, 436_000.01, 10.0, "2026-11-01", "2026-11-30"),
        ("acme", 3, 0.0, 10.0, "2026-11-01", "2026-11-30"), ("acme", 4, 1.0, 0.004, "2026-11-01", "2026-11-30"),
        ("acme", 5, 1.0, 1.0, "2026-11-02", "2026-11-01"), ("acme", 6, 1.0, 1.0, "2026-11-01", "2026-11-01"),
    ]
    proposals = spark.createDataFrame(
        rows, "client string, proposal_id bigint, amount double, daily_cap double, start string, end string"
    )
    got = {r.proposal_id: r.reason for r in gate.check_requests(proposals, position).collect()}
    assert got == {1: None, 2: "over_ceiling", 3: "not_positive", 4: "not_positive", 5: "start_after_end", 6: None}


ASKED = "client string, request_id string, requested_amount double, daily_cap double"
DECISIONS = "client string, request_id string, at timestamp_ntz, seq bigint, approved_amount double, " \
    "daily_cap double, via string"  # fmt: skip


def _audit(spark, ceiling, asked, decided, **more):
    at = datetime(2027, 5, 3, 8, 0, 0)
    rows = [("kite", rid, at + timedelta(hours=i // 2), i, amount, cap, via) for i, (rid, amount, cap, via) in enumerate(decided)]
    requests = spark.createDataFrame([("kite", *r) for r in asked], ASKED)
    engagement = spark.createDataFrame([("kite", ceiling)], "client string, ceiling double")
    return requests, gate.check_approvals(spark.createDataFrame(rows, DECISIONS).repartition(3), requests, engagement, **more)


def test_refused_decisions_count_for_nothing(spark):
    asked = [("q1", 70.0, 5.0), ("q2", 45.0, 5.0), ("q3", 30.0, 5.0)]
    decided = [
        ("q1", 55.0, None, None),  # lowered: taken
        ("q1", None, None, None),  # decided before
        ("q9", 10.0, None, None),  # never filed
        ("q2", -300.0, None, None),
        ("q2", None, 0.0, None),
        ("q2", 46.0, None, "chat"),
        ("q2", 46.0, None, None),  # 55 + 46 > 90
        ("q3", None, 4.0, "chat"),  # 55 + 30: taken, as the refused ones don't count
        ("q2", 5.0, None, None),  # still pending, and now it fits
    ]
    requests, audit = _audit(spark, 90.0, asked, decided)
    rows = sorted(audit.collect(), key=lambda r: r.seq)
    assert [r.reason for r in rows] == [
        None, "already_decided", "no_request", "amount_not_positive", "cap_not_positive",
        "raised_from_chat", "over_ceiling", None, None,
    ]
    assert [r.running_approved for r in rows] == [55.0] * 7 + [85.0, 90.0]
    assert [r.modified for r in rows if r.valid] == [True, True, True]
    states = {r.request_id: (r.status, r.approved_amount, r.daily_cap) for r in gate.request_states(requests, audit).collect()}
    assert states == {"q1": ("APPROVED", 55.0, 5.0), "q2": ("APPROVED", 5.0, 5.0), "q3": ("APPROVED", 30.0, 4.0)}


def test_a_rejection_decides_and_takes_nothing(spark):
    at = datetime(2027, 5, 3, 8, 0, 0)
    rows = [("q1", "reject", None), ("q1", "approve", 5.0), ("q2", "approve", 60.0), ("q2", "reject", None), ("q9", "reject", None),
            ("q3", "reject", -1.0), ("q4", None, 30.0)]
    decisions = spark.createDataFrame(
        [("kite", rid, at, i, amount, None, None, what) for i, (rid, what, amount) in enumerate(rows)], f"{DECISIONS}, decision string"
    )
    requests = spark.createDataFrame([("kite", f"q{i}", 70.0, 5.0) for i in (1, 2, 3, 4, 5)], ASKED)
    engagement = spark.createDataFrame([("kite", 90.0)], "client string, ceiling double")
    for most in (2, 100_000):
        audit = gate.check_approvals(decisions, requests, engagement, most=most)
        got = [(r.reason, r.running_approved) for r in sorted(audit.collect(), key=lambda r: r.seq)]
        assert got == [(None, 0.0), ("already_decided", 0.0), (None, 60.0), ("already_decided", 60.0), ("no_request", 60.0),
                       (None, 60.0), (None, 90.0)]
    states = {r.request_id: (r.status, r.approved_amount) for r in gate.request_states(requests, audit).collect()}
    assert states == {"q1": ("REJECTED", 0.0), "q2": ("APPROVED", 60.0), "q3": ("REJECTED", 0.0), "q4": ("APPROVED", 30.0),
                      "q5": ("PENDING", 0.0)}


def test_ledger_entries_and_pauses_need_their_campaign(spark):
    _, _, campaigns, _ = _ledger_frames(spark)
    entries = [("acme", 1, "lighthouse", 10.004, "2026-11-05"), ("acme", 2, "ghost", 1.0, "2026-11-05"),
               ("acme", 3, "lighthouse", None, "2026-11-05"), ("acme", 4, "small", 1.0, "never"), ("other", 5, "lighthouse", 1.0, "2026-11-05")]
    frame = spark.createDataFrame(entries, "client string, entry_id bigint, campaign string, amount double, date string")
    got = {r.entry_id: (r.reason, r.booked) for r in gate.check_ledger_entries(frame, campaigns).collect()}
    assert got == {1: (None, 10.0), 2: ("no_campaign", None), 3: ("no_amount", None), 4: ("unreadable_date", None), 5: ("no_campaign", None)}
    columns = [c.strip().split(" ")[0] for c in ACTIONS.split(",")][2:]
    actions = [_launch(type="pause", campaign=c) for c in ("lighthouse", "ghost", None)] + [_launch()]
    frame = spark.createDataFrame([("acme", i, *(a[c] for c in columns)) for i, a in enumerate(actions)], ACTIONS)
    got = {r.action_id: r.reason for r in gate.check_pauses(frame, campaigns).collect()}
    assert got == {0: None, 1: "no_campaign", 2: "no_campaign"}


def _one_by_one(decided, ceiling):
    """(seq, cents, request) in order -> seqs that are accepted."""
    total, done, taken = 0, set(), set()
    for seq, cents, request in decided:
        if request not in done and total + cents <= ceiling:
            total += cents
            done.add(request)
            taken.add(seq)
    return taken


SHAPES = {
    "even": lambda rng, i: rng.randint(1, 50),
    "falling": lambda rng, i: max(1, 400 - i) if i % 2 else 1,  # a large one that just fails after each small one
    "few large": lambda rng, i: 900 if rng.random() < 0.05 else rng.randint(1, 3),
    "all too large": lambda rng, i: 5_000,
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("most", [5, 100_000])
def test_stretches_equal_one_by_one(spark, shape, most):
    rng = random.Random(shape)
    at, rows, want, ceilings = datetime(2027, 5, 3), [], set(), []
    for client, n, ceiling in (("hot", 400, 3_000), ("cold", 30, 200), ("tiny", 3, 10), ("none", 40, 0)):
        # Several decisions a second, some requests again and again.
        mine = [(i, SHAPES[shape](rng, i), f"{client}{rng.randrange(n)}") for i in range(n)]
        want |= {(client, s) for s in _one_by_one(mine, ceiling)}
        rows += [(client, request, at + timedelta(seconds=s // 7), s, cents) for s, cents, request in mine]
        ceilings.append((client, ceiling))
    frame = spark.createDataFrame(rows, "client string, request_id string, at timestamp_ntz, seq bigint, cents bigint")
    room = spark.createDataFrame(ceilings, "client string, room bigint")
    got = approvals.accepted(frame.repartition(4), room, salts=3, most=most).collect()
    assert {(r.client, r.seq) for r in got} == want and len(got) == len(want)


def test_no_task_holds_a_client(spark):
    """Half of all rows are one client's, more than a task folds."""
    rng = random.Random(8)
    asked = [(f"q{i}", float(rng.randint(1, 90)), 5.0) for i in range(150)]
    decided = [(rng.choice(asked)[0], rng.choice([None, float(rng.randint(-2, 99))]), rng.choice([None, 0.0, 4.0]),
                rng.choice([None, "chat"])) for _ in range(300)]
    requests, whole = _audit(spark, 900.0, asked, decided)
    _, cut = _audit(spark, 900.0, asked, decided, most=10)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, cut.collect()), key=str)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan


def test_requests_are_not_copied_for_their_decisions(spark, monkeypatch):
    """There are as many requests as decisions; only a table of few rows is worth a copy per slice."""
    copied, real = [], gate.lookup
    monkeypatch.setattr(gate, "lookup", lambda big, small, on, *more: copied.append(on) or real(big, small, on, *more))
    at = datetime(2026, 1, 1)
    decisions = spark.createDataFrame(
        [("c", "R1", at, 1, None, None, None), ("c", "R1", at, 2, None, None, None), ("c", "R2", at, 3, 5.0, None, None)],
        "client string, request_id string, at timestamp_ntz, seq bigint, approved_amount double, daily_cap double, via string",
    )
    requests = spark.createDataFrame([("c", "R1", 10.0, 1.0)], "client string, request_id string, requested_amount double, daily_cap double")
    ceilings = spark.createDataFrame([("c", 100.0)], "client string, ceiling double")
    for most in (1, 100):
        got = gate.check_approvals(decisions, requests, ceilings, most=most).orderBy("seq").collect()
        assert [(r.valid, r.reason) for r in got] == [(True, None), (False, "already_decided"), (False, "no_request")]
    assert copied and ["client", "request_id"] not in copied


def test_a_client_without_an_engagement_keeps_its_decisions(spark):
    requests = spark.createDataFrame([("lone", "q", 1.0, 1.0)], ASKED)
    decisions = spark.createDataFrame([("lone", "q", datetime(2027, 1, 1), 1, None, None, None)], DECISIONS)
    engagement = spark.createDataFrame([], "client string, ceiling double")
    (row,) = gate.check_approvals(decisions, requests, engagement).collect()
    assert (row.valid, row.reason) == (False, "no_engagement")


def test_unreadable_dates_refuse_one_action_only(spark):
    rows = [("acme", 1, *_launch(start="soon").values()), ("acme", 2, *_launch().values())]
    actions = spark.createDataFrame(rows, ACTIONS)
    campaigns = spark.createDataFrame([_campaign()], CAMPAIGNS)
    out = gate.authorise(actions, campaigns, spark.createDataFrame([_request()], REQUESTS))
    assert {r.action_id: r.reason for r in out.collect()} == {1: "unreadable_date", 2: None}


def test_check_decreases(spark):
    _, _, campaigns, spend = _ledger_frames(spark)
    columns = [c.strip().split(" ")[0] for c in ACTIONS.split(",")][2:]
    cut = lambda **c: _launch(type="decrease_budget", campaign="lighthouse", **c)
    actions = [cut(budget=40_000.0, daily_budget=None), cut(budget=400_000.0), cut(budget=12_499.99),
               cut(budget=12_500.0, daily_budget=9_999.0), _launch(type="decrease_budget", campaign="ghost"),
               _launch()]
    frame = spark.createDataFrame([("acme", i, *(a[c] for c in columns)) for i, a in enumerate(actions)], ACTIONS)
    out = {r.action_id: (r.reason, r.daily_budget_after) for r in gate.check_decreases(frame, campaigns, spend).collect()}
    assert out == {
        0: (None, RUNS_DAILY), 1: ("raises_budget", None), 2: ("below_spent", None),
        3: (None, RUNS_DAILY), 4: ("no_campaign", None),
    }


EXECUTED = "client string, at string, seq bigint, action struct<type:string, campaign:string, " \
    "request_id:string, channel:string, budget:double, daily_budget:double, start:string, end:string>"  # fmt: skip


# What an event does to a field, by kind: "set" (a null leaves it), "lower", or a fixed value.
EFFECTS = {
    "launch": {"rid": "set", "channel": "set", "budget": "set", "daily": "set", "start": "set", "end": "set", "status": "=live"},
    "increase_budget": {"budget": "set", "daily": "set"},
    "decrease_budget": {"budget": "set", "daily": "lower"},
    "extend_flight": {"end": "set"},
    "pause": {"status": "=paused"},
}
FIELDS = ("rid", "channel", "budget", "daily", "start", "end")


def _fold(events):
    """One campaign's events applied in order, by the table of effects."""
    state = {"start": str(OPENS), "end": str(CLOSES)}
    for event in sorted(events, key=lambda e: e[1:3]):
        kind, _, *values = event[3]
        given = dict(zip(FIELDS, values, strict=True))
        for field, effect in EFFECTS[kind].items():
            if effect[0] == "=":
                state[field] = effect[1:]
            elif given[field] is not None:
                state[field] = min(state[field], given[field]) if effect == "lower" else given[field]
    return state


@pytest.mark.parametrize("seed", [3, 4])
def test_replay_equals_a_sequential_fold(spark, seed):
    rng = random.Random(seed)
    events, want = [], {}
    for c in range(12):
        name = f"c{c}"
        mine = [("acme", "2026-11-01T00:00:00+00:00", c, ("launch", name, "R", "radio", 100.0, 50.0,
                 None, rng.choice([None, "2026-11-20"])))]
        for i in range(rng.choice([0, 3, 200 if c == 0 else 30])):
            kind = rng.choice(["increase_budget", "decrease_budget", "decrease_budget", "extend_flight", "pause"])
            has_budget = kind.endswith("budget")
            mine.append(
                ("acme", f"2026-11-0{rng.randrange(2, 6)}T00:00:0{rng.randrange(3)}+00:00", 100 + i,
                 (kind, name, None, None, float(rng.randrange(1, 999)) if has_budget else None,
                  rng.choice([None, float(rng.randrange(1, 99))]) if has_budget else None, None,
                  f"2026-11-{rng.randrange(10, 30)}" if kind == "extend_flight" else None))
            )
        events += mine
        want[name] = _fold(mine)
    rng.shuffle(events)
    requests = spark.createDataFrame([_request()], REQUESTS)
    out = gate.replay(spark.createDataFrame(events, EXECUTED).repartition(5), requests, salts=4)
    got = {
        r.campaign: dict(rid=r.request_id, channel=r.channel, budget=r.budget, daily=r.daily_budget,
                         start=str(r.start_date), end=str(r.end_date), status=r.status)
        for r in out.collect()
    }
    assert got == want


STATE = "client string, channels map<string, struct<user_id:bigint, chat_id:bigint>>, " \
    "requests map<string, struct<id:string, status:string, amount:double, nonces:map<string,string>>>"  # fmt: skip


def test_messages(spark):
    bound = {"chat": (7, 70)}
    docs = [
        ("a", bound, {"R1": ("R1", "PENDING", 1.0, None), "R2": ("R2", "PENDING", 1.0, {"chat": "n"}),
                      "R3": ("R3", "APPROVED", 1.0, {})}),
        ("b", bound, {"R2": ("R2", "PENDING", 1.0, {"chat": ""})}),
        ("c", None, {"R1": ("R1", "PENDING", 1.0, {})}),
    ]
    messages = request_messages(spark.createDataFrame(docs, STATE), "chat")
    sent = {(r.client, r.request_id) for r in gate.requests_to_send(messages).collect()}
    assert sent == {("a", "R1"), ("b", "R2")}
    owners = gate.pending_owner(messages)
    assert {(r.request_id, r.clients, r.client) for r in owners.collect()} == {("R1", 1, "a"), ("R2", 2, None)}
    assert gate.claim_owner(owners, 7, "R1").collect()[0].client == "a"
    with pytest.raises(Exception, match="several clients"):
        gate.claim_owner(owners, 7, "R2").collect()
    with pytest.raises(Exception, match="no pending R9"):
        gate.claim_owner(owners, 7, "R9").collect()
