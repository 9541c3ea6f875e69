"""The model graph: raw tables -> staging -> fact -> marts.

Without a store everything is virtual: a model is one query over the raw tables and reads what it needs. With a
store the fact, the campaign mart and the campaigns' terms are written once, in buckets, and all models read them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.operators import alerts as alert_rules
from spendloom.operators import fact, gate, marts, reports
from spendloom.operators.staging import stage_all
from spendloom.params import Params
from spendloom.plans.store import PARTS, Landing, Store, Written, in_parts, parts_of


FACT, DAYS, TERMS, CONTEXT = "fct_performance_daily", "campaign_days", "campaign_terms", "reporting_context"


class Warehouse:
    def __init__(
        self, raw: dict[str, DataFrame], params: Params = Params(), store: Store | None = None,
        ready: tuple[str, ...] = (),
    ) -> None:
        """``store``: where the fact and what is made of it are kept, each written on first use unless it is
        ``ready``, that is published there before."""
        self.raw, self.params, self.store, self._ready = raw, params, store, ready

    @classmethod
    def open(cls, store: Store, raw: dict[str, DataFrame], params: Params = Params()) -> Warehouse:
        """Models over a fact that was saved before; nothing of it is built again."""
        return cls(raw, params, store, (FACT, DAYS, TERMS, CONTEXT))

    @cached_property
    def stg(self) -> dict[str, DataFrame]:
        return stage_all(self.raw)

    def _kept(self, name: str, stage: Callable[[str], object]) -> DataFrame:
        """A table of the store; staged now unless it is ready."""
        table = f"{self.store.core}.{name}"
        if name not in self._ready:
            stage(table)
        return self.store.table(table).drop(*PARTS)

    @cached_property
    def stored_fact(self) -> DataFrame:
        rows = lambda: fact.daily_fact(self.stg, self.params).drop("ref_date")
        return self._kept(FACT, lambda table: self.store.stage_fact(rows(), table, list(self.raw.values())))

    @cached_property
    def daily(self) -> DataFrame:
        """The fact with the client's reference day on every row."""
        if self.store is None:
            return fact.daily_fact(self.stg, self.params)
        # One row per client; Spark decides by its size whether it is sent round.
        return self.stored_fact.join(self.context.select("client", "ref_date"), "client", "left")

    def daily_of(self, *logs: str) -> DataFrame:
        """The fact for models that need only these logs. A stored fact serves everyone; without
        one, a model builds its own and leaves the other logs unread."""
        return self.daily if self.store else fact.daily_fact(self.stg, self.params, logs)

    @cached_property
    def terms(self) -> DataFrame:
        """The campaigns' approved terms."""
        terms = self.stg["stg_gate_campaigns"]
        return self._kept(TERMS, lambda table: self.store.stage_bucketed(terms, table, f"{self.store.core}.{FACT}")) if self.store else terms

    @cached_property
    def _campaigns(self) -> DataFrame:
        made = lambda: marts.campaign_performance(self.daily, self.terms)
        return self._kept(DAYS, lambda table: self.store.stage_bucketed(made(), table, f"{self.store.core}.{FACT}")) if self.store else made()

    @cached_property
    def context(self) -> DataFrame:
        """One row per client: as-of days and the reference day, of the stored fact if there is one."""
        freshness = self.stg["stg_source_freshness"]
        if self.store is None:
            return fact.reporting_context(fact.spine(self.stg), freshness)

        def stage(table: str) -> None:
            days = self.stored_fact.where("has_platform_data").groupBy("client").agg(F.max("date").alias("ref_date"))
            self.store.stage(days.join(fact.as_of_dates(freshness), "client", "full"), table)

        return self._kept(CONTEXT, stage)

    @property
    def campaigns_checked(self) -> DataFrame:
        return marts.with_reconciliation(self._campaigns, self.params)

    @property
    def reference_days(self) -> DataFrame:
        return self.context.select("client", "ref_date")

    @property
    def approvals_dated(self) -> DataFrame:
        """The approvals mart with the client's reference day, for the alerts."""
        return self.mart_approvals().join(self.reference_days, "client", "left")

    def fct_performance_daily(self) -> DataFrame:
        return self.stored_fact if self.store else self.daily.drop("ref_date")

    def mart_campaign_performance(self) -> DataFrame:
        return self._campaigns.drop("ref_date")

    def mart_channel_performance(self) -> DataFrame:
        return marts.channel_performance(self._campaigns)

    def mart_channel_daily(self) -> DataFrame:
        return marts.channel_daily(self.daily_of("web", "crm"))

    def mart_funnel(self) -> DataFrame:
        return marts.funnel(self.daily_of("web", "crm"))

    def mart_reconciliation(self) -> DataFrame:
        return marts.reconciliation(self._campaigns, self.params)

    def mart_approvals(self) -> DataFrame:
        return marts.approvals(
            self.stg["stg_gate_requests"],
            self.stg["stg_gate_campaigns"],
            self.daily_of("ledger"),
        )

    def mart_freshness(self) -> DataFrame:
        return marts.freshness_mart(self.stg["stg_source_freshness"])

    def mart_alerts(self) -> DataFrame:
        return alert_rules.alerts(
            self.daily, self.campaigns_checked, self.approvals_dated, self.params
        )

    def mart_exec_overview(self) -> DataFrame:
        return marts.executive_overview(
            self.stg["stg_gate_engagement"],
            self._campaigns,
            self.stg["stg_gate_requests"],
            self.mart_freshness(),
            self.mart_alerts(),
        )

    def spend_trend(self) -> DataFrame:
        return reports.spend_trend(self.daily_of())

    def ledger(self) -> DataFrame:
        return gate.ledger_position(
            self.stg["stg_gate_engagement"],
            self.stg["stg_gate_requests"],
            self.stg["stg_gate_campaigns"],
            self.stg["stg_gate_spend"],
        )

    def models(self) -> dict[str, Callable[[], DataFrame]]:
        return {name: getattr(self, name) for name in MODELS}

    def _stage_all(self) -> dict[str, Written]:
        """All models staged in the store; what was counted while they were written."""
        made = {}
        self.stored_fact, self.context, self.terms, self._campaigns  # noqa: B018
        for name, database in MODELS.items():
            if name != FACT:
                of = self.store.core if database == "core" else self.store.marts
                made[name] = self.store.stage(getattr(self, name)(), f"{of}.{name}")
        return made

    def save(self, client: str | None = None) -> list[Written]:
        """Save the fact and the marts: all or, if one fails, none. Returns what was counted on the way.

        With ``client``, whose rows alone the raw tables then hold, the partitions of that client are replaced, and
        everybody else's files stay as they are.
        """
        store = self.store or Store(next(iter(self.raw.values())).sparkSession)
        new = Warehouse(self.raw, self.params, store)
        try:
            new._stage_all()
        except Exception:
            store.drop_staged()
            raise
        if client is None:
            return store.publish()
        by = {name: PARTS[0] if name in (FACT, DAYS, TERMS) else "client" for name in (*MODELS, DAYS, TERMS, CONTEXT)}
        return store.publish({t: F.col(by[t.split(".")[1]]) == client for t in store.staged})

    def touched(self, changed: DataFrame) -> list[tuple[str, str]]:
        """Partitions of the stored fact that don't say any more what the raw tables say: those of the
        ``changed`` days (client, date), those with days that an as-of day has passed since, and those of
        campaigns that came under another request. As many as partitions at most, which the catalog lists as well."""
        store = self.store
        found = changed.select(*(c.alias(n) for n, c in parts_of("date", store.period).items()))
        known = store.table(f"{store.core}.{FACT}")
        sources = ("platform_as_of", "web_as_of", "crm_as_of")
        before = store.table(f"{store.core}.{CONTEXT}").select("client", *(F.col(c).alias(f"_{c}") for c in sources))
        moved = before.join(fact.as_of_dates(self.stg["stg_source_freshness"]), "client", "full")
        spans = known.groupBy("client", *PARTS).agg(F.min("date").alias("_first"), F.max("date").alias("_last"))

        def passed(c: str) -> Column:
            old, new = F.col(f"_{c}"), F.col(c)
            between = (F.col("_last") > F.least(old, new)) & (F.col("_first") <= F.greatest(old, new))
            return ~old.eqNullSafe(new) & (old.isNull() | new.isNull() | between)

        flipped = spans.join(moved, "client").where(passed(sources[0]) | passed(sources[1]) | passed(sources[2]))
        had = store.table(f"{store.core}.{TERMS}").select("client", "campaign", F.col("request_id").alias("_had"))
        has = self.stg["stg_gate_campaigns"].select("client", "campaign", "request_id")
        other = had.join(has, ["client", "campaign"], "full").where(~F.col("_had").eqNullSafe(F.col("request_id")))
        moved_terms = known.select("client", "campaign", *PARTS).join(other, ["client", "campaign"], "left_semi")
        parts = found.unionByName(flipped.select(*PARTS)).unionByName(moved_terms.select(*PARTS)).distinct()
        return sorted(tuple(r) for r in parts.collect())

    def refresh(self, landing: Landing, changed: DataFrame) -> list[tuple[str, str]]:
        """Bring the saved fact and marts up to date with the landed tables after the days of ``changed``
        were restated. Of the logs and the fact only the touched partitions are read and written; the fact comes
        first, then the marts, which read it, all or none."""
        store, raw = self.store, landing.raw()
        parts = Warehouse.open(store, raw, self.params).touched(changed)
        if parts:
            table = f"{store.core}.{FACT}"
            logs = landing.raw(parts)
            store.stage_fact(Warehouse(logs, self.params).fct_performance_daily(), table, list(logs.values()))
            store.publish({table: in_parts(parts)})
        try:
            Warehouse(raw, self.params, store, (FACT,))._stage_all()
        except Exception:
            store.drop_staged()
            raise
        store.publish()
        return parts


# Model -> database of its saved table.
MODELS = {
    "fct_performance_daily": "core",
    "mart_campaign_performance": "marts",
    "mart_channel_performance": "marts",
    "mart_channel_daily": "marts",
    "mart_funnel": "marts",
    "mart_reconciliation": "marts",
    "mart_approvals": "marts",
    "mart_freshness": "marts",
    "mart_alerts": "marts",
    "mart_exec_overview": "marts",
}
