"""Fund ledger, cost estimates and their ordered folds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Dollars per million tokens (input, output) by model-name prefix, first match wins.
PRICES = [("claude-opus-4", 15.0, 75.0), ("claude-sonnet-4", 3.0, 15.0), ("claude-haiku-4", 1.0, 5.0), ("claude-3-5-haiku", 0.80, 4.0), ("claude-3-5-sonnet", 3.0, 15.0)]
OTHER_PRICE = (15.0, 75.0)
CACHE_READ, CACHE_WRITE, OCR_PAGE = 0.10, 1.25, 0.001
DEFAULT_COST_CENTS = 10


def balances(events: DataFrame, keys=("jurisdiction_id",)) -> DataFrame:
    """Balance, held amounts and what is available, per key; holds are the grants here."""
    amount = F.col("amount_cents")
    return events.groupBy(*keys).agg(
        F.sum(F.when(F.col("kind") != "grant", amount).otherwise(0)).alias("balance"), F.sum(F.when(F.col("kind") == "grant", amount).otherwise(0)).alias("held")
    ).withColumn("available", F.col("balance") - F.col("held"))


def recent_average(events: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Mean of the latest k spends per key."""
    w = Window.partitionBy(*keys).orderBy(F.desc("ts"), F.desc("event_id"))
    rows = events.filter("kind = 'spend'").withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
    return rows.groupBy(*keys).agg(F.round(F.avg(-F.col("amount_cents")), 6).alias("avg_cents"), F.count(F.lit(1)).alias("n"))


def fold_admission(events: pd.DataFrame, floor: int = 0, state: dict | None = None) -> tuple[list[tuple[int, str, int]], dict]:
    """Admission of one account's events in order: (event, decision, balance) and the state after.

    A spend that would take the balance under the floor is refused and pauses
    the account until the next deposit; while paused every spend is refused.
    """
    state = state or {"balance": 0, "paused": False}
    out = []
    for event, kind, cents in zip(events["event_id"], events["kind"], events["amount_cents"]):
        cents = int(cents)
        if kind != "spend":
            state["balance"] += cents
            state["paused"] = False
            decision = "credited"
        elif state["paused"]:
            decision = "refused_paused"
        elif state["balance"] + cents < floor:
            state["paused"] = True
            decision = "refused_floor"
        else:
            state["balance"] += cents
            decision = "admitted"
        out.append((int(event), decision, state["balance"]))
    return out, state


def admission(events: DataFrame, keys: list[str], floor: int = 0) -> DataFrame:
    """The fold per account; accounts are the unit that can't be cut, their events small rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts", "event_id"])
        return pd.DataFrame(fold_admission(pdf, floor)[0], columns=["event_id", "decision", "balance"])

    return events.select(*keys, "event_id", "ts", "kind", "amount_cents").groupBy(*keys).applyInPandas(run, "event_id long, decision string, balance long")


HOLD_MINUTES = 60


class Account:
    """Balance, status and open holds of one account, the oldest hold first.

    A hold reserves an expected cost: refused unless the account is active; under
    the floor it is refused and pauses the account until money comes in; work that
    isn't essential also leaves the reserve alone, without a pause.  Settling books
    the actual cost and drops the hold; of an unknown hold it does nothing.  Holds
    older than an hour are dropped.  A suspended account stays so until resumed.
    """

    def __init__(self, floor: int, reserve: int, state: dict | None = None):
        state = state or {}
        self.floor, self.reserve = floor, reserve
        self.balance, self.status = state.get("balance", 0), state.get("status", "active")
        self.holds = {int(k): (c, t) for k, c, t in sorted(state.get("holds", []), key=lambda h: h[2])}
        self.held = sum(c for c, _ in self.holds.values())

    def state(self) -> dict:
        return {"balance": self.balance, "status": self.status, "holds": [(k, c, t) for k, (c, t) in self.holds.items()]}

    def drop(self, hold: int) -> bool:
        cents, _ = self.holds.pop(hold, (None, None))
        self.held -= cents or 0
        return cents is not None

    def reap(self, minute: float) -> int:
        """Drop holds opened more than an hour before the minute; how many."""
        n = 0
        while self.holds and next(iter(self.holds.values()))[1] < minute - HOLD_MINUTES:
            self.drop(next(iter(self.holds)))
            n += 1
        return n

    def take(self, event: int, kind: str, cents: int, minute: float, hold: int | None, essential: bool) -> str:
        self.reap(minute)
        if kind in ("deposit", "grant"):
            self.balance += cents
            if cents > 0 and self.status == "paused":
                self.status = "active"
            return "credited"
        if kind in ("suspend", "resume"):
            self.status = "suspended" if kind == "suspend" else "active"
            return kind
        if kind == "reserve":
            if self.status != "active":
                return f"refused_{self.status}"
            left = self.balance - self.held - cents
            if left < self.floor:
                self.status = "paused"
                return "refused_floor"
            if not essential and left < self.floor + self.reserve:
                return "refused_reserve"
            self.holds[event] = (cents, minute)
            self.held += cents
            return "held"
        if hold is None or not self.drop(hold):
            return "unknown_hold"
        if kind == "settle":
            self.balance -= max(cents, 0)
            return "settled"
        return "released"


RESERVATION = "event_id long, decision string, balance long, held long, status string"


def fold_reservations(events: pd.DataFrame, floor: int, reserve: int, state: dict | None = None) -> tuple[pd.DataFrame, dict]:
    """The rows of one account's events (event_id, ts, kind, cents, hold, essential) in order, and its state after."""
    account, out = Account(floor, reserve, state), []
    events = events.sort_values(["ts", "event_id"])
    minutes = events["ts"].astype("datetime64[us]").astype("int64") / 6e7
    for event, kind, cents, minute, hold, essential in zip(events["event_id"], events["kind"], events["cents"], minutes, events["hold"], events["essential"]):
        decision = account.take(int(event), kind, 0 if pd.isna(cents) else int(cents), float(minute), None if pd.isna(hold) else int(hold), bool(essential))
        out.append((int(event), decision, account.balance, account.held, account.status))
    return pd.DataFrame(out, columns=["event_id", "decision", "balance", "held", "status"]), account.state()


def reservations(events: DataFrame, keys: list[str], floor: int = 0, reserve: int = 0) -> DataFrame:
    """The fold per account, in event order."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return fold_reservations(pdf, floor, reserve)[0]

    return events.select(*keys, "event_id", "ts", "kind", "cents", "hold", "essential").groupBy(*keys).applyInPandas(run, RESERVATION)


def usage_cost(usage: DataFrame) -> DataFrame:
    """Cost per unit and model from tokens, cached tokens and recognised pages."""
    price_in, price_out = F.lit(OTHER_PRICE[0]), F.lit(OTHER_PRICE[1])
    for prefix, a, b in reversed(PRICES):
        hit = F.col("model").startswith(prefix)
        price_in, price_out = F.when(hit, a).otherwise(price_in), F.when(hit, b).otherwise(price_out)
    tokens = F.col("input") * price_in + F.col("output") * price_out + F.col("cache_read") * price_in * CACHE_READ + F.col("cache_write") * price_in * CACHE_WRITE
    cost = tokens / 1e6 + F.col("pages") * OCR_PAGE
    return usage.groupBy("unit_id", "model").agg(F.round(F.sum(cost), 6).alias("cost"))


def workload(meeting: DataFrame, body: DataFrame, split_day: str, todo: Column) -> DataFrame:
    """Documents in all, to do (by a condition on the meeting), and from before the split day, per jurisdiction and kind."""
    kinds = meeting.select("body_id", "meeting_id", "meeting_date", todo.alias("todo"), F.expr("stack(2, 'agenda', agenda_url, 'minutes', minutes_url) AS (kind, url)"))
    rows = kinds.filter("url is not null").join(body.select("body_id", "jurisdiction_id"), "body_id")
    old = F.col("meeting_date") < F.lit(split_day).cast("date")
    return rows.groupBy("jurisdiction_id", "kind").agg(F.count(F.lit(1)).alias("total"), F.count_if("todo").alias("remaining"), F.count_if(F.col("todo") & old).alias("historical"))


def onboarding_estimate(work: DataFrame, rates: DataFrame) -> DataFrame:
    """Cost of the remaining documents at the kind's recent rate, or the default where there is none."""
    rows = work.join(F.broadcast(rates), "kind", "left")  # one row per kind
    cost = F.col("remaining") * F.coalesce("avg_cents", F.lit(float(DEFAULT_COST_CENTS)))
    used = F.col("remaining") > 0
    per = rows.groupBy("jurisdiction_id").agg(
        F.round(F.sum(cost), 4).alias("cents"), F.count_if(used & F.col("avg_cents").isNotNull()).alias("known"), F.count_if(used & F.col("avg_cents").isNull()).alias("unknown")
    )
    basis = F.when(F.col("unknown") == 0, "empirical").when(F.col("known") == 0, "default").otherwise("mixed")
    return per.select("jurisdiction_id", "cents", basis.alias("basis"))
