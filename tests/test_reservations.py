"""The reserve and settle fold against a plain ledger kept event by event, and as a stream against the batch."""

import random

import pandas as pd

from quorumdf.operators import ledger as L


def plain(events, floor, reserve):
    """Every quantity recomputed from the whole history at each event."""
    booked, holds, status, out = [], [], "active", []
    for e in events:
        holds = [h for h in holds if h["at"] >= e["minute"] - 60]
        held, balance = sum(h["cents"] for h in holds), sum(booked)
        if e["kind"] == "deposit":
            booked.append(e["cents"])
            decision, status = "credited", "active" if status == "paused" and e["cents"] > 0 else status
        elif e["kind"] in ("suspend", "resume"):
            decision, status = e["kind"], {"suspend": "suspended", "resume": "active"}[e["kind"]]
        elif e["kind"] == "reserve":
            after = balance - held - e["cents"]
            if status != "active":
                decision = "refused_" + status
            elif after < floor:
                decision, status = "refused_floor", "paused"
            elif not e["essential"] and after < floor + reserve:
                decision = "refused_reserve"
            else:
                decision = "held"
                holds.append({"id": e["event_id"], "cents": e["cents"], "at": e["minute"]})
        elif any(h["id"] == e["hold"] for h in holds):
            holds = [h for h in holds if h["id"] != e["hold"]]
            decision = "released"
            if e["kind"] == "settle":
                booked.append(-e["cents"])
                decision = "settled"
        else:
            decision = "unknown_hold"
        out.append((e["event_id"], decision, sum(booked), sum(h["cents"] for h in holds), status))
    return out


def history(seed):
    rng, minute, events = random.Random(seed), 0, []
    for i in range(300):
        minute += rng.choice([0, 1, 5, 30])
        kind = rng.choice(["deposit", "reserve", "reserve", "reserve", "settle", "settle", "release", "suspend", "resume", "resume"])
        events.append({"event_id": i, "minute": minute, "kind": kind, "cents": rng.randint(0, 120), "hold": rng.choice([None, *range(max(0, i - 6), i)]), "essential": rng.random() < 0.5})
    return events


def frame(events):
    df = pd.DataFrame(events)
    return df.assign(ts=pd.Timestamp("2024-01-01") + pd.to_timedelta(df.minute, unit="min"))


def test_fold_equals_plain_ledger_in_any_cut():
    seen = set()
    for seed in range(20):
        events = history(seed)
        want = plain(events, 20, 50)
        seen |= {d for _, d, *_ in want}
        df, state, got = frame(events), None, []
        for a, b in [(0, 300)] if seed % 2 else [(0, 70), (70, 71), (71, 300)]:
            part, state = L.fold_reservations(df.iloc[a:b], 20, 50, state)
            got += list(part.itertuples(index=False, name=None))
        assert got == want
    assert {"held", "settled", "released", "refused_floor", "refused_reserve", "refused_paused", "refused_suspended", "unknown_hold"} <= seen


def test_nulls_and_nothing():
    df = frame([{"event_id": 1, "minute": 0, "kind": "deposit", "cents": None, "hold": None, "essential": True}, {"event_id": 2, "minute": 0, "kind": "settle", "cents": 5, "hold": None, "essential": True}])
    assert list(L.fold_reservations(df, 0, 0)[0]["decision"]) == ["credited", "unknown_hold"]
    assert L.fold_reservations(df.iloc[:0], 0, 0)[0].empty


def test_stream_equals_batch(spark):
    from quorumdf import plans

    data = "/root/testdata/sf0.001"
    q = plans.queries()
    batch = sorted(map(tuple, q["l03b_reserve_and_settle"](spark, data).collect()))
    stream = sorted(tuple(r) for r in q["z05b_reserve_and_settle_stream"](spark, data).collect() if r.event_id is not None)
    assert batch == stream and len(batch) > 0
