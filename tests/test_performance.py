import math

import pytest

from posledger.operators import performance as perf
from tests.helpers import collect, day, history


def trade(period, action, shares, value, prev=None, value_prev=None, ticker="AAA", note=None):
    delta = (shares or 0) - (prev or 0)
    return {"period_end": period, "investee_ticker": ticker, "investee_name": ticker, "action": action,
            "shares_held": shares, "market_value_usd": value, "shares_prev": prev, "shares_delta": delta,
            "value_prev": value_prev, "note": note}


def events(spark, rows, method):
    return [e for e in collect(perf.realized_events(history(spark, rows)), "period_end", "lot_opened_period")
            if e["cost_method"] == method]


def test_simple_exit(spark):
    rows = [trade("2024-03-31", "new", 100, 1000.0), trade("2024-06-30", "exit", 0, 0.0, 100, 1500.0)]
    for method in ("avg", "fifo"):
        (e,) = events(spark, rows, method)
        assert (e["cost_px"], e["exit_px"], e["realized_pnl_est"], e["holding_periods"]) == (10.0, 15.0, 500.0, 1)


def test_partial_sale(spark):
    rows = [trade("2024-03-31", "new", 50, 500.0), trade("2024-06-30", "buy", 100, 2000.0, 50, 500.0),
            trade("2024-09-30", "sell", 40, 1200.0, 100, 2000.0)]
    assert [(e["shares_sold"], e["realized_pnl_est"]) for e in events(spark, rows, "fifo")] == [(50, 1000), (10, 100)]
    (avg,) = events(spark, rows, "avg")
    assert avg["cost_px"] == 15 and avg["realized_pnl_est"] == 900


def test_three_lots(spark):
    rows, held = [], 0.0
    for period, size, px in [("2020-12-31", 6.65e6, 35.54), ("2021-03-31", 24_659_232, 12.18), ("2021-06-30", 6.65e6, 11.82)]:
        rows.append(trade(period, "buy" if held else "new", held + size, (held + size) * px, held or None))
        held += size
    rows.append(trade("2021-09-30", "sell", held - 3_087_020, (held - 3_087_020) * 20.72, held))
    assert sum(e["realized_pnl_est"] for e in events(spark, rows, "fifo")) == pytest.approx(-45_749_636, abs=1)
    assert events(spark, rows, "avg")[0]["realized_pnl_est"] == pytest.approx(13_924_550, abs=1)


def test_split_rescales_lots(spark):
    rows = [trade("2021-03-31", "new", 10e6, 10e6 * 11.97),
            trade("2021-06-30", "ratio_adj", 2e6, 2e6 * 50, 10e6, 10e6 * 11.97),
            trade("2021-09-30", "exit", 0, 0.0, 2e6, 2e6 * 50)]
    got = events(spark, rows, "avg")
    assert len(got) == 1 and got[0]["cost_px"] == pytest.approx(59.85) and got[0]["shares_sold"] == pytest.approx(2e6)
    assert got[0]["period_end"] == day("2021-09-30")


def test_oversold_shares_are_dropped(spark):
    rows = [trade("2021-03-31", "new", 100, 1000.0),
            {**trade("2021-06-30", "sell", 10, 200.0, 260), "shares_delta": -250.0},
            trade("2021-09-30", "buy", 60, 600.0, 10), trade("2021-12-31", "exit", 0, 0.0, 60, 900.0)]
    fifo = events(spark, rows, "fifo")
    assert [(str(e["period_end"]), e["shares_sold"]) for e in fifo] == [("2021-06-30", 100), ("2021-12-31", 50)]
    avg = events(spark, rows, "avg")
    assert avg[0]["shares_sold"] == 250 and avg[0]["cost_px"] == 10 and avg[1]["cost_px"] == 10


def test_average_uses_lots_left_after_fifo(spark):
    rows = [trade("2021-03-31", "new", 10, 100.0), trade("2021-06-30", "buy", 20, 400.0, 10),
            trade("2021-09-30", "sell", 10, 300.0, 20), trade("2021-12-31", "exit", 0, 0.0, 10, 300.0)]
    assert [e["cost_px"] for e in events(spark, rows, "avg")] == [15.0, 20.0]


def brute_force(rows):
    """Sequential ledger, for comparison on random inputs."""
    lots, out = [], []
    for r in sorted(rows, key=lambda r: (r["period_end"], r["action"] not in ("new", "buy"))):
        px = r["market_value_usd"] / r["shares_held"] if r["shares_held"] else (
            r["value_prev"] / r["shares_prev"] if r["action"] == "exit" and r["shares_prev"] else None)
        d = r["shares_delta"]
        if px is None or d == 0:
            continue
        if d > 0:
            lots.append([d, px, r["period_end"]])
            continue
        need = -d
        if not lots:
            continue
        have = sum(q for q, _, _ in lots)
        avg = sum(q * p for q, p, _ in lots) / have
        out.append(("avg", r["period_end"], need, round(need * (px - avg), 2), lots[0][2]))
        while need > 0 and lots:
            take = min(need, lots[0][0])
            out.append(("fifo", r["period_end"], take, round(take * (px - lots[0][1]), 2), lots[0][2]))
            need -= take
            lots[0][0] -= take
            if lots[0][0] <= 0:
                lots.pop(0)
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_ledgers_match_sequential_lots(spark, seed):
    import random
    rng = random.Random(seed)
    rows = []
    for name in ("AAA", "BBB", "CCC"):
        held, value = 0, 0.0
        for i in range(24):
            period = f"{2015 + i // 4}-{('03-31', '06-30', '09-30', '12-31')[i % 4]}"
            target = rng.choice([0, 0, 10, 40, 75, 120, 300])
            if held == 0 and target == 0:
                continue
            action = "new" if held == 0 else "exit" if target == 0 else "buy" if target > held else "sell" if target < held else "hold"
            new_value = target * float(rng.choice([8, 10, 16, 20]))
            rows.append(trade(period, action, target, new_value, held or None, value or None, ticker=name))
            held, value = target, new_value
    got = []
    for e in collect(perf.realized_events(history(spark, rows))):
        got.append((e["investee_ticker"], e["cost_method"], str(e["period_end"]), e["shares_sold"],
                    round(e["realized_pnl_est"], 2), str(e["lot_opened_period"])))
    want = []
    for name in ("AAA", "BBB", "CCC"):
        want += [(name, *w) for w in brute_force([r for r in rows if r["investee_ticker"] == name])]
    assert sorted(got, key=str) == sorted(want, key=str)


def returns(spark, rows):
    return collect(perf.portfolio_returns(history(spark, rows)), "period_end")


def test_dietz_without_flow(spark):
    got = returns(spark, [trade("2024-03-31", "new", 10, 100.0), trade("2024-06-30", "hold", 10, 110.0, 10, 100.0)])
    assert got[1]["dietz_return"] == pytest.approx(0.10) and got[1]["mtm_pnl"] == 10
    assert got[0]["cum_dietz_growth"] is None and got[0]["net_external_flow"] == 100


def test_flow_is_priced_at_the_period(spark):
    got = returns(spark, [trade("2024-03-31", "new", 10, 100.0), trade("2024-06-30", "buy", 20, 240.0, 10, 100.0)])
    assert got[1]["net_external_flow"] == 120 and got[1]["mtm_pnl"] == 20


def test_missing_value_is_not_zero(spark):
    rows = [trade("2024-03-31", "new", 10, 100.0), trade("2024-06-30", "hold", 10, 120.0, 10, 100.0),
            trade("2024-06-30", "new", 5, None, ticker="BBB"), trade("2024-09-30", "exit", 0, 0.0, 5, None, ticker="BBB")]
    got = returns(spark, rows)
    assert [r["portfolio_mv_end"] for r in got] == [100, 120]
    assert collect(perf.realized_events(history(spark, rows))) == []


def test_weights_and_contribution(spark):
    rows = [trade("2024-03-31", "new", 5, 50.0), trade("2024-03-31", "new", 5, 50.0, ticker="BBB"),
            trade("2024-06-30", "hold", 5, 60.0, 5, 50.0), trade("2024-06-30", "hold", 5, 40.0, 5, 50.0, ticker="BBB")]
    got = {(str(r["period_end"]), r["investee_ticker"]): r for r in collect(perf.holding_returns(history(spark, rows)))}
    a = got["2024-06-30", "AAA"]
    assert a["weight"] == 0.6 and a["holding_dietz_return"] == pytest.approx(0.2) and a["contribution"] == pytest.approx(0.12)
    assert got["2024-06-30", "BBB"]["weight"] == 0.4


def test_cagr(spark):
    rows, value = [trade("2023-03-31", "new", 10, 100.0)], 100.0
    for p in ("2023-06-30", "2023-09-30", "2023-12-31", "2024-03-31"):
        rows.append(trade(p, "hold", 10, value * 1.1, 10, value))
        value *= 1.1
    (got,) = collect(perf.linked_cagr(perf.portfolio_returns(history(spark, rows))))
    years = (day("2024-03-31") - day("2023-03-31")).days / 365.25
    assert got["cagr"] == pytest.approx(math.pow(1.1 ** 4, 1 / years) - 1, rel=1e-6)


def valued(period, ticker, value):
    return {"period_end": period, "investee_ticker": ticker, "investee_name": ticker, "action": "hold", "market_value_usd": value}


def test_coverage_flow_and_series_break(spark):
    rows = [valued("2021-12-31", "PRIV_A", 100.0), valued("2022-12-31", "PRIV_A", 110.0), valued("2022-12-31", "PRIV_B", 50.0),
            valued("2023-12-31", "PRIV_C", 300.0)]
    got = returns(spark, rows)
    assert got[1]["net_external_flow"] == 50 and got[1]["mtm_pnl"] == 10
    assert got[2]["dietz_return"] is None and got[2]["cum_dietz_growth"] == 1.0 and "series_break" in got[2]["note"]
    (growth,) = collect(perf.linked_cagr(perf.portfolio_returns(history(spark, rows))))
    assert growth["start_period"] == day("2023-12-31") and growth["cagr"] is None


def test_identity_holds(spark):
    rows = [trade("2024-03-31", "new", 10, 100.0), trade("2024-06-30", "buy", 20, 240.0, 10, 100.0)]
    assert perf.mtm_identity_breaks(perf.portfolio_returns(history(spark, rows))).count() == 0
