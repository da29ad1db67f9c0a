import random

import pytest
from pyspark.sql import functions as F

from posledger.operators import ledger, merge, performance as perf, snapshots
from posledger.schemas import SNAPSHOT_SCHEMA
from tests.helpers import collect, day, frame, history, snapshots as snaps


def test_latest_filing_per_period_wins(spark):
    df = spark.createDataFrame([
        ("P", day("2024-03-31"), day("2024-05-01"), "a"), ("P", day("2024-03-31"), day("2024-06-01"), "b"),
        ("P", None, day("2024-08-01"), "c")], "parent_ticker string, period_end date, filing_date date, accession_no string")
    got = {str(r["period_end"]): r["accession_no"] for r in collect(snapshots.period_filings(df))}
    assert got == {"2024-03-31": "b", "2024-08-01": "c"}


def running_brute(events, dates):
    out, state = {}, {}
    for d in dates:
        for e in sorted(e for e in events if e[1] == d):
            _, _, acc, key, value, gone = e
            state.pop(key, None) if gone else state.__setitem__(key, value)
        out[d] = dict(state)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_running_positions_match_sequential(spark, seed):
    rng = random.Random(seed)
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 7) for d in (5, 20)]
    events = [("P", day(rng.choice(days)), f"{i:03d}", rng.choice("ABCD"), float(i), rng.random() < 0.3) for i in range(40)]
    df = spark.createDataFrame(events, "parent_ticker string, filing_date date, accession_no string, key string, value double, is_exit boolean")
    dates = sorted({e[1] for e in events})
    want = running_brute(events, dates)
    got = {d: {} for d in dates}
    for r in collect(snapshots.running_positions(df)):
        got[r["snapshot_date"]][r["key"]] = r["value"]
    assert got == want
    grid = spark.createDataFrame([("P", day(d)) for d in ("2023-12-31", "2024-02-10", "2024-03-20", "2024-12-31")],
                                 "parent_ticker string, as_of date")
    at = {}
    for r in collect(snapshots.positions_at(df, grid)):
        at.setdefault(r["as_of"], {})[r["key"]] = r["value"]
    for d in (day("2024-02-10"), day("2024-03-20"), day("2024-12-31")):
        last = max(x for x in dates if x <= d)
        assert at.get(d, {}) == want[last]
    assert day("2023-12-31") not in at
    latest = {r["key"]: r["value"] for r in collect(snapshots.latest_positions(df))}
    assert latest == want[dates[-1]]


def note_case(spark, rows, points, window=None):
    """[(filed, value date or None, value)] of one name and [(period end, as of)] -> value per period end."""
    df = frame(spark, SNAPSHOT_SCHEMA, [
        {"parent_ticker": "P", "filing_date": f, "accession_no": f"x{f}", "investee_name": "N", "investee_ticker": "N",
         "as_of_date": d, "market_value_usd": v, "note": "20f_note"} for f, d, v in rows])
    grid = spark.createDataFrame([("P", day(p), day(a)) for p, a in points], "parent_ticker string, period_end date, as_of date")
    return {str(r["period_end"]): r["market_value_usd"] for r in collect(snapshots.notes_as_of(df, grid, window=window))}


@pytest.mark.parametrize("rows, want", [
    # Dated at the period end beats a newer filing of an older value.
    ([("2024-07-01", "2024-06-30", 1.0), ("2024-08-01", "2024-03-31", 2.0)], 1.0),
    # Else the newest value date, whichever filing states it.
    ([("2024-05-01", "2024-03-31", 1.0), ("2024-06-01", "2023-12-31", 2.0)], 1.0),
    # Equal value dates: the later filing.
    ([("2024-05-01", "2024-03-31", 1.0), ("2024-06-01", "2024-03-31", 2.0)], 2.0),
    # An undated value replaces what earlier filings said, and is replaced by what later ones say.
    ([("2024-05-01", "2024-03-31", 1.0), ("2024-06-01", None, 2.0)], 2.0),
    ([("2024-05-01", None, 1.0), ("2024-06-01", "2023-03-31", 2.0)], 2.0),
    # Values dated after the period and filings after the as-of date are unknown.
    ([("2024-07-01", "2024-07-01", 1.0), ("2024-09-30", "2024-06-30", 2.0), ("2023-01-01", "2022-12-31", 3.0)], 3.0),
])
def test_note_preference(spark, rows, want):
    assert note_case(spark, rows, [("2024-06-30", "2024-08-14")]) == {"2024-06-30": want}


def test_note_window_is_the_callers(spark):
    rows = [(f"20{y:02d}-05-01", f"20{y:02d}-03-31" if y == 10 else None, float(y)) for y in range(10, 22)]
    rows = [(f, d, v) for f, d, v in rows if v in (10.0,)] + [(f"20{y:02d}-05-01", "1999-12-31", float(y)) for y in range(11, 22)]
    points = [("2022-12-31", "2023-02-14")]
    assert note_case(spark, rows, points) == {"2022-12-31": 10.0}
    assert note_case(spark, rows, points, window=3) == {"2022-12-31": 21.0}


def held(ticker, shares, value):
    return {"investee_name": ticker, "investee_ticker": ticker, "shares_held": shares, "market_value_usd": value}


def test_inception_before_the_window(spark):
    rows, periods = snaps(spark, [
        ("2018-12-31", "2019-02-01", "z", []),
        ("2019-12-31", "2020-02-01", "a", [held("AAA", 100, 4000.0), held("OTHER", 1, 1.0)]),
        ("2020-12-31", "2021-02-01", "b", [held("AAA", 100, 5000.0)]),
        ("2021-12-31", "2022-02-01", "c", [held("AAA", 100, 6000.0), held("NEW", 5, 50.0)]),
        ("2024-12-31", "2025-02-01", "d", [held("NEW", 5, 60.0)])])
    pre, pre_periods, truncated = snapshots.prewindow_backfill(rows, periods, "2021-06-01")
    assert {(r["investee_ticker"], str(r["period_end"])) for r in collect(pre)} == {("AAA", "2019-12-31"), ("AAA", "2020-12-31")}
    assert {str(r["period_end"]) for r in collect(pre_periods)} == {"2019-12-31", "2020-12-31"}
    assert [r["ticker"] for r in collect(truncated)] == ["AAA"]
    inside, _ = snapshots.split_window(periods, "2021-06-01")
    main = rows.join(inside, ["parent_ticker", "period_end"], "left_semi")
    hist = ledger.diff_snapshots(main.unionByName(pre), inside.unionByName(pre_periods))
    first = {r["investee_ticker"]: r["first_seen_period"] for r in collect(hist)}
    assert first == {"AAA": day("2019-12-31"), "NEW": day("2021-12-31")}
    (avg,) = [e for e in collect(perf.realized_events(hist)) if e["cost_method"] == "avg"]
    assert avg["cost_px"] == 40.0 and avg["investee_ticker"] == "AAA"


def test_truncated_name_has_no_priced_lot(spark):
    rows, periods = snaps(spark, [
        ("2021-12-31", "2022-02-01", "c", [held("AAA", 100, 6000.0)]), ("2022-12-31", "2023-02-01", "d", [])])
    _, _, truncated = snapshots.prewindow_backfill(rows, periods, "2021-06-01")
    hist = snapshots.stamp_truncated(ledger.diff_snapshots(rows, periods), truncated)
    notes = {r["action"]: r["note"] for r in collect(hist)}
    assert "cost_basis=unknown_truncated" in notes["new"] and "lookback_truncated=1" in notes["exit"]
    (e,) = collect(perf.realized_events(hist))
    assert e["cost_px"] is None and e["realized_pnl_est"] is None and e["shares_sold"] == 100


def src(spark, source, note, **values):
    return frame(spark, SNAPSHOT_SCHEMA, [{"parent_ticker": "P", "period_end": "2024-03-31", "investee_name": "Grab",
                                           "investee_ticker": "GRAB", "source": source, "note": note, **values}])


def test_first_source_wins_and_provenance_follows(spark):
    a = src(spark, "13f", "source=13f", shares_held=10, cusip="G1", as_of_accession_no="f13")
    b = src(spark, "13g", "source=13g", shares_held=99, ownership_pct=12.5, as_of_accession_no="g13")
    c = src(spark, "10q_investments_table", "source=10q_investments_table", market_value_usd=2020.0, as_of_accession_no="q10")
    (r,) = collect(merge.merge_sources([a, b, c]))
    assert (r["shares_held"], r["ownership_pct"], r["market_value_usd"]) == (10, 12.5, 2020.0)
    assert r["note"] == "source=13f; source=13g; source=10q_investments_table"
    assert r["source"] == "13f+10q_investments_table" and r["as_of_accession_no"] == "q10"


def test_live_merge_market_fields_and_narrative_cost(spark):
    own = src(spark, "13g", "source=13g", ownership_pct=12.5, shares_held=5)
    cost = src(spark, "10k_note", "source=10k_note").withColumn("carrying_usd", F.lit(7.0))
    late = src(spark, "13f", "source=13f", shares_held=10, market_value_usd=500.0)
    (r,) = collect(merge.merge_live([own, cost, late]))
    assert (r["shares_held"], r["market_value_usd"], r["ownership_pct"]) == (10, 500.0, 12.5) and "merged 13f" in r["note"]
    (r,) = collect(merge.merge_live([own, cost]))
    assert r["market_value_usd"] is None and r["carrying_usd"] == 7.0


def test_ticker_continues_in_another_source(spark):
    q, periods = snaps(spark, [("2024-03-31", "2024-05-01", "a", [held("SERV", 10, 100.0)]), ("2024-06-30", "2024-08-01", "b", [])])
    g = frame(spark, SNAPSHOT_SCHEMA, [{"parent_ticker": "P", "period_end": "2024-06-30", "investee_name": "Serve", "investee_ticker": "SERV",
                                        "shares_held": 10, "ownership_pct": 9.0, "note": "source=13g", "as_of_date": "2024-07-01"}])
    merged = merge.merge_sources([q.drop("filing_date", "accession_no"), g.drop("filing_date", "accession_no")]).join(
        periods, ["parent_ticker", "period_end"])
    hist = collect(ledger.diff_snapshots(merged, periods), "period_end")
    assert [r["action"] for r in hist] == ["new", "hold"]


def test_export_coalesce_fills_and_joins_notes(spark):
    df = history(spark, [
        {"period_end": "2024-03-31", "investee_ticker": "a", "action": "hold", "market_value_usd": 5.0, "note": "source=13f"},
        {"period_end": "2024-03-31", "investee_ticker": "A", "action": "hold", "ownership_pct": 3.0, "cusip": "C", "note": "source=13g"}])
    (r,) = collect(merge.coalesce_for_export(df))
    assert (r["market_value_usd"], r["ownership_pct"], r["cusip"], r["note"]) == (5.0, 3.0, "C", "source=13f; source=13g")


def test_reconcile(spark):
    a = spark.createDataFrame([("D", 500e6), ("E", 100e6), ("ONLY", 1.0)], "ticker string, value_a double")
    b = spark.createDataFrame([("D", 2020e6), ("E", 101e6)], "ticker string, value_b double")
    assert [r["ticker"] for r in collect(merge.reconcile(a, b))] == ["D"]


def test_live_merge_of_many_rows_of_one_name_takes_the_first_or_last_that_has_a_value(spark):
    """Rows of a source lack different values; ties are settled by the row's own values, whatever the partitions."""
    rng = random.Random(8)
    some = lambda *xs: rng.choice([None, *xs])
    rows = [(name, prio, some(1.0, 2.0, 3.0), some(10.0, 20.0, 30.0), some(5.0, 6.0), some("u", "v"))
            for name in ("A", "B", "C") for prio in range(3) for _ in range(rng.randint(1, 12))]
    sources = ["13g", "20f_investments_table", "13f"]
    groups = [spark.createDataFrame(
        [("P", n, n, None, pct, sh, mv, q, s, f"source={s}") for n, p, pct, sh, mv, q in rows if p == prio],
        "parent_ticker string, investee_name string, investee_ticker string, cusip string, ownership_pct double, shares_held double, "
        "market_value_usd double, source_quote string, source string, note string").repartition(3) for prio, s in enumerate(sources)]
    least = lambda v: (v is not None, v or 0)  # noqa: E731  nulls come first
    got = {r["investee_ticker"]: r for r in collect(merge.merge_live(groups))}
    for name in ("A", "B", "C"):
        mine = sorted((r for r in rows if r[0] == name), key=lambda r: (r[1], least(r[2]), least(r[3]), least(r[4])))
        first = lambda i, prios: next((r[i] for r in mine if r[1] in prios and r[i] is not None), None)
        last = lambda i: next((r[i] for r in reversed(mine) if r[1] == 2 and r[i] is not None), None)
        assert got[name]["ownership_pct"] == first(2, (0, 1, 2))
        assert got[name]["shares_held"] == (last(3) if last(3) is not None else first(3, (0, 1, 2)))
        assert got[name]["market_value_usd"] == (last(4) if last(4) is not None else first(4, (1, 2)))
        assert got[name]["source"] == "13f+13g" and got[name]["note"] == "source=13g; merged 13f"
