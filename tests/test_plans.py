import json

import pytest
from pyspark.sql import functions as F

from posledger.operators import quality, text, valuation
from posledger.plans import export, history as plan, holdings, performance, precheck, summaries
from posledger.schemas import HOLDINGS_SCHEMA, SNAPSHOT_SCHEMA
from posledger.sources.filings import load_dims
from tests.helpers import collect, day, frame, history


def report(period, filed, accession, rows):
    return json.dumps({"periodOfReport": period, "filedAt": filed, "accessionNo": accession, "cik": "1543151", "holdings": [
        {"nameOfIssuer": n, "ticker": t, "cusip": c, "value": v, "shrsOrPrnAmt": {"sshPrnamt": s, "sshPrnamtType": "SH"}}
        for n, t, c, s, v in rows]})


def ownership(name, shares, pct):
    return (f"<html><body>{name} (Name of Issuer) 23292E108 (CUSIP Number) Aggregate Amount Beneficially Owned by Each Reporting Person "
            f"{shares} Percent of Class Represented by Amount in Row (11): {pct}%</body></html>")


TABLE = ("<table><tr><td>As of</td><td>December 31, 2023</td><td>March 31, 2024</td></tr><tr><td>Non-marketable equity securities:</td></tr>"
         "<tr><td>Didi</td><td>$</td><td>3,011</td><td>$</td><td>1,900</td></tr></table>")


@pytest.fixture(scope="module")
def built(spark):
    dims = load_dims(spark)
    payloads = spark.createDataFrame([
        ("UBER", report("2018-12-31", "2019-02-14", "q0", [("Grab", "GRAB", "G1", 50, 400)])),
        ("UBER", report("2023-12-31", "2024-02-14", "q1", [("Grab", "GRAB", "G1", 100, 1000), ("Aurora", "AUR", "A1", 10, 50)])),
        ("UBER", report("2024-03-31", "2024-05-15", "q2", [("Grab", "GRAB", "G1", 150, 1800)])),
        ("UBER", report("2024-03-31", "2024-05-10", "q2old", [("Grab", "GRAB", "G1", 1, 1)])),
        ("UBER", report("2024-06-30", "2024-08-14", "q3", [("Grab", "GRAB", "G1", 150, 2100)]))], "parent_ticker string, payload string")
    quarterly, periods = plan.quarterly_snapshots(payloads, dims)
    filings = spark.createDataFrame([
        ("UBER", "1543151", "SC 13G", day("2024-02-01"), "g1", ownership("Didi Global Inc.", "143,911,749", "11.8")),
        ("UBER", "1543151", "SC 13G", day("2024-02-02"), "g2", ownership("Uber Technologies Inc", "5", "5")),
        ("UBER", "1543151", "SC 13G/A", day("2024-08-01"), "g3", ownership("Didi Global Inc.", "0", "0")),
        ("SOLO", "7", "SC 13D", day("2024-01-10"), "s1", ownership("Tuya Inc.", "700", "9.5"))],
        "parent_ticker string, cik string, form string, filing_date date, accession_no string, body string")
    events = plan.ownership_events(filings, dims)
    notes = plan.note_snapshots(spark.createDataFrame(
        [("UBER", "10-Q", day("2024-05-08"), "n1", TABLE)],
        "parent_ticker string, form string, filing_date date, accession_no string, body string"), dims)
    return dims, plan.build_history(quarterly, periods, events, notes, "2023-01-01", dims["ciks"])


def test_history_from_filings(built):
    _, hist = built
    got = {(r["parent_ticker"], r["investee_ticker"], str(r["period_end"])): r for r in collect(hist)}
    grab = [got["UBER", "GRAB", p] for p in ("2018-12-31", "2023-12-31", "2024-03-31", "2024-06-30")]
    assert [r["action"] for r in grab] == ["new", "buy", "buy", "hold"]
    assert all(r["first_seen_period"] == day("2018-12-31") for r in grab)
    assert all("lookback_truncated=1" in r["note"] for r in grab)
    assert grab[2]["shares_held"] == 150 and grab[2]["filing_url"].endswith("/1543151/q2/q2-index.htm")
    assert got["UBER", "AUR", "2024-03-31"]["action"] == "exit" and got["UBER", "AUR", "2024-03-31"]["market_value_usd"] == 0.0
    didi = got["UBER", "DIDIY", "2024-03-31"]
    assert (didi["shares_held"], didi["ownership_pct"], didi["market_value_usd"]) == (143_911_749.0, 11.8, 1.9e9)
    assert "investments_table" in didi["note"]
    gone = got["UBER", "DIDIY", "2024-06-30"]
    assert gone["action"] == "exit" and not any(k[1] == "UBER" for k in got)
    assert got["SOLO", "TUYA", "2024-01-10"]["action"] == "new"


def test_precheck_and_export(spark, built, tmp_path):
    dims, hist = built
    # The overlay exit had a disclosed value before, so it is closed at zero, which the check reports.
    (only,) = collect(precheck.mechanical_precheck(hist, dims))
    assert only["check_id"] == "overlay_exit_invented_zero" and only["evidence"]["investee_ticker"] == "DIDIY"
    live = holdings.live_from_history(hist)
    names = {r["investee_ticker"]: r for r in collect(live)}
    assert set(names) == {"GRAB", "TUYA"} and names["GRAB"]["confidence"] == "history_slice"
    tables = export.report_tables(live, hist, dims["ciks"], "2023-01-01")
    export.export_tables(tables, str(tmp_path / "out"))
    export.export_tables({"current": tables["current"]}, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out" / "history"))
    assert back.count() == hist.count()
    shown = spark.read.parquet(str(tmp_path / "out" / "portfolio"))
    assert shown.where("period_end < '2023-01-01'").count() == 0 and shown.count() > 0
    assert spark.read.parquet(str(tmp_path / "out" / "current")).count() == 2


def test_gate_refuses_bad_rows(spark):
    rows = history(spark, [{"period_end": "2024-03-31", "investee_ticker": "A", "action": "hold", "cost_basis_est_usd": 1.0}])
    try:
        export.report_tables(holdings.live_from_history(rows), rows, load_dims(spark)["ciks"], "2020-01-01")
        raise AssertionError("must raise")
    except quality.QualityError as e:
        assert "excluded_from_portfolio_mv" in str(e)


def test_aggregate_history(spark):
    dims = load_dims(spark)
    filings = spark.createDataFrame([
        ("TCEHY", "1293451", "SC 13G", day("2024-02-01"), "g1", ownership("PDD Holdings", "1,000", "15.5")),
        ("TCEHY", "1293451", "SC 13G", day("2024-02-05"), "g2", ownership("Glu Mobile Inc.", "50", "9.0"))],
        "parent_ticker string, cik string, form string, filing_date date, accession_no string, body string")
    annual = spark.createDataFrame([("TCEHY", day("2024-12-31"), "u", "PRIV_HK_LISTED_INVESTEES_FV", "All listed", 80e9, 80e9, None, "value_source=hk_annual_note22")],
                                   "parent_ticker string, as_of_date date, source_url string, investee_ticker string, investee_name string, "
                                   "market_value_usd double, fair_value_disclosed_usd double, carrying_usd double, note string")
    stakes = valuation.add_usd(spark.createDataFrame([("TCEHY", "PDD", day("2025-03-21"), "PDD", 15.5, 78_000.0, "r", "c", "u")],
                               "parent_ticker string, investee_ticker string, as_of date, investee_name string, ownership_pct double, "
                               "value_to_parent_hkd_mn double, report_id string, citation string, source_url string"))
    bars = spark.createDataFrame([("PDD", day("2024-02-01"), 120.0)], "ticker string, date date, close double")
    cuts = spark.createDataFrame([("GLUU", day("2021-04-29"))], "investee_ticker string, cutoff date")
    hist = plan.build_aggregate_history(plan.ownership_events(filings, dims), annual, stakes, bars, cuts, dims["ciks"])
    rows = collect(hist)
    by = {(r["investee_ticker"], str(r["period_end"])): r for r in rows}
    pdd = by["PDD", "2024-02-01"]
    assert pdd["mark_at_filing_est_usd"] == 120_000.0 and pdd["cost_basis_est_usd"] == 120_000.0 and pdd["market_value_usd"] is None
    # The hold row of the second filing date is the latest at the year end and carries the stamp.
    assert by["PDD", "2024-02-05"]["composition_as_of"] == day("2024-12-31")
    broker = by["PDD", "2025-03-21"]
    assert broker["market_value_usd"] == 1e10 and "excluded_from_portfolio_mv" in broker["note"] and broker["child_value_source"] == "broker_sotp"
    assert ("GLUU", "2024-02-05") not in by and by["PRIV_HK_LISTED_INVESTEES_FV_RESIDUAL", "2024-12-31"]["market_value_usd"] == 80e9
    live = {r["investee_ticker"] for r in collect(holdings.live_from_history(hist))}
    assert {"PDD", "PRIV_HK_LISTED_INVESTEES_FV"} <= live


def test_live_and_universe(spark):
    f13 = frame(spark, SNAPSHOT_SCHEMA, [{"parent_ticker": "P", "investee_name": "Grab", "investee_ticker": "GRAB", "shares_held": 10,
                                          "market_value_usd": 500.0, "source": "13f", "note": "source=13f", "as_of_date": "2024-05-15", "as_of_accession_no": "q"}])
    notes = frame(spark, SNAPSHOT_SCHEMA, [{"parent_ticker": "P", "investee_name": "Moon", "ownership_pct": 36.0, "shares_held": 36.0,
                                            "market_value_usd": 9.0, "source": "20f_note", "note": "source=20f_note", "as_of_date": "2024-06-01"}])
    rows = holdings.checked_holdings(holdings.live_holdings([f13, notes]))
    by = {r["investee_name"]: r for r in collect(rows)}
    assert by["Grab"]["market_value_usd"] == 500.0 and by["Moon"]["market_value_usd"] is None
    assert by["Moon"]["shares_held"] is None and "scrubbed_shares_eq_ownership_pct" in by["Moon"]["note"]
    assert by["Moon"]["gaap_treatment"] == "equity_method"
    parents = spark.createDataFrame([("P", 10.0, 5.0, 100.0), ("NONE", 1.0, 1.0, 1.0)], "ticker string, price double, book_value double, shares double")
    allow = spark.createDataFrame([("p",), ("none",), ("absent",)], "ticker string")
    mine, rolls = holdings.holdings_universe(parents, rows, allow)
    got = {r["ticker"]: r for r in collect(rolls)}
    assert got["P"]["holdings_count"] == 2 and got["P"]["extract_error"] is None and got["P"]["accession_no"] == "q"
    assert got["NONE"]["holdings_count"] == 0 and got["ABSENT"]["extract_error"] and mine.count() == 2


def test_universe_sees_only_what_was_known(spark):
    rows = [("P", "X", "2019-06-30", 10.0, True), ("P", "X", "2024-06-30", 99.0, True), ("P", "Y", "2019-12-31", 5.0, True), ("P", "Z", None, 1.0, True)]
    held = frame(spark, HOLDINGS_SCHEMA, [
        {"parent_ticker": p, "investee_name": n, "investee_ticker": n, "as_of_date": d, "suggested_adj_usd": v, "include_in_book_adj": i,
         "as_of_accession_no": d} for p, n, d, v, i in rows])
    parents = spark.createDataFrame(
        [("P", 10.0, 5.0, 100.0, day("2020-12-31")), ("P", 10.0, 5.0, 100.0, day("2019-07-01")), ("P", 10.0, 5.0, 100.0, day("2025-01-01"))],
        "ticker string, price double, book_value double, shares double, as_of date")
    mine, rolls = holdings.holdings_universe(parents, held)
    got = {str(r["as_of_date"]): (r["holdings_count"], r["holdings_book_adj_usd"]) for r in collect(rolls)}
    assert got == {"2019-07-01": (2, 11.0), "2020-12-31": (3, 16.0), "2025-01-01": (3, 105.0)} and rolls.count() == 3
    assert mine.count() == 8


def test_performance_frames(spark):
    rows = history(spark, [
        {"period_end": "2023-12-31", "investee_ticker": "A", "action": "new", "shares_held": 10, "shares_delta": 10, "market_value_usd": 100.0},
        {"period_end": "2024-03-31", "investee_ticker": "A", "action": "sell", "shares_held": 5, "shares_prev": 10, "shares_delta": -5,
         "market_value_usd": 60.0, "value_prev": 100.0}])
    income = spark.createDataFrame([("P", "FY24", day("2024-03-31"), day("2024-01-01"), day("2024-12-31"), 15.0, None)],
                                   "parent_ticker string, period_label string, fiscal_year_end date, calendar_start date, calendar_end date, "
                                   "amount_usd double, amount_rmb_million double")
    frames = performance.performance_frames(rows, income)
    assert set(frames) == {"returns_by_period", "realized_pnl_qoq", "holding_returns", "returns_chart", "realized_chart",
                           "realized_by_ticker_chart", "reported_vs_est"}
    chart = [r.period_end for r in frames["returns_chart"].orderBy("line_no").collect()]
    assert chart[:4] == ["2023-12-31", "2024-03-31", "", "CAGR (estimated Dietz)"] and chart[4].startswith("years=0.25")
    (rep,) = collect(frames["reported_vs_est"])
    assert rep["our_mtm_sum_usd"] == 20.0 and rep["residual_usd"] == 5.0
    (chart,) = collect(frames["realized_by_ticker_chart"])
    assert chart["investee_ticker"] == "A" and chart["realized_pnl_m"] == 1e-05
    assert collect(performance.performance_frames(rows, min_abs_usd=1e6)["realized_by_ticker_chart"]) == []


def test_backtest(spark):
    deletions = spark.createDataFrame([("A", day("2020-01-01"), "x"), ("B", day("2020-01-01"), "x"), ("C", day("2020-01-01"), "x"),
                                       ("A", day("2021-01-01"), "x")], "ticker string, deletion_date date, source_index string")
    bars = spark.createDataFrame([("A", day("2020-02-01"), 12.0), ("A", day("2020-03-01"), 8.0), ("A", day("2021-05-01"), 7.0), ("A", day("2020-09-01"), 30.0),
                                  ("A", day("2021-08-01"), 30.0), ("B", day("2020-02-01"), 5.0)], "ticker string, date date, close double")
    book = spark.createDataFrame([("A", day("2019-12-01"), 10.0, 7.0), ("B", day("2020-06-01"), 10.0, 7.0)], "ticker string, filed date, bvps double, shares double")
    earn = spark.createDataFrame([("A", day("2019-12-01"), 1.0)], "ticker string, filed date, net_income double")
    adds = spark.createDataFrame([("A", day("2020-08-15"))], "ticker string, added_date date")
    crossings, outcomes = summaries.run_backtest(deletions, adds, bars, book, earn, F.to_date(F.lit("2021-08-05")))
    got = {(r["ticker"], str(r["deletion_date"])): r for r in collect(crossings)}
    first = got["A", "2020-01-01"]
    assert (first["status"], first["crossing_date"], first["buy_price"], first["shares_at_crossing"]) == ("crossed", day("2020-03-01"), 8.0, 7.0)
    assert got["B", "2020-01-01"]["status"] == "never_crossed" and got["C", "2020-01-01"]["status"] == "insufficient_data"
    out = {str(r["deletion_date"]): r for r in collect(outcomes)}
    # Two bars share the best close: the earlier one is the sale.
    assert out["2020-01-01"]["status"] == "realized" and out["2020-01-01"]["sell_date"] == day("2020-09-01")
    assert out["2021-01-01"]["status"] == "still_holding" and out["2021-01-01"]["sell_price"] == 30.0
    wide = summaries.backtest_summary(crossings, outcomes)
    assert wide.count() == 4 and "buyback_period_end" in wide.columns
    (n,) = collect(summaries.summary_counts(wide))
    assert n["num_rows"] == 4 and n["num_with_holdings"] == 0
    assert text.STAKE_PARSERS


def test_published_versions(spark, built, tmp_path):
    """A failing gate and a run that dies before its entry leave the last complete version; parents move on their own."""
    dims, hist = built
    folder = str(tmp_path / "published")
    first = export.export_parents(hist, dims["ciks"], folder, "2023-01-01")
    before = collect(export.read_published(spark, folder, "history"), "parent_ticker", "period_end", "investee_ticker")
    assert len(before) == hist.count() and {r["ticker"] for r in collect(export.read_published(spark, folder, "rollups"))} == {"UBER", "SOLO"}
    with pytest.raises(quality.QualityError):
        export.export_parents(hist.withColumn("cost_basis_est_usd", F.lit(1.0)), dims["ciks"], folder, "2023-01-01")
    # A run that stops after some tables: their files are there, their entry is not.
    hist.where("false").write.parquet(f"{folder}/history/version=v9")
    hist.limit(1).withColumn("extra", F.lit(1)).write.parquet(f"{folder}/current/version=v9")
    assert collect(export.read_published(spark, folder, "history"), "parent_ticker", "period_end", "investee_ticker") == before
    second = export.export_parents(hist.where("parent_ticker = 'SOLO'").withColumn("investee_name", F.lit("renamed")), dims["ciks"], folder, "2023-01-01")
    assert second > first
    names = {(r["parent_ticker"], r["investee_name"] == "renamed") for r in collect(export.read_published(spark, folder, "history"))}
    assert names == {("UBER", False), ("SOLO", True)}
    versions = {r["parent_ticker"]: r["version"] for r in collect(export.published_versions(spark, folder))}
    assert versions == {"UBER": first, "SOLO": second}


def test_export_of_nothing(spark, built, tmp_path):
    dims, hist = built
    export.export_parents(hist.where("false"), dims["ciks"], str(tmp_path / "none"), "2023-01-01")
    assert export.read_published(spark, str(tmp_path / "none"), "portfolio").count() == 0


def test_each_parent_by_its_strategy(spark):
    dims = load_dims(spark)
    none = lambda schema: spark.createDataFrame([], schema)
    payloads = spark.createDataFrame([
        ("UBER", report("2024-03-31", "2024-05-15", "q2", [("Grab", "GRAB", "G1", 150, 1800)])),
        ("TCEHY", report("2024-03-31", "2024-05-15", "t2", [("Grab", "GRAB", "G1", 9, 9)]))], "parent_ticker string, payload string")
    filings = spark.createDataFrame([
        (p, "1", "SC 13G", day("2024-02-01"), f"g-{p}", ownership("Tuya Inc.", "700", "9.5")) for p in ("UBER", "TCEHY", "SOLO")],
        "parent_ticker string, cik string, form string, filing_date date, accession_no string, body string")
    pages = spark.createDataFrame([("TCEHY", day("2024-12-31"), "u", "The fair value of our shareholdings in listed investee companies amounted to "
                                    "RMB10.0 billion as at")], "parent_ticker string, as_of_date date, source_url string, text string")
    stakes = valuation.add_usd(none("parent_ticker string, investee_ticker string, as_of date, investee_name string, ownership_pct double, "
                                    "value_to_parent_hkd_mn double, report_id string, citation string, source_url string"))
    hist = plan.history_of_parents(payloads, filings, pages, dims, F.to_date(F.lit("2025-06-30")), stakes,
                                   none("ticker string, date date, close double"), none("investee_ticker string, cutoff date"))
    rows = {(r["parent_ticker"], r["investee_ticker"], str(r["period_end"])): (r["strategy"], r["grid"]) for r in collect(hist)}
    assert rows["UBER", "GRAB", "2024-03-31"] == rows["UBER", "TUYA", "2024-03-31"] == ("fanout_13f_13g_notes", "13f")
    assert rows["SOLO", "TUYA", "2024-02-01"] == ("fanout_13f_13g_notes", "13g")
    assert rows["TCEHY", "TUYA", "2024-02-01"] == rows["TCEHY", "PRIV_HK_LISTED_INVESTEES_FV", "2024-12-31"] == ("fanout_13g_hk", "13g")
    assert not any(k[0] == "TCEHY" and k[1] == "GRAB" for k in rows)


def test_aggregate_steps_are_a_fixpoint(spark):
    """Stamp, overlay and stamp again: a second run over the result changes nothing."""
    rows = history(spark, [
        {"period_end": "2024-03-31", "investee_ticker": "PDD", "investee_name": "PDD", "action": "new", "shares_held": 5, "note": "source=13g"},
        {"period_end": "2024-06-30", "investee_ticker": "PDD", "investee_name": "PDD", "action": "hold", "shares_held": 5, "note": "source=13g"},
        {"period_end": "2024-12-31", "investee_ticker": "PRIV_HK_LISTED_INVESTEES_FV", "investee_name": "All", "action": "hold",
         "market_value_usd": 8e10, "note": "value_source=hk_annual_note22"}], parent="TCEHY")
    stakes = valuation.add_usd(spark.createDataFrame(
        [("TCEHY", "PDD", day("2024-06-30"), "PDD", 15.5, 78_000.0, "r", "c", "u"), ("TCEHY", "BZ", day("2024-09-30"), "BZ", 9.0, 7_800.0, "r", "c", "u")],
        "parent_ticker string, investee_ticker string, as_of date, investee_name string, ownership_pct double, "
        "value_to_parent_hkd_mn double, report_id string, citation string, source_url string"))

    def run(df):
        return valuation.finalize_composition(valuation.stamp_composition(valuation.overlay_values(valuation.stamp_composition(df), stakes)))

    once = collect(run(rows), "investee_ticker", "period_end")
    twice = collect(run(spark.createDataFrame([tuple(r[c] for c in rows.columns) for r in once], rows.schema)), "investee_ticker", "period_end")
    assert once == twice and len(once) == 5
    assert sum(r["child_value_source"] == "broker_sotp" for r in once) == 2


def test_holdings_meet_only_the_dates_they_are_known_at(spark):
    held = frame(spark, HOLDINGS_SCHEMA, [{"parent_ticker": "P", "investee_name": "X", "investee_ticker": "X", "as_of_date": "2020-01-01"}])
    keys = spark.createDataFrame([("P", day("2021-01-01"))], "parent_ticker string, as_of date")
    joins = [x for x in holdings.holdings_as_of(held, keys)._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert joins and not any("<" in x or ">" in x for x in joins)


def test_row_checks_share_one_scan(spark, built):
    dims, hist = built
    checks = quality.history_checks(hist)
    plan_text = quality.row_findings(hist, checks)._jdf.queryExecution().executedPlan().toString()
    assert len(checks) >= 9 and plan_text.count("FileScan") == 1 and "Union" not in plan_text and "Exchange" not in plan_text


def test_holdings_are_worked_out_once_for_check_and_reader(spark):
    """The check reads what it hands on; the plan of the result is a scan."""
    f13 = frame(spark, SNAPSHOT_SCHEMA, [{"parent_ticker": "P", "investee_name": "Grab", "investee_ticker": "GRAB", "shares_held": 10,
                                          "ownership_pct": 10, "market_value_usd": 500.0, "source": "13f", "note": "source=13f"}])
    rows = holdings.checked_holdings(holdings.live_holdings([f13]))
    assert "Aggregate" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["shares_held"], r["note"]) for r in collect(rows)] == [(None, "source=13f; scrubbed_shares_eq_ownership_pct")]
