from pyspark.sql import functions as F

from posledger.functions import valuation as val
from posledger.operators import ownership, performance as perf, quality, reporting, valuation
from posledger.schemas import HOLDINGS_SCHEMA
from tests.helpers import collect, day, frame, history


def test_bands(spark):
    df = spark.createDataFrame([(0, 10.0), (1, 20.0), (2, 49.9), (3, 50.0), (4, None)], "i int, p double")
    assert [r.b for r in df.orderBy("i").select(val.ownership_band("p").alias("b")).collect()] == [
        "lt_20", "ge_20_lt_50", "ge_20_lt_50", "ge_50", "unknown"]


def holdings(spark):
    rows = [{"parent_ticker": "P", "investee_ticker": "A", "ownership_pct": 5, "carrying_usd": 50e0, "fair_value_disclosed_usd": 80.0},
            {"parent_ticker": "P", "investee_ticker": "B", "ownership_pct": 30, "carrying_usd": 100.0, "fair_value_disclosed_usd": 150.0},
            {"parent_ticker": "P", "investee_ticker": "C"}]
    df = frame(spark, HOLDINGS_SCHEMA, rows)
    return df.withColumn("filing_gaap_hint", F.when(F.col("investee_ticker") == "A", F.lit("cost")))


def test_cost_stake_and_rollup(spark):
    treated = val.apply_gaap_and_adjustment(holdings(spark))
    by = {r["investee_ticker"]: r for r in collect(treated)}
    assert (by["A"]["gaap_treatment"], by["A"]["suggested_adj_usd"], by["A"]["market_vs_carrying"]) == (
        "measurement_alternative_cost", 30.0, "above")
    assert by["B"]["gaap_treatment"] == "equity_method" and by["B"]["suggested_adj_usd"] == 0.0
    assert by["C"]["gaap_treatment"] == "unclear" and by["C"]["market_vs_carrying"] == "unknown"
    parents = spark.createDataFrame([("P", 10.0, 5.0, 100.0), ("EMPTY", 1.0, 2.0, None)],
                                    "parent_ticker string, price double, bvps double, shares double")
    got = {r["parent_ticker"]: r for r in collect(valuation.rollup_parent(treated, parents))}
    p = got["P"]
    assert (p["holdings_count"], p["holdings_book_adj_usd"], p["holdings_above_count"]) == (3, 30.0, 2)
    assert p["holdings_lookthrough_mtm_usd"] == 50.0
    assert abs(p["bvps_holdings_adj"] - 5.3) < 1e-12 and abs(p["pb_holdings_adj"] - 10 / 5.3) < 1e-12
    assert got["EMPTY"]["holdings_count"] == 0 and got["EMPTY"]["bvps_holdings_adj"] == 2.0


def test_hint_priority(spark):
    df = spark.createDataFrame([(0, 60.0, None, False), (1, 60.0, "cost", True), (2, 5.0, "fv_ni", True), (3, 5.0, "consolidated", False)],
                               "i int, p double, h string, infl boolean")
    got = [r.t for r in df.orderBy("i").select(val.gaap_treatment("p", F.col("infl"), hint=F.col("h"))["gaap_treatment"].alias("t")).collect()]
    assert got == ["consolidated", "consolidated", "equity_method", "consolidated"]


def test_lifo_bundle(spark):
    df = spark.createDataFrame([(0, "US GAAP", 10.0, 8.0, 10.0, 5.0), (1, "IFRS", 10.0, 8.0, 10.0, 5.0), (2, None, None, 8.0, 10.0, 5.0),
                                (3, "GAAP", 10.0, None, 10.0, 5.0)], "i int, b string, r double, p double, k double, s double")
    got = df.orderBy("i").select(val.lifo_adjustment("b", F.lit(True), "r", "p", "k", "s", F.lit("note")).alias("a")).select("a.*").collect()
    assert (got[0].lifo_reserve_usd, got[0].adjusted_bvps, got[0].adjusted_pb_ratio) == (10.0, 12.0, 8 / 12)
    assert got[0].quirk_notes == "note" and got[1].adjusted_bvps is None and got[1].accounting_basis == "IFRS"
    assert "not permitted" in got[1].quirk_notes and "no dollar amount" in got[2].quirk_notes and "missing" in got[3].quirk_notes


AGG = "PRIV_HK_LISTED_INVESTEES_FV"


def composed(spark):
    return history(spark, [
        {"period_end": "2024-12-31", "investee_ticker": AGG, "action": "hold", "market_value_usd": 100e9, "note": "value_source=hk_annual_note22"},
        {"period_end": "2024-06-30", "investee_ticker": "PDD", "action": "hold", "shares_held": 5, "note": "source=13g"},
        {"period_end": "2023-06-30", "investee_ticker": "PDD", "action": "new", "shares_held": 5, "note": "source=13g"},
        {"period_end": "2024-05-31", "investee_ticker": "SE", "action": "hold", "shares_held": 7, "note": "source=13g"},
        {"period_end": "2025-03-31", "investee_ticker": "SE", "action": "hold", "shares_held": 7, "note": "source=13g"}])


def test_composition_stamps_and_residual(spark):
    once = valuation.stamp_composition(composed(spark))
    rows = collect(once)
    stamped = {(r["investee_ticker"], str(r["period_end"])) for r in rows if r["composition_parent"] and "RESIDUAL" not in r["investee_ticker"]}
    assert stamped == {("PDD", "2024-06-30"), ("SE", "2024-05-31")}
    assert all(r["market_value_usd"] is None for r in rows if r["investee_ticker"] in ("PDD", "SE"))
    (res,) = [r for r in rows if r["investee_ticker"] == AGG + "_RESIDUAL"]
    assert res["market_value_usd"] == 100e9 and "excluded_from_portfolio_mv" in res["note"]
    assert [r["portfolio_mv"] for r in collect(perf.portfolio_value(once))] == [100e9]
    again = collect(valuation.stamp_composition(once), "period_end", "investee_ticker")
    assert again == sorted(rows, key=lambda r: (str(r["period_end"]), r["investee_ticker"]))


def stakes(spark, as_of="2024-06-30"):
    rows = [("TCEHY", "PDD", day(as_of), "PDD", 15.5, 120_578.0), ("TCEHY", "NEW", day(as_of), "NewCo", 3.0, 780.0)]
    df = spark.createDataFrame(rows, "parent_ticker string, investee_ticker string, as_of date, investee_name string, "
                               "ownership_pct double, value_to_parent_hkd_mn double").withColumns({
                                   "report_id": F.lit("r1"), "citation": F.lit("c"), "source_url": F.lit("u")})
    return valuation.add_usd(df)


def test_overlay_fills_and_excludes(spark):
    hist = composed(spark).withColumn("parent_ticker", F.lit("TCEHY"))
    rows = collect(valuation.overlay_values(hist, stakes(spark)))
    pdd = [r for r in rows if r["investee_ticker"] == "PDD" and str(r["period_end"]) == "2024-06-30"][0]
    assert pdd["ownership_pct"] == 15.5 and abs(pdd["market_value_usd"] - 120_578e6 / 7.8) < 1
    assert "value_source=broker_sotp" in pdd["note"] and "excluded_from_portfolio_mv" in pdd["note"]
    (new,) = [r for r in rows if r["investee_ticker"] == "NEW"]
    assert new["action"] == "hold" and new["shares_held"] is None and abs(new["market_value_usd"] - 1e8) < 1e-6
    assert len(rows) == 6
    view = collect(valuation.composition_view(valuation.stamp_composition(valuation.overlay_values(hist, stakes(spark)))))
    child = [r for r in view if r["child_ticker"] == "PDD"][0]
    assert child["child_value_source"] == "broker_sotp" and child["parent_aggregate_market_value_usd"] == 100e9


def mark_rows(values=(None, None, None)):
    periods = ("2024-03-31", "2024-06-30", "2024-09-30")
    return [{"period_end": p, "investee_ticker": "XP", "action": "new" if i == 0 else "hold", "shares_held": 31_588_292.0,
             "market_value_usd": values[i], "note": "source=13g"} for i, p in enumerate(periods)]


def bars(spark):
    return spark.createDataFrame([("XP", day("2024-03-28"), 10.0), ("XP", day("2024-06-28"), 12.0), ("XP", day("2024-09-30"), 20.0)],
                                 "ticker string, date date, close double")


def test_marks_and_fixed_basis(spark):
    got = collect(valuation.filing_marks(history(spark, mark_rows()), bars(spark)), "period_end")
    assert [r["mark_at_filing_est_usd"] for r in got] == [31_588_292.0 * p for p in (10, 12, 20)]
    assert {r["cost_basis_est_usd"] for r in got} == {315_882_920.0}
    assert all(r["market_value_usd"] is None and "excluded_from_portfolio_mv" in r["note"] for r in got)
    assert "estimate_role=cost_basis" in got[0]["note"] and "estimate_role=mark_at_filing" in got[1]["note"]
    assert collect(quality.estimates_in_value(history(spark, got))) == []


def test_disclosed_value_keeps_basis_without_mark(spark):
    got = collect(valuation.filing_marks(history(spark, mark_rows((None, 500e6, None))), bars(spark)), "period_end")
    assert got[1]["mark_at_filing_est_usd"] is None and got[1]["market_value_usd"] == 500e6
    assert got[1]["cost_basis_est_usd"] == 315_882_920.0


def test_quarter_axis(spark):
    rows = [{"period_end": p, "investee_ticker": t, "action": "hold", "market_value_usd": v} for p, t, v in (
        ("2025-08-10", "AS", 100e6), ("2025-09-12", "AS", 120e6), ("2025-10-02", "ZZ", 5e6), ("2025-11-20", "AS", 130e6))]
    got = collect(reporting.quarterly_locf(history(spark, rows)))
    assert [(str(r["period_end"]), r["investee_ticker"], r["display_value_usd"]) for r in got] == [("2025-09-30", "AS", 120e6)]
    wide = reporting.pivot_stack(reporting.quarterly_locf(history(spark, rows), include_open_quarter=True), "display_value_usd", top_n=9).orderBy("period_end").collect()
    assert [r.asDict() for r in wide] == [{"period_end": day("2025-09-30"), "AS": 120.0, "ZZ": 0.0}, {"period_end": day("2025-12-31"), "AS": 130.0, "ZZ": 5.0}]


def test_quality_findings(spark):
    rows = history(spark, [
        {"period_end": "2024-03-31", "investee_ticker": "A", "action": "hold", "shares_held": 22.87, "ownership_pct": 22.87, "note": "x"},
        {"period_end": "2024-03-31", "investee_ticker": "a", "action": "exit", "market_value_usd": 0.0, "note": "source=13g"},
        {"period_end": "2024-06-30", "investee_ticker": "YTO", "action": "hold", "market_value_usd": 9.0, "note": "source=13g"}])
    ids = lambda f: [r["check_id"] for r in collect(f)]
    assert ids(quality.unique_period_ticker(rows)) == ["duplicate_ticker_same_period"]
    assert ids(quality.pct_as_shares(rows)) == ["ownership_pct_stuffed_into_shares_held"]
    assert ids(quality.overlay_exit_zero(rows)) == ["overlay_exit_invented_zero"]
    assert ids(quality.placeholder_tickers(rows)) == ["placeholder_exchange_like_ticker"]
    assert ids(quality.ownership_as_value_source(rows)) == ["beneficial_ownership_used_as_value_source"]
    (v,) = collect(quality.verdict(quality.unique_period_ticker(rows)))
    assert (v["ok"], v["n_fail"], v["verdict"], v["score"]) == (False, 1, "fail", 0)
    try:
        quality.enforce(quality.unique_period_ticker(rows))
        raise AssertionError("must raise")
    except quality.QualityError as e:
        assert "duplicate_ticker_same_period" in str(e)


def test_stake_checks(spark):
    parsed = stakes(spark).withColumn("ownership_pct", F.when(F.col("investee_ticker") == "NEW", 120.0).otherwise(F.col("ownership_pct")))
    ids = {r["check_id"] for r in collect(quality.stake_sanity(parsed))}
    assert ids == {"too_few_rows", "stake_out_of_range"}
    assert collect(quality.fx_round_trip(stakes(spark))) == []


def test_buyback_totals_of_refiled_quarters_without_spreading_lists(spark):
    import random

    rng = random.Random(6)
    periods = [day(f"{y}-{q}") for y in (2020, 2021) for q in ("03-31", "06-30", "09-30", "12-31")]
    rows = [(t, p, day(f"{rng.randint(2020, 2022)}-{rng.randint(1, 12):02d}-15"), rng.choice([None, -5.0, 7.0]), rng.choice([None, 2.0]))
            for t in ("A", "B", None) for p in [*periods, None] for _ in range(rng.randint(1, 3))]
    totals = ownership.buyback_totals(spark.createDataFrame(
        rows, "ticker string, period_end date, filing_date date, sale_purchase double, issuance double").repartition(3))
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    got = {(r["ticker"], r["filing_date"]): r["q"] for r in totals.collect()}
    assert totals.count() == len(got) and set(got) == {(r[0], r[2]) for r in rows}
    low = lambda v: (v is not None, v or 0)  # noqa: E731  nulls are least
    for (ticker, filed), q in got.items():
        known = {}
        for r in sorted((r for r in rows if r[0] == ticker and r[2] <= filed), key=lambda r: (r[2], low(r[3]), low(r[4]))):
            known[r[1]] = r
        last = sorted(known.values(), key=lambda r: (r[1] is not None, r[1] or filed))[-4:]
        total = lambda xs: sum(xs) * 10_000 if xs else None
        sale = [r[3] for r in last if r[3] is not None]
        assert (q["period_end"], q["quarters_used"]) == (last[-1][1], len(last))
        assert (q["_sale"], q["_gross"]) == (total(sale), total([max(-s, 0.0) for s in sale]))
        assert q["_issue"] == total([r[4] for r in last if r[4] is not None])
