from pyspark.sql import functions as F

from posledger.operators import ledger
from posledger.operators.merge import coalesce_survivors
from posledger.operators.ledger import classify_quantity
from tests.helpers import collect, day, history, snapshots


def row(ticker, shares=None, value=None, **extra):
    return {"investee_name": extra.pop("name", ticker), "investee_ticker": ticker,
            "shares_held": shares, "market_value_usd": value, **extra}


def test_quantity_actions(spark):
    pairs = [(0.0, 100.0), (100.0, 0.0), (100.0, 150.0), (150.0, 100.0), (100.0, 100.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p double, c double")
    got = [r.a for r in df.orderBy("i").select(classify_quantity(F.col("p"), F.col("c")).alias("a")).collect()]
    assert got == ["new", "exit", "buy", "sell", "hold"]


def test_three_names_then_two(spark):
    rows, periods = snapshots(spark, [
        ("2024-03-31", "2024-05-15", "a1", [
            row("AAA", 10_000_000, 1e8, ownership_pct=3.0), row("BBB", 10_887_904, 2e8), row("CCC", 5, 50.0)]),
        ("2024-06-30", "2024-08-14", "a2", [row("BBB", 4_419_823, 9e7), row("CCC", 5, 60.0)]),
    ])
    got = {(str(r["period_end"]), r["investee_ticker"]): r
           for r in collect(ledger.diff_snapshots(rows, periods))}
    gone = got["2024-06-30", "AAA"]
    assert gone["action"] == "exit" and gone["shares_delta"] == -10_000_000
    assert gone["ownership_pct"] == 0.0 and gone["market_value_usd"] == 0.0
    assert gone["exited_period"] == day("2024-06-30") and gone["accession_no"] == "a2"
    sold = got["2024-06-30", "BBB"]
    assert sold["action"] == "sell" and sold["shares_delta"] == 4_419_823 - 10_887_904
    assert got["2024-06-30", "CCC"]["action"] == "hold"
    assert got["2024-03-31", "AAA"]["first_seen_period"] == day("2024-03-31")


def test_shares_then_percent_only(spark):
    rows, periods = snapshots(spark, [
        ("2024-03-31", "2024-03-31", "a1", [row("AAA", 1000, None, ownership_pct=50.0)]),
        ("2024-06-30", "2024-06-30", "a2", [row("AAA", None, None, ownership_pct=50.6)]),
    ])
    last = collect(ledger.diff_snapshots(rows, periods), "period_end")[-1]
    assert last["action"] == "buy" and last["shares_delta"] is None and last["shares_held"] is None
    assert "qoq_continuity=ownership_pct" in last["note"]


def test_empty_filing_exits_all_and_reentry_is_new(spark):
    rows, periods = snapshots(spark, [
        ("2024-03-31", "2024-03-31", "a1", [row("AAA", 10, 100.0)]),
        ("2024-06-30", "2024-06-30", "a2", []),
        ("2024-09-30", "2024-09-30", "a3", [row("AAA", 4, 80.0)]),
    ])
    got = [(r["action"], r["first_seen_period"]) for r in collect(ledger.diff_snapshots(rows, periods), "period_end")]
    first = day("2024-03-31")
    assert got == [("new", first), ("exit", first), ("new", first)]


def test_exit_cutoff_gives_one_documented_exit(spark):
    periods = [
        ("2021-04-20", "2021-04-20", "g1", [row("GLUU", 100, None, note="source=13g")]),
        ("2021-05-17", "2021-05-17", "g2", [row("GLUU", 100, None, note="source=13g"), row("ZZZ", 5, None, note="source=13g")]),
    ]
    rows, grid = snapshots(spark, periods)
    cuts = spark.createDataFrame([("GLUU", day("2021-04-29"))], "investee_ticker string, cutoff date")
    kept, events = ledger.apply_exit_cutoffs(rows, cuts)
    got = [r for r in collect(ledger.diff_snapshots(kept, grid, events)) if r["investee_ticker"] == "GLUU" and r["action"] == "exit"]
    assert len(got) == 1
    assert got[0]["period_end"] == day("2021-05-17") and got[0]["market_value_usd"] is None
    assert got[0]["accession_no"] == "g2" and "exit_reason=mna_acquired" in got[0]["note"]


def test_exits_stay_with_their_parent(spark):
    frames = [snapshots(spark, [
        (d, d, f"{p}-{d}", [row("GONE", 100, None, note="source=13g"), row("STAYS", 5, None, note="source=13g")]) for d in dates], parent=p)
        for p, dates in (("A", ["2020-06-30", "2020-09-30"]), ("B", ["2020-06-30", "2020-12-31"]))]
    rows, grid = (x.unionByName(y) for x, y in zip(*frames))
    cuts = spark.createDataFrame([("GONE", day("2020-07-01"))], "investee_ticker string, cutoff date")
    kept, events = ledger.apply_exit_cutoffs(rows, cuts)
    exits = {r["parent_ticker"]: r for r in collect(ledger.diff_snapshots(kept, grid, events)) if r["action"] == "exit"}
    assert {p: (r["accession_no"], str(r["filing_date"])) for p, r in exits.items()} == {
        "A": ("A-2020-09-30", "2020-09-30"), "B": ("B-2020-12-31", "2020-12-31")}


def ratio_case(spark, rows):
    return {(str(r["period_end"]), r["action"]) for r in collect(ledger.reclassify_share_ratio(history(spark, rows)))}


def base(period, action, cusip, held, prev):
    return {"period_end": period, "action": action, "cusip": cusip, "investee_ticker": "G",
            "shares_held": held, "shares_prev": prev}


def test_share_ratio_next_period_id(spark):
    got = ratio_case(spark, [
        base("2021-03-31", "hold", "08653C106", 10e6, 10e6),
        base("2021-06-30", "sell", "08653C106", 2e6, 10e6),
        base("2021-09-30", "hold", "08653C502", 2e6, 2e6)])
    assert ("2021-06-30", "ratio_adj") in got


def test_share_ratio_same_period_id(spark):
    got = ratio_case(spark, [
        base("2021-03-31", "hold", "08653C502", 2e6, 2e6), base("2021-06-30", "sell", "08653C601", 5e5, 2e6)])
    assert ("2021-06-30", "ratio_adj") in got


def test_real_sale_stays_a_sale(spark):
    got = ratio_case(spark, [
        base("2021-03-31", "hold", "123456789", 1e6, 1e6), base("2021-06-30", "sell", "123456789", 2e5, 1e6),
        base("2021-09-30", "hold", "123456789", 2e5, 2e5)])
    assert ("2021-06-30", "sell") in got


def test_exit_and_new_coalesce_to_new(spark):
    df = history(spark, [
        {"period_end": "2024-03-31", "investee_ticker": "SERV", "action": "exit", "shares_held": 0, "cusip": "X1"},
        {"period_end": "2024-03-31", "investee_ticker": "SERV", "action": "new", "shares_held": 7}])
    got = collect(coalesce_survivors(df))
    assert len(got) == 1 and got[0]["action"] == "new" and got[0]["cusip"] == "X1"


def test_input_order_and_partitions_do_not_matter(spark):
    rows, periods = snapshots(spark, [
        (f"20{y}-{m}", f"20{y}-{m}", f"a{y}{m}", [row(t, (hash((y, m, t)) % 7) * 10, 5.0) for t in "ABCD"])
        for y in (21, 22) for m in ("03-31", "06-30", "09-30", "12-31")])
    a = collect(ledger.diff_snapshots(rows, periods), "period_end", "investee_ticker")
    b = collect(ledger.diff_snapshots(rows.orderBy(F.rand(3)).repartition(7), periods.repartition(3)),
                "period_end", "investee_ticker")
    assert a == b and a
