import time
"""Text extractors on invented filings; expected values are worked out by hand."""

import datetime as dt

from pyspark.sql import functions as F

from posledger.functions import patterns as pat
from posledger.operators import text
from tests.helpers import collect, day


def one(spark, value, column="body", **extra):
    return spark.createDataFrame([(value, *extra.values())], [column, *extra])


# -- keyword windows -----------------------------------------------------------------------------

def excerpt(spark, body, width, keywords=("lifo", "fifo", "inventory"), priority=("lifo", "fifo")):
    (r,) = text.keyword_windows(one(spark, body), "body", keywords, priority, width).collect()
    return r.excerpt


def test_windows_by_hand(spark):
    body = "0123456789 LIFO 0123456789 0123456789 inventory 0123456789"
    # Priority first, then the other hit; four characters on either side.
    assert excerpt(spark, body, 4) == text.SEPARATOR.join(["789 LIFO 012", "789 inventory 012"])
    # Windows that touch become one; a secondary window inside a priority one is left out.
    assert excerpt(spark, "aa lifo bb fifo cc", 3) == "aa lifo bb fifo cc"
    assert excerpt(spark, "xxxx lifo inventory yyyy", 30) == "xxxx lifo inventory yyyy"
    assert excerpt(spark, "inventory only", 2) == "inventory o"


def test_texts_are_never_cut(spark):
    plain = "no such word here. " * 3000
    assert excerpt(spark, plain, 10) == plain.strip()
    many = " ".join(f"number {i} lifo end{i}" for i in range(4000))
    kept = excerpt(spark, many, 8)
    assert kept.count("lifo") == 4000 and "end3999" in kept
    assert excerpt(spark, "", 10) == ""


def test_every_hit_is_covered_and_windows_are_apart(spark):
    body = "".join(f"{'lifo' if i % 37 == 0 else 'word'}{i} " for i in range(500))
    parts = excerpt(spark, body, 25).split(text.SEPARATOR)
    starts = [body.index(p) for p in parts]
    assert starts == sorted(starts)
    ends = [s + len(p) for s, p in zip(starts, parts)]
    assert all(a < b for a, b in zip(ends, starts[1:]))
    assert all(any(s <= 0 + body.index(f"lifo{i} ") < e for s, e in zip(starts, ends)) for i in range(0, 500, 37))


def test_ownership_slices_keep_all_in_order(spark):
    body = "x" * 50 + " we held 10% of A " + "y" * 30000 + " we held 33% of B " + "z" * 50
    (r,) = text.ownership_slices(one(spark, body), "body", width=20).collect()
    assert r.slices.index("10%") < r.slices.index("33%") and text.SEPARATOR in r.slices


# -- ownership filings ---------------------------------------------------------------------------

def cover(issuer, amount, percent, closing):
    return f"""<html><body>
{issuer} (Name of Issuer)
CUSIP No. 44332N106
Aggregate Amount Beneficially Owned by Each Reporting Person
{amount}
10 Check Box if the Aggregate Amount in Row (9) Excludes Certain Shares
Percent of Class Represented by Amount in Row (9)
{percent}
{closing}
</body></html>"""


def test_ownership_filing_html(spark):
    gone = cover("Northlake Media Corp.", "0", "0%", "As of May 2, 2022, the holder no longer owns any ordinary shares.")
    held = cover("Quillfeather Foods Inc.", "1,204,500", "6.4%", "As of May 2, 2022, the holder owns ordinary shares.")
    voting = """<html><body>Saltmarsh Labs Inc. (Name of Issuer) 55512Q103 (CUSIP Number)
(7) Sole Voting Power 2,400,018 (1)
(13) Percent of Class Represented by Amount in Row (11): 8.2% (2)</body></html>"""
    df = spark.createDataFrame([(0, gone), (1, held), (2, voting)], "i int, body string")
    a, b, c = text.extract_ownership_filing(df).orderBy("i").collect()
    assert (a.ownership_pct, a.shares, a.exit_flag) == (0.0, 0.0, True) and "Northlake" in a.issuer_name
    assert (b.ownership_pct, b.shares, b.exit_flag) == (6.4, 1204500.0, False)
    assert (c.ownership_pct, c.shares, c.cusip) == (8.2, 2400018.0, "55512Q103")


def test_ownership_filing_xml(spark):
    xml = ('<?xml version="1.0"?><n:doc xmlns:n="u"><n:issuerName>Peakmoor Inc</n:issuerName><n:issuerCusipNumber>71234A109'
           '</n:issuerCusipNumber><n:classPercent>5.5 %</n:classPercent><n:aggregateAmountOwned>98,700'
           '</n:aggregateAmountOwned></n:doc>')
    (r,) = text.extract_ownership_filing(one(spark, xml)).collect()
    assert (r.issuer_name, r.cusip, r.ownership_pct, r.shares, r.exit_flag) == ("Peakmoor Inc", "71234A109", 5.5, 98700.0, False)


def test_ownership_positions(spark):
    df = spark.createDataFrame(
        [("A", "A", 22.87, None, False), ("B", "B", None, None, False), ("C", "C", None, None, True), ("D", "D", 7.0, 10.0, True)],
        "investee_name string, investee_ticker string, ownership_pct double, shares double, exit_flag boolean").withColumns({
            "form": F.lit("SC 13G"), "cik": F.lit("1"), "filing_date": F.lit(dt.date(2024, 1, 1)), "accession_no": F.lit("x")})
    got = {r["investee_name"]: r for r in collect(text.ownership_positions(df))}
    assert set(got) == {"A", "C", "D"}
    assert got["A"]["shares_held"] is None and "qoq_continuity=ownership_pct" in got["A"]["note"]
    assert got["C"]["is_exit"] and got["C"]["shares_held"] == 0.0 and "13g_exit=1" in got["C"]["note"]
    assert not got["D"]["is_exit"] and got["D"]["shares_held"] == 10.0


# -- investments tables and notes ----------------------------------------------------------------

def test_investments_table_html_and_prose(spark):
    (name_a, tick_a), (name_b, tick_b) = pat.INVESTMENT_NAMES[0], pat.INVESTMENT_NAMES[1]
    table = f"""<table><tr><td>As of</td><td>March 31, 2021</td><td>March 31, 2022</td></tr>
<tr><td>Non-marketable equity securities:</td></tr>
<tr><td>{name_a}</td><td>$</td><td>120</td><td>$</td><td>95</td></tr>
<tr><td>{name_b}</td><td>(2)</td><td>40</td><td></td><td>61.5</td></tr></table>"""
    filler = " Nothing of note." * 500
    prose = (f"Balances As of March 31, 2021 March 31, 2022 {name_a} $ 120 $ 95 {filler} {name_b} (2) 40 61.5 and later "
             f"As of June 30, 2022 June 30, 2023 {name_a} $ 70 $ 71")
    df = spark.createDataFrame([("h", table, "10-Q"), ("p", prose, "10-K")], "id string, body string, form string")
    rows = collect(text.extract_investments_table(df))
    by = {(r["id"], r["investee_ticker"], str(r["as_of_date"])): r["fair_value_disclosed_usd"] for r in rows}
    for i in "hp":
        assert by[i, tick_a, "2021-03-31"] == 120e6 and by[i, tick_a, "2022-03-31"] == 95e6
        # In the prose this row lies more than 8,000 characters behind its header.
        assert by[i, tick_b, "2021-03-31"] == 40e6 and by[i, tick_b, "2022-03-31"] == 61.5e6
    # A second header opens a section of its own.
    assert by["p", tick_a, "2022-06-30"] == 70e6 and by["p", tick_a, "2023-06-30"] == 71e6
    assert len(rows) == 10 and {r["source"] for r in rows} == {"10q_investments_table", "10k_investments_table"}


def test_investment_notes(spark):
    body = ("Investment in certain contracts (\"k&\") June 2020, we signed several contracts.\n"
            "Investment in Lanternfish Ltd (\"Lanternfish\"). " + "The terms are long. " * 100 +
            "We acquired approximately 12% equity interest and invested US $0.3 billion.\n"
            "Investment in Bramble Tools (\"Bramble\"). No terms were disclosed.")
    frame = one(spark, body, form="20-F")
    rows = {r["investee_name"]: r for r in collect(text.extract_investment_notes(frame))}
    assert set(rows) == {"Lanternfish Ltd"}
    note = rows["Lanternfish Ltd"]
    # The facts stand 2,000 characters behind the heading and before the next one.
    assert note["ownership_pct"] == 12.0 and note["carrying_usd"] == 3e8 and note["source"] == "20f_note"
    (pos,) = collect(text.note_positions(text.extract_investment_notes(frame)))
    assert pos["market_value_usd"] is None and pos["shares_held"] is None
    assert pos["investee_ticker"] == "PRIV_LANTERNFISH_LTD"


def test_long_private_names_stay_apart(spark):
    from posledger.functions.text import private_ticker
    name = "Upper Valley Cooperative Semiconductor Equipment Holding Company Number"
    df = spark.createDataFrame([(f"{name} {n}",) for n in ("One", "Two")], "n string")
    assert len({r[0] for r in df.select(private_ticker("n")).collect()}) == 2


# -- annual aggregates and stake tables ----------------------------------------------------------

def annual(listed, unlisted, line=""):
    return f"""9 INVESTMENTS IN ASSOCIATES
2021 2020
Investments in associates
– Listed entities {listed} 1,000
– Unlisted entities {unlisted} 2,000
9,999 3,000
{line}
"""


def test_annual_aggregates(spark):
    values = ("The fair value of our shareholdings in listed investee companies (excluding subsidiaries) amounted to RMB71.9 "
              "billion as at 31 December 2021 (31 December 2020: RMB60.0 billion), and the carrying book value of our "
              "shareholdings in unlisted investee companies (excluding subsidiaries) amounted to RMB30.1 billion as at 31 December 2021")
    nested = "2021 Listed entities (Note) 1 2 3 4 (5) 6 80,000"
    lone = "The fair value of our shareholdings in listed investee companies (excluding subsidiaries) amounted to RMB7.1884 billion as at"
    df = spark.createDataFrame(
        [(annual("5,000", "4,000", nested + "\n" + values), day("2021-12-31"), "u"), ("nothing", day("2020-12-31"), "u"),
         (lone, day("2019-12-31"), "u")], "text string, as_of_date date, source_url string")
    rows = {(str(r["as_of_date"])[:4], r["investee_ticker"]): r for r in collect(text.extract_annual_aggregates(df))}
    assert len(rows) == 5
    rate = 7.1884
    inner = rows["2021", "PRIV_HK_LISTED_ASSOCIATES"]
    assert abs(inner["carrying_usd"] - 5_000e6 / rate) < 1 and abs(inner["fair_value_disclosed_usd"] - 80_000e6 / rate) < 1
    assert inner["market_value_usd"] is None and "nested_in=listed_investees_fv" in inner["note"]
    assert "incomplete" not in inner["note"]
    assert abs(rows["2021", "PRIV_HK_LISTED_INVESTEES_FV"]["market_value_usd"] - 71.9e9 / rate) < 1
    assert rows["2021", "PRIV_HK_UNLISTED_INVESTEES"]["market_value_usd"] is None
    assert abs(rows["2021", "PRIV_HK_UNLISTED_ASSOCIATES"]["carrying_usd"] - 4_000e6 / rate) < 1
    # A report with a single aggregate keeps it and says that others are missing.
    single = rows["2019", "PRIV_HK_LISTED_INVESTEES_FV"]
    assert abs(single["market_value_usd"] - 1e9) < 1 and "aggregates=incomplete" in single["note"]


STAKES = """Figure 3: valuation of strategic investments
Name Ticker Tencent's stake % Mkt cap (US$mn) Value to Tencent (HK$mn)
Harbourline Inc HBL US 11.5 2,000 1,800
Oxbow Rail Ltd 880 HK 7.25 900 510
Tidepool Games Inc 123456 KS 3.5 640 175
Cedarwick Corp 4321 JP 2.0 75 12
Other listed entities as a whole 5,000 700
Listed investments (current value) 9,000
Afterthought Plc 770 HK 1.5 100 12
"""


def test_stake_table_lines_and_running_text(spark):
    want = {"HBL": 11.5, "0880.HK": 7.25, "123456.KS": 3.5, "4321.T": 2.0}
    flat = "valuation of strategic investments " + " ".join(STAKES.splitlines()[2:6])
    far = "Preface. " * 2000 + flat
    df = spark.createDataFrame([("t", STAKES), ("i", flat), ("f", far)], "id string, text string")
    rows = collect(text.extract_stake_table(df))
    for i in "tif":
        got = {r["investee_ticker"]: r["ownership_pct"] for r in rows if r["id"] == i}
        assert got == want, i
    assert [r for r in rows if r["investee_ticker"] == "HBL"][0]["value_to_parent_hkd_mn"] == 1800.0


def test_stakes_of_running_text_without_heading_or_behind_stop_words(spark):
    run = " ".join(STAKES.splitlines()[2:6])
    head, late = "valuation of strategic investments", " Listed investments 9,000 Afterthought Plc 770 HK 1.5 100 12"
    lines = STAKES.replace("valuation of strategic investments", "strategic investments, stake")
    want = {"HBL", "0880.HK", "123456.KS", "4321.T"}
    texts = {
        "no heading": ("Holdings of the group: " + run, want),
        "stop words between, no heading": (run.replace(" Tidepool", " Source: filings. Tidepool"), want),
        "caption": (f"{head} Figure 12: stakes held. Source: company data. Note: rounded. {run}{late}", want),
        "heading twice": (f"Contents: {head} 4, outlook 9. Figure 3: {head} {run}{late}", want),
        "stop word within a name": (f"{head} {run} Alpine Figure Works Inc 555 HK 2.5 40 9{late}", want | {"0555.HK"}),
        "other heading over lines": (lines, want),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "id string, text string")
    rows = collect(text.extract_stake_table(df))
    for i, (_, tickers) in texts.items():
        assert {r["investee_ticker"] for r in rows if r["id"] == i} == tickers, i


# -- small extractors ----------------------------------------------------------------------------

def test_small_extractors(spark):
    df = spark.createDataFrame([("<h:periodOfReport>09-30-2019</h:periodOfReport>",), ("<periodOfReport>2020-12-31</periodOfReport>",), ("x",)], "body string")
    assert [r.p for r in df.select(text.period_of_report("body").alias("p")).collect()] == [day("2019-09-30"), day("2020-12-31"), None]
    lines = "HARBOURLINE INC   HBL   Health Care\nnot a row\n  OXBOW & SONS INC    OX   Real Estate  \n"
    assert [(r.company, r.ticker, r.industry) for r in text.reconstitution_rows(one(spark, lines, "text")).collect()] == [
        ("HARBOURLINE INC", "HBL", "Health Care"), ("OXBOW & SONS INC", "OX", "Real Estate")]
    soup = "p pMember qMember rMember rest"
    assert one(spark, soup).select(text.strip_tag_runs("body").alias("t")).collect()[0].t == "p  rest"


# -- many hits -----------------------------------------------------------------------------------

def test_spans_of_many_hits(spark):
    """A hundred thousand hits of one text: positions, merged windows and slices, without copying arrays hit by hit."""
    hits = 100_000
    body = "".join(f"we held {i % 60}% x{'y' * (i % 90)} " for i in range(hits))
    frame = one(spark, body)
    took = time.perf_counter()
    spans = frame.select(text.match_spans("body", r"we held\s+\d+%").alias("s")).first().s
    assert len(spans) == hits and all(body[a:a + 7] == "we held" and body[b - 1] == "%" for a, b in spans[::997])
    merged = frame.select(text.keyword_spans("body", ["we held"], 20).alias("s")).first().s
    assert time.perf_counter() - took < 60
    assert all(a.hi < b.lo for a, b in zip(merged, merged[1:])) and merged[0].lo == 0
    covered = [False] * len(body)
    for s in merged[:50]:
        covered[s.lo:s.hi] = [True] * (s.hi - s.lo)
    assert all(covered[a] for a, b in spans if b <= merged[49].hi)


def test_spans_without_hits_and_without_text(spark):
    rows = spark.createDataFrame([("",), (None,), ("none",), ("ab",)], "body string")
    got = [r.s for r in rows.select(text.keyword_spans("body", ["ab"], 3).alias("s")).collect()]
    assert [x and [tuple(s) for s in x] for x in got] == [[], [], [], [(0, 2)]]


def filters_of(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Filter " in line]


def test_notes_search_each_page_and_section_once(spark):
    """No filter on the results repeats the searches, and headings are not searched again for every hit."""
    body = "".join(f'Investment in Firm{i} Ltd ("Short{i}"). Approximately {i}% equity interest and invested US ${i} million. ' for i in (3, 4, 5))
    body += "ANT GROUP: newly  issued 33% equity interest of Ant Group Co. We Held 12 % of shares of ant group then."
    notes = text.extract_investment_notes(one(spark, body).withColumn("form", F.lit("20-F")))
    got = {(r.investee_name, r.ownership_pct, r.carrying_usd) for r in notes.collect()}
    assert got == {("Firm3 Ltd", 3.0, 3e6), ("Firm4 Ltd", 4.0, 4e6), ("Firm5 Ltd", 5.0, 5e6), ("Ant Group Co., Ltd.", 12.0, None)}
    assert not any("regexp" in f for f in filters_of(notes))
    assert notes._jdf.queryExecution().optimizedPlan().toString().count("Investment\\s+in") <= 4


def test_annual_aggregates_repeat_no_search_in_a_filter(spark):
    body = ("İstanbul. Carrying Book Value of our shareholdings in unlisted investee companies was RMB 2.5 billion. Fair value of cash. "
            "FAIR VALUE OF our shareholdings in listed investee companies amounted to RMB3.0 Billion")
    df = spark.createDataFrame([(b,) for b in (body, body.replace("İ", "I"), "none", None)], "text string").withColumns(
        {"as_of_date": F.lit("2020-12-31").cast("date"), "source_url": F.lit("u")})
    rows = text.extract_annual_aggregates(df, rate=1.0)
    got = [(r.investee_ticker, r.market_value_usd or r.carrying_usd) for r in rows.collect()]
    assert sorted(got) == sorted(2 * [("PRIV_HK_LISTED_INVESTEES_FV", 3e9), ("PRIV_HK_UNLISTED_INVESTEES", 2.5e9)])
    assert not any("regexp" in f.lower() for f in filters_of(rows))


def test_ownership_filing_searches_each_mark_once(spark):
    parsed = text.extract_ownership_filing(one(spark, "<p>x</p>"))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Percent of Class Represented by Amount") == 1 and plan.count("Sole Voting Power") == 1
