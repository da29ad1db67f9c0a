import pytest
import json

from pyspark.sql import functions as F, types as T

from posledger.functions import dates, text as txt
from posledger.operators import identity, ownership, screening
from posledger.schemas import MEMBERSHIP_SCHEMA, conform, evolve
from posledger.sources import filings, listings, tables
from posledger.streaming import incremental
from tests.helpers import collect, day

XML = """<?xml version="1.0" ?>
<informationTable xmlns="http://www.sec.gov/edgar/document/thirteenf/informationtable">
<infoTable><nameOfIssuer>WEIBO CORP</nameOfIssuer><titleOfClass>SPONSORED ADR</titleOfClass><cusip>948596101</cusip><value>78750000</value>
<shrsOrPrnAmt><sshPrnamt>9000000</sshPrnamt><sshPrnamtType>SH</sshPrnamtType></shrsOrPrnAmt></infoTable>
<infoTable><nameOfIssuer>XPENG INC</nameOfIssuer><cusip>98422D105</cusip><value>573822</value>
<shrsOrPrnAmt><sshPrnamt>33537232</sshPrnamt></shrsOrPrnAmt></infoTable>
<infoTable><nameOfIssuer>OPT</nameOfIssuer><value>5</value><putCall>Put</putCall></infoTable></informationTable>"""


def test_xml_table_units(spark):
    rows = collect(filings.flatten_13f_xml(spark.createDataFrame([("a", XML)], "id string, body string")), "cusip")
    assert [(r["cusip"], r["shares_held"], r["market_value_usd"]) for r in rows] == [
        ("948596101", 9e6, 78_750_000.0), ("98422D105", 33_537_232.0, 573_822_000.0)]


def test_json_report(spark):
    payload = json.dumps({"periodOfReport": "2024-03-31", "filedAt": "2024-05-14T10:00:00", "accessionNo": "x", "cik": "1", "holdings": [
        {"nameOfIssuer": "Weibo", "cusip": "948596101", "value": 100, "shrsOrPrnAmt": {"sshPrnamt": 10, "sshPrnamtType": "SH"}},
        {"nameOfIssuer": "Opt", "putCall": "Call", "value": 1, "shrsOrPrnAmt": {"sshPrnamt": 1}},
        {"nameOfIssuer": "Bond", "value": 1, "shrsOrPrnAmt": {"sshPrnamt": 1, "sshPrnamtType": "PRN"}},
        {"nameOfIssuer": "Zero", "ticker": "zz", "value": 0, "shrsOrPrnAmt": {"sshPrnamt": 5, "sshPrnamtType": "SH"}}]})
    flat = filings.flatten_13f_json(filings.parse_13f_json(spark.createDataFrame([("P", payload)], "parent_ticker string, payload string")))
    dims = filings.load_dims(spark)
    rows = collect(identity.resolve_identity(flat, dims["cusips"], dims["aliases"], dims["hints"]), "investee_name")
    assert [(r["investee_ticker"], r["market_value_usd"]) for r in rows] == [("WB", 100.0), ("ZZ", None)]
    assert rows[0]["period_end"] == day("2024-03-31")


def test_identity_order(spark):
    dims = filings.load_dims(
        spark, aliases=spark.createDataFrame([("tuya", "TUYA", 0), ("bilibili inc", "BILI", 1), ("moonshot", None, 2)], "alias string, ticker string, alias_order int"))
    names = [("Tuya Inc.", None, None), ("Bilibili", None, None), ("x", None, "98422d105"), ("Neutron Holdings, Inc", None, None),
             ("y", "brk.b", None), ("Under the Securities Exchange Act of 1934 MOGU Inc.", None, None), ("Nobody", None, None)]
    df = spark.createDataFrame(names, "investee_name string, investee_ticker string, cusip string")
    got = sorted((r["investee_name"], r["investee_ticker"]) for r in collect(identity.resolve_identity(
        df, dims["cusips"], dims["aliases"], dims["hints"])) if r["investee_ticker"])
    assert got == sorted([("Tuya Inc.", "TUYA"), ("Bilibili", "BILI"), ("x", "XPEV"), ("Neutron Holdings, Inc", "PRIV_NEUTRON_HOLDINGS_INC"),
                          ("y", "BRK-B"), ("MOGU Inc.", "MOGU")])


def test_self_issuer(spark):
    dims = filings.load_dims(spark)
    df = spark.createDataFrame([("UBER", "Uber Technologies Inc", None), ("BABA", "Alibaba Group", None), ("UBER", "Didi", None), ("UBER", "x", "uber")],
                               "parent_ticker string, investee_name string, investee_ticker string")
    assert [r["investee_name"] for r in collect(identity.drop_self_issuer(df, dims["parent_hints"]))] == ["Didi"]


def test_parents(spark):
    dims = filings.load_dims(spark)
    df = spark.createDataFrame([("tencent",), ("0700.HK",), ("Berkshire Hathaway",), ("brk.b",), ("msft",), ("alibaba group holdings",), (" ",)], "parent string")
    got = {r["parent"]: r["parent_ticker"] for r in collect(filings.normalize_parent(df, dims["parents"]))}
    assert got == {"tencent": "TCEHY", "0700.HK": "TCEHY", "Berkshire Hathaway": "BRK-B", "brk.b": "BRK-B", "msft": "MSFT",
                   "alibaba group holdings": "BABA", " ": None}


def test_fundamentals_shapes(spark):
    rec = {"2024-03-31": {"date": "2024-03-31", "filing_date": "2024-05-01", "totalStockholderEquity": "100", "commonStockSharesOutstanding": "10", "netIncome": "None"}}
    shapes = [{"Financials::Balance_Sheet::quarterly": rec}, {"Financials": {"Balance_Sheet": {"quarterly": rec}}}, rec]
    raw = spark.createDataFrame([(f"T{i}", json.dumps(s)) for i, s in enumerate(shapes)], "ticker string, payload string")
    rows = collect(filings.flatten_fundamentals(raw, "Balance_Sheet"), "ticker")
    assert [(r["ticker"], r["equity"], r["shares"], r["net_income"], str(r["filed"])) for r in rows] == [
        (f"T{i}", 100.0, 10.0, None, "2024-05-01") for i in range(3)]
    assert [r["bvps"] for r in collect(filings.book_per_share_series(filings.flatten_fundamentals(raw, "Balance_Sheet")))] == [10.0] * 3


def test_company_facts_nearest_shares(spark):
    fact = lambda end, filed, val: {"end": end, "filed": filed, "val": val}
    payload = json.dumps({"facts": {
        "us-gaap": {"StockholdersEquity": {"units": {"USD": [fact("2024-03-31", "2024-05-01", 100), fact("2020-03-31", "2020-05-01", 50), {"filed": "x"}]}},
                    "ProfitLoss": {"units": {"USD": [fact("2024-03-31", "2024-05-01", -3)]}}},
        "dei": {"EntityCommonStockSharesOutstanding": {"units": {"shares": [fact("2024-04-20", "2024-05-01", 10)]}}}}})
    raw = spark.createDataFrame([("T", payload)], "ticker string, payload string")
    assert [(str(r["filed"]), r["bvps"]) for r in collect(filings.book_series_from_facts(raw))] == [("2024-05-01", 10.0)]
    assert [r["net_income"] for r in collect(filings.earnings_series_from_facts(raw))] == [-3.0]


def test_catalog(spark):
    series = spark.createDataFrame([("s1", "TCEHY", "CMB", "p", "{broker} report {as_of}", [
        {"id": "r1", "as_of": "2024-01-01", "url": "u", "parser": None, "enabled": None, "citation": None},
        {"id": "r2", "as_of": "2025-01-01", "url": "u", "parser": "q", "enabled": True, "citation": "own"},
        {"id": "r3", "as_of": None, "url": None, "parser": None, "enabled": False, "citation": None}])],
        "series_id string, parent_ticker string, broker string, parser string, citation_template string, "
        "reports array<struct<id:string,as_of:string,url:string,parser:string,enabled:boolean,citation:string>>")
    cat = filings.flatten_catalog(series)
    assert [(r["id"], r["parser"], r["citation"]) for r in collect(cat, "id")] == [("r1", "p", "CMB report 2024-01-01"), ("r2", "q", "own")]
    assert {r["id"] for r in collect(filings.expand_series(cat.where("id = 'r1'"), cat))} == {"r1", "r2"}


def test_exchange_tickers(spark):
    raw = ["780 HK", "259960 KS", "9468 JP", "002602 CH", "600000 CH", "PDD US", "JD"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string")
    assert [r.x for r in df.orderBy("i").select(txt.exchange_ticker("t").alias("x")).collect()] == [
        "0780.HK", "259960.KS", "9468.T", "002602.SZ", "600000.SS", "PDD", "JD"]


def test_dates(spark):
    df = spark.createDataFrame([(day("2024-02-29"),)], "d date")
    r = df.select(dates.lookback_start("d", 1).alias("a"), dates.lookback_start("d", 0).alias("b"), dates.filed_quarter_end("d").alias("c"),
                  dates.quarter_end_on_or_before(F.to_date(F.lit("2024-03-31"))).alias("q")).collect()[0]
    assert (r.a, r.b, r.c, r.q) == (day("2023-02-28"), day("2000-01-01"), day("2023-12-31"), day("2024-03-31"))


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    path = str(tmp_path / "t")
    tables.replace_by_key(df, path, "k")
    tables.replace_by_key(spark.createDataFrame([("b", 9)], "k string, v int"), path, "k")
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 9)}
    got = tables.upsert(df, spark.createDataFrame([("b", 5), ("c", 6), ("c", 7)], "k string, v int"), ["k"], ["v"])
    assert {(r.k, r.v) for r in got.collect()} == {("a", 1), ("b", 5), ("c", 7)}
    assert evolve(df, {"x": "double", "v": "int"}).columns == ["k", "v", "x"]
    assert conform(df.withColumnRenamed("k", "ticker"), MEMBERSHIP_SCHEMA).columns == MEMBERSHIP_SCHEMA.fieldNames()
    assert tables.read_or_empty(spark, "no_such_table", MEMBERSHIP_SCHEMA).count() == 0


def test_jsonl_last_write_wins(spark, tmp_path):
    (tmp_path / "w1.jsonl").write_text('{"ticker":"A","snapshot_date":"2024-01-01T00:00"}\n{"ticker":"B","index_name":"x"}\n')
    (tmp_path / "w2.jsonl").write_text('{"ticker":"A","index_name":"new","snapshot_date":"2024-02-01"}\n')
    got = {r["ticker"]: r for r in collect(tables.read_jsonl_latest(
        spark, [str(tmp_path / "w1.jsonl"), str(tmp_path / "w2.jsonl")], MEMBERSHIP_SCHEMA, ["ticker"], ["snapshot_date"]))}
    assert got["A"]["index_name"] == "new" and got["A"]["snapshot_date"] == day("2024-02-01") and got["B"]["snapshot_date"] is None


def test_universe_and_changes(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("Ticker,Name\nBRK.B,x\n-,y\n,z\nAAPL,w\n")
    assert [r["ticker"] for r in collect(listings.read_universe_csv(spark, str(path), "idx"), "ticker")] == ["AAPL", "BRK-B"]
    wide = spark.createDataFrame([("June 30, 2024", "AA", "Aa", "BB", "Bb", "why")],
                                 "date string, added_ticker string, added_security string, removed_ticker string, removed_security string, reason string")
    sides = {r["side"]: r for r in collect(listings.membership_sides(wide))}
    assert sides["added"]["ticker"] == "AA" and sides["removed"]["reconstitution_date"] == day("2024-06-30")


def test_dropouts(spark):
    rows = [("A", "i", day("2024-01-01")), ("B", "i", day("2024-01-01")), ("B", "i", day("2024-02-15"))]
    df = spark.createDataFrame(rows, "ticker string, index_name string, snapshot_date date")
    assert [(r["ticker"], str(r["last_seen_date"])) for r in collect(screening.index_dropouts(df, 30))] == [("A", "2024-01-01")]
    assert collect(screening.index_dropouts(df, 300)) == []


def test_forced_cap(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate("DACBADE")], "k string, i int")
    keep = lambda n, f: {r["k"] for r in collect(screening.cap_with_forced(df, "k", n, f, ["i"]))}
    assert keep(2, ["E"]) == {"E", "D"} and keep(1, ["E", "B"]) == {"E", "B"} and keep(3, ["Z"]) == {"D", "A", "C"}


def test_insider_lines(spark):
    payload = json.dumps({"filedAt": "2024-05-01", "reportingOwner": {"cik": "7", "relationship": {"isOfficer": True}}, "nonDerivativeTable": {
        "holdings": [{"securityTitle": "Common Stock", "postTransactionAmounts": {"sharesOwnedFollowingTransaction": 5}},
                     {"securityTitle": "Class B common", "postTransactionAmounts": {"sharesOwnedFollowingTransaction": 100}},
                     {"securityTitle": "Preferred", "postTransactionAmounts": {"sharesOwnedFollowingTransaction": 1000}}],
        "transactions": [{"securityTitle": "Common Stock", "transactionDate": "2024-04-02", "postTransactionAmounts": {"sharesOwnedFollowingTransaction": 8}},
                         {"securityTitle": "Common Stock", "transactionDate": "2024-04-01", "postTransactionAmounts": {"sharesOwnedFollowingTransaction": 9}}]}})
    lines = filings.flatten_insider_forms(spark.createDataFrame([("T", payload)], "ticker string, payload string"))
    per = ownership.insider_filing_shares(lines)
    assert [r["shares"] for r in collect(per)] == [108.0]
    keys = spark.createDataFrame([("T", day("2024-06-01")), ("T", day("2024-04-01")), ("T", day("2028-01-01"))], "ticker string, as_of date")
    got = {str(r["as_of"]): (r["insider_shares"], r["insider_owner_count"]) for r in collect(ownership.insider_shares(per, keys))}
    assert got == {"2024-06-01": (108.0, 1), "2024-04-01": (None, 0), "2028-01-01": (None, 0)}


def test_pending_run(spark):
    schema = "ticker string, v int"
    spark.sql("DROP TABLE IF EXISTS pl_done")
    from pyspark.sql import types as T
    st = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("v", T.IntegerType())])
    keys = spark.createDataFrame([("A",), ("B",)], "ticker string")
    first = incremental.run_pending(spark, keys.where("ticker = 'A'"), "pl_done", st, ["ticker"], lambda k: k.withColumn("v", F.lit(1)))
    assert first.count() == 1 and schema
    again = incremental.run_pending(spark, keys, "pl_done", st, ["ticker"], lambda k: k.withColumn("v", F.lit(2)))
    assert {(r.ticker, r.v) for r in again.collect()} == {("A", 1), ("B", 2)}
    spark.sql("DROP TABLE pl_done")


def test_staging_needs_the_shared_folder():
    from posledger.sources.tables import shared_folder

    class Unset:
        def get(self, key, default=None):
            return default

        def getConf(self):
            return self

    class Session:
        conf = sparkContext = Unset()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).selectExpr("id AS k", "id * 2 AS v")
    tables.write_buckets(rows, path, ["k"], 16)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    updates = spark.createDataFrame([(3, -1), (3, -2), (1000, 7)], "k long, v long")
    tables.upsert_buckets(spark, path, updates, ["k"], 16, ["v"])
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {i: 2 * i for i in range(200)} | {3: -1, 1000: 7}
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert len({p.parent for p in after if after[p] != before.get(p)}) <= 2
    tables.upsert_buckets(spark, path, updates, ["k"], 16, ["v"])
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == got
    tables.upsert_buckets(spark, path, updates.where("false"), ["k"], 16)
    assert spark.read.parquet(path).count() == 201


def test_a_run_that_died_is_not_read_and_can_be_repeated(spark, tmp_path):
    folder = str(tmp_path / "log")
    schema = T.StructType().add("k", "long").add("v", "string")
    keys = spark.range(6).withColumnRenamed("id", "k")
    work = lambda name: lambda todo: todo.withColumn("v", F.lit(name))
    assert incremental.finished_rows(spark, folder, schema).count() == 0

    def dies(todo):
        todo.withColumn("v", F.lit("half")).limit(2).write.mode("overwrite").parquet(f"{folder}/rows/run=a")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        incremental.run_once(spark, keys, folder, schema, ["k"], "a", dies)
    assert incremental.finished_rows(spark, folder, schema).count() == 0
    rows = incremental.run_once(spark, keys.where("k < 4"), folder, schema, ["k"], "a", work("a")).collect()
    assert sorted((r.k, r.v) for r in rows) == [(i, "a") for i in range(4)]
    incremental.run_once(spark, keys, folder, schema, ["k"], "a", work("again"))
    rows = incremental.run_once(spark, keys, folder, schema, ["k"], "b", work("b")).collect()
    assert sorted((r.k, r.v) for r in rows) == [(i, "a") for i in range(4)] + [(4, "b"), (5, "b")]
