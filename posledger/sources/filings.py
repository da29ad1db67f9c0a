"""Flatteners for landed payloads: fundamentals, facts, quarterly reports, ownership forms, catalogs.

Payloads arrive as one text column per row. They are parsed with explicit schemas, so only the
declared fields are materialised. Arrays are exploded with the outer form and filtered afterwards:
the plain form makes the optimizer repeat the parse in a pushed-down filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from posledger.functions.dates import iso_date
from posledger.functions.numbers import digits_number, divide, to_number
from posledger.operators.asof import asof_join
from posledger.operators.ownership import is_share_position
from posledger.schemas import INCOME_SCHEMA, conform
from posledger.sources import fixed_values as fixed

# -- fundamentals --------------------------------------------------------------------------------

# Fields read from quarterly statements (numbers may arrive as text).
STATEMENT_FIELDS = (
    "date", "filing_date", "totalStockholderEquity", "commonStockSharesOutstanding", "netIncome",
    "salePurchaseOfStock", "issuanceOfCapitalStock", "treasuryStock",
)
_RECORD = "struct<" + ",".join(f"{name}:string" for name in STATEMENT_FIELDS) + ">"


def flatten_fundamentals(raw: DataFrame, statement: str, key: str = "ticker",
                         payload: str = "payload") -> DataFrame:
    """Quarterly records of one statement from any of the three payload shapes.

    The shapes are a flat filter key, nested sections, and a bare map of dates.
    """
    flat_key = f"Financials::{statement}::quarterly"
    text = F.col(payload)
    flat = F.from_json(text, f"map<string,map<string,{_RECORD}>>")[flat_key]
    nested = F.from_json(
        text, f"Financials struct<{statement}:struct<quarterly:map<string,{_RECORD}>>>"
    )[f"Financials"][statement]["quarterly"]
    section = F.from_json(text, f"{statement} struct<quarterly:map<string,{_RECORD}>>")[statement]["quarterly"]
    quarterly = F.from_json(text, f"quarterly map<string,{_RECORD}>")["quarterly"]
    bare = F.from_json(text, f"map<string,{_RECORD}>")

    def useful(records: Column) -> Column:
        known = F.exists(F.map_values(records), lambda r: F.coalesce(
            r["date"], r["filing_date"], r["totalStockholderEquity"], r["netIncome"]).isNotNull())
        return F.when(known, records)

    records = F.coalesce(*[useful(m) for m in (flat, nested, section, quarterly, bare)])
    rows = raw.select(key, F.explode_outer(F.map_values(records)).alias("r")).where(F.col("r").isNotNull())
    period = iso_date("r.date")
    return rows.select(
        key, period.alias("period_end"), F.coalesce(iso_date("r.filing_date"), period).alias("filed"),
        to_number("r.totalStockholderEquity").alias("equity"),
        to_number("r.commonStockSharesOutstanding").alias("shares"),
        to_number("r.netIncome").alias("net_income"),
        to_number("r.salePurchaseOfStock").alias("sale_purchase"),
        to_number("r.issuanceOfCapitalStock").alias("issuance"),
        to_number("r.treasuryStock").alias("treasury_stock"))


def book_per_share_series(statements: DataFrame, key: str = "ticker") -> DataFrame:
    """Book value per share by filing date; the last record of a date wins."""
    ok = statements.where(F.col("filed").isNotNull() & F.col("equity").isNotNull() & (F.col("shares") > 0))
    order = F.struct("period_end", "equity", "shares")
    return ok.groupBy(key, "filed").agg(
        F.max(order).alias("r")).select(
        key, "filed", divide("r.equity", "r.shares").alias("bvps"), F.col("r.shares").alias("shares"))


def income_series(statements: DataFrame, key: str = "ticker") -> DataFrame:
    ok = statements.where(F.col("filed").isNotNull() & F.col("net_income").isNotNull())
    return ok.groupBy(key, "filed").agg(F.max(F.struct("period_end", "net_income")).alias("r")).select(
        key, "filed", F.col("r.net_income").alias("net_income"))


# -- company facts -------------------------------------------------------------------------------

# Tags tried in order, with taxonomy and unit.
EQUITY_TAGS = (
    ("us-gaap", "StockholdersEquity"),
    ("us-gaap", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"),
)
SHARES_TAGS = (
    ("dei", "EntityCommonStockSharesOutstanding"), ("us-gaap", "CommonStockSharesOutstanding"),
)
EARNINGS_TAGS = (("us-gaap", "NetIncomeLoss"), ("us-gaap", "ProfitLoss"))
_FACTS = ("facts map<string,map<string,struct<units:map<string,array<struct<"
          "end:string,filed:string,val:string>>>>>>")


def flatten_facts(raw: DataFrame, tags: Sequence[tuple[str, str]], unit: str, key: str = "ticker",
                  payload: str = "payload") -> DataFrame:
    """Facts of the first tag in the list that has any complete row, per key."""
    facts = F.from_json(F.col(payload), _FACTS)["facts"]
    options = F.array(*[
        F.struct(F.lit(i).alias("rank"), F.lit(f"{taxonomy}:{tag}").alias("tag"),
                 F.transform(F.coalesce(
                     facts[taxonomy][tag]["units"][unit],
                     F.array().cast("array<struct<end:string,filed:string,val:string>>")),
                     lambda x: F.struct(
                         iso_date(x["end"]).alias("end"), iso_date(x["filed"]).alias("filed"),
                         to_number(x["val"]).alias("val"))).alias("rows"))
        for i, (taxonomy, tag) in enumerate(tags)])
    complete = F.transform(options, lambda o: F.struct(
        o["tag"].alias("tag"), F.filter(o["rows"], lambda r: r["end"].isNotNull()
                                        & r["filed"].isNotNull() & r["val"].isNotNull()).alias("rows")))
    chosen = F.filter(complete, lambda o: F.size(o["rows"]) > 0)
    first = raw.select(key, F.get(chosen, F.lit(0)).alias("c"))
    return first.select(key, F.col("c.tag").alias("tag"), F.posexplode_outer("c.rows").alias("pos", "r")).where(
        F.col("r").isNotNull()).select(key, "tag", "pos", "r.end", "r.filed", "r.val")


def book_series_from_facts(raw: DataFrame, key: str = "ticker", payload: str = "payload",
                           tolerance_days: int = 100) -> DataFrame:
    """Book per share: equity matched to the nearest share count by period end."""
    def last_per_end(df, name):
        return df.groupBy(key, "end").agg(F.max(F.struct("filed", "pos", "val", "tag")).alias("r")).select(
            key, "end", F.col("r.filed").alias("filed"), F.col("r.val").alias(name), F.col("r.tag").alias(f"{name}_tag"))

    equity = last_per_end(flatten_facts(raw, EQUITY_TAGS, "USD", key, payload), "equity")
    shares = last_per_end(flatten_facts(raw, SHARES_TAGS, "shares", key, payload), "shares").select(
        key, F.col("end").alias("shares_end"), "shares")
    near = asof_join(equity, shares, key, "end", "shares_end", "nearest", tolerance_days=tolerance_days)
    ok = near.where(F.col("shares") > 0)
    return ok.groupBy(key, "filed").agg(F.max(F.struct("end", "equity", "shares")).alias("r")).select(
        key, "filed", (F.col("r.equity") / F.col("r.shares")).alias("bvps"))


def earnings_series_from_facts(raw: DataFrame, key: str = "ticker", payload: str = "payload") -> DataFrame:
    facts = flatten_facts(raw, EARNINGS_TAGS, "USD", key, payload)
    per_end = facts.groupBy(key, "end").agg(F.max(F.struct("filed", "pos", "val")).alias("r")).select(
        key, "end", "r.filed", "r.val")
    return per_end.groupBy(key, "filed").agg(F.max(F.struct("end", "val")).alias("r")).select(
        key, "filed", F.col("r.val").alias("net_income"))


# -- quarterly holdings reports ------------------------------------------------------------------

_INFO_TABLE = (
    "infoTable array<struct<nameOfIssuer:string,titleOfClass:string,cusip:string,value:string,"
    "putCall:string,shrsOrPrnAmt:struct<sshPrnamt:string,sshPrnamtType:string>>>")


def flatten_13f_xml(raw: DataFrame, body: str = "body") -> DataFrame:
    """One row per reported security of an information table, options left out.

    Amounts are either dollars or thousands: a price between 0.5 and 5000 per share means dollars.
    """
    # Namespace prefixes differ between filers; element names do not.
    plain = F.regexp_replace(F.col(body), r"(</?)[A-Za-z0-9_.-]+:", "$1")
    rows = F.from_xml(plain, _INFO_TABLE, {"mode": "PERMISSIVE"})["infoTable"]
    keep = [c for c in raw.columns if c != body]
    flat = raw.select(*keep, F.explode_outer(rows).alias("h"))
    put_call = F.upper(F.trim(F.coalesce("h.putCall", F.lit(""))))
    name = F.trim(F.col("h.nameOfIssuer"))
    shares = F.nullif(digits_number("h.shrsOrPrnAmt.sshPrnamt"), F.lit(0.0))
    amount = digits_number("h.value")
    per_share = amount / shares
    dollars = per_share.between(0.5, 5000)
    value = F.when(amount > 0, F.when(F.coalesce(dollars, F.lit(False)), amount).otherwise(amount * 1000.0))
    return flat.where(~put_call.isin("PUT", "CALL") & (name != "")).select(
        *keep, name.alias("investee_name"), F.upper(F.trim("h.cusip")).alias("cusip"),
        F.trim("h.titleOfClass").alias("title"), shares.alias("shares_held"),
        value.alias("market_value_usd"), (value / shares).alias("market_price"))


_HOLDING = ("struct<nameOfIssuer:string,titleOfClass:string,cusip:string,ticker:string,putCall:string,"
            "value:string,shrsOrPrnAmt:struct<sshPrnamt:string,sshPrnamtType:string>>")
_REPORT = (f"formType string, periodOfReport string, filedAt string, accessionNo string, cik string, "
           f"holdings array<{_HOLDING}>")


def parse_13f_json(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Report headers with their holdings array."""
    keep = [c for c in raw.columns if c != payload]
    p = raw.select(*keep, F.from_json(F.col(payload), _REPORT).alias("p"))
    filed = iso_date("p.filedAt")
    return p.select(
        *keep, F.coalesce(iso_date("p.periodOfReport"), filed).alias("period_end"),
        filed.alias("filing_date"), F.col("p.accessionNo").alias("accession_no"),
        F.col("p.cik").alias("cik"), F.col("p.holdings").alias("holdings"))


def flatten_13f_json(reports: DataFrame) -> DataFrame:
    """One row per share position; values are dollars, non-positive values are unknown."""
    keep = [c for c in reports.columns if c != "holdings"]
    flat = reports.select(*keep, F.explode_outer("holdings").alias("h"))
    name = F.trim(F.coalesce("h.nameOfIssuer", F.lit("")))
    put_call = F.upper(F.trim(F.coalesce("h.putCall", F.lit(""))))
    plain = is_share_position(
        F.col("h.titleOfClass"), F.when(put_call.isin("PUT", "CALL"), put_call),
        F.col("h.shrsOrPrnAmt.sshPrnamtType"))
    shares = F.nullif(to_number("h.shrsOrPrnAmt.sshPrnamt"), F.lit(0.0))
    amount = to_number("h.value")
    value = F.when(amount > 0, amount)
    ticker = F.nullif(F.upper(F.trim("h.ticker")), F.lit(""))
    cusip = F.nullif(F.upper(F.trim("h.cusip")), F.lit(""))
    note = F.concat(F.lit("source=sec_api_13f cusip="), F.coalesce(cusip, F.lit("None")), F.lit(" class="),
                    F.coalesce("h.titleOfClass", F.lit("None")))
    return flat.where(plain & (name != "")).select(
        *keep, name.alias("investee_name"), ticker.alias("investee_ticker"), cusip.alias("cusip"),
        shares.alias("shares_held"), value.alias("market_value_usd"),
        F.when(shares > 0, value / shares).alias("market_price"),
        value.alias("fair_value_disclosed_usd"), F.col("filing_date").alias("as_of_date"),
        F.col("accession_no").alias("as_of_accession_no"), F.lit("sec_api_13f").alias("source"),
        note.alias("note"), F.lit(True).alias("fair_value_through_earnings"),
        F.lit("fv_ni").alias("filing_gaap_hint"))


# -- insider forms -------------------------------------------------------------------------------

_AMOUNT = "postTransactionAmounts:struct<sharesOwnedFollowingTransaction:string>"
_FORM = (
    "filedAt string, reportingOwner struct<cik:string,name:string,relationship:struct<"
    "isOfficer:boolean,isDirector:boolean>>, nonDerivativeTable struct<"
    f"holdings:array<struct<securityTitle:string,{_AMOUNT}>>,"
    f"transactions:array<struct<securityTitle:string,transactionDate:string,{_AMOUNT}>>>")


def flatten_insider_forms(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Holdings and transactions of officers and directors, one row per line of the form."""
    keep = [c for c in raw.columns if c != payload]
    p = raw.select(*keep, F.from_json(F.col(payload), _FORM).alias("p"))
    rel = F.col("p.reportingOwner.relationship")
    insider = F.coalesce(rel["isOfficer"], F.lit(False)) | F.coalesce(rel["isDirector"], F.lit(False))
    owner = F.coalesce(F.nullif(F.trim("p.reportingOwner.cik"), F.lit("")),
                       F.nullif(F.trim("p.reportingOwner.name"), F.lit("")))
    head = p.where(insider & owner.isNotNull() & iso_date("p.filedAt").isNotNull()).select(
        *keep, owner.alias("owner"), iso_date("p.filedAt").alias("filing_date"),
        F.col("p.nonDerivativeTable").alias("t"))

    def lines(array: Column, kind: int, day):
        return F.transform(F.coalesce(array, F.array().cast(
            "array<struct<securityTitle:string," + ("transactionDate:string," if kind else "") + _AMOUNT + ">>")),
            lambda x, i: F.struct(
                x["securityTitle"].alias("title"),
                to_number(x["postTransactionAmounts"]["sharesOwnedFollowingTransaction"]).alias("shares"),
                F.lit(kind).alias("kind"), day(x).alias("day"), i.alias("pos")))

    both = F.concat(
        lines(F.col("t.holdings"), 0, lambda x: F.lit("")),
        lines(F.col("t.transactions"), 1, lambda x: F.coalesce(x["transactionDate"], F.lit(""))))
    return head.select(*keep, "owner", "filing_date", F.inline_outer(both))


# -- dimensions, catalogs, curated tables --------------------------------------------------------

def load_dims(spark: SparkSession, cusips: DataFrame | None = None, aliases: DataFrame | None = None,
              hints: DataFrame | None = None) -> dict[str, DataFrame]:
    """Identity tables: built-in rows overridden by the given tables.

    An alias without ticker means "known, but no symbol" and is skipped.
    """
    built_in = spark.createDataFrame(list(fixed.CUSIP_TICKERS), "cusip string, ticker string")
    if cusips is not None:
        extra = cusips.where(F.col("cusip").isNotNull() & F.col("ticker").isNotNull()).select(
            F.upper(F.trim("cusip")).alias("cusip"), F.upper(F.trim("ticker")).alias("ticker"))
        built_in = built_in.join(extra, "cusip", "left_anti").unionByName(extra)
    empty = spark.createDataFrame([], "alias string, ticker string, alias_order long")
    alias_rows = empty if aliases is None else aliases.where(F.col("ticker").isNotNull()).select(
        F.lower(F.trim("alias")).alias("alias"), F.upper(F.trim("ticker")).alias("ticker"),
        F.col("alias_order").cast("long").alias("alias_order"))
    hint_rows = hints if hints is not None else spark.createDataFrame(
        [(a, t, i) for i, (a, t) in enumerate(fixed.ISSUER_HINTS)],
        "alias string, ticker string, alias_order long")
    parents = spark.createDataFrame(list(fixed.PARENT_ALIASES), "alias string, parent_ticker string")
    ciks = spark.createDataFrame(list(fixed.PARENT_CIKS), "parent_ticker string, cik string")
    own = spark.createDataFrame(list(fixed.PARENT_NAME_HINTS), "parent_ticker string, hint string")
    return {"cusips": built_in, "aliases": alias_rows, "hints": hint_rows, "parents": parents,
            "ciks": ciks, "parent_hints": own}


def normalize_parent(df: DataFrame, parents: DataFrame, name: str = "parent",
                     result: str = "parent_ticker") -> DataFrame:
    """Company name or nickname to the canonical parent ticker; a blank name gives NULL."""
    text = F.trim(F.col(name))
    key = F.translate(F.lower(text), "_", " ")
    short = F.trim(F.regexp_replace(key, " holdings", ""))
    ticker = F.translate(F.upper(text), ".", "-")
    canonical = (
        F.when(ticker.isin("BRK-B", "BRKB"), F.lit("BRK-B"))
        .when(ticker.isin(*fixed.AGGREGATE_PARENTS, "0700"), F.lit("TCEHY")).otherwise(ticker))
    a = parents.select(F.col("alias").alias("_k1"), F.col("parent_ticker").alias("_p1"))
    b = parents.select(F.col("alias").alias("_k2"), F.col("parent_ticker").alias("_p2"))
    joined = df.withColumns({"_k1": key, "_k2": short}).join(a, "_k1", "left").join(b, "_k2", "left")
    return joined.withColumn(result, F.when(text != "", F.coalesce("_p1", "_p2", canonical))).select(
        *df.columns, *([result] if result not in df.columns else []))


def history_strategy(parent: str) -> Column:
    return F.when(F.col(parent).isin(*fixed.AGGREGATE_PARENTS), F.lit("fanout_13g_hk")).otherwise(
        F.lit("fanout_13f_13g_notes"))


def flatten_catalog(series: DataFrame) -> DataFrame:
    """One row per enabled report of a source series; reports inherit the series fields.

    ``series``: series_id, parent_ticker, broker, parser, citation_template, reports array of
    (id, as_of, url, parser, enabled, citation).
    """
    flat = series.select(
        "series_id", "parent_ticker", "broker", F.col("parser").alias("_parser"), "citation_template",
        F.explode("reports").alias("r")).where(F.coalesce("r.enabled", F.lit(True)))
    cite = F.replace(F.replace(
        F.coalesce("citation_template", F.lit("{broker} {as_of}")), F.lit("{broker}"), F.coalesce("broker", F.lit(""))),
        F.lit("{as_of}"), F.coalesce(F.col("r.as_of").cast("string"), F.lit("")))
    return flat.select(
        F.col("r.id").alias("id"), "series_id", "parent_ticker", "broker", F.col("r.as_of").alias("as_of"),
        F.col("r.url").alias("source_url"), F.coalesce("r.parser", "_parser").alias("parser"),
        F.coalesce(F.col("r.citation"), cite).alias("citation"))


def expand_series(hits: DataFrame, catalog: DataFrame) -> DataFrame:
    """Hits plus every report that shares a series with one of them."""
    mates = catalog.join(hits.select("series_id").distinct(), "series_id", "left_semi")
    alone = hits.where(F.col("series_id").isNull()).select(*catalog.columns)
    return mates.unionByName(alone).dropDuplicates(["id"])


def read_reported_income(rows: DataFrame, parent: str | None = None) -> DataFrame:
    """Curated income periods: amounts in millions become dollars; an unknown parent is empty."""
    base = rows if parent is None else rows.where(F.upper("parent_ticker") == parent.upper())
    scaled = base.withColumn("amount_usd", F.col("amount_usd_million").cast("double") * 1e6)
    named = scaled.withColumn("line_item", F.coalesce(
        F.col("line_item") if "line_item" in base.columns else F.lit(None).cast("string"),
        F.lit("Interest and investment income, net")))
    noted = named.withColumn("note", F.coalesce(
        F.col("note") if "note" in base.columns else F.lit(None).cast("string"),
        F.lit(fixed.NOTE_RECONCILIATION)))
    return conform(noted, INCOME_SCHEMA)
