"""Text, payload, scalar and summary queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from posledger.bindings.market import _CROSS, _OUTCOME, _crossings, _outcomes
from posledger.bindings.registry import query
from posledger.bindings.views import (
    ADDITIONS, additions, book_series, deletions, earnings_series, msum, prices, qend, table,
)
from posledger.functions import dates, numbers as num, text as txt
from posledger.functions.dates import quarter_end, quarter_end_on_or_before
from posledger.operators import ownership, text
from posledger.plans import holdings, summaries
from posledger.schemas import HOLDINGS_SCHEMA, conform
from posledger.sources import filings
from posledger.sources.tables import stage

# -- text ----------------------------------------------------------------------------------------

_STRIP = """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  html, '<script[^>]*>.*?</script>', ' ', 'gis'), '<style[^>]*>.*?</style>', ' ', 'gis'), '<br\\s*/?>', chr(10), 'gi'), '</p>', chr(10), 'gi'),
  '<[^>]+>', ' ', 'g'), '&nbsp;', ' ', 'g'), '&#\\d+;', ' ', 'g'), '\\s+', ' ', 'g'))"""


@query("strip_html", f"SELECT page_id, {_STRIP} AS plain FROM pages")
def strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_html("html").alias("plain"))


@query("strip_tag_runs", r"""SELECT doc_id, regexp_replace(regexp_replace(text, '(?:[A-Za-z0-9:._-]*tion\s+){2,}', ' ', 'g'),
  '\s{3,}', chr(10), 'g') AS plain FROM documents""")
def strip_tag_runs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.strip_tag_runs("text", "tion", 2).alias("plain"))


_NUMBER = "[0-9]{3,}"


@query("match_spans", f"""WITH d AS (SELECT doc_id, regexp_split_to_array(text, '{_NUMBER}') AS gaps,
  regexp_extract_all(text, '{_NUMBER}') AS hits FROM documents),
u AS (SELECT doc_id, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM d)
SELECT doc_id, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS lo,
       length(hits[i]) AS size FROM u""")
def match_spans(spark, sf_dir):
    spans = F.explode_outer(text.match_spans("text", _NUMBER)).alias("s")
    return table(spark, sf_dir, "documents").select("doc_id", spans).where("s is not null").select(
        "doc_id", F.col("s.lo").cast("long").alias("lo"), (F.col("s.hi") - F.col("s.lo")).cast("long").alias("size"))


_KEYS, _PRIORITY, _WIDTH = ("token", "example", "http"), ("token",), 80


def _spans_sql(words) -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, size, unnest(range(1, len(string_split(low, '{w}')))) AS i, string_split(low, '{w}') AS gaps, {len(w)} AS k FROM low"
        for w in words)


def _merged_sql(name: str, words) -> str:
    return f"""{name}_hits AS (SELECT doc_id, size, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + (i - 1) * k AS pos, k FROM ({_spans_sql(words)})),
{name}_spans AS (SELECT doc_id, greatest(0, pos - {_WIDTH}) AS lo, least(size, pos + k + {_WIDTH}) AS hi FROM {name}_hits),
{name}_gaps AS (SELECT *, max(hi) OVER (PARTITION BY doc_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {name}_spans),
{name}_isles AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY lo, hi) AS isle FROM {name}_gaps),
{name} AS (SELECT doc_id, min(lo) AS lo, max(hi) AS hi FROM {name}_isles GROUP BY doc_id, isle)"""


_LOW = "low AS (SELECT doc_id, text, lower(text) AS low, length(text) AS size FROM documents)"


@query("keyword_spans", f"""WITH {_LOW}, {_merged_sql('w', _KEYS)}
SELECT doc_id, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM w""")
def keyword_spans(spark, sf_dir):
    spans = F.explode_outer(text.keyword_spans("text", _KEYS, _WIDTH)).alias("s")
    return table(spark, sf_dir, "documents").select("doc_id", spans).where("s is not null").select(
        "doc_id", F.col("s.lo").cast("long").alias("lo"), F.col("s.hi").cast("long").alias("hi"))


@query("keyword_windows", f"""WITH {_LOW}, {_merged_sql('p', _PRIORITY)}, {_merged_sql('q', [k for k in _KEYS if k not in _PRIORITY])},
kept AS (SELECT doc_id, lo, hi, 0 AS o FROM p
  UNION ALL SELECT q.doc_id, q.lo, q.hi, 1 FROM q WHERE NOT EXISTS (
    SELECT 1 FROM p WHERE p.doc_id = q.doc_id AND q.lo >= p.lo AND q.hi <= p.hi)),
cut AS (SELECT k.doc_id, o, lo, regexp_replace(substring(text, CAST(lo AS BIGINT) + 1, CAST(hi - lo AS BIGINT)), '^\\s+|\\s+$', '', 'g') AS chunk
        FROM kept k JOIN low USING (doc_id)),
joined AS (SELECT doc_id, string_agg(chunk, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY o, lo) AS excerpt FROM cut WHERE chunk <> '' GROUP BY ALL)
SELECT low.doc_id, coalesce(excerpt, regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS excerpt
FROM low LEFT JOIN joined USING (doc_id)""")
def keyword_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.keyword_windows(docs, "text", _KEYS, _PRIORITY, _WIDTH).drop("text")


_SLICE = 40
_SLICES_SQL = f"""lines AS (SELECT o_custkey, o_orderkey, 'Order ' || o_orderkey || ' ' || repeat('of plain goods ', o_orderkey % 9) || CASE
    WHEN o_custkey % 5 > 0 THEN 'We held ' || o_orderkey % 60 || '% of it' WHEN o_orderkey % 3 = 0 THEN 'Equity method investees' ELSE 'nothing' END AS line FROM orders),
t AS (SELECT o_custkey, string_agg(line, ' ' ORDER BY o_orderkey) AS text FROM lines GROUP BY o_custkey),
cut AS (SELECT *, length(text) AS size,
  CASE WHEN o_custkey % 5 > 0 THEN regexp_split_to_array(lower(text), 'we held [0-9]+%') ELSE regexp_split_to_array(lower(text), 'equity method investees') END AS gaps,
  CASE WHEN o_custkey % 5 > 0 THEN regexp_extract_all(lower(text), 'we held [0-9]+%') ELSE regexp_extract_all(lower(text), 'equity method investees') END AS hits FROM t),
each AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut),
at AS (SELECT o_custkey, text, size, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS pos,
  length(hits[i]) AS k FROM each),
spans AS (SELECT o_custkey, text, greatest(0, pos - {_SLICE}) AS lo, least(size, pos + k + {_SLICE}) AS hi FROM "at"),
reaches AS (SELECT *, max(hi) OVER (PARTITION BY o_custkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
isles AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY lo, hi) AS isle FROM reaches),
merged AS (SELECT o_custkey, any_value(text) AS text, min(lo) AS lo, max(hi) AS hi FROM isles GROUP BY o_custkey, isle),
joined AS (SELECT o_custkey, string_agg(substring(text, CAST(lo AS BIGINT) + 1, CAST(hi - lo AS BIGINT)), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY lo) AS slices
           FROM merged GROUP BY o_custkey)"""


@query("ownership_slices", f"WITH {_SLICES_SQL.replace('at AS (', chr(34) + 'at' + chr(34) + ' AS (')} SELECT t.o_custkey, coalesce(slices, '') AS slices FROM t LEFT JOIN joined USING (o_custkey)")
def ownership_slices(spark, sf_dir):
    key, order = F.col("o_custkey"), F.col("o_orderkey")
    told = F.when(key % 5 > 0, F.concat(F.lit("We held "), (order % 60).cast("string"), F.lit("% of it"))).when(
        order % 3 == 0, F.lit("Equity method investees")).otherwise(F.lit("nothing"))
    line = F.concat(F.lit("Order "), order.cast("string"), F.lit(" "), F.expr("repeat('of plain goods ', cast(o_orderkey % 9 as int))"), told)
    texts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))), lambda x: x["line"]), " ").alias("text"))
    return text.ownership_slices(texts, "text", _SLICE).drop("text")


@query("extract_facts", r"""SELECT doc_id, unnest(regexp_extract_all(text, '(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})')) AS fact FROM documents""")
def extract_facts(spark, sf_dir):
    pattern = r"(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})"
    return table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(
        F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("fact")).where("fact is not null")


# -- payloads ------------------------------------------------------------------------------------

@query("json_flatten", """SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events""")
def json_flatten(spark, sf_dir):
    parsed = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", num.to_number(parsed["k"]).alias("k"))


@query("flatten_13f_json", """SELECT l_orderkey, l_linenumber, 'Part ' || l_partkey AS investee_name,
  CASE WHEN l_linenumber % 2 = 0 THEN 'T' || l_suppkey END AS investee_ticker, l_quantity AS shares_held,
  l_extendedprice AS market_value_usd, l_extendedprice / l_quantity AS market_price, CAST(l_shipdate AS DATE) AS filing_date
FROM lineitem WHERE l_returnflag <> 'R'""")
def flatten_13f_json(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    holding = F.struct(
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("nameOfIssuer"), F.lit("COM").alias("titleOfClass"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("t"), F.col("l_suppkey").cast("string"))).alias("ticker"),
        F.when(F.col("l_returnflag") == "R", F.lit("Put")).alias("putCall"),
        F.col("l_extendedprice").alias("value"),
        F.struct(F.col("l_quantity").alias("sshPrnamt"), F.lit("SH").alias("sshPrnamtType")).alias("shrsOrPrnAmt"))
    payload = F.to_json(F.struct(
        F.lit("13F-HR").alias("formType"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("filedAt"), F.array(holding).alias("holdings")))
    raw = line.select("l_orderkey", "l_linenumber", payload.alias("payload"))
    return filings.flatten_13f_json(filings.parse_13f_json(raw)).select(
        "l_orderkey", "l_linenumber", "investee_name", "investee_ticker", "shares_held", "market_value_usd",
        "market_price", "filing_date")


@query("flatten_13f_xml", """WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity AS sh,
  CAST(floor(l_extendedprice) AS BIGINT) / CASE WHEN l_linenumber % 3 = 0 THEN 10000 ELSE 1 END AS v, l_returnflag FROM lineitem),
y AS (SELECT *, CAST(floor(v) AS BIGINT) AS amt FROM x)
SELECT l_orderkey, l_linenumber, sh AS shares_held,
  CASE WHEN amt > 0 THEN CASE WHEN amt / sh BETWEEN 0.5 AND 5000 THEN CAST(amt AS DOUBLE) ELSE amt * 1000.0 END END AS market_value_usd
FROM y WHERE l_returnflag <> 'R'""")
def flatten_13f_xml(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    whole = F.floor("l_extendedprice") / F.when(F.col("l_linenumber") % 3 == 0, 10000).otherwise(1)
    body = F.concat(
        F.lit('<n1:informationTable xmlns:n1="u"><n1:infoTable><n1:nameOfIssuer>Part '), F.col("l_partkey").cast("string"),
        F.lit("</n1:nameOfIssuer><n1:value>"), F.floor(whole).cast("string"), F.lit("</n1:value><n1:putCall>"),
        F.when(F.col("l_returnflag") == "R", F.lit("Put")).otherwise(F.lit("")),
        F.lit("</n1:putCall><n1:shrsOrPrnAmt><n1:sshPrnamt>"), F.col("l_quantity").cast("string"),
        F.lit("</n1:sshPrnamt></n1:shrsOrPrnAmt></n1:infoTable></n1:informationTable>"))
    return filings.flatten_13f_xml(line.select("l_orderkey", "l_linenumber", body.alias("body"))).select(
        "l_orderkey", "l_linenumber", "shares_held", "market_value_usd")


@query("flatten_insider_forms", """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS owner, CAST(o_orderdate AS DATE) AS filing_date,
  o_totalprice AS shares FROM orders WHERE o_orderstatus <> 'P'""")
def flatten_insider_forms(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")

    def amount(value):
        return F.struct(value.alias("sharesOwnedFollowingTransaction"))

    payload = F.to_json(F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("filedAt"),
        F.struct(F.col("o_custkey").cast("string").alias("cik"), F.struct(
            (F.col("o_orderstatus") == "O").alias("isOfficer"), (F.col("o_orderstatus") == "F").alias("isDirector")).alias("relationship")).alias("reportingOwner"),
        F.struct(
            F.array(F.struct(F.lit("Common Stock").alias("securityTitle"), amount(F.lit(1.0)).alias("postTransactionAmounts"))).alias("holdings"),
            F.array(
                F.struct(F.lit("Common Stock").alias("securityTitle"), F.lit("2001-01-01").alias("transactionDate"), amount(F.lit(2.0)).alias("postTransactionAmounts")),
                F.struct(F.lit("Common Stock").alias("securityTitle"), F.lit("2002-01-01").alias("transactionDate"), amount(F.col("o_totalprice")).alias("postTransactionAmounts")),
                F.struct(F.lit("Stock Option").alias("securityTitle"), F.lit("2003-01-01").alias("transactionDate"), amount(F.lit(9.0)).alias("postTransactionAmounts")),
            ).alias("transactions")).alias("nonDerivativeTable")))
    lines = filings.flatten_insider_forms(orders.select("o_orderkey", payload.alias("payload")))
    return ownership.insider_filing_shares(lines)


@query("flatten_fundamentals", f"""WITH q AS (SELECT o_custkey AS ticker, {qend('o_orderdate')} AS period_end,
  max(CAST(o_orderdate AS DATE)) AS filed, count(*) AS n FROM orders GROUP BY ALL)
SELECT ticker, period_end, CASE WHEN n > 1 THEN filed ELSE period_end END AS filed, CAST(n AS DOUBLE) AS shares,
       CASE WHEN n <> 2 THEN n * 10.0 END AS equity FROM q""")
def flatten_fundamentals(spark, sf_dir):
    q = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("ticker"), dates.quarter_end("o_orderdate").alias("period_end")).agg(
        F.max(F.col("o_orderdate").cast("date")).alias("filed"), F.count(F.lit(1)).alias("n"))
    # One record per customer and quarter; the payload shape differs by customer.
    record = F.struct(
        F.col("period_end").cast("string").alias("date"),
        F.when(F.col("n") > 1, F.col("filed").cast("string")).alias("filing_date"),
        F.when(F.col("n") == 2, F.lit("None")).otherwise((F.col("n") * 10).cast("string")).alias("totalStockholderEquity"),
        F.col("n").cast("string").alias("commonStockSharesOutstanding"))
    records = F.create_map(F.col("period_end").cast("string"), record)
    flat = F.to_json(F.create_map(F.lit("Financials::Balance_Sheet::quarterly"), records))
    nested = F.to_json(F.struct(F.struct(F.struct(records.alias("quarterly")).alias("Balance_Sheet")).alias("Financials")))
    shape = F.col("ticker") % 3
    payload = F.when(shape == 0, flat).when(shape == 1, nested).otherwise(F.to_json(records))
    return filings.flatten_fundamentals(q.select("ticker", payload.alias("payload")), "Balance_Sheet").select(
        "ticker", "period_end", "filed", "shares", "equity")


@query("flatten_facts", """SELECT o_orderkey AS ticker,
  CASE WHEN o_orderstatus = 'F' THEN 'us-gaap:StockholdersEquity'
       ELSE 'us-gaap:StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest' END AS tag,
  CAST(o_orderdate AS DATE) AS filed, o_totalprice AS val FROM orders""")
def flatten_facts(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    good = F.struct(day.alias("end"), day.alias("filed"), F.col("o_totalprice").alias("val"))
    partial = F.struct(F.lit(None).cast("string").alias("end"), day.alias("filed"), F.col("o_totalprice").alias("val"))
    wide = "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"
    first = F.when(F.col("o_orderstatus") == "F", good).otherwise(partial)
    payload = F.to_json(F.struct(F.struct(F.struct(
        F.struct(F.struct(F.array(first).alias("USD")).alias("units")).alias("StockholdersEquity"),
        F.struct(F.struct(F.array(good).alias("USD")).alias("units")).alias(wide)).alias("us-gaap")).alias("facts")))
    raw = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ticker"), payload.alias("payload"))
    return filings.flatten_facts(raw, filings.EQUITY_TAGS, "USD").select("ticker", "tag", "filed", "val")


# Customers state equity per quarter, every third of them twice, and share counts of some quarters twenty days later.
_FACTS_SQL = f"""quarters AS (SELECT o_custkey AS ticker, {qend('o_orderdate')} AS e, sum(CAST(floor(o_totalprice) AS BIGINT)) AS v, count(*) AS n,
    bool_or(o_orderstatus = 'F') OR min(o_orderkey) % 3 = 0 AS counted FROM orders GROUP BY ALL),
equity AS (SELECT ticker, e, e + CASE WHEN ticker % 3 = 0 THEN 70 ELSE 40 END AS filed, v + CASE WHEN ticker % 3 = 0 THEN 1 ELSE 0 END AS v FROM quarters),
shares AS (SELECT ticker, e + 20 AS e, n + 100 AS n FROM quarters WHERE counted)"""


@query("facts_book_series", f"""WITH {_FACTS_SQL},
near AS (SELECT q.ticker, q.e, q.filed, q.v, s.n FROM equity q JOIN shares s ON s.ticker = q.ticker AND abs(s.e - q.e) <= 100
         QUALIFY row_number() OVER (PARTITION BY q.ticker, q.e ORDER BY abs(s.e - q.e)) = 1)
SELECT ticker, CAST(filed AS DATE) AS filed, CAST(v AS DOUBLE) / n AS bvps FROM near""")
def facts_book_series(spark, sf_dir):
    quarters = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("ticker"), quarter_end("o_orderdate").alias("e")).agg(
        F.sum(F.floor("o_totalprice")).alias("v"), F.count(F.lit(1)).alias("n"),
        (F.bool_or(F.col("o_orderstatus") == "F") | (F.min("o_orderkey") % 3 == 0)).alias("counted"))

    def fact(end, filed, value):
        return F.struct(end.cast("string").alias("end"), filed.cast("string").alias("filed"), value.alias("val"))

    e = F.col("e")
    twice = F.when(F.col("ticker") % 3 == 0, fact(e, F.date_add(e, 70), F.col("v") + 1))
    counted = F.when(F.col("counted"), fact(F.date_add(e, 20), F.date_add(e, 40), F.col("n") + 100))
    stated = quarters.groupBy("ticker").agg(
        F.concat(F.collect_list(fact(e, F.date_add(e, 40), F.col("v"))), F.collect_list(twice)).alias("USD"),
        F.collect_list(counted).alias("shares"))
    units = lambda unit: F.struct(F.struct(F.col(unit)).alias("units"))
    facts = F.struct(F.struct(units("USD").alias("StockholdersEquity")).alias("us-gaap"),
                     F.struct(units("shares").alias("EntityCommonStockSharesOutstanding")).alias("dei"))
    raw = stated.select("ticker", F.to_json(F.struct(facts.alias("facts"))).alias("payload"))
    return filings.book_series_from_facts(raw)


# -- scalars -------------------------------------------------------------------------------------

@query("scalar_strings", r"""SELECT p_partkey, upper(trim(p_brand)) AS ticker,
  CASE WHEN p_size % 3 = 0 THEN 't:' || upper(p_brand) WHEN p_size % 3 = 1 THEN 'c:' || upper('id' || p_partkey)
       ELSE 'n:' || regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') END AS holding_key,
  'PRIV_' || upper(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_')) AS private_ticker,
  CASE p_size % 5 WHEN 0 THEN lpad(CAST(p_size AS VARCHAR), 4, '0') || '.HK' WHEN 1 THEN p_size || '.T' WHEN 2 THEN p_size || '.SS'
       WHEN 3 THEN CAST(p_size AS VARCHAR) ELSE p_size || '.KS' END AS exchange_ticker,
  lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS cik,
  CASE WHEN p_partkey > 0 THEN 'https://www.sec.gov/Archives/edgar/data/' || p_partkey || '/' || replace('1-2-' || p_size, '-', '') || '/1-2-' || p_size || '-index.htm' END AS url,
  CASE WHEN contains(p_name, p_type) THEN p_name ELSE p_name || '; ' || p_type END AS tagged,
  'v' || p_size AS tag_value
FROM part""")
def scalar_strings(spark, sf_dir):
    size = F.col("p_size")
    mod = size % 3
    exch = F.element_at(F.array(*[F.lit(e) for e in ("HK", "JP", "CH", "US", "KS")]), (size % 5 + 1).cast("int"))
    none = F.lit(None).cast("string")
    number = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        "p_partkey", txt.normalize_ticker("p_brand").alias("ticker"),
        txt.holding_key(F.when(mod == 0, F.col("p_brand")).otherwise(F.lit("nan")),
                        F.when(mod == 1, F.concat(F.lit("id"), number)).otherwise(none), F.col("p_name")).alias("holding_key"),
        txt.private_ticker("p_name").alias("private_ticker"),
        txt.exchange_ticker(F.concat_ws(" ", size.cast("string"), exch)).alias("exchange_ticker"),
        txt.cik_pad("p_partkey").alias("cik"),
        txt.filing_url(number, F.concat(F.lit("1-2-"), size.cast("string"))).alias("url"),
        txt.append_tag("p_name", F.col("p_type")).alias("tagged"),
        txt.extract_tag(F.concat(F.lit("a=1; k=v"), size.cast("string"), F.lit("; z=2")), "k").alias("tag_value"))


@query("scalar_dates", f"""SELECT o_orderkey, {qend('o_orderdate')} AS quarter_end,
  CAST(date_trunc('quarter', CAST(o_orderdate AS DATE) - 45 + 1) - INTERVAL 1 DAY AS DATE) AS filed_quarter,
  CAST(CAST(o_orderdate AS DATE) - INTERVAL 5 YEAR AS DATE) AS lookback, CAST(o_orderdate AS DATE) >= DATE '1998-01-01' AS in_window
FROM orders""")
def scalar_dates(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.quarter_end("o_orderdate").alias("quarter_end"),
        dates.filed_quarter_end("o_orderdate").alias("filed_quarter"), dates.lookback_start(day, 5).alias("lookback"),
        dates.in_window(day, F.lit(None).cast("date"), F.to_date(F.lit("1998-01-01"))).alias("in_window"))


@query("scalar_math", """SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS price,
  CASE WHEN abs(l_extendedprice + l_tax * 500.0) >= 1e-6 THEN (l_extendedprice * 1.1 - l_extendedprice - l_tax * 1000.0) / (l_extendedprice + (l_tax * 1000.0) / 2.0) END AS dietz,
  CASE WHEN l_quantity > l_linenumber AND l_quantity % l_linenumber = 0 THEN CAST(l_quantity / l_linenumber AS INTEGER) END AS ratio,
  l_quantity * 1000000.0 / 7.8 AS usd, least(l_quantity * 4.0, 100.0) AS pct, greatest(0.0, 100.0 - l_quantity * 4.0) AS rest
FROM lineitem""")
def scalar_math(spark, sf_dir):
    price, qty, flow = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_tax") * 1000.0
    none = F.lit(None).cast("double")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", num.period_price(F.lit("hold"), price, qty, none, none).alias("price"),
        num.dietz(price, price * 1.1, flow).alias("dietz"),
        num.share_ratio(qty, F.col("l_linenumber").cast("double")).alias("ratio"), num.to_usd(qty).alias("usd"),
        num.pct_capped(qty * 4.0).alias("pct"), num.pct_complement(qty * 4.0).alias("rest"))


# -- summaries -----------------------------------------------------------------------------------

@query("backtest_summary", f"""WITH {_OUTCOME}
SELECT c.ticker, c.deletion_date, c.status, c.buy_price, o.status AS return_status, o.sell_price, o.return_pct,
       CAST(NULL AS DOUBLE) AS adjusted_bvps FROM crossings c
LEFT JOIN outcomes o ON o.ticker = c.ticker AND o.deletion_date = c.deletion_date""")
def backtest_summary(spark, sf_dir):
    crossings = stage(_crossings(spark, sf_dir), "crossings")
    return summaries.backtest_summary(crossings, _outcomes(spark, sf_dir, crossings)).select(
        "ticker", "deletion_date", "status", "buy_price", "return_status", "sell_price", "return_pct", "adjusted_bvps")


@query("wide_summary", """WITH spend AS (SELECT o_custkey, arg_max(o_orderkey, (CAST(o_orderdate AS DATE), CAST(o_orderkey AS VARCHAR))) AS last_order,
    arg_max(o_orderpriority, (CAST(o_orderdate AS DATE), CAST(o_orderkey AS VARCHAR))) AS method FROM orders GROUP BY ALL)
SELECT c_custkey AS ticker, c_acctbal AS pb_ratio, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS is_index_dropout,
       method, CAST(last_order AS VARCHAR) AS lifo_source_quote, CAST(NULL AS VARCHAR) AS description, n_nationkey AS holdings_count
FROM customer LEFT JOIN spend ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def wide_summary(spark, sf_dir):
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    base = customer.select(F.col("c_custkey").alias("ticker"), F.col("c_acctbal").alias("pb_ratio"))
    dropouts = orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("ticker"))
    lifo = orders.select(
        F.col("o_custkey").alias("ticker"), F.col("o_orderkey").cast("string").alias("accession_no"),
        F.col("o_orderdate").cast("date").alias("filing_date"), F.col("o_orderpriority").alias("method"),
        F.col("o_orderkey").cast("string").alias("source_quote"))
    nation = table(spark, sf_dir, "nation")
    rollups = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("ticker"), F.col("n_nationkey").alias("holdings_count"))
    return summaries.stock_summary(base, dropouts, lifo, rollups=rollups).select(
        "ticker", "pb_ratio", "is_index_dropout", "method", "lifo_source_quote", "description", "holdings_count")


_UNIVERSE_SQL = """h AS (SELECT l_suppkey AS p, l_partkey AS i, CAST(l_shipdate AS DATE) AS d, l_orderkey || '-' || l_linenumber AS acc,
    CAST(floor(l_extendedprice * 10000.0 + 0.5) AS HUGEINT) AS v, l_linenumber % 2 = 0 AS incl FROM lineitem),
keys AS (SELECT s_suppkey AS p, CAST(d AS DATE) AS as_of FROM supplier, (VALUES (DATE '1900-01-01'), (DATE '1996-12-31'), (DATE '1999-06-30')) v(d)),
known AS (SELECT k.as_of, h.* FROM keys k JOIN h ON h.p = k.p AND h.d <= k.as_of
          QUALIFY row_number() OVER (PARTITION BY k.p, k.as_of, h.i ORDER BY d DESC, acc DESC) = 1)"""


@query("universe_rollup_as_of", f"""WITH {_UNIVERSE_SQL}
SELECT CAST(k.p AS VARCHAR) AS ticker, k.as_of AS as_of_date, count(i) AS holdings_count,
  CAST(coalesce(sum(v) FILTER (incl), 0) AS DOUBLE) / 10000.0 AS holdings_book_adj_usd,
  CAST(coalesce(sum(v) FILTER (NOT incl), 0) AS DOUBLE) / 10000.0 AS holdings_lookthrough_mtm_usd,
  CASE WHEN count(i) = 0 THEN 'no holdings from 13F/13G/notes' END AS extract_error
FROM keys k LEFT JOIN known USING (p, as_of) GROUP BY ALL""")
def universe_rollup_as_of(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    ticker = F.concat(F.lit("T"), F.col("l_partkey"))
    held = conform(line.select(
        F.col("l_suppkey").cast("string").alias("parent_ticker"), ticker.alias("investee_ticker"), ticker.alias("investee_name"),
        F.col("l_shipdate").cast("date").alias("as_of_date"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("as_of_accession_no"),
        F.col("l_extendedprice").alias("suggested_adj_usd"), F.col("l_extendedprice").alias("lookthrough_mtm_usd"),
        (F.col("l_linenumber") % 2 == 0).alias("include_in_book_adj")), HOLDINGS_SCHEMA)
    dates = F.array(*[F.to_date(F.lit(d)) for d in ("1900-01-01", "1996-12-31", "1999-06-30")])
    parents = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ticker"), F.lit(1.0).alias("price"), F.lit(1.0).alias("book_value"),
        F.lit(1.0).alias("shares"), F.explode(dates).alias("as_of"))
    _, rollups = holdings.holdings_universe(parents, held)
    return rollups.select("ticker", "as_of_date", "holdings_count", "holdings_book_adj_usd", "holdings_lookthrough_mtm_usd",
                          "extract_error")


_PREV_Q = "CAST(date_trunc('quarter', {0} + 1) - INTERVAL 1 DAY AS DATE)"
_FULL_SQL = f"""{_CROSS}, {ADDITIONS},
day AS (SELECT user_id AS ticker, event_id AS e, event_type AS kind, CAST(ts AS DATE) AS d, value AS v, lpad(CAST(event_id AS VARCHAR), 12, '0') AS acc FROM events),
again AS (SELECT c.ticker, min(a.added_date) AS reentry_date FROM crossings c JOIN additions a ON a.ticker = c.ticker AND a.added_date > c.crossing_date
          WHERE status = 'crossed' GROUP BY ALL),
lastday AS (SELECT max(date) AS m FROM prices),
best AS (SELECT a.ticker, arg_max(p.close, (p.close, -datediff('day', DATE '1970-01-01', p.date))) AS close FROM again a
         JOIN prices p ON p.ticker = a.ticker AND p.date BETWEEN a.reentry_date AND a.reentry_date + 365 GROUP BY ALL),
recent AS (SELECT ticker, arg_max(close, date) AS close FROM prices, lastday WHERE date >= m - 10 GROUP BY ALL),
outcome AS (SELECT c.ticker, a.reentry_date IS NOT NULL AS back, CASE WHEN a.reentry_date IS NOT NULL THEN b.close ELSE r.close END AS px, c.buy_price
            FROM crossings c LEFT JOIN again a ON a.ticker = c.ticker LEFT JOIN best b ON b.ticker = c.ticker LEFT JOIN recent r ON r.ticker = c.ticker
            WHERE status = 'crossed'),
filed AS (SELECT ticker, e % 3 AS owner, d, max(v) AS v FROM day WHERE kind = 'click' GROUP BY ALL),
owners AS (SELECT c.ticker, owner, arg_max(v, d) AS v FROM deletions c JOIN filed f ON f.ticker = c.ticker AND f.d <= c.deletion_date GROUP BY ALL),
insider AS (SELECT ticker, {msum('v')} AS s, count(*) AS n FROM owners WHERE v > 0 GROUP BY ALL),
reports AS (SELECT ticker, e % 5 AS manager, {_PREV_Q.format('(d - 45)')} AS period_end, d, sum(CAST(floor(v * 10000.0 + 0.5) AS HUGEINT)) AS s FROM day WHERE kind = 'view' GROUP BY ALL),
q AS (SELECT ticker, deletion_date, {_PREV_Q.format('(deletion_date - 45)')} AS q0 FROM deletions),
tries AS (SELECT ticker, deletion_date, 0 AS t, q0 AS period_end FROM q UNION ALL SELECT ticker, deletion_date, 1, {_PREV_Q.format('(q0 - 1 - 45)')} FROM q),
managers AS (SELECT t.ticker, t.t, manager, arg_max(s, d) AS s FROM tries t JOIN reports r ON r.ticker = t.ticker AND r.period_end = t.period_end AND r.d <= t.deletion_date GROUP BY ALL),
inst AS (SELECT * FROM (SELECT ticker, t, CAST(sum(s) AS DOUBLE) / 10000.0 AS s, count(*) AS n FROM managers GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY t) = 1),
counted AS (SELECT d.ticker, arg_max(bvps, filed) * 100.0 AS n, arg_max(bvps, filed) AS treasury FROM deletions d JOIN book b ON b.ticker = d.ticker AND b.filed <= d.deletion_date GROUP BY ALL),
flows AS (SELECT d.ticker, e.net_income AS x FROM deletions d JOIN earn e ON e.ticker = d.ticker AND e.filed <= d.deletion_date
          QUALIFY row_number() OVER (PARTITION BY d.ticker ORDER BY e.filed DESC) <= 4),
spent AS (SELECT ticker, {msum('x')} AS s, {msum('CASE WHEN x < 0 THEN -x ELSE 0.0 END')} AS g, count(*) AS n FROM flows GROUP BY ALL),
facts AS (SELECT ticker, arg_max(v, (d, acc)) AS reserve, arg_max(e, (d, acc)) % 3 AS basis FROM day WHERE kind = 'error' GROUP BY ALL),
told AS (SELECT ticker, 'event ' || arg_max(e, (d, acc)) AS description FROM day WHERE kind = 'click' GROUP BY ALL),
adjusted AS (SELECT f.*, c.buy_price, bvps_at_crossing + reserve / (bvps_at_crossing * 10.0) AS adj,
               coalesce(basis <> 1 AND reserve > 0 AND c.buy_price IS NOT NULL AND bvps_at_crossing > 0, false) AS ok
             FROM facts f JOIN crossings c ON c.ticker = f.ticker),
known AS (SELECT c.ticker, i.kind, i.v FROM deletions c JOIN day i ON i.ticker = c.ticker AND i.d <= c.deletion_date
          QUALIFY row_number() OVER (PARTITION BY c.ticker, i.kind ORDER BY i.d DESC, i.acc DESC) = 1),
rolled AS (SELECT ticker, count(*) AS n, CAST(sum(CAST(floor(v * 10000.0 + 0.5) AS HUGEINT)) AS DOUBLE) / 10000.0 AS adj FROM known GROUP BY ALL),
fullsum AS (SELECT CAST(c.ticker AS VARCHAR) AS ticker, c.deletion_date, c.status,
  CASE WHEN o.ticker IS NULL THEN NULL WHEN px IS NULL THEN 'insufficient_data' WHEN back THEN 'realized' ELSE 'still_holding' END AS return_status,
  px AS sell_price, (px - o.buy_price) / o.buy_price * 100.0 AS return_pct,
  CASE WHEN a.ticker IS NOT NULL THEN 'LIFO' END AS method, (['US_GAAP', 'IFRS', 'unclear'])[a.basis + 1] AS accounting_basis,
  CASE WHEN ok THEN a.adj END AS adjusted_bvps, CASE WHEN ok THEN a.buy_price / a.adj END AS adjusted_pb_ratio, description,
  CASE WHEN i.s / k.n IS NOT NULL THEN least(100.0 * i.s / k.n, 100.0) END AS percent_insiders,
  CASE WHEN h.s / k.n IS NOT NULL THEN least(100.0 * h.s / k.n, 100.0) END AS percent_institutions,
  CASE WHEN h.s / k.n IS NOT NULL THEN greatest(0.0, 100.0 - least(100.0 * h.s / k.n, 100.0)) END AS percent_non_institutions,
  coalesce(i.n, 0) AS insider_owner_count, coalesce(h.n, 0) AS institutional_holder_count,
  CASE WHEN b.s IS NOT NULL THEN greatest(0.0, -b.s) END AS net_buyback_usd_ttm, b.g AS gross_repurchase_usd_ttm,
  k.treasury AS treasury_stock, coalesce(b.n, 0) AS buyback_quarters_used, coalesce(r.n, 0) AS holdings_count, coalesce(r.adj, 0.0) AS holdings_book_adj_usd
  FROM crossings c LEFT JOIN outcome o ON o.ticker = c.ticker LEFT JOIN adjusted a ON a.ticker = c.ticker LEFT JOIN told t ON t.ticker = c.ticker
  LEFT JOIN insider i ON i.ticker = c.ticker LEFT JOIN inst h ON h.ticker = c.ticker LEFT JOIN counted k ON k.ticker = c.ticker
  LEFT JOIN spent b ON b.ticker = c.ticker LEFT JOIN rolled r ON r.ticker = c.ticker)"""


def _full(spark, sf_dir):
    """The whole backtest: users leave an index, and events of each kind are their bars, books, reports and filings."""
    text = lambda df: df.withColumn("ticker", F.col("ticker").cast("string"))
    bars, book = text(prices(spark, sf_dir)), text(book_series(spark, sf_dir))
    earned = text(earnings_series(spark, sf_dir))
    day = F.col("ts").cast("date")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("ticker"), "event_id", "event_type", day.alias("filing_date"), "value",
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("accession_no"))
    of = lambda kind: events.where(F.col("event_type") == kind)
    insiders = of("click").select("ticker", (F.col("event_id") % 3).alias("owner"), "filing_date", F.col("value").alias("shares"))
    institutions = of("view").select(
        "ticker", (F.col("event_id") % 5).alias("manager"), quarter_end_on_or_before(F.date_sub("filing_date", 45)).alias("period_end"),
        "filing_date", F.col("value").alias("shares"))
    filed = F.col("filed")
    outstanding = book.select("ticker", filed.alias("shares_date"), (F.col("bvps") * 100.0).alias("shares_outstanding"))
    cash = earned.select("ticker", filed.alias("period_end"), filed.alias("filing_date"), F.col("net_income").alias("sale_purchase"),
                         F.lit(None).cast("double").alias("issuance"))
    sheet = book.select("ticker", filed.alias("period_end"), filed.alias("filing_date"), F.col("bvps").alias("treasury_stock"))
    basis = F.element_at(F.array(F.lit("US GAAP"), F.lit("IFRS"), F.lit("")), (F.col("event_id") % 3 + 1).cast("int"))
    facts = of("error").select("ticker", "accession_no", "filing_date", basis.alias("basis"), F.lit("LIFO").alias("method"),
                               F.lit(True).alias("lifo_reserve_disclosed"), F.col("value").alias("lifo_reserve_usd"))
    told = of("click").select("ticker", "accession_no", "filing_date", F.concat(F.lit("event "), "event_id").alias("description"))
    held = conform(events.select(
        F.col("ticker").alias("parent_ticker"), F.col("event_type").alias("investee_ticker"), F.col("event_type").alias("investee_name"),
        F.col("filing_date").alias("as_of_date"), F.col("accession_no").alias("as_of_accession_no"), F.col("value").alias("suggested_adj_usd"),
        F.lit(True).alias("include_in_book_adj")), HOLDINGS_SCHEMA)
    return summaries.run_backtest_summary(
        text(deletions(spark, sf_dir)), text(additions(spark, sf_dir)), bars, book.withColumn("shares", F.col("bvps") * 10.0), earned,
        bars.agg(F.max("date")).scalar(), insiders, institutions, outstanding, cash, sheet, facts, told, held)


_FULL_COLUMNS = (
    "ticker", "deletion_date", "status", "return_status", "sell_price", "return_pct", "method", "accounting_basis", "adjusted_bvps",
    "adjusted_pb_ratio", "description", "percent_insiders", "percent_institutions", "percent_non_institutions", "insider_owner_count",
    "institutional_holder_count", "net_buyback_usd_ttm", "gross_repurchase_usd_ttm", "treasury_stock", "buyback_quarters_used",
    "holdings_count", "holdings_book_adj_usd")


@query("backtest_full", f"WITH {_FULL_SQL} SELECT * FROM fullsum")
def backtest_full(spark, sf_dir):
    return _full(spark, sf_dir).select(*_FULL_COLUMNS)


@query("summary_counts", f"""WITH {_FULL_SQL} SELECT count(*) AS num_rows, count(adjusted_bvps) AS num_lifo_adjusted,
  count(adjusted_pb_ratio) AS num_with_adjusted_pb, count(percent_insiders) AS num_with_insiders,
  count(percent_non_institutions) AS num_with_non_inst, count(net_buyback_usd_ttm) AS num_with_buybacks,
  count(*) FILTER (holdings_count > 0) AS num_with_holdings FROM fullsum""")
def summary_counts(spark, sf_dir):
    return summaries.summary_counts(_full(spark, sf_dir))


@query("screener_full", """WITH avg_order AS (SELECT o_custkey, CAST(sum(CAST(floor(o_totalprice * 100.0 + 0.5) AS HUGEINT)) AS DOUBLE) / 100.0 / count(*) AS a,
    count(*) AS n, CAST(coalesce(sum(CAST(floor(o_totalprice * 10000.0 + 0.5) AS HUGEINT)) FILTER (o_orderstatus = 'F'), 0) AS DOUBLE) / 10000.0 AS adj
  FROM orders GROUP BY ALL),
pb AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal / a AS pb_ratio, a, n, adj FROM customer JOIN avg_order ON c_custkey = o_custkey),
s AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events), t AS (SELECT max(d) AS today FROM s),
b AS (SELECT max(d) AS base FROM s, t WHERE d <= today - 10),
gone AS (SELECT user_id FROM s, b WHERE d = base EXCEPT SELECT user_id FROM s, t WHERE d = today)
SELECT ticker, pb_ratio, ticker IN (SELECT CAST(user_id AS VARCHAR) FROM gone) AS is_index_dropout, 'LIFO' AS method, n AS holdings_count,
  adj AS holdings_book_adj_usd, a + adj / 1000.0 AS bvps_holdings_adj FROM pb WHERE pb_ratio > 0 AND pb_ratio < 1""")
def screener_full(spark, sf_dir):
    from posledger.bindings.views import cents

    orders, customer, events = (table(spark, sf_dir, n) for n in ("orders", "customer", "events"))
    ticker = F.col("o_custkey").cast("string")
    book = orders.groupBy("o_custkey").agg((cents("o_totalprice") / F.count(F.lit(1))).alias("book_value"))
    quotes = customer.join(book, customer.c_custkey == book.o_custkey).select(
        ticker.alias("ticker"), F.col("c_acctbal").alias("price"), "book_value", F.lit(1000.0).alias("shares"),
        (F.col("c_acctbal") / F.col("book_value")).alias("pb_ratio"))
    members = events.select(F.col("user_id").cast("string").alias("ticker"), F.lit("x").alias("index_name"),
                            F.col("ts").cast("date").alias("snapshot_date")).distinct()
    held = conform(orders.select(
        ticker.alias("parent_ticker"), F.concat(F.lit("H"), "o_orderkey").alias("investee_ticker"), F.concat(F.lit("H"), "o_orderkey").alias("investee_name"),
        F.col("o_orderdate").cast("date").alias("as_of_date"), F.col("o_totalprice").alias("suggested_adj_usd"),
        (F.col("o_orderstatus") == "F").alias("include_in_book_adj")), HOLDINGS_SCHEMA)
    lifo = orders.select(ticker.alias("ticker"), F.concat(F.lit("a"), "o_orderkey").alias("accession_no"),
                         F.col("o_orderdate").cast("date").alias("filing_date"), F.lit("LIFO").alias("method"))
    return summaries.run_screener(quotes, members, 10, held, lifo).select(
        "ticker", "pb_ratio", "is_index_dropout", "method", "holdings_count", "holdings_book_adj_usd", "bvps_holdings_adj")
