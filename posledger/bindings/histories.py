"""Histories of several parents from landed filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from posledger.bindings.registry import query
from posledger.bindings.views import cents, owned_lines, qend, sql_cents, table
from posledger.functions.dates import quarter_end
from posledger.operators import valuation
from posledger.plans import history as plan
from posledger.sources.filings import load_dims
from posledger.sources.tables import stage

# Nations 0 to 14 file quarterly reports, ownership filings and annual tables; 15 to 19 and from 22 on ownership
# filings only; 20 and 21 stand for the two parents that publish annual aggregates.
_PARENT_SQL = "CASE n_nationkey WHEN 20 THEN 'TCEHY' WHEN 21 THEN 'TCTZF' ELSE n_name END"
_LAST = "(SELECT CAST(max(l_shipdate) AS DATE) AS last FROM lineitem)"

_LANDED_SQL = f"""
owned AS (SELECT {_PARENT_SQL} AS parent_ticker, n_nationkey AS nk, replace(p_brand, '#', '') AS brand, 'Maker' || p_size % 5 AS mfgr,
            l_quantity AS q, l_extendedprice AS v, CAST(l_shipdate AS DATE) AS day
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
limits AS (SELECT CAST(last - INTERVAL 5 YEAR AS DATE) AS start5, CAST(last - INTERVAL 8 YEAR AS DATE) AS start8 FROM {_LAST}),
reports AS (SELECT parent_ticker, nk, {qend('day')} AS period_end, {qend('day')} + 45 AS filed, upper(brand) AS t, sum(q) AS shares,
              {sql_cents('v')} AS mv FROM owned WHERE nk < 15 GROUP BY ALL),
inside AS (SELECT r.* FROM reports r, limits WHERE period_end >= start5 OR filed >= start5),
edge AS (SELECT parent_ticker, t FROM inside QUALIFY period_end = min(period_end) OVER (PARTITION BY parent_ticker)),
before_window AS (SELECT r.* FROM reports r, limits WHERE period_end < start5 AND filed < start5),
pre AS (SELECT b.* FROM before_window b SEMI JOIN edge e ON e.parent_ticker = b.parent_ticker AND e.t = b.t),
pre_span AS (SELECT parent_ticker, min(period_end) AS lo, max(period_end) AS hi FROM pre GROUP BY ALL),
pre_grid AS (SELECT DISTINCT b.parent_ticker, b.period_end FROM before_window b JOIN pre_span s ON s.parent_ticker = b.parent_ticker AND period_end BETWEEN lo AND hi),
grid13f AS (SELECT DISTINCT parent_ticker, period_end, filed FROM inside),
covers AS (SELECT parent_ticker, nk, upper(mfgr) AS t, last_day(day) AS filed, month(day) % 7 = 0 AS gone, sum(q) * 1000.0 AS shares
           FROM owned GROUP BY ALL),
recent AS (SELECT c.* FROM covers c, limits WHERE filed >= CASE WHEN nk IN (20, 21) THEN start8 ELSE start5 END),
held AS (SELECT *, lead(filed) OVER (PARTITION BY parent_ticker, t ORDER BY filed) AS until FROM recent),
overlay AS (SELECT g.parent_ticker, g.period_end, h.t, h.shares FROM grid13f g JOIN held h ON h.parent_ticker = g.parent_ticker
              AND h.filed <= g.filed AND (h.until IS NULL OR h.until > g.filed) WHERE NOT gone),
grid13g AS (SELECT DISTINCT parent_ticker, filed AS period_end FROM recent WHERE nk >= 15),
running AS (SELECT g.parent_ticker, g.period_end, h.t, h.shares FROM grid13g g JOIN held h ON h.parent_ticker = g.parent_ticker
              AND h.filed <= g.period_end AND (h.until IS NULL OR h.until > g.period_end) WHERE NOT gone),
years AS (SELECT parent_ticker, nk, year(day) AS y, count(*) AS n FROM owned GROUP BY ALL),
filed_notes AS (SELECT y.*, make_date(y, 12, 31) AS ye FROM years y, limits WHERE nk < 15 AND make_date(y + 1, 2, 10) >= start5),
stated AS (SELECT parent_ticker, ye, n FROM filed_notes
           UNION SELECT f.parent_ticker, make_date(f.y - 1, 12, 31), coalesce(y.n, 1) FROM filed_notes f LEFT JOIN years y ON y.parent_ticker = f.parent_ticker AND y.y = f.y - 1),
known AS (SELECT g.parent_ticker, g.period_end, s.ye, s.n FROM grid13f g JOIN stated s ON s.parent_ticker = g.parent_ticker AND s.ye <= g.period_end
          WHERE EXISTS (SELECT 1 FROM filed_notes f WHERE f.parent_ticker = g.parent_ticker AND make_date(f.y + 1, 2, 10) <= g.filed
                          AND (f.ye = s.ye OR make_date(f.y - 1, 12, 31) = s.ye))),
noted AS (SELECT parent_ticker, period_end, 'DIDIY' AS t, arg_max(n, ye) * 1e6 AS mv FROM known GROUP BY ALL),
pos AS (
  SELECT parent_ticker, period_end, t, shares, mv, '13f' AS src FROM inside
  UNION ALL SELECT parent_ticker, period_end, t, shares, mv, '13f' FROM pre
  UNION ALL SELECT parent_ticker, period_end, t, shares, NULL, '13g' FROM overlay
  UNION ALL SELECT parent_ticker, period_end, t, shares, NULL, '13g' FROM running
  UNION ALL SELECT parent_ticker, period_end, t, NULL, mv, 'note' FROM noted),
numbered AS (SELECT *, row_number() OVER (PARTITION BY parent_ticker ORDER BY period_end) AS i
             FROM (SELECT parent_ticker, period_end FROM grid13f UNION SELECT parent_ticker, period_end FROM pre_grid UNION SELECT parent_ticker, period_end FROM grid13g)),
placed AS (SELECT p.*, i FROM pos p JOIN numbered USING (parent_ticker, period_end)),
steps AS (
  SELECT coalesce(c.parent_ticker, p.parent_ticker) AS parent_ticker, coalesce(c.t, p.t) AS t, coalesce(c.i, p.i + 1) AS i,
    c.t IS NOT NULL AS now, p.t IS NOT NULL AS before, c.shares AS cs, p.shares AS ps, c.mv AS cv, p.mv AS pv, coalesce(c.src, p.src) AS src
  FROM placed c FULL OUTER JOIN placed p ON c.parent_ticker = p.parent_ticker AND c.t = p.t AND c.i = p.i + 1),
history AS (
  SELECT s.parent_ticker, s.t AS investee_ticker, n.period_end,
    CASE WHEN NOT before THEN 'new' WHEN NOT now THEN 'exit' WHEN cs > ps THEN 'buy' WHEN cs < ps THEN 'sell' ELSE 'hold' END AS action,
    CASE WHEN now THEN cs ELSE 0.0 END AS shares_held, ps AS shares_prev,
    CASE WHEN now THEN cv WHEN src <> '13g' THEN 0.0 END AS market_value_usd, src
  FROM steps s JOIN numbered n ON n.parent_ticker = s.parent_ticker AND n.i = s.i
  WHERE before OR cs > 0),
aggregates AS (SELECT y.parent_ticker, make_date(y.y, 12, 31) AS ye, y.n * 1e9 / 7.1884 AS v FROM years y, limits
               WHERE nk IN (20, 21) AND make_date(y.y, 12, 31) >= start8),
eligible AS (SELECT a.parent_ticker, a.ye, h.investee_ticker, max(h.period_end) AS period_end FROM aggregates a JOIN history h
               ON h.parent_ticker = a.parent_ticker AND h.period_end <= a.ye AND h.action <> 'exit' GROUP BY ALL),
stamped AS (SELECT parent_ticker, investee_ticker, period_end, max(ye) AS ye FROM eligible GROUP BY ALL),
full_rows AS (
  SELECT h.parent_ticker, h.investee_ticker, h.period_end, h.action, h.shares_held, h.shares_prev, h.market_value_usd, h.src,
    CASE WHEN s.ye IS NOT NULL THEN 'PRIV_HK_LISTED_INVESTEES_FV' END AS composition_parent, s.ye AS composition_as_of
  FROM history h LEFT JOIN stamped s USING (parent_ticker, investee_ticker, period_end)
  UNION ALL SELECT parent_ticker, 'PRIV_HK_LISTED_INVESTEES_FV', ye, 'hold', NULL, NULL, v, 'annual', NULL, NULL FROM aggregates
  UNION ALL SELECT parent_ticker, 'PRIV_HK_LISTED_INVESTEES_FV_RESIDUAL', ye, 'hold', NULL, NULL, v, 'residual', 'PRIV_HK_LISTED_INVESTEES_FV', ye FROM aggregates)"""

_COLUMNS = ("parent_ticker, investee_ticker, period_end, action, shares_held, shares_prev, market_value_usd, src, composition_parent, "
            "composition_as_of")


def _parents(spark, sf_dir) -> DataFrame:
    key = F.col("n_nationkey")
    parent = F.when(key == 20, F.lit("TCEHY")).when(key == 21, F.lit("TCTZF")).otherwise(F.col("n_name"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    lines = owned_lines(spark, sf_dir, brands=False).join(part, F.col("l_partkey") == F.col("p_partkey"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("_n"))
    return lines.drop("n_nationkey").join(nation, F.col("n_name") == F.col("_n")).select(
        parent.alias("parent_ticker"), key.alias("nk"), F.translate("p_brand", "#", "").alias("brand"),
        F.concat(F.lit("Maker"), (F.col("p_size") % 5).cast("string")).alias("mfgr"), "l_quantity", "l_extendedprice", F.col("l_shipdate").cast("date").alias("day"))


def _payloads(owned: DataFrame) -> DataFrame:
    """One quarterly report per nation and quarter with all its holdings."""
    cells = owned.where("nk < 15").groupBy("parent_ticker", "nk", quarter_end("day").alias("q"), "brand").agg(
        F.sum("l_quantity").alias("shares"), cents("l_extendedprice").alias("value"))
    holding = F.struct(
        F.concat("brand", F.lit(" Corp")).alias("nameOfIssuer"), F.lit("COM").alias("titleOfClass"), F.lower("brand").alias("ticker"),
        F.col("value"), F.struct(F.col("shares").alias("sshPrnamt"), F.lit("SH").alias("sshPrnamtType")).alias("shrsOrPrnAmt"))
    report = cells.groupBy("parent_ticker", "nk", "q").agg(F.collect_list(holding).alias("holdings"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return report.select("parent_ticker", F.to_json(F.struct(
        F.lit("13F-HR").alias("formType"), day("q").alias("periodOfReport"), day(F.date_add("q", 45)).alias("filedAt"),
        F.concat_ws("-", F.lit("q"), "nk", day("q")).alias("accessionNo"), F.col("nk").cast("string").alias("cik"), "holdings")).alias("payload"))


_COVER = """<html><body><p>SCHEDULE 13G</p>{name} Works Inc. (Name of Issuer) {cusip} (CUSIP Number)
<td>Aggregate Amount Beneficially Owned by Each Reporting Person</td><td>{amount}</td>
<td>Percent of Class Represented by Amount in Row (9)</td><td>{pct}%</td></body></html>"""


def _cusip(mfgr: str) -> Column:
    return F.concat(F.lit("MF000000"), F.substring(mfgr, -1, 1))


def _filings(owned: DataFrame) -> DataFrame:
    """A monthly ownership filing per manufacturer, and an annual report with a table of two year ends."""
    months = owned.groupBy("parent_ticker", "nk", "mfgr", F.last_day("day").alias("filing_date")).agg(F.sum("l_quantity").alias("q"))
    gone = F.month("filing_date") % 7 == 0
    body = F.lit(_COVER)
    for name, value in (
            ("name", F.col("mfgr")), ("cusip", _cusip("mfgr")),
            ("amount", F.when(gone, F.lit("0")).otherwise(F.format_string("%,d", (F.col("q") * 1000).cast("long")))),
            ("pct", F.when(gone, F.lit("0")).otherwise((F.col("q").cast("long") % 60 + 1).cast("string")))):
        body = F.replace(body, F.lit("{" + name + "}"), value)
    cik = F.col("nk").cast("string").alias("cik")
    covers = months.select("parent_ticker", cik, F.lit("SC 13G").alias("form"), "filing_date",
                           F.concat_ws("-", F.lit("g"), "mfgr", "filing_date").alias("accession_no"), body.alias("body"))
    years = owned.where("nk < 15").groupBy("parent_ticker", "nk", F.year("day").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    before = years.select("parent_ticker", (F.col("y") + 1).alias("y"), F.col("n").alias("m"))
    both = years.join(before, ["parent_ticker", "y"], "left")
    page = F.format_string(
        "<table><tr><td>As of</td><td>December 31, %d</td><td>December 31, %d</td></tr><tr><td>Non-marketable equity securities:</td></tr>"
        "<tr><td>Didi</td><td>$</td><td>%s</td><td>$</td><td>%,d</td></tr></table>",
        F.col("y") - 1, "y", F.format_string("%,d", F.coalesce("m", F.lit(1))), "n")
    reports = both.select("parent_ticker", cik, F.lit("10-K").alias("form"), F.make_date(F.col("y") + 1, F.lit(2), F.lit(10)).alias("filing_date"),
                          F.concat_ws("-", F.lit("k"), "y").alias("accession_no"), page.alias("body"))
    return covers.unionByName(reports)


def landed_history(spark, sf_dir) -> DataFrame:
    """All parents by their strategies, from landed payloads, filings and annual pages."""
    owned = stage(_parents(spark, sf_dir), "owned")
    cusips = owned.select(_cusip("mfgr").alias("cusip"), F.upper("mfgr").alias("ticker")).distinct()
    dims = load_dims(spark, cusips)
    years = owned.where("nk IN (20, 21)").groupBy("parent_ticker", F.year("day").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    pages = years.select("parent_ticker", F.make_date("y", F.lit(12), F.lit(31)).alias("as_of_date"), F.lit("u").alias("source_url"), F.format_string(
        "The fair value of our shareholdings in listed investee companies amounted to RMB%d.0 billion as at", "n").alias("text"))
    last = owned.select(F.max("day").alias("last")).scalar()
    none = lambda schema: spark.createDataFrame([], schema)
    stakes = valuation.add_usd(none("parent_ticker string, investee_ticker string, as_of date, investee_name string, ownership_pct double, "
                                    "value_to_parent_hkd_mn double, report_id string, citation string, source_url string"))
    return plan.history_of_parents(
        _payloads(owned), stage(_filings(owned), "landed-filings"), pages, dims, last, stakes, none("ticker string, date date, close double"),
        none("investee_ticker string, cutoff date"))


@query("history_of_parents", f"""WITH {_LANDED_SQL}
SELECT {_COLUMNS}, CASE WHEN parent_ticker IN ('TCEHY', 'TCTZF') THEN 'fanout_13g_hk' ELSE 'fanout_13f_13g_notes' END AS strategy,
  CASE WHEN parent_ticker IN (SELECT parent_ticker FROM grid13f) THEN '13f' ELSE '13g' END AS grid FROM full_rows""")
def history_of_parents(spark, sf_dir):
    note = F.coalesce("note", F.lit(""))
    source = F.when(note.contains("residual_of_aggregate"), "residual").when(note.contains("source=hk_annual"), "annual").when(
        note.contains("investments_table"), "note").when(note.contains("source=13g"), "13g").when(note.contains("source=sec_api_13f"), "13f")
    return landed_history(spark, sf_dir).select(
        "parent_ticker", "investee_ticker", "period_end", "action", "shares_held", "shares_prev", "market_value_usd",
        source.alias("src"), "composition_parent", "composition_as_of", "strategy", "grid")
