"""Reports, valuation, composition, quality and identity on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from posledger.bindings.registry import query
from posledger.bindings.views import (
    HIST, cents, ledger, msum, owned_lines, sql_cents, table,
)
from posledger.functions.numbers import scrub_pct_as_shares
from posledger.functions.valuation import RATIONALES, apply_gaap_and_adjustment, lifo_adjustment
from posledger.operators import identity, performance as perf, quality, reporting, valuation
from posledger.schemas import HISTORY_SCHEMA, conform
from posledger.sources.tables import stage


@query("portfolio_by_period", f"""WITH {HIST}
SELECT parent_ticker, period_end, upper(investee_ticker) AS investee_ticker, market_value_usd FROM hist WHERE action <> 'exit'""")
def portfolio_by_period(spark, sf_dir):
    return reporting.portfolio_by_period(ledger(spark, sf_dir))


@query("holdings_overview", f"""WITH {HIST}
SELECT parent_ticker, count(*) AS num_rows, count(DISTINCT investee_ticker) AS num_names,
       count(market_value_usd) AS num_valued, min(period_end) AS first_period, max(period_end) AS last_period
FROM hist GROUP BY ALL""")
def holdings_overview(spark, sf_dir):
    return reporting.holdings_overview(ledger(spark, sf_dir))


# Marks replace the value of brands ending in 4, so the stack shows both sources.
def _display_ledger(spark, sf_dir):
    hist = ledger(spark, sf_dir)
    marked = F.col("investee_ticker").endswith("4")
    return hist.withColumns({
        "mark_at_filing_est_usd": F.when(marked, F.col("shares_held") * 10.0),
        "market_value_usd": F.when(~marked, F.col("market_value_usd"))})


_DISPLAY = f"""{HIST},
shown AS (
  SELECT parent_ticker, period_end, upper(investee_ticker) AS investee_ticker, action, exited_period,
         CASE WHEN investee_ticker LIKE '%4' THEN shares_held * 10.0 ELSE market_value_usd END AS v FROM hist
),
stack AS (SELECT parent_ticker, period_end, investee_ticker, v AS display_value_usd FROM shown WHERE action <> 'exit' AND v IS NOT NULL)"""


@query("display_stack", f"WITH {_DISPLAY} SELECT * FROM stack")
def display_stack(spark, sf_dir):
    return reporting.display_stack(_display_ledger(spark, sf_dir))


_LOCF = f"""{_DISPLAY},
moved AS (SELECT parent_ticker, investee_ticker, display_value_usd, CAST(period_end + 20 AS DATE) AS period_end FROM stack),
span AS (SELECT parent_ticker, min(period_end) AS lo, max(period_end) AS hi FROM moved GROUP BY ALL),
exits AS (SELECT parent_ticker, investee_ticker, min(exited_period + 20) AS x FROM shown WHERE action = 'exit' GROUP BY ALL),
quarters AS (SELECT parent_ticker, CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS q
             FROM span, LATERAL (SELECT unnest(generate_series(date_trunc('quarter', lo), CAST(hi AS TIMESTAMP), INTERVAL 3 MONTH)) AS d) g
             WHERE CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) BETWEEN lo AND hi),
names AS (SELECT DISTINCT parent_ticker, investee_ticker FROM moved),
points AS (SELECT q.parent_ticker, n.investee_ticker, q.q FROM quarters q JOIN names n USING (parent_ticker)),
locf AS (SELECT p.parent_ticker, p.q AS period_end, p.investee_ticker, m.display_value_usd
         FROM points p ASOF JOIN moved m ON m.parent_ticker = p.parent_ticker AND m.investee_ticker = p.investee_ticker AND p.q >= m.period_end
         LEFT JOIN exits e ON e.parent_ticker = p.parent_ticker AND e.investee_ticker = p.investee_ticker
         WHERE e.x IS NULL OR p.q < e.x)"""


def _locf(spark, sf_dir):
    # Filing dates fall 20 days into the next quarter.
    hist = _display_ledger(spark, sf_dir).withColumns({
        "period_end": F.date_add("period_end", 20), "exited_period": F.date_add("exited_period", 20)})
    return reporting.quarterly_locf(stage(hist, "display-ledger"))


@query("quarterly_locf", f"WITH {_LOCF} SELECT * FROM locf")
def quarterly_locf(spark, sf_dir):
    return _locf(spark, sf_dir)


_RANKED = f"""{HIST},
long AS (SELECT period_end, upper(investee_ticker) AS investee_ticker, market_value_usd AS v FROM hist WHERE action <> 'exit'),
cells AS (SELECT period_end, investee_ticker, {msum('v')} AS v FROM long GROUP BY ALL),
sized AS (SELECT investee_ticker, max(CASE WHEN period_end = (SELECT max(period_end) FROM cells) THEN v END) AS latest_value,
                 max(v) AS max_value FROM cells GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (ORDER BY latest_value DESC NULLS LAST, max_value DESC, investee_ticker) AS series_rank FROM sized)"""


@query("rank_series", f"WITH {_RANKED} SELECT * FROM ranked WHERE series_rank <= 20")
def rank_series(spark, sf_dir):
    return reporting.rank_series(
        reporting.portfolio_by_period(ledger(spark, sf_dir)), "market_value_usd", top_n=20)


@query("top_series", f"""WITH {HIST},
long AS (SELECT parent_ticker, period_end, upper(investee_ticker) AS investee_ticker, market_value_usd FROM hist WHERE action <> 'exit'),
sized AS (SELECT parent_ticker, investee_ticker,
            max(CASE WHEN period_end = last THEN market_value_usd END) AS lv, max(market_value_usd) AS mv
          FROM (SELECT *, max(period_end) OVER (PARTITION BY parent_ticker) AS last FROM long) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY parent_ticker ORDER BY lv DESC NULLS LAST, mv DESC, investee_ticker) AS series_rank FROM sized)
SELECT l.*, r.series_rank FROM long l JOIN ranked r USING (parent_ticker, investee_ticker) WHERE series_rank <= 5 AND lv IS NOT NULL""")
def top_series(spark, sf_dir):
    return reporting.top_series(reporting.portfolio_by_period(ledger(spark, sf_dir)), "market_value_usd", 5)


@query("pivot_stack", f"""WITH {_RANKED}
SELECT c.period_end, {', '.join(f"round(coalesce(max(CASE WHEN series_rank = {i} THEN v END), 0.0) / 1000000.0, 2) AS s{i}" for i in range(1, 9))}
FROM cells c JOIN ranked r USING (investee_ticker) WHERE series_rank <= 8 GROUP BY ALL""")
def pivot_stack(spark, sf_dir):
    long = stage(reporting.portfolio_by_period(ledger(spark, sf_dir)), "portfolio")
    ranked = reporting.rank_series(long, "market_value_usd", top_n=8)
    named = long.join(ranked.select("investee_ticker", "series_rank"), "investee_ticker").withColumn(
        "investee_ticker", F.concat(F.lit("s"), F.col("series_rank").cast("string")))
    return reporting.pivot_stack(named, "market_value_usd", series=[f"s{i}" for i in range(1, 9)], exclude=())


@query("stake_wide", f"""WITH s AS (
  SELECT n_name AS series_id, p_brand AS investee_ticker, l_returnflag AS broker, make_date(year(l_shipdate), 12, 31) AS as_of,
         sum(l_quantity) AS stake FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
         JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT series_id, investee_ticker, broker,
  {', '.join(f"max(CASE WHEN as_of = DATE '{y}-12-31' THEN stake END) AS \"{y}-12-31\"" for y in range(1995, 2002))},
  {' + '.join(f"CASE WHEN max(CASE WHEN as_of = DATE '{y}-12-31' THEN stake END) IS NOT NULL THEN 1 ELSE 0 END" for y in range(1995, 2002))} AS n_vintages
FROM s GROUP BY ALL""")
def stake_wide(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    rows = owned_lines(spark, sf_dir, line).groupBy(
        F.col("n_name").alias("series_id"), F.col("p_brand").alias("investee_ticker"), F.col("l_returnflag").alias("broker"),
        F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31)).alias("as_of"),
    ).agg(F.sum("l_quantity").alias("ownership_pct"))
    # One column per vintage; the calendar bounds their number.
    rows = stage(rows, "stakes")
    return reporting.stake_wide(rows, [str(r.as_of) for r in rows.select("as_of").distinct().orderBy("as_of").collect()])


@query("duplicates", """SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, count(*) AS rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def duplicates(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("day"))
    return reporting.duplicates(line, ["l_suppkey", "day"])


# -- accounting ----------------------------------------------------------------------------------

_HINTS = ("cost", "equity_method", "", "fv_ni", "consolidated", "asc_321")


def _holdings(spark, sf_dir):
    """Suppliers hold parts: percentage from the part size, cost from the retail price."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    agg = line.groupBy("l_suppkey", "l_partkey").agg(cents("l_extendedprice").alias("value"), F.sum("l_quantity").alias("qty"))
    hint = F.element_at(F.array(*[F.lit(h) for h in _HINTS]), (F.col("p_partkey") % 6 + 1).cast("int"))
    return agg.join(part, agg.l_partkey == part.p_partkey).select(
        F.col("l_suppkey").cast("string").alias("parent_ticker"), F.col("p_partkey").cast("string").alias("investee_ticker"),
        (F.col("p_size") * 1.5).alias("ownership_pct"), hint.alias("filing_gaap_hint"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice") * F.col("qty")).alias("carrying_usd"),
        F.when(F.col("p_partkey") % 3 == 0, F.col("value") * 1.25).alias("fair_value_disclosed_usd"),
        F.col("value").alias("market_value_usd"), (F.col("p_size") % 7 == 0).alias("influence_disclosed"))


_GAAP = f"""h AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS parent_ticker, CAST(p_partkey AS VARCHAR) AS investee_ticker, p_size * 1.5 AS pct,
         (['cost', 'equity_method', '', 'fv_ni', 'consolidated', 'asc_321'])[p_partkey % 6 + 1] AS hint,
         CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice * qty END AS carrying,
         CASE WHEN p_partkey % 3 = 0 THEN value * 1.25 END AS fv, value, p_size % 7 = 0 AS infl
  FROM (SELECT l_suppkey, l_partkey, {sql_cents('l_extendedprice')} AS value, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL)
       JOIN part ON l_partkey = p_partkey
),
g AS (
  SELECT *, CASE WHEN pct < 0 OR pct IS NULL THEN 'unknown' WHEN pct < 20 THEN 'lt_20' WHEN pct < 50 THEN 'ge_20_lt_50' ELSE 'ge_50' END AS band,
    CASE WHEN hint = 'consolidated' OR pct >= 50 THEN 'consolidated'
         WHEN infl OR hint = 'equity_method' THEN 'equity_method'
         WHEN hint IN ('fv_ni', 'asc_321') THEN 'fv_ni'
         WHEN hint = 'cost' THEN 'measurement_alternative_cost'
         WHEN pct >= 20 THEN 'equity_method' ELSE 'fv_ni' END AS treatment,
    coalesce(fv, value) - carrying AS look FROM h
),
adj AS (
  SELECT *, treatment = 'measurement_alternative_cost' AND look IS NOT NULL AS included,
    CASE WHEN treatment = 'measurement_alternative_cost' THEN look WHEN look IS NOT NULL THEN 0.0 END AS suggested,
    CASE WHEN look IS NULL THEN 'unknown' WHEN look > 0 THEN 'above' WHEN look < 0 THEN 'below' ELSE 'flat' END AS mvc
  FROM g
)"""


_WHY = {k: v.replace("'", "''") for k, v in RATIONALES.items()}


@query("gaap_treatment", f"""WITH {_GAAP} SELECT parent_ticker, investee_ticker, band AS ownership_band, treatment AS gaap_treatment,
  included AS include_in_book_adj, suggested AS suggested_adj_usd, look AS lookthrough_mtm_usd, mvc AS market_vs_carrying,
  treatment <> 'measurement_alternative_cost' AS impacts_parent_ni, treatment = 'fv_ni' AS already_at_market,
  CASE treatment WHEN 'consolidated' THEN 'consolidated_subsidiary' WHEN 'equity_method' THEN 'equity_earnings'
    WHEN 'fv_ni' THEN 'fv_changes' ELSE 'none_until_sale' END AS ni_mechanism,
  CASE WHEN hint = 'consolidated' THEN '{_WHY['consolidated_disclosed']}' WHEN pct >= 50 THEN '{_WHY['consolidated_band']}'
    WHEN infl OR hint = 'equity_method' THEN '{_WHY['equity_disclosed']}' WHEN hint IN ('fv_ni', 'asc_321') THEN '{_WHY['fair_value_disclosed']}'
    WHEN hint = 'cost' THEN '{_WHY['cost_disclosed']}' WHEN pct >= 20 THEN '{_WHY['equity_band']}'
    ELSE '{_WHY['fair_value_band']}' END AS adj_rationale FROM adj""")
def gaap_treatment(spark, sf_dir):
    return apply_gaap_and_adjustment(_holdings(spark, sf_dir)).select(
        "parent_ticker", "investee_ticker", "ownership_band", "gaap_treatment", "include_in_book_adj",
        "suggested_adj_usd", "lookthrough_mtm_usd", "market_vs_carrying", "impacts_parent_ni", "already_at_market",
        "ni_mechanism", "adj_rationale")


@query("gaap_rollup", f"""WITH {_GAAP},
r AS (SELECT parent_ticker, count(*) AS holdings_count,
  coalesce({msum('CASE WHEN included THEN suggested END')}, 0.0) AS book_adj,
  coalesce({msum('CASE WHEN NOT included THEN look END')}, 0.0) AS holdings_lookthrough_mtm_usd,
  count(*) FILTER (mvc = 'above') AS holdings_above_count, count(*) FILTER (mvc = 'below') AS holdings_below_count,
  count(*) FILTER (treatment <> 'measurement_alternative_cost') AS holdings_ni_impact_count FROM adj GROUP BY ALL),
b AS (SELECT r.*, CASE WHEN s_suppkey % 4 > 0 THEN 50.0 + book_adj / ((s_suppkey % 4) * 1000000.0) WHEN book_adj = 0 THEN 50.0 END AS bvps
      FROM supplier JOIN r ON r.parent_ticker = CAST(s_suppkey AS VARCHAR))
SELECT parent_ticker, holdings_count, book_adj AS holdings_book_adj_usd, holdings_lookthrough_mtm_usd, holdings_above_count,
  holdings_below_count, holdings_ni_impact_count, bvps AS bvps_holdings_adj, CASE WHEN bvps > 0 THEN 20.0 / bvps END AS pb_holdings_adj FROM b""")
def gaap_rollup(spark, sf_dir):
    parents = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("parent_ticker"), F.lit(20.0).alias("price"), F.lit(50.0).alias("bvps"),
        ((F.col("s_suppkey") % 4) * 1_000_000.0).alias("shares"))
    return valuation.rollup_parent(apply_gaap_and_adjustment(_holdings(spark, sf_dir)), parents).where("holdings_count > 0")


@query("lifo_adjust", """WITH c AS (SELECT c_custkey, c_acctbal, (['US GAAP', 'IFRS', 'other', ''])[c_custkey % 4 + 1] AS basis,
  CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS reserve, count(o_orderkey) AS n,
  CAST(sum(CAST(floor(o_totalprice * 100.0 + 0.5) AS HUGEINT)) AS DOUBLE) / 100.0 AS total
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
k AS (SELECT *, CASE basis WHEN 'US GAAP' THEN 'US_GAAP' WHEN 'IFRS' THEN 'IFRS' WHEN 'other' THEN 'other' ELSE 'unclear' END AS kind,
  coalesce(basis <> 'IFRS' AND reserve > 0 AND total / 1000.0 > 0 AND n > 0, false) AS ok FROM c)
SELECT c_custkey, kind AS accounting_basis, CASE WHEN ok THEN reserve END AS lifo_reserve_usd,
  CASE WHEN ok THEN total / 1000.0 + reserve / n END AS adjusted_bvps,
  CASE WHEN ok THEN c_acctbal / (total / 1000.0 + reserve / n) END AS adjusted_pb_ratio,
  CASE WHEN kind = 'IFRS' THEN 'IFRS reporting basis: LIFO not permitted; LIFO→FIFO book adjustment not applied.'
       WHEN ok THEN NULL WHEN reserve IS NULL THEN 'LIFO reserve mentioned but no dollar amount; adjustment not applied.'
       ELSE 'LIFO reserve found but price/book/shares missing; adjustment not applied.' END AS quirk_notes FROM k""")
def lifo_adjust(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("n"), cents("o_totalprice").alias("total"))
    rows = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").na.fill(0, ["n"])
    basis = F.element_at(F.array(*[F.lit(b) for b in ("US GAAP", "IFRS", "other", "")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    adjusted = lifo_adjustment(
        basis, F.lit(True), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")), F.col("c_acctbal"),
        F.col("total") / 1000.0, F.col("n").cast("double"))
    return rows.select("c_custkey", adjusted.alias("a")).select("c_custkey", "a.*")


# -- overlay and composition ---------------------------------------------------------------------

def _broker(spark, sf_dir):
    """Yearly published stakes of brands ending in 2 or 5."""
    line = table(spark, sf_dir, "lineitem")
    return owned_lines(spark, sf_dir, line).where(F.col("p_brand").rlike("[25]$")).groupBy(
        F.col("n_name").alias("parent_ticker"), F.col("p_brand").alias("investee_ticker"),
        F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31)).alias("as_of"),
    ).agg(F.max("l_quantity").alias("ownership_pct"), cents("l_extendedprice").alias("value_usd")).withColumns({
        "investee_name": F.col("investee_ticker"), "fx": F.lit(7.8), "report_id": F.lit("r"),
        "citation": F.lit("c"), "source_url": F.lit(None).cast("string")})


def _sparse_ledger(spark, sf_dir):
    """Ledger in which brands ending in 2 never had a value."""
    hist = ledger(spark, sf_dir)
    return hist.withColumn("market_value_usd", F.when(
        ~F.col("investee_ticker").endswith("2"), F.col("market_value_usd")))


_OVERLAY = f"""{HIST},
brk AS (SELECT n_name AS parent_ticker, p_brand AS investee_ticker, make_date(year(l_shipdate), 12, 31) AS as_of,
               max(l_quantity) AS pct, {sql_cents('l_extendedprice')} AS usd
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
             JOIN part ON l_partkey = p_partkey WHERE regexp_matches(p_brand, '[25]$') GROUP BY ALL)"""


@query("overlay_values", f"""WITH {_OVERLAY}
SELECT coalesce(h.parent_ticker, b.parent_ticker) AS parent_ticker,
       CASE WHEN h.parent_ticker IS NULL THEN upper(b.investee_ticker) ELSE h.investee_ticker END AS investee_ticker,
       coalesce(h.period_end, b.as_of) AS period_end, coalesce(h.action, 'hold') AS action,
       coalesce(CASE WHEN h.action = 'exit' THEN 0.0 END, b.pct) AS ownership_pct,
       coalesce(CASE WHEN h.investee_ticker NOT LIKE '%2' THEN h.market_value_usd END, b.usd) AS market_value_usd,
       CASE WHEN b.usd IS NOT NULL AND (h.parent_ticker IS NULL OR h.investee_ticker LIKE '%2') THEN true ELSE false END AS stamped
FROM hist h FULL JOIN brk b ON h.parent_ticker = b.parent_ticker AND h.investee_ticker = b.investee_ticker AND h.period_end = b.as_of""")
def overlay_values(spark, sf_dir):
    return valuation.overlay_values(_sparse_ledger(spark, sf_dir), _broker(spark, sf_dir)).select(
        "parent_ticker", "investee_ticker", "period_end", "action", "ownership_pct", "market_value_usd",
        F.coalesce(F.col("note").contains("value_source=broker_sotp"), F.lit(False)).alias("stamped"))


def _aggregate_rows(spark, sf_dir):
    """Year-end totals of every nation as listed (and, in even years, unlisted) aggregates."""
    line = table(spark, sf_dir, "lineitem")
    year_end = F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31))
    totals = owned_lines(spark, sf_dir, line, brands=False).groupBy(
        F.col("n_name").alias("parent_ticker"), year_end.alias("period_end")).agg(cents("l_extendedprice").alias("v"))
    even = F.year("period_end") % 2 == 0
    bucket = F.when(even, F.lit("PRIV_HK_LISTED_INVESTEES_FV")).otherwise(F.lit("PRIV_HK_LISTED_ASSOCIATES"))
    return conform(totals.select(
        "parent_ticker", "period_end", F.col("period_end").alias("filing_date"), bucket.alias("investee_ticker"),
        bucket.alias("investee_name"), F.col("v").alias("market_value_usd"), F.lit("hold").alias("action"),
        F.col("period_end").alias("first_seen_period")), HISTORY_SCHEMA)


def _composed(spark, sf_dir):
    hist = stage(ledger(spark, sf_dir).unionByName(_aggregate_rows(spark, sf_dir)), "composed")
    return valuation.stamp_composition(hist)


_COMPOSED = f"""{HIST},
agg AS (SELECT n_name AS parent_ticker, make_date(year(l_shipdate), 12, 31) AS ye, {sql_cents('l_extendedprice')} AS v
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
agg2 AS (SELECT *, CASE WHEN year(ye) % 2 = 0 THEN 'PRIV_HK_LISTED_INVESTEES_FV' ELSE 'PRIV_HK_LISTED_ASSOCIATES' END AS bucket FROM agg),
live AS (SELECT * FROM hist WHERE action <> 'exit'),
eligible AS (
  SELECT a.parent_ticker, a.ye, a.bucket, a.v, l.investee_ticker, max(l.period_end) AS period_end
  FROM agg2 a JOIN live l ON l.parent_ticker = a.parent_ticker AND l.period_end <= a.ye GROUP BY ALL),
final AS (SELECT parent_ticker, investee_ticker, period_end, arg_max(bucket, ye) AS composition_parent,
                 max(ye) AS composition_as_of, arg_max(v, ye) AS pagg FROM eligible GROUP BY ALL),
named_rows AS (SELECT h.parent_ticker, h.investee_ticker, h.period_end, h.action, h.market_value_usd,
                 f.composition_parent, f.composition_as_of, f.pagg AS parent_aggregate_market_value_usd
               FROM hist h LEFT JOIN final f ON h.action <> 'exit' AND f.parent_ticker = h.parent_ticker
                AND f.investee_ticker = h.investee_ticker AND f.period_end = h.period_end),
composed AS (
  SELECT * FROM named_rows
  UNION ALL SELECT parent_ticker, bucket, ye, 'hold', v, NULL, NULL, NULL FROM agg2
  UNION ALL SELECT parent_ticker, bucket || '_RESIDUAL', ye, 'hold', v, bucket, ye, v FROM agg2)"""


@query("composition_stamp", f"WITH {_COMPOSED} SELECT * FROM composed")
def composition_stamp(spark, sf_dir):
    return _composed(spark, sf_dir).select(
        "parent_ticker", "investee_ticker", "period_end", "action", "market_value_usd", "composition_parent",
        "composition_as_of", "parent_aggregate_market_value_usd")


@query("composition_view", f"""WITH {_COMPOSED}
SELECT parent_ticker, composition_as_of AS period_end, composition_parent, upper(investee_ticker) AS child_ticker,
       market_value_usd AS child_market_value_usd, parent_aggregate_market_value_usd,
       CASE WHEN investee_ticker LIKE '%RESIDUAL' THEN 'residual_of_aggregate' ELSE 'row' END AS child_value_source
FROM composed WHERE composition_parent IS NOT NULL""")
def composition_view(spark, sf_dir):
    return valuation.composition_view(stage(_composed(spark, sf_dir), "stamped")).select(
        "parent_ticker", "period_end", "composition_parent", "child_ticker", "child_market_value_usd",
        "parent_aggregate_market_value_usd", "child_value_source")


@query("filing_marks", f"""WITH {HIST},
mx AS (SELECT *, investee_ticker LIKE '%7' AS disclosed FROM hist),
px AS (SELECT p_brand AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) + 14 AS date, max(l_extendedprice / l_quantity) AS close
       FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'A' GROUP BY ALL),
elig AS (SELECT * FROM mx WHERE action <> 'exit' AND shares_held > 0),
hit AS (SELECT e.*, p.close, p.date FROM elig e ASOF LEFT JOIN px p ON p.ticker = e.investee_ticker AND e.period_end >= p.date),
priced AS (SELECT *, CASE WHEN NOT disclosed AND period_end - date <= 21 THEN close END AS pr FROM hit),
mk AS (SELECT *, shares_held * pr AS mark FROM priced),
basis AS (
  SELECT *, coalesce(
    last_value(CASE WHEN mark IS NOT NULL AND action = 'new' THEN mark END IGNORE NULLS) OVER w,
    first_value(mark IGNORE NULLS) OVER w) AS b
  FROM mk WINDOW w AS (PARTITION BY parent_ticker, investee_ticker ORDER BY period_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT h.parent_ticker, h.investee_ticker, h.period_end, b.mark AS mark_at_filing_est_usd, b.b AS cost_basis_est_usd
FROM mx h LEFT JOIN basis b ON b.parent_ticker = h.parent_ticker AND b.investee_ticker = h.investee_ticker AND b.period_end = h.period_end""")
def filing_marks(spark, sf_dir):
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    prices = line.where("l_returnflag = 'A'").join(part, line.l_partkey == F.col("p_partkey")).groupBy(
        F.col("p_brand").alias("ticker"), F.date_add(F.trunc(F.col("l_shipdate").cast("date"), "month"), 14).alias("date")).agg(
        F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("close"))
    hist = ledger(spark, sf_dir)
    hist = hist.withColumn("market_value_usd", F.when(F.col("investee_ticker").endswith("7"), F.col("market_value_usd")))
    return valuation.filing_marks(stage(hist, "unpriced"), prices).select(
        "parent_ticker", "investee_ticker", "period_end", "mark_at_filing_est_usd", "cost_basis_est_usd")


# -- quality -------------------------------------------------------------------------------------

@query("dq_findings", f"""WITH {HIST},
d AS (SELECT parent_ticker, investee_ticker, period_end, action, shares_held,
             CASE WHEN investee_ticker LIKE '%1' AND period_end > DATE '2001-01-01' THEN shares_held ELSE 12.5 END AS pct,
             market_value_usd,
             CASE WHEN investee_ticker LIKE '%5' THEN 'source=13g; 13g_exit=1' WHEN investee_ticker LIKE '%6' THEN 'priced=shares*eodhd'
                  WHEN investee_ticker LIKE '%8' THEN 'source=13g shares_proxy=presence'
                  WHEN investee_ticker LIKE '%2' THEN 'value_estimate=eod_at_filing' ELSE '' END AS note,
             investee_ticker LIKE '%3' AND shares_held = 7 AS twice, investee_ticker LIKE '%4' AS estimated FROM hist)
SELECT check_id, count(*) AS findings FROM (
  SELECT 'ownership_pct_stuffed_into_shares_held' AS check_id FROM d WHERE shares_held > 0 AND shares_held <= 100 AND pct > 0 AND pct <= 100 AND abs(shares_held - pct) < 1e-6
  UNION ALL SELECT 'otc_invent_marker' FROM d WHERE note LIKE '%priced=shares*eodhd%'
  UNION ALL SELECT 'beneficial_ownership_used_as_value_source' FROM d WHERE market_value_usd > 0 AND note LIKE '%source=13g%'
  UNION ALL SELECT 'false_13g_exit_positive_stake' FROM d WHERE note LIKE '%13g_exit=1%' AND (pct > 0 OR shares_held > 0)
  UNION ALL SELECT 'shares_proxy_presence_invent' FROM d WHERE note LIKE '%shares_proxy=presence%'
  UNION ALL SELECT 'duplicate_ticker_same_period' FROM d WHERE twice
  UNION ALL SELECT 'estimate_missing_excluded_from_portfolio_mv' FROM d WHERE estimated
  UNION ALL SELECT 'eod_estimate_as_market_value' FROM d WHERE note = 'value_estimate=eod_at_filing' AND market_value_usd IS NOT NULL
  UNION ALL SELECT 'placeholder_exchange_like_ticker' FROM d WHERE investee_ticker = (SELECT max(p_brand) FROM part)
  UNION ALL SELECT 'overlay_exit_invented_zero' FROM d WHERE note LIKE '%source=13g%' AND action = 'exit' AND market_value_usd = 0
) GROUP BY ALL""")
def dq_findings(spark, sf_dir):
    t = F.col("investee_ticker")
    rows = stage(ledger(spark, sf_dir).withColumns({
        "ownership_pct": F.when(t.endswith("1") & (F.col("period_end") > F.lit("2001-01-01").cast("date")), F.col("shares_held")).otherwise(F.lit(12.5)),
        "note": F.when(t.endswith("5"), F.lit("source=13g; 13g_exit=1")).when(t.endswith("6"), F.lit("priced=shares*eodhd"))
        .when(t.endswith("8"), F.lit("source=13g shares_proxy=presence")).when(t.endswith("2"), F.lit("value_estimate=eod_at_filing"))
        .otherwise(F.lit("")),
        "cost_basis_est_usd": F.when(t.endswith("4"), F.lit(1.0)),
    }), "dq")
    twice = rows.unionByName(rows.where(t.endswith("3") & (F.col("shares_held") == 7)))
    deny = table(spark, sf_dir, "part").agg(F.max("p_brand").alias("ticker"))
    found = [quality.unique_period_ticker(twice), quality.pct_as_shares(rows), quality.estimates_in_value(rows),
             quality.invented_pricing(rows), quality.ownership_as_value_source(rows), quality.false_exit(rows),
             quality.presence_proxy(rows), quality.overlay_exit_zero(rows), quality.placeholder_tickers(rows, deny)]
    all_rows = found[0]
    for f in found[1:]:
        all_rows = all_rows.unionByName(f)
    return all_rows.groupBy("check_id").agg(F.count(F.lit(1)).alias("findings"))


@query("dq_verdict", f"""WITH {HIST},
bad AS (SELECT count(*) AS n FROM hist WHERE shares_held > 0 AND shares_held <= 100 AND shares_held = 12.0)
SELECT n = 0 AS ok, n AS n_fail, 0 AS n_warn, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS verdict FROM bad""")
def dq_verdict(spark, sf_dir):
    rows = ledger(spark, sf_dir).withColumn("ownership_pct", F.lit(12.0))
    return quality.verdict(quality.pct_as_shares(rows)).drop("score")


@query("scrub_pct_as_shares", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_quantity > 0 AND l_quantity <= 100 AND abs(l_quantity - 25) < 1e-6 THEN NULL ELSE l_quantity END AS shares_held,
  CASE WHEN l_quantity = 25 THEN l_returnflag || '; scrubbed_shares_eq_ownership_pct' ELSE l_returnflag END AS note FROM lineitem""")
def scrub(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("shares_held"), F.lit(25.0).alias("ownership_pct"),
        F.col("l_returnflag").alias("note"))
    return scrub_pct_as_shares(line).drop("ownership_pct")


# -- identity ------------------------------------------------------------------------------------

@query("resolve_identity", """WITH words AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS w FROM part),
aliases AS (SELECT w AS alias, 'W_' || upper(w) AS ticker, row_number() OVER (ORDER BY w) AS o FROM words WHERE w < 'p'),
names AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 9 = 0 THEN upper(p_brand) END AS own,
                 CASE WHEN p_partkey % 7 = 0 THEN 'C' || p_size END AS cusip FROM part),
hits AS (SELECT p_partkey, arg_min(ticker, o) AS t FROM names JOIN aliases ON contains(p_name, alias) OR contains(alias, p_name) GROUP BY ALL),
cus AS (SELECT DISTINCT 'C' || p_size AS cusip, 'S' || p_size AS ticker FROM part WHERE p_size <= 20)
SELECT n.p_partkey, coalesce(n.own, cus.ticker, h.t,
   CASE WHEN n.p_name LIKE '%ring%' THEN 'RING' WHEN n.p_name LIKE '%rod%' THEN 'PRIV_' || upper(replace(n.p_name, ' ', '_')) END) AS investee_ticker
FROM names n LEFT JOIN cus ON cus.cusip = n.cusip LEFT JOIN hits h ON h.p_partkey = n.p_partkey""")
def resolve_identity(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    word = F.split("p_name", " ")[1]
    vocabulary = part.select(word.alias("alias")).distinct().where("alias < 'p'")
    aliases = vocabulary.select("alias", F.concat(F.lit("W_"), F.upper("alias")).alias("ticker"), F.col("alias").alias("alias_order"))
    hints = spark.createDataFrame([("ring", "RING", "1"), ("rod", "", "2")], "alias string, ticker string, alias_order string")
    cusips = part.where("p_size <= 20").select(
        F.concat(F.lit("C"), F.col("p_size").cast("string")).alias("cusip"),
        F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("ticker")).distinct()
    rows = part.select(
        "p_partkey", F.col("p_name").alias("investee_name"),
        F.when(F.col("p_partkey") % 9 == 0, F.col("p_brand")).alias("investee_ticker"),
        F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("C"), F.col("p_size").cast("string"))).alias("cusip"))
    return identity.resolve_identity(rows, cusips, aliases, hints).select("p_partkey", "investee_ticker")


@query("drop_self_issuer", """SELECT s_suppkey, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE NOT contains(lower(s_name || ' of ' || n_name), CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE 'zzz' || n_nationkey END)
  AND NOT contains(lower(s_name), '#00000000' || (n_nationkey % 10))""")
def drop_self_issuer(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    number = F.col("n_nationkey").cast("string")
    parent = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.concat(F.lit("zzz"), number))
    rows = s.join(n, s.s_nationkey == n.n_nationkey).select(
        "s_suppkey", "s_name", F.concat("s_name", F.lit(" of "), "n_name").alias("investee_name"),
        F.lit(None).cast("string").alias("investee_ticker"), parent.alias("parent_ticker"))
    # One further name fragment per parent, so the hint table stays as small as the parents.
    hints = n.select(parent.alias("parent_ticker"), F.concat(
        F.lit("#00000000"), (F.col("n_nationkey") % 10).cast("string")).alias("hint"))
    return identity.drop_self_issuer(rows, hints).select("s_suppkey", "s_name")


@query("child_flags", f"""WITH t AS (SELECT DISTINCT CASE WHEN p_size % 5 = 0 THEN 'PRIV_HK_' || upper(p_type) || '_RESIDUAL'
   WHEN p_size % 5 = 1 THEN 'PRIV_' || upper(p_type) WHEN p_size % 5 = 2 THEN 'HK' ELSE p_brand END AS ticker,
   CASE WHEN p_size % 11 = 0 THEN 'excluded_from_portfolio_mv' ELSE 'x' END AS note FROM part)
SELECT ticker, note, ticker LIKE 'PRIV_HK_%_RESIDUAL' OR note LIKE '%excluded_from_portfolio_mv%' AS excluded,
  NOT (ticker LIKE 'PRIV\\_%' ESCAPE '\\' OR ticker = 'HK') AS priceable FROM t""")
def child_flags(spark, sf_dir):
    size = F.col("p_size") % 5
    rows = table(spark, sf_dir, "part").select(
        F.when(size == 0, F.concat(F.lit("PRIV_HK_"), F.upper("p_type"), F.lit("_RESIDUAL")))
        .when(size == 1, F.concat(F.lit("PRIV_"), F.upper("p_type"))).when(size == 2, F.lit("HK"))
        .otherwise(F.col("p_brand")).alias("ticker"),
        F.when(F.col("p_size") % 11 == 0, F.lit("excluded_from_portfolio_mv")).otherwise(F.lit("x")).alias("note")).distinct()
    return rows.select("ticker", "note", perf.excluded_from_portfolio("ticker", "note").alias("excluded"),
                       valuation.is_public_priceable("ticker").alias("priceable"))
