"""Flows, disposals and returns on the ledger of the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from posledger.bindings.registry import query
from posledger.bindings.views import HIST, ledger, msum, msum_over, table
from posledger.operators import performance as perf
from posledger.sources.tables import stage

# Brands ending in 3 disclose a value only, so they exercise coverage flows and series breaks.
_NAMED = "investee_ticker NOT LIKE '%3'"


def mixed_ledger(spark, sf_dir):
    hist = ledger(spark, sf_dir)
    only = F.col("investee_ticker").endswith("3")
    return stage(hist.withColumns({
        c: F.when(~only, F.col(c)) for c in ("shares_held", "shares_prev", "shares_delta")}), "mixed-ledger")


MIXED = f"""{HIST},
mixed AS (
  SELECT parent_ticker, upper(investee_ticker) AS t, period_end, action, market_value_usd AS mv, value_prev,
         CASE WHEN {_NAMED} THEN shares_held END AS shares_held,
         CASE WHEN {_NAMED} THEN shares_prev END AS shares_prev,
         CASE WHEN {_NAMED} THEN shares_delta END AS shares_delta
  FROM hist
),
led AS (
  SELECT *,
    coalesce(shares_delta, CASE WHEN action = 'exit' THEN -coalesce(shares_prev, 0.0)
             ELSE coalesce(shares_held, 0.0) - coalesce(shares_prev, 0.0) END) AS delta,
    CASE WHEN shares_held > 0 THEN mv / shares_held
         WHEN action = 'exit' AND shares_prev > 0 THEN value_prev / shares_prev END AS px
  FROM mixed
)"""

EVENTS = """trades AS (
  SELECT *, CASE WHEN delta > 0 AND px IS NOT NULL THEN delta ELSE 0.0 END AS b,
            CASE WHEN delta < 0 AND px IS NOT NULL THEN -delta ELSE 0.0 END AS s FROM led
),
run AS (
  SELECT *, sum(b) OVER w AS a, sum(s) OVER w AS n, """ + msum_over(
    "b * px", "PARTITION BY parent_ticker, t ORDER BY period_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW") + """ AS cost_in
  FROM trades WHERE b > 0 OR s > 0
  WINDOW w AS (PARTITION BY parent_ticker, t ORDER BY period_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
capped AS (
  SELECT *, n - greatest(0.0, max(n - a) OVER (PARTITION BY parent_ticker, t ORDER BY period_end
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS c FROM run
),
buys AS (SELECT parent_ticker, t, period_end AS opened, px AS lot_px, a - b AS lo, a AS hi FROM capped WHERE b > 0),
sells AS (
  SELECT *, coalesce(lag(c) OVER (PARTITION BY parent_ticker, t ORDER BY period_end), 0.0) AS c_prev
  FROM capped WHERE s > 0
),
fifo AS (
  SELECT x.parent_ticker, x.t, x.period_end, least(b.hi, x.c) - greatest(b.lo, x.c_prev) AS qty,
         b.lot_px, x.px AS exit_px, b.opened
  FROM sells x JOIN buys b ON b.parent_ticker = x.parent_ticker AND b.t = x.t
   AND b.lo < x.c AND b.hi > x.c_prev
),
taken AS (SELECT parent_ticker, t, period_end, sum(CAST(floor(qty * lot_px * 10000.0 + 0.5) AS HUGEINT)) AS m, min(opened) AS oldest
          FROM fifo GROUP BY parent_ticker, t, period_end),
avg_rows AS (
  SELECT x.*, k.oldest, CAST(coalesce(sum(k.m) OVER (PARTITION BY x.parent_ticker, x.t ORDER BY x.period_end
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / 10000.0 AS used
  FROM sells x LEFT JOIN taken k ON k.parent_ticker = x.parent_ticker AND k.t = x.t AND k.period_end = x.period_end
),
events AS (
  SELECT parent_ticker, period_end, t, qty AS shares_sold, lot_px AS cost_px, exit_px,
         qty * (exit_px - lot_px) AS pnl, 'fifo' AS method, opened FROM fifo
  UNION ALL
  SELECT parent_ticker, period_end, t, -delta, (cost_in - used) / (a - c_prev), px,
         -delta * (px - (cost_in - used) / (a - c_prev)), 'avg', oldest
  FROM avg_rows WHERE a - c_prev > 0
)"""

_QUARTERS = ("greatest(0, CAST(round_even(((year(period_end) - year(opened)) * 12 + month(period_end)"
             " - month(opened)) / 3.0, 0) AS INTEGER))")


def _realized_sql(method: str) -> str:
    return f"""WITH {MIXED}, {EVENTS}
SELECT parent_ticker, period_end, t AS investee_ticker, shares_sold, cost_px, exit_px, pnl AS realized_pnl_est,
       opened AS lot_opened_period, {_QUARTERS} AS holding_periods
FROM events WHERE method = '{method}'"""


def _realized(spark, sf_dir, method):
    events = perf.realized_events(mixed_ledger(spark, sf_dir))
    return events.where(F.col("cost_method") == method).select(
        "parent_ticker", "period_end", "investee_ticker", "shares_sold", "cost_px", "exit_px",
        "realized_pnl_est", "lot_opened_period", "holding_periods")


@query("realized_avg", _realized_sql("avg"))
def realized_avg(spark, sf_dir):
    return _realized(spark, sf_dir, "avg")


@query("realized_fifo", _realized_sql("fifo"))
def realized_fifo(spark, sf_dir):
    return _realized(spark, sf_dir, "fifo")


@query("realized_by_ticker", f"""WITH {MIXED}, {EVENTS},
totals AS (SELECT parent_ticker, t AS investee_ticker, {msum('pnl')} AS usd FROM events WHERE method = 'avg' GROUP BY ALL)
SELECT parent_ticker, investee_ticker, round(usd / 1000000.0, 6) AS realized_pnl_m FROM totals WHERE abs(usd) >= 10000
QUALIFY row_number() OVER (PARTITION BY parent_ticker ORDER BY abs(usd) DESC, investee_ticker) <= 5""")
def realized_by_ticker(spark, sf_dir):
    events = perf.realized_events(mixed_ledger(spark, sf_dir))
    return perf.realized_by_ticker(events, max_tickers=5, min_abs_usd=10_000).withColumn(
        "realized_pnl_m", F.round("realized_pnl_m", 6))


FLOWS = f"""port AS (
  SELECT parent_ticker, period_end, {msum('mv')} AS end_mv FROM led
  WHERE action <> 'exit' AND mv IS NOT NULL GROUP BY ALL
),
share_flow AS (
  SELECT parent_ticker, period_end, t, delta * px AS f, false AS broken FROM led
  WHERE px IS NOT NULL AND abs(delta) >= 1e-12
),
based AS (SELECT DISTINCT parent_ticker, t FROM led WHERE shares_held > 0 OR shares_prev > 0),
pidx AS (SELECT parent_ticker, period_end, row_number() OVER (PARTITION BY parent_ticker ORDER BY period_end) AS i
         FROM port),
cover AS (
  SELECT l.parent_ticker, l.t, p.i, l.mv AS v FROM led l JOIN pidx p USING (parent_ticker, period_end)
  ANTI JOIN based b ON b.parent_ticker = l.parent_ticker AND b.t = l.t
  WHERE l.action <> 'exit' AND l.mv IS NOT NULL
),
change AS (
  SELECT coalesce(c.parent_ticker, p.parent_ticker) AS parent_ticker, coalesce(c.t, p.t) AS t,
         coalesce(c.i, p.i + 1) AS i, c.v AS cv, p.v AS pv
  FROM cover c FULL JOIN cover p ON c.parent_ticker = p.parent_ticker AND c.t = p.t AND c.i = p.i + 1
),
breaks AS (SELECT parent_ticker, i, bool_or(pv IS NULL) AND bool_or(cv IS NULL) AS broken FROM change GROUP BY ALL),
cover_flow AS (
  SELECT c.parent_ticker, p.period_end, c.t,
         CASE WHEN b.broken THEN 0.0 WHEN c.pv IS NULL THEN c.cv ELSE -c.pv END AS f, b.broken
  FROM change c JOIN breaks b ON b.parent_ticker = c.parent_ticker AND b.i = c.i
       JOIN pidx p ON p.parent_ticker = c.parent_ticker AND p.i = c.i
  WHERE c.pv IS NULL OR c.cv IS NULL
),
flow AS (
  SELECT parent_ticker, period_end, t, {msum('f')} AS flow, bool_or(broken) AS series_break
  FROM (SELECT * FROM share_flow UNION ALL SELECT * FROM cover_flow) GROUP BY ALL
)"""


@query("portfolio_value", f"WITH {MIXED}, {FLOWS} SELECT parent_ticker, period_end, end_mv AS portfolio_mv FROM port")
def portfolio_value(spark, sf_dir):
    return perf.portfolio_value(ledger(spark, sf_dir))


@query("flows", f"WITH {MIXED}, {FLOWS} SELECT parent_ticker, period_end, t AS ticker, flow, series_break FROM flow")
def flows(spark, sf_dir):
    return perf.flows(mixed_ledger(spark, sf_dir))


RETURNS = f"""{FLOWS}, {EVENTS},
per_flow AS (SELECT parent_ticker, period_end, {msum('flow')} AS net, bool_or(series_break) AS broken FROM flow GROUP BY ALL),
real AS (SELECT parent_ticker, period_end,
           coalesce({msum("CASE WHEN method = 'avg' THEN pnl END")}, 0.0) AS ra,
           coalesce({msum("CASE WHEN method = 'fifo' THEN pnl END")}, 0.0) AS rf FROM events GROUP BY ALL),
base AS (
  SELECT p.parent_ticker, p.period_end, p.end_mv, coalesce(f.net, 0.0) AS net, coalesce(f.broken, false) AS broken,
         coalesce(r.ra, 0.0) AS ra, coalesce(r.rf, 0.0) AS rf,
         lag(p.end_mv) OVER (PARTITION BY p.parent_ticker ORDER BY p.period_end) AS start_mv
  FROM port p LEFT JOIN per_flow f ON f.parent_ticker = p.parent_ticker AND f.period_end = p.period_end
       LEFT JOIN real r ON r.parent_ticker = p.parent_ticker AND r.period_end = p.period_end
),
flagged AS (
  SELECT *, broken AND start_mv IS NOT NULL AS is_break, start_mv IS NULL OR broken AS fresh FROM base
),
seg AS (
  SELECT *, sum(CASE WHEN is_break THEN 1 ELSE 0 END) OVER (PARTITION BY parent_ticker ORDER BY period_end
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS segment,
         CASE WHEN NOT fresh AND abs(start_mv + net / 2.0) >= 1e-6
              THEN (end_mv - start_mv - net) / (start_mv + net / 2.0) END AS dietz FROM flagged
),
returns AS (
  SELECT parent_ticker, period_end, CASE WHEN NOT fresh THEN start_mv END AS portfolio_mv_start,
    end_mv AS portfolio_mv_end, CASE WHEN fresh THEN end_mv ELSE net END AS net_external_flow,
    CASE WHEN fresh THEN 0.0 ELSE end_mv - start_mv - net END AS mtm_pnl, ra, rf, dietz,
    {msum_over('rf', 'PARTITION BY parent_ticker ORDER BY period_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')} AS cum_fifo,
    CASE WHEN start_mv IS NULL THEN NULL WHEN is_break THEN 1.0 ELSE
      product(1.0 + coalesce(dietz, 0.0)) OVER (PARTITION BY parent_ticker, segment ORDER BY period_end
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS growth, is_break
  FROM seg
)"""


def _returns(spark, sf_dir):
    return perf.portfolio_returns(mixed_ledger(spark, sf_dir))


@query("portfolio_returns", f"""WITH {MIXED}, {RETURNS}
SELECT parent_ticker, period_end, portfolio_mv_start, portfolio_mv_end, net_external_flow, mtm_pnl,
       round(ra, 2) AS realized_pnl_avg_est, rf AS realized_pnl_fifo_est, dietz AS dietz_return,
       cum_fifo AS cum_realized_pnl_fifo_est, round(growth, 6) AS cum_dietz_growth, is_break AS series_break FROM returns""")
def portfolio_returns(spark, sf_dir):
    return _returns(spark, sf_dir).select(
        "parent_ticker", "period_end", "portfolio_mv_start", "portfolio_mv_end", "net_external_flow", "mtm_pnl",
        F.round("realized_pnl_avg_est", 2).alias("realized_pnl_avg_est"), "realized_pnl_fifo_est", "dietz_return",
        "cum_realized_pnl_fifo_est", F.round("cum_dietz_growth", 6).alias("cum_dietz_growth"),
        F.col("note").contains("series_break").alias("series_break"))


@query("linked_cagr", f"""WITH {MIXED}, {RETURNS},
ends AS (
  SELECT parent_ticker, min(period_end) AS first_p, max(CASE WHEN growth IS NOT NULL THEN period_end END) AS end_period,
         max(CASE WHEN is_break THEN period_end END) AS break_p,
         arg_max(growth, CASE WHEN growth IS NOT NULL THEN period_end END) AS cum_end FROM returns GROUP BY ALL
),
spans AS (SELECT *, CASE WHEN end_period IS NULL THEN NULL WHEN break_p <= end_period THEN break_p ELSE first_p END AS start_period FROM ends)
SELECT parent_ticker, start_period, end_period, round(cum_end, 6) AS cum_end,
       round(CASE WHEN (end_period - start_period) / 365.25 > 0 AND cum_end > 0
             THEN pow(cum_end, 1.0 / ((end_period - start_period) / 365.25)) - 1.0 END, 6) AS cagr FROM spans""")
def linked_cagr(spark, sf_dir):
    return perf.linked_cagr(_returns(spark, sf_dir)).select(
        "parent_ticker", "start_period", "end_period", F.round("cum_end", 6).alias("cum_end"),
        F.round("cagr", 6).alias("cagr"))


@query("returns_chart", f"""WITH {MIXED}, {RETURNS}
SELECT parent_ticker, period_end, round(dietz * 100.0, 6) AS dietz_return_pct, round(growth, 6) AS cum_growth_index FROM returns""")
def returns_chart(spark, sf_dir):
    return perf.returns_chart(_returns(spark, sf_dir)).select(
        "parent_ticker", "period_end", F.round("dietz_return_pct", 6).alias("dietz_return_pct"),
        F.round("cum_growth_index", 6).alias("cum_growth_index"))


@query("realized_chart", f"""WITH {MIXED}, {RETURNS}
SELECT parent_ticker, period_end, round(ra / 1000000.0, 6) AS realized_pnl_qoq_m,
  round({msum_over('ra', 'PARTITION BY parent_ticker ORDER BY period_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')} / 1000000.0, 6) AS cum_realized_pnl_m
FROM returns""")
def realized_chart(spark, sf_dir):
    return perf.realized_chart(_returns(spark, sf_dir)).select(
        "parent_ticker", "period_end", F.round("realized_pnl_qoq_m", 6).alias("realized_pnl_qoq_m"),
        F.round("cum_realized_pnl_m", 6).alias("cum_realized_pnl_m"))


@query("returns_chart_with_footer", f"""WITH {MIXED}, {RETURNS},
chart AS (SELECT parent_ticker, row_number() OVER (PARTITION BY parent_ticker ORDER BY period_end) AS line_no,
            CAST(period_end AS VARCHAR) AS period_end, round(dietz * 100.0, 6) AS dietz_return_pct, round(growth, 6) AS cum_growth_index FROM returns),
ends AS (
  SELECT parent_ticker, min(period_end) AS first_p, max(CASE WHEN growth IS NOT NULL THEN period_end END) AS end_period, count(*) AS n,
         max(CASE WHEN is_break THEN period_end END) AS break_p,
         arg_max(growth, CASE WHEN growth IS NOT NULL THEN period_end END) AS cum_end FROM returns GROUP BY ALL),
spans AS (SELECT *, CASE WHEN end_period IS NULL THEN NULL WHEN break_p <= end_period THEN break_p ELSE first_p END AS start_period FROM ends),
rated AS (SELECT *, (end_period - start_period) / 365.25 AS years, CASE WHEN (end_period - start_period) / 365.25 > 0 AND cum_end > 0
            THEN pow(cum_end, 1.0 / ((end_period - start_period) / 365.25)) - 1.0 END AS cagr FROM spans)
SELECT * FROM chart
UNION ALL SELECT parent_ticker, n + 1, '', NULL, NULL FROM rated
UNION ALL SELECT parent_ticker, n + 2, 'CAGR (estimated Dietz)', round(cagr * 100.0, 6), NULL FROM rated
UNION ALL SELECT parent_ticker, n + 3, CASE WHEN cagr IS NULL THEN 'note=estimated; Modified Dietz; not tax/GAAP' ELSE
  printf('years=%.2f; ', years) || start_period || '→' || end_period || '; estimated; Modified Dietz; not tax/GAAP' END, NULL, NULL FROM rated""")
def returns_chart_with_footer(spark, sf_dir):
    return perf.returns_chart_with_footer(_returns(spark, sf_dir)).select(
        "parent_ticker", "line_no", "period_end", F.round("dietz_return_pct", 6).alias("dietz_return_pct"),
        F.round("cum_growth_index", 6).alias("cum_growth_index"))


@query("mtm_identity", f"""WITH {MIXED}, {RETURNS}
SELECT parent_ticker, count(*) AS periods,
  count(*) FILTER (abs(mtm_pnl + CASE WHEN month(period_end) = 3 THEN 5 ELSE 0 END - (portfolio_mv_end - portfolio_mv_start - net_external_flow)) > 1) AS violations
FROM returns GROUP BY ALL""")
def mtm_identity(spark, sf_dir):
    # Every first quarter is off by five dollars, so there is something to find.
    planted = F.col("mtm_pnl") + F.when(F.month("period_end") == 3, 5.0).otherwise(0.0)
    rows = stage(_returns(spark, sf_dir).withColumn("mtm_pnl", planted), "returns")
    bad = perf.mtm_identity_breaks(rows).groupBy("parent_ticker").agg(F.count(F.lit(1)).alias("violations"))
    return rows.groupBy("parent_ticker").agg(F.count(F.lit(1)).alias("periods")).join(
        bad, "parent_ticker", "left").na.fill(0, ["violations"])


@query("holding_returns", f"""WITH {MIXED}, {RETURNS},
held AS (SELECT l.parent_ticker, l.t, p.i, l.mv FROM led l JOIN pidx p USING (parent_ticker, period_end)
         WHERE l.action <> 'exit' AND l.mv IS NOT NULL),
pairs AS (SELECT coalesce(c.parent_ticker, p.parent_ticker) AS parent_ticker, coalesce(c.t, p.t) AS t,
            coalesce(c.i, p.i + 1) AS i, coalesce(c.mv, 0.0) AS end_mv, coalesce(p.mv, 0.0) AS start_mv
          FROM held c FULL JOIN held p ON c.parent_ticker = p.parent_ticker AND c.t = p.t AND c.i = p.i + 1),
named AS (SELECT a.*, p.period_end, o.end_mv AS port_end, coalesce(f.flow, 0.0) AS net, coalesce(b.broken, false) AS broken
          FROM pairs a JOIN pidx p ON p.parent_ticker = a.parent_ticker AND p.i = a.i
          JOIN port o ON o.parent_ticker = a.parent_ticker AND o.period_end = p.period_end
          LEFT JOIN flow f ON f.parent_ticker = a.parent_ticker AND f.period_end = p.period_end AND f.t = a.t
          LEFT JOIN per_flow b ON b.parent_ticker = a.parent_ticker AND b.period_end = p.period_end),
kept AS (SELECT *, CASE WHEN start_mv > 0 AND abs(start_mv + net / 2.0) >= 1e-6
                        THEN (end_mv - start_mv - net) / (start_mv + net / 2.0) END AS d FROM named
         WHERE NOT (start_mv <= 0 AND end_mv <= 0 AND abs(net) < 1e-6) AND NOT (broken AND end_mv <= 0 AND start_mv > 0))
SELECT parent_ticker, period_end, t AS investee_ticker, CASE WHEN end_mv > 0 THEN end_mv END AS market_value_usd,
       CASE WHEN port_end > 0 THEN end_mv / port_end END AS weight, d AS holding_dietz_return,
       CASE WHEN port_end > 0 THEN end_mv / port_end END * d AS contribution,
       CASE WHEN start_mv > 0 THEN end_mv - start_mv - net ELSE 0.0 END AS mtm_pnl FROM kept""")
def holding_returns(spark, sf_dir):
    return perf.holding_returns(mixed_ledger(spark, sf_dir)).select(
        "parent_ticker", "period_end", "investee_ticker", "market_value_usd", "weight", "holding_dietz_return",
        "contribution", "mtm_pnl")


@query("reported_vs_estimated", f"""WITH {MIXED}, {RETURNS},
income AS (SELECT parent_ticker, 'FY' || CAST(y AS VARCHAR) AS period_label, make_date(y, 3, 31) AS calendar_end,
                  make_date(y - 1, 4, 1) AS calendar_start, y * 1000.0 AS amount
           FROM (SELECT DISTINCT parent_ticker FROM port), (SELECT unnest(range((SELECT year(min(l_shipdate)) + 1 FROM lineitem), (SELECT year(max(l_shipdate)) + 1 FROM lineitem))) AS y))
SELECT i.parent_ticker, i.period_label, i.amount AS company_reported_usd,
       coalesce({msum('r.mtm_pnl')}, 0.0) AS our_mtm_sum_usd,
       coalesce({msum('r.mtm_pnl')}, 0.0) - any_value(i.amount) AS residual_usd
FROM income i LEFT JOIN returns r ON r.parent_ticker = i.parent_ticker
 AND r.period_end BETWEEN i.calendar_start AND i.calendar_end
GROUP BY i.parent_ticker, i.period_label, i.amount""")
def reported_vs_estimated(spark, sf_dir):
    returns = stage(_returns(spark, sf_dir), "returns")
    span = table(spark, sf_dir, "lineitem").agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    year = F.explode(F.sequence(span.select(F.year("lo") + 1).scalar(), span.select(F.year("hi")).scalar()))
    income = returns.select("parent_ticker").distinct().select("parent_ticker", year.alias("y")).select(
        "parent_ticker", F.concat(F.lit("FY"), F.col("y").cast("string")).alias("period_label"),
        F.make_date("y", F.lit(3), F.lit(31)).alias("calendar_end"),
        F.make_date(F.col("y") - 1, F.lit(4), F.lit(1)).alias("calendar_start"),
        F.make_date("y", F.lit(3), F.lit(31)).alias("fiscal_year_end"),
        (F.col("y") * 1000.0).alias("amount_usd"), F.lit(None).cast("double").alias("amount_rmb_million"))
    return perf.reported_vs_estimated(income, returns).select(
        "parent_ticker", "period_label", "company_reported_usd", "our_mtm_sum_usd", "residual_usd")
