"""Published reports of the driver tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from posledger.bindings.performance import MIXED, RETURNS, mixed_ledger
from posledger.bindings.registry import ORACLES, query
from posledger.bindings.views import msum, qend, table
from posledger.functions.dates import lookback_start, quarter_end
from posledger.operators import quality
from posledger.plans import export
from posledger.sources.tables import shared_folder

#: What is compared of each published table: period, name, value, quantity, label.
SHOWN = {
    "current": ("as_of_date", "investee_ticker", "market_value_usd", "shares_held", "confidence"),
    "history": ("period_end", "investee_ticker", "market_value_usd", "shares_held", "action"),
    "portfolio": ("period_end", "investee_ticker", "market_value_usd", None, None),
    "holdings_qoq_chart": ("period_end", "investee_ticker", "value_usd", None, "chart_basis"),
    "returns_by_period": ("period_end", None, "mtm_pnl", "cum_dietz_growth", None),
    "realized_pnl_qoq": ("period_end", "investee_ticker", "realized_pnl_est", "shares_sold", "cost_method"),
    "holding_returns": ("period_end", "investee_ticker", "mtm_pnl", "weight", None),
    "reported_vs_est": ("fiscal_year_end", None, "residual_usd", "our_mtm_sum_usd", "period_label"),
    "rollups": ("as_of_date", None, "holdings_lookthrough_mtm_usd", "holdings_count", "extract_error"),
}

_SPAN = f"(SELECT max({qend('l_shipdate')}) AS last, year(min(l_shipdate)) AS y0, year(max(l_shipdate)) AS y1 FROM lineitem)"
_EXPORT_SQL = f"""WITH {MIXED}, {RETURNS},
win AS (SELECT n_name AS parent_ticker,
          CAST(CASE WHEN n_name LIKE '%0' THEN last - INTERVAL 2 YEAR ELSE last - INTERVAL 5 YEAR END AS DATE) AS start FROM nation, {_SPAN}),
inside AS (SELECT m.* FROM mixed m JOIN win w ON w.parent_ticker = m.parent_ticker AND m.period_end >= w.start),
open AS (SELECT * FROM mixed QUALIFY row_number() OVER (PARTITION BY parent_ticker, t ORDER BY period_end DESC) = 1),
live AS (SELECT * FROM open WHERE action <> 'exit'),
stack AS (SELECT * FROM inside WHERE action <> 'exit' AND mv IS NOT NULL),
bounds AS (SELECT parent_ticker, min(period_end) AS lo, max(period_end) AS hi FROM stack GROUP BY ALL),
gone AS (SELECT parent_ticker, t, min(period_end) AS x FROM inside WHERE action = 'exit' GROUP BY ALL),
points AS (SELECT b.parent_ticker, n.t, CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS q
           FROM bounds b, LATERAL (SELECT unnest(generate_series(date_trunc('quarter', lo), CAST(hi AS TIMESTAMP), INTERVAL 3 MONTH)) AS d) g,
                (SELECT DISTINCT parent_ticker, t FROM stack) n WHERE n.parent_ticker = b.parent_ticker),
chart AS (SELECT p.parent_ticker, p.q, p.t, s.mv FROM points p
          ASOF JOIN stack s ON s.parent_ticker = p.parent_ticker AND s.t = p.t AND p.q >= s.period_end
          LEFT JOIN gone g ON g.parent_ticker = p.parent_ticker AND g.t = p.t WHERE g.x IS NULL OR p.q < g.x),
income AS (SELECT parent_ticker, y, y * 1000.0 AS amount FROM (SELECT DISTINCT parent_ticker FROM hist),
             (SELECT unnest(range(y0 + 1, y1 + 1)) AS y FROM {_SPAN})),
reported AS (SELECT i.parent_ticker, i.y, coalesce({msum('r.mtm_pnl')}, 0.0) AS ours, any_value(i.amount) AS amount
             FROM income i LEFT JOIN returns r ON r.parent_ticker = i.parent_ticker
               AND r.period_end BETWEEN make_date(i.y - 1, 4, 1) AND make_date(i.y, 3, 31) GROUP BY ALL)
SELECT 'current' AS table_name, parent_ticker, period_end, replace(t, 'BRAND', 'Brand') AS investee_ticker, mv AS value, shares_held AS quantity, 'history_slice' AS label FROM live
UNION ALL SELECT 'history', parent_ticker, period_end, t, mv, shares_held, action FROM mixed
UNION ALL SELECT 'portfolio', parent_ticker, period_end, t, mv, NULL, NULL FROM stack
UNION ALL SELECT 'holdings_qoq_chart', parent_ticker, q, t, mv, NULL, 'display_estimate_or_broker' FROM chart
UNION ALL SELECT 'returns_by_period', r.parent_ticker, r.period_end, NULL, r.mtm_pnl, round(r.growth, 6), NULL
          FROM returns r JOIN win w ON w.parent_ticker = r.parent_ticker AND r.period_end >= w.start
UNION ALL SELECT 'realized_pnl_qoq', parent_ticker, period_end, t, pnl, round(shares_sold, 6), method FROM events
UNION ALL SELECT 'holding_returns', parent_ticker, period_end, investee_ticker, mtm_pnl, round(weight, 6), NULL FROM ({ORACLES['holding_returns']})
UNION ALL SELECT 'reported_vs_est', parent_ticker, make_date(y, 3, 31), NULL, ours - amount, round(ours, 6), 'FY' || CAST(y AS VARCHAR) FROM reported
UNION ALL SELECT 'rollups', parent_ticker, max(period_end), NULL, 0.0, CAST(count(*) AS DOUBLE), NULL FROM live GROUP BY parent_ticker"""


def _income(spark, sf_dir, history: DataFrame) -> DataFrame:
    """A reported amount per nation and fiscal year of the line items' span."""
    span = table(spark, sf_dir, "lineitem").agg(F.year(F.min("l_shipdate")).alias("y0"), F.year(F.max("l_shipdate")).alias("y1"))
    years = span.select(F.explode(F.sequence(F.col("y0") + 1, F.col("y1"))).alias("y"), F.lit(1).alias("_one"))
    parents = history.select("parent_ticker", F.lit(1).alias("_one")).distinct()
    day = lambda year, month, dom: F.make_date(year, F.lit(month), F.lit(dom))
    return parents.join(years, "_one").select(
        "parent_ticker", F.concat(F.lit("FY"), F.col("y").cast("string")).alias("period_label"),
        day(F.col("y"), 3, 31).alias("fiscal_year_end"), day(F.col("y") - 1, 4, 1).alias("calendar_start"),
        day(F.col("y"), 3, 31).alias("calendar_end"), (F.col("y") * 1000.0).alias("amount_usd"),
        F.lit(None).cast("double").alias("amount_rmb_million"))


def _shown(name: str, df: DataFrame) -> DataFrame:
    period, ticker, value, quantity, label = SHOWN[name]
    pick = lambda c, kind: (F.col(c) if c else F.lit(None)).cast(kind)
    rounded = F.round(pick(quantity, "double"), 6) if quantity != "shares_held" else pick(quantity, "double")
    parent = "ticker" if name == "rollups" else "parent_ticker"
    return df.select(
        F.lit(name).alias("table_name"), F.col(parent).alias("parent_ticker"), pick(period, "date").alias("period_end"),
        pick(ticker, "string").alias("investee_ticker"), pick(value, "double").alias("value"), rounded.alias("quantity"),
        pick(label, "string").alias("label"))


@query("export_parents", _EXPORT_SQL)
def export_parents(spark, sf_dir):
    """All nations are exported, the first of them again from a later window; a third export fails its gate.

    Read back, the first nations show their second version, all others the first, and nothing of the third is seen.
    """
    history = mixed_ledger(spark, sf_dir)
    nation = table(spark, sf_dir, "nation")
    ciks = nation.select(F.col("n_name").alias("parent_ticker"), F.col("n_nationkey").cast("string").alias("cik"))
    income = _income(spark, sf_dir, history)
    last = table(spark, sf_dir, "lineitem").agg(F.max(quarter_end("l_shipdate")).alias("last"))
    start = lambda years: last.select(lookback_start("last", years)).scalar()
    folder = f"{shared_folder(spark)}/exports-{uuid.uuid4().hex}"
    export.export_parents(history, ciks, folder, start(5), income)
    early = F.col("parent_ticker").endswith("0")
    export.export_parents(history.where(early), ciks, folder, start(2), income.where(early))
    broken = history.where(early).withColumn("cost_basis_est_usd", F.lit(1.0))
    try:
        export.export_parents(broken, ciks, folder, start(1), income)
    except quality.QualityError:
        pass
    else:
        raise AssertionError("an estimate without its tag must not be published")
    return reduce(DataFrame.unionByName, [_shown(name, export.read_published(spark, folder, name)) for name in SHOWN])
