"""As-of joins, the crossing backtest, ownership and buybacks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from posledger.bindings.registry import query
from posledger.bindings.views import (
    ADDITIONS, BOOK, DELETIONS, EARN, PRICES, additions, book_series, deletions, earnings_series,
    msum, prices, qend, table,
)
from posledger.functions.dates import quarter_end
from posledger.operators import asof, ownership, screening, valuation
from posledger.sources import tables
from posledger.sources.tables import stage


def _views(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'view'").select("event_id", "user_id", "ts", "value")


def _purchases(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("p_ts"), F.col("value").alias("p_value"))


_V = "v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view')"
_P = "p AS (SELECT user_id, ts AS p_ts, value AS p_value FROM events WHERE event_type = 'purchase')"


@query("asof_backward", f"""WITH {_V}, {_P}
SELECT v.event_id, v.user_id, v.ts, p.p_ts, p.p_value
FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.p_ts""")
def asof_backward(spark, sf_dir):
    return asof.asof_join(_views(spark, sf_dir).drop("value"), _purchases(spark, sf_dir), "user_id", "ts", "p_ts")


@query("asof_forward", f"""WITH {_V}, {_P}
SELECT v.event_id, v.user_id, v.ts, p.p_ts, p.p_value
FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts <= p.p_ts""")
def asof_forward(spark, sf_dir):
    return asof.asof_join(_views(spark, sf_dir).drop("value"), _purchases(spark, sf_dir),
                          "user_id", "ts", "p_ts", "forward")


@query("asof_nearest", f"""WITH {_V}, {_P},
b AS (SELECT v.*, p.p_ts AS bt, p.p_value AS bv FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.p_ts),
f AS (SELECT v.event_id, p.p_ts AS ft, p.p_value AS fv FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts <= p.p_ts),
n AS (SELECT b.event_id, user_id, ts,
        CASE WHEN bt IS NOT NULL AND (ft IS NULL OR epoch_us(ts) - epoch_us(bt) <= epoch_us(ft) - epoch_us(ts)) THEN bt ELSE ft END AS t,
        CASE WHEN bt IS NOT NULL AND (ft IS NULL OR epoch_us(ts) - epoch_us(bt) <= epoch_us(ft) - epoch_us(ts)) THEN bv ELSE fv END AS x
      FROM b JOIN f ON b.event_id = f.event_id)
SELECT event_id, user_id, ts,
       CASE WHEN abs(epoch_us(ts) - epoch_us(t)) <= 86400000000 THEN t END AS p_ts,
       CASE WHEN abs(epoch_us(ts) - epoch_us(t)) <= 86400000000 THEN x END AS p_value FROM n""")
def asof_nearest(spark, sf_dir):
    return asof.asof_join(_views(spark, sf_dir).drop("value"), _purchases(spark, sf_dir),
                          "user_id", "ts", "p_ts", "nearest", tolerance_days=1)


@query("lookup_as_of", f"""WITH {PRICES}, {EARN}
SELECT prices.ticker, prices.date, earn.filed, earn.net_income, earn.net_income > 0 AS profitable
FROM prices ASOF LEFT JOIN earn ON prices.ticker = earn.ticker AND prices.date >= earn.filed""")
def lookup_as_of(spark, sf_dir):
    return asof.positive_as_of(
        prices(spark, sf_dir).drop("close"), earnings_series(spark, sf_dir), "ticker", "date", "filed",
        "net_income", "profitable")


@query("lookup_with_fallback", f"""WITH {PRICES}, {EARN},
b AS (SELECT prices.ticker, prices.date, earn.filed AS bf, earn.net_income AS bn
      FROM prices ASOF LEFT JOIN earn ON prices.ticker = earn.ticker AND prices.date >= earn.filed),
f AS (SELECT prices.ticker, prices.date, earn.filed AS ff, earn.net_income AS fn
      FROM prices ASOF LEFT JOIN earn ON prices.ticker = earn.ticker AND prices.date <= earn.filed)
SELECT b.ticker, b.date, coalesce(bf, ff) AS filed, coalesce(bn, fn) AS net_income
FROM b JOIN f ON b.ticker = f.ticker AND b.date = f.date""")
def lookup_with_fallback(spark, sf_dir):
    return asof.lookup_value(
        prices(spark, sf_dir).drop("close"), earnings_series(spark, sf_dir), "ticker", "date", "filed",
        "net_income", fallback="forward")


@query("close_on_or_before", f"""WITH {PRICES}, {BOOK},
b AS (SELECT book.ticker, book.filed, prices.date AS d, prices.close AS c
      FROM book ASOF LEFT JOIN prices ON book.ticker = prices.ticker AND book.filed >= prices.date),
f AS (SELECT book.ticker, book.filed, prices.date AS d, prices.close AS c
      FROM book ASOF LEFT JOIN prices ON book.ticker = prices.ticker AND book.filed <= prices.date)
SELECT b.ticker, b.filed,
  CASE WHEN b.filed - b.d <= 3 THEN b.d WHEN f.d - f.filed <= 1 THEN f.d END AS price_as_of,
  CASE WHEN b.filed - b.d <= 3 THEN b.c WHEN f.d - f.filed <= 1 THEN f.c END AS market_price
FROM b JOIN f ON b.ticker = f.ticker AND b.filed = f.filed""")
def close_on_or_before(spark, sf_dir):
    return asof.last_close(book_series(spark, sf_dir).drop("bvps"), prices(spark, sf_dir),
                           "ticker", "filed", days_back=3)


@query("first_after", f"""WITH {DELETIONS}, {ADDITIONS}
SELECT d.ticker, d.deletion_date, min(a.added_date) AS reentry_date
FROM deletions d LEFT JOIN additions a ON a.ticker = d.ticker AND a.added_date > d.deletion_date GROUP BY ALL""")
def first_after(spark, sf_dir):
    return asof.first_after(deletions(spark, sf_dir), additions(spark, sf_dir), "ticker",
                            "deletion_date", "added_date", "reentry_date")


_CROSS = f"""{PRICES}, {BOOK}, {EARN}, {DELETIONS},
valued AS (SELECT prices.*, book.bvps FROM prices ASOF JOIN book
           ON prices.ticker = book.ticker AND prices.date >= book.filed),
hit AS (
  SELECT d.ticker, d.deletion_date, min(v.date) AS crossing_date
  FROM deletions d JOIN valued v ON v.ticker = d.ticker AND v.date >= d.deletion_date
  WHERE v.bvps > 0 AND v.close / v.bvps > 0 AND v.close / v.bvps < 1 GROUP BY ALL
),
priced AS (SELECT h.*, v.close AS buy_price, v.bvps AS bvps_at_crossing, v.close / v.bvps AS pb_ratio_at_crossing
           FROM hit h JOIN valued v ON v.ticker = h.ticker AND v.date = h.crossing_date),
earned AS (SELECT p.*, e.net_income FROM priced p ASOF LEFT JOIN earn e
           ON p.ticker = e.ticker AND p.crossing_date >= e.filed),
crossings AS (
  SELECT d.ticker, d.deletion_date,
    CASE WHEN NOT EXISTS (SELECT 1 FROM prices x WHERE x.ticker = d.ticker AND x.date >= d.deletion_date)
           THEN 'insufficient_data'
         WHEN NOT EXISTS (SELECT 1 FROM book b WHERE b.ticker = d.ticker) THEN 'insufficient_data'
         WHEN crossing_date IS NULL THEN 'never_crossed' WHEN net_income > 0 THEN 'crossed'
         WHEN net_income <= 0 THEN 'crossed_unprofitable' ELSE 'crossed_earnings_unknown' END AS status,
    crossing_date, buy_price, bvps_at_crossing, pb_ratio_at_crossing,
    net_income > 0 AS profitable_at_crossing, net_income AS net_income_at_crossing
  FROM deletions d LEFT JOIN earned e ON e.ticker = d.ticker AND e.deletion_date = d.deletion_date
)"""
_CROSS_COLUMNS = ["ticker", "deletion_date", "status", "crossing_date", "buy_price", "bvps_at_crossing",
                  "pb_ratio_at_crossing", "profitable_at_crossing", "net_income_at_crossing"]


def _crossings(spark, sf_dir):
    return screening.first_crossing(deletions(spark, sf_dir), prices(spark, sf_dir),
                                    book_series(spark, sf_dir), earnings_series(spark, sf_dir))


@query("first_crossing", f"WITH {_CROSS} SELECT {', '.join(_CROSS_COLUMNS)} FROM crossings")
def first_crossing(spark, sf_dir):
    return _crossings(spark, sf_dir).select(*_CROSS_COLUMNS)


@query("status_counts", f"WITH {_CROSS} SELECT status, count(*) AS rows FROM crossings GROUP BY ALL")
def status_counts(spark, sf_dir):
    return screening.status_counts(_crossings(spark, sf_dir))


_OUTCOME = f"""{_CROSS}, {ADDITIONS},
crossed AS (SELECT c.*, (SELECT min(a.added_date) FROM additions a
              WHERE a.ticker = c.ticker AND a.added_date > c.crossing_date + 7) AS reentry_date
            FROM crossings c WHERE status = 'crossed'),
last_day AS (SELECT max(date) AS d FROM prices),
best AS (SELECT c.ticker, arg_max(p.close, (p.close, -datediff('day', DATE '1970-01-01', p.date))) AS close,
                arg_max(p.date, (p.close, -datediff('day', DATE '1970-01-01', p.date))) AS date
         FROM crossed c JOIN prices p ON p.ticker = c.ticker
          AND p.date BETWEEN c.reentry_date AND c.reentry_date + 5 GROUP BY ALL),
recent AS (SELECT ticker, arg_max(close, date) AS close, max(date) AS date FROM prices, last_day
           WHERE date >= last_day.d - 4 GROUP BY ALL),
outcomes AS (
  SELECT c.ticker, c.deletion_date,
    CASE WHEN c.reentry_date IS NOT NULL THEN CASE WHEN b.close IS NULL THEN 'insufficient_data' ELSE 'realized' END
         WHEN r.close IS NULL THEN 'insufficient_data' ELSE 'still_holding' END AS status,
    CASE WHEN c.reentry_date IS NOT NULL THEN b.date ELSE r.date END AS sell_date,
    CASE WHEN c.reentry_date IS NOT NULL THEN b.close ELSE r.close END AS sell_price,
    (CASE WHEN c.reentry_date IS NOT NULL THEN b.close ELSE r.close END - c.buy_price) / c.buy_price * 100.0 AS return_pct
  FROM crossed c LEFT JOIN best b ON b.ticker = c.ticker LEFT JOIN recent r ON r.ticker = c.ticker
)"""


def _outcomes(spark, sf_dir, crossings=None):
    found = crossings if crossings is not None else stage(_crossings(spark, sf_dir), "crossings")
    crossed = found.where("status = 'crossed'")
    # The sample covers one month, so a re-entry counts a week after the crossing.
    later = asof.first_after(
        crossed.withColumn("_from", F.date_add("crossing_date", 7)), additions(spark, sf_dir), "ticker",
        "_from", "added_date", "reentry_date").drop("_from")
    bars = prices(spark, sf_dir)
    as_of = bars.agg(F.max("date")).scalar()
    return screening.trade_outcome(later, bars, as_of, hold_days=5, recent_days=4)


@query("trade_outcome", f"""WITH {_OUTCOME}
SELECT ticker, deletion_date, status, sell_date, sell_price, return_pct FROM outcomes""")
def trade_outcome(spark, sf_dir):
    return _outcomes(spark, sf_dir).select(
        "ticker", "deletion_date", "status", "sell_date", "sell_price", "return_pct")


@query("outcome_summary", f"""WITH {_OUTCOME}
SELECT count(*) AS num_rows, count(*) FILTER (status = 'realized') AS num_realized,
       count(*) FILTER (status = 'still_holding') AS num_still_holding,
       round(avg(return_pct) FILTER (status IN ('realized', 'still_holding')), 6) AS avg_return_pct FROM outcomes""")
def outcome_summary(spark, sf_dir):
    return screening.outcome_summary(_outcomes(spark, sf_dir)).withColumn(
        "avg_return_pct", F.round("avg_return_pct", 6))


@query("index_dropouts", """WITH s AS (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS d FROM events),
t AS (SELECT max(d) AS today FROM s),
b AS (SELECT max(d) AS base FROM s, t WHERE d <= today - 10)
SELECT DISTINCT user_id AS ticker, event_type AS index_name, base AS last_seen_date FROM s, b
WHERE d = base AND user_id IN (SELECT user_id FROM s, b WHERE d = base EXCEPT SELECT user_id FROM s, t WHERE d = today)""")
def index_dropouts(spark, sf_dir):
    snaps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ticker"), F.col("event_type").alias("index_name"),
        F.col("ts").cast("date").alias("snapshot_date"))
    return screening.index_dropouts(snaps, 10)


@query("membership_changes", """SELECT user_id AS ticker, CAST(ts AS DATE) AS reconstitution_date,
  CASE WHEN event_type = 'signup' THEN 'added' ELSE 'removed' END AS side, event_type AS source_index
FROM events WHERE event_type IN ('signup', 'error')""")
def membership_changes(spark, sf_dir):
    from posledger.sources.listings import membership_sides
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "error"))
    wide = ev.select(
        F.date_format("ts", "MMMM d, yyyy").alias("date"),
        F.when(F.col("event_type") == "signup", F.col("user_id").cast("string")).alias("added_ticker"),
        F.when(F.col("event_type") == "error", F.col("user_id").cast("string")).alias("removed_ticker"),
        F.lit(None).cast("string").alias("added_security"), F.lit(None).cast("string").alias("removed_security"),
        F.col("event_type").alias("reason"))
    return membership_sides(wide).select(
        F.col("ticker").cast("long").alias("ticker"), "reconstitution_date", "side",
        F.col("reason").alias("source_index"))


# -- ownership and buybacks ----------------------------------------------------------------------

def _keys(spark, sf_dir):
    """Brands looked at the end of every February, when year-end reports are partly in."""
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker")).distinct()
    span = table(spark, sf_dir, "lineitem").agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    day = lambda c: span.select(F.make_date(F.year(c) + 1, F.lit(2), F.lit(20))).scalar()
    return part.withColumn("as_of", F.explode(F.sequence(day("lo"), day("hi"), F.expr("interval 1 year"))))


_KEYS = """keys AS (SELECT DISTINCT p_brand AS ticker, CAST(d AS DATE) AS as_of FROM part,
  generate_series((SELECT make_date(year(min(l_shipdate)) + 1, 2, 20) FROM lineitem),
                  (SELECT make_date(year(max(l_shipdate)) + 1, 2, 20) FROM lineitem), INTERVAL 1 YEAR) g(d))"""


def _reports(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    day = F.col("l_shipdate").cast("date")
    return line.join(part, line.l_partkey == F.col("p_partkey")).select(
        "ticker", F.col("l_suppkey").alias("manager"),
        quarter_end(F.add_months(day, -3)).alias("period_end"), day.alias("filing_date"),
        F.col("l_quantity").alias("shares"))


_REPORTS = f"""reports AS (SELECT p_brand AS ticker, l_suppkey AS manager,
  {qend("(CAST(l_shipdate AS DATE) - INTERVAL 3 MONTH)")} AS period_end, CAST(l_shipdate AS DATE) AS filing_date,
  sum(l_quantity) AS shares FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""

_PREV_Q = "CAST(date_trunc('quarter', {0} + 1) - INTERVAL 1 DAY AS DATE)"


@query("institutional_holders", f"""WITH {_KEYS}, {_REPORTS},
q AS (SELECT *, {_PREV_Q.format('(as_of - 45)')} AS q0 FROM keys),
tries AS (SELECT ticker, as_of, 0 AS t, q0 AS period_end FROM q
          UNION ALL SELECT ticker, as_of, 1, {_PREV_Q.format('(q0 - 1 - 45)')} FROM q),
latest AS (SELECT t.ticker, t.as_of, t.t, t.period_end, manager, arg_max(shares, filing_date) AS shares
           FROM tries t JOIN reports r ON r.ticker = t.ticker AND r.period_end = t.period_end
            AND r.filing_date <= t.as_of GROUP BY ALL),
totals AS (SELECT ticker, as_of, t, period_end, sum(shares) AS s, count(*) AS n FROM latest GROUP BY ALL),
pick AS (SELECT * FROM totals QUALIFY row_number() OVER (PARTITION BY ticker, as_of ORDER BY t) = 1)
SELECT q.ticker, q.as_of, p.s AS institutional_shares, coalesce(p.n, 0) AS institutional_holder_count,
       coalesce(p.period_end, {_PREV_Q.format('(q0 - 1 - 45)')}) AS institutional_period
FROM q LEFT JOIN pick p ON p.ticker = q.ticker AND p.as_of = q.as_of""")
def institutional_holders(spark, sf_dir):
    return ownership.institutional_holders(_reports(spark, sf_dir), _keys(spark, sf_dir))


def _insider_filings(spark, sf_dir):
    """Suppliers report brand positions; the return flag plays the security title."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    titles = {"A": "Common Stock", "N": "Class B common", "R": "Preferred"}
    title = F.create_map(*[F.lit(x) for kv in titles.items() for x in kv])[F.col("l_returnflag")]
    rows = line.join(part, line.l_partkey == F.col("p_partkey")).select(
        "ticker", F.col("l_suppkey").alias("owner"), F.col("l_shipdate").cast("date").alias("filing_date"),
        title.alias("title"), F.col("l_quantity").alias("shares"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("kind"),
        F.col("l_orderkey").alias("day"), F.struct("l_linenumber", "l_quantity", "l_extendedprice").alias("pos"))
    return ownership.insider_filing_shares(rows)


_INSIDER = """titled AS (
  SELECT p_brand AS ticker, l_suppkey AS owner, CAST(l_shipdate AS DATE) AS filing_date, l_returnflag AS title,
         arg_max(l_quantity, (CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END, l_orderkey, l_linenumber, l_quantity, l_extendedprice)) AS shares
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('A', 'N') GROUP BY ALL),
filed AS (SELECT ticker, owner, filing_date, sum(shares) AS shares FROM titled GROUP BY ALL)"""


@query("insider_shares", f"""WITH {_KEYS}, {_INSIDER},
latest AS (SELECT k.ticker, k.as_of, owner, arg_max(shares, filing_date) AS shares, max(filing_date) AS last
           FROM keys k JOIN filed f ON f.ticker = k.ticker AND f.filing_date <= k.as_of GROUP BY ALL),
fresh AS (SELECT ticker, as_of, sum(shares) AS s, count(*) AS n FROM latest
          WHERE last >= as_of - 1095 AND shares > 0 GROUP BY ALL)
SELECT k.ticker, k.as_of, s AS insider_shares, coalesce(n, 0) AS insider_owner_count
FROM keys k LEFT JOIN fresh f ON f.ticker = k.ticker AND f.as_of = k.as_of""")
def insider_shares(spark, sf_dir):
    return ownership.insider_shares(_insider_filings(spark, sf_dir), _keys(spark, sf_dir))


@query("ownership_pct", f"""WITH {_KEYS}, {_REPORTS}, {_INSIDER},
latest AS (SELECT k.ticker, k.as_of, owner, arg_max(shares, filing_date) AS shares, max(filing_date) AS last
           FROM keys k JOIN filed f ON f.ticker = k.ticker AND f.filing_date <= k.as_of GROUP BY ALL),
fresh AS (SELECT ticker, as_of, sum(shares) AS s FROM latest WHERE last >= as_of - 1095 AND shares > 0 GROUP BY ALL),
q AS (SELECT *, {_PREV_Q.format('(as_of - 45)')} AS q0 FROM keys),
tries AS (SELECT ticker, as_of, 0 AS t, q0 AS period_end FROM q
          UNION ALL SELECT ticker, as_of, 1, {_PREV_Q.format('(q0 - 1 - 45)')} FROM q),
held AS (SELECT t.ticker, t.as_of, t.t, manager, arg_max(shares, filing_date) AS shares
         FROM tries t JOIN reports r ON r.ticker = t.ticker AND r.period_end = t.period_end
          AND r.filing_date <= t.as_of GROUP BY ALL),
inst AS (SELECT * FROM (SELECT ticker, as_of, t, sum(shares) AS s FROM held GROUP BY ALL)
         QUALIFY row_number() OVER (PARTITION BY ticker, as_of ORDER BY t) = 1),
out AS (SELECT p_brand AS ticker, CAST(date_trunc('year', l_shipdate) AS DATE) AS d, sum(l_quantity) * 2 AS n
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
joined AS (SELECT k.ticker, k.as_of, o.n FROM keys k ASOF LEFT JOIN out o ON o.ticker = k.ticker AND k.as_of >= o.d)
SELECT j.ticker, j.as_of AS as_of_date, j.n AS shares_outstanding,
       CASE WHEN f.s / j.n IS NOT NULL THEN least(100.0 * f.s / j.n, 100.0) END AS percent_insiders,
       CASE WHEN i.s / j.n IS NOT NULL THEN least(100.0 * i.s / j.n, 100.0) END AS percent_institutions,
       CASE WHEN i.s / j.n IS NOT NULL THEN greatest(0.0, 100.0 - least(100.0 * i.s / j.n, 100.0)) END AS percent_non_institutions
FROM joined j LEFT JOIN fresh f ON f.ticker = j.ticker AND f.as_of = j.as_of
     LEFT JOIN inst i ON i.ticker = j.ticker AND i.as_of = j.as_of""")
def ownership_pct(spark, sf_dir):
    keys, reports = _keys(spark, sf_dir), _reports(spark, sf_dir)
    outstanding = reports.groupBy("ticker", F.trunc("filing_date", "year").alias("shares_date")).agg(
        (F.sum("shares") * 2).alias("shares_outstanding"))
    rows = ownership.ownership_as_of(
        keys, ownership.insider_shares(_insider_filings(spark, sf_dir), keys),
        ownership.institutional_holders(reports, keys), outstanding)
    return rows.select("ticker", "as_of_date", "shares_outstanding", "percent_insiders",
                       "percent_institutions", "percent_non_institutions")


@query("ttm_last4", f"""WITH cf AS (
  SELECT o_custkey AS ticker, {qend('o_orderdate')} AS period_end, max(CAST(o_orderdate AS DATE)) AS filing_date,
         {msum("CASE WHEN o_orderstatus = 'F' THEN -o_totalprice WHEN o_orderstatus = 'O' THEN o_totalprice END")} AS sale,
         {msum("CASE WHEN o_orderstatus = 'P' THEN o_totalprice END")} AS issue
  FROM orders GROUP BY ALL),
keys AS (SELECT DISTINCT o_custkey AS ticker, CAST(d AS DATE) AS as_of FROM orders,
         generate_series((SELECT make_date(year(min(o_orderdate)) + 1, 6, 30) FROM orders),
                         (SELECT make_date(year(max(o_orderdate)), 6, 30) FROM orders), INTERVAL 1 YEAR) g(d)),
ranked AS (SELECT k.as_of, cf.*, row_number() OVER (PARTITION BY k.ticker, k.as_of ORDER BY filing_date DESC, period_end DESC) AS rn
           FROM keys k JOIN cf ON cf.ticker = k.ticker AND cf.filing_date <= k.as_of),
agg AS (SELECT ticker, as_of, {msum('sale')} AS s,
               {msum('CASE WHEN sale < 0 THEN -sale WHEN sale IS NOT NULL THEN 0.0 END')} AS g, {msum('issue')} AS i,
               count(*) AS n, max(CASE WHEN rn = 1 THEN period_end END) AS pe, max(filing_date) AS fd
        FROM ranked WHERE rn <= 4 GROUP BY ALL),
bs AS (SELECT ticker, as_of, issue FROM ranked WHERE rn = 1)
SELECT k.ticker, k.as_of, pe AS period_end, fd AS filing_date, s AS sale_purchase_of_stock_ttm,
       CASE WHEN s IS NOT NULL THEN greatest(0.0, -s) END AS net_buyback_usd_ttm, g AS gross_repurchase_usd_ttm,
       i AS issuance_of_capital_stock_ttm, bs.issue AS treasury_stock, coalesce(n, 0) AS quarters_used
FROM keys k LEFT JOIN agg a ON a.ticker = k.ticker AND a.as_of = k.as_of
     LEFT JOIN bs ON bs.ticker = k.ticker AND bs.as_of = k.as_of""")
def ttm_last4(spark, sf_dir):
    from posledger.functions.numbers import money_sum
    orders = table(spark, sf_dir, "orders")
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    cash = orders.groupBy(F.col("o_custkey").alias("ticker"), quarter_end("o_orderdate").alias("period_end")).agg(
        F.max(F.col("o_orderdate").cast("date")).alias("filing_date"),
        money_sum(F.when(status == "F", -price).when(status == "O", price)).alias("sale_purchase"),
        money_sum(F.when(status == "P", price)).alias("issuance"))
    span = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    june = lambda year: span.select(F.make_date(year, F.lit(6), F.lit(30))).scalar()
    keys = orders.select(F.col("o_custkey").alias("ticker")).distinct().withColumn("as_of", F.explode(F.sequence(
        june(F.year("lo") + 1), june(F.year("hi")), F.expr("interval 1 year"))))
    return ownership.buybacks_ttm(
        cash, cash.select("ticker", "period_end", "filing_date", F.col("issuance").alias("treasury_stock")), keys,
    ).drop("note")


@query("ttm_refiled", f"""WITH cf AS (
  SELECT o_custkey AS ticker, {qend('o_orderdate')} AS period_end, CAST(o_orderdate AS DATE) + CAST((o_orderkey % 2) * 400 AS INTEGER) AS filing_date,
         max(CAST(floor(o_totalprice * 10000.0 + 0.5) AS BIGINT)) AS v FROM orders GROUP BY ALL),
keys AS (SELECT DISTINCT o_custkey AS ticker, CAST(d AS DATE) AS as_of FROM orders,
         generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 9 MONTH) g(d)),
known AS (SELECT k.as_of, cf.*, row_number() OVER (PARTITION BY k.ticker, k.as_of, period_end ORDER BY filing_date DESC) AS version
          FROM keys k JOIN cf ON cf.ticker = k.ticker AND cf.filing_date <= k.as_of),
last AS (SELECT *, row_number() OVER (PARTITION BY ticker, as_of ORDER BY period_end DESC) AS rn FROM known WHERE version = 1),
agg AS (SELECT ticker, as_of, CAST(-sum(v) AS DOUBLE) / 10000.0 AS s, count(*) AS n, max(period_end) AS pe FROM last WHERE rn <= 4 GROUP BY ALL)
SELECT k.ticker, k.as_of, pe AS period_end, s AS sale_purchase_of_stock_ttm, -s AS net_buyback_usd_ttm, coalesce(n, 0) AS quarters_used
FROM keys k LEFT JOIN agg a ON a.ticker = k.ticker AND a.as_of = k.as_of""")
def ttm_refiled(spark, sf_dir):
    # Orders of a quarter are filings of it: every second one is filed 400 days later, when newer periods are known.
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    cash = orders.select(
        F.col("o_custkey").alias("ticker"), quarter_end("o_orderdate").alias("period_end"),
        F.date_add(day, ((F.col("o_orderkey") % 2) * 400).cast("int")).alias("filing_date"), F.col("o_totalprice").alias("v"))
    cash = cash.groupBy("ticker", "period_end", "filing_date").agg((-F.max("v")).alias("sale_purchase")).withColumn(
        "issuance", F.lit(None).cast("double"))
    span = orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    keys = orders.select(F.col("o_custkey").alias("ticker")).distinct().withColumn("as_of", F.explode(F.sequence(
        span.select("lo").scalar(), span.select("hi").scalar(), F.expr("interval 9 months"))))
    sheet = cash.where("false").select("ticker", "period_end", "filing_date", F.col("sale_purchase").alias("treasury_stock"))
    return ownership.buybacks_ttm(cash, sheet, keys).select(
        "ticker", "as_of", "period_end", "sale_purchase_of_stock_ttm", "net_buyback_usd_ttm", "quarters_used")


# -- filters, work lists and summaries -----------------------------------------------------------

@query("price_book_screen", """WITH avg_order AS (SELECT o_custkey, CAST(sum(CAST(floor(o_totalprice * 100.0 + 0.5) AS HUGEINT)) AS DOUBLE) / 100.0 / count(*) AS a
  FROM orders GROUP BY ALL),
pb AS (SELECT c_custkey, c_acctbal / a AS pb_ratio FROM customer JOIN avg_order ON c_custkey = o_custkey)
SELECT c_custkey, pb_ratio FROM pb WHERE pb_ratio > 0 AND pb_ratio < 1""")
def price_book_screen(spark, sf_dir):
    from posledger.bindings.views import cents
    avg_order = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        (cents("o_totalprice") / F.count(F.lit(1))).alias("a"))
    rows = table(spark, sf_dir, "customer").join(avg_order, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", (F.col("c_acctbal") / F.col("a")).alias("pb_ratio"))
    return screening.screening_candidates(screening.price_book_screen(rows))


@query("cap_with_forced", """WITH firsts AS (SELECT o_custkey, min(o_orderkey) AS f FROM orders GROUP BY ALL),
keep AS (SELECT o_custkey FROM firsts ORDER BY o_custkey IN (7, 11, 13) DESC, f LIMIT 40)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT o_custkey FROM keep)""")
def cap_with_forced(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return screening.cap_with_forced(orders, "o_custkey", 40, [7, 11, 13], ["o_orderkey"])


@query("apply_allowlist", """WITH allow AS (SELECT DISTINCT upper(p_brand) AS ticker FROM part
  UNION SELECT 'MISSING#' || upper(p_type) FROM part),
m AS (SELECT upper(p_brand) AS ticker, max(p_retailprice) AS top_price FROM part GROUP BY ALL)
SELECT ticker, top_price FROM allow LEFT JOIN m USING (ticker)""")
def apply_allowlist(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    allow = part.select(F.col("p_brand").alias("ticker")).unionByName(
        part.select(F.concat(F.lit("missing#"), F.col("p_type")).alias("ticker")))
    rows = part.groupBy(F.col("p_brand").alias("ticker")).agg(F.max("p_retailprice").alias("top_price"))
    return screening.apply_allowlist(rows, allow)


@query("recent_filings", """SELECT o_custkey AS cik, o_orderkey AS accession_no, CAST(o_orderdate AS DATE) AS filing_date
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND CAST(o_orderdate AS DATE) <= DATE '2000-06-30'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) <= 3""")
def recent_filings(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("cik"), F.col("o_orderkey").alias("accession_no"),
        F.col("o_orderdate").cast("date").alias("filing_date"), F.col("o_orderpriority").alias("form"))
    return screening.recent_filings(rows, ["1-URGENT", "2-HIGH"], "2000-06-30", 3).drop("form")


@query("pending_keys", """SELECT doc_id, source FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def pending_keys(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    done = table(spark, sf_dir, "labels").withColumn("finished", F.when(F.col("quality") == 1, 1))
    return screening.pending(docs, done, ["doc_id"], required=["finished"])


@query("flag_exists", """SELECT c_custkey, c_mktsegment, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS is_large
FROM customer""")
def flag_exists(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return screening.flag_exists(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), big, ["c_custkey"], "is_large")


@query("latest_per_key", """SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key(spark, sf_dir):
    from posledger.sources.tables import latest_per_key as latest
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("earliest_per_key", """SELECT o_custkey, arg_min(o_orderkey, (CAST(o_orderdate AS DATE), o_orderkey)) AS o_orderkey,
  arg_min(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey)) AS o_totalprice FROM orders GROUP BY ALL""")
def earliest_per_key(spark, sf_dir):
    return tables.earliest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate").cast("date"), "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


@query("dated_rates", """WITH rates AS (SELECT CAST(o_orderdate AS DATE) AS day, max(o_orderkey % 10) / 10.0 + 7.0 * (min(o_orderkey) % 3) AS rate FROM orders
  WHERE o_orderpriority LIKE '1%' GROUP BY ALL),
stakes AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) - 700 AS as_of, l_quantity AS v FROM lineitem),
hit AS (SELECT s.*, r.rate FROM stakes s ASOF LEFT JOIN rates r ON s.as_of >= r.day)
SELECT l_orderkey, l_linenumber, CASE WHEN rate > 0 THEN rate ELSE 7.8 END AS fx, v * 1e6 / CASE WHEN rate > 0 THEN rate ELSE 7.8 END AS value_usd FROM hit""")
def dated_rates(spark, sf_dir):
    # Days without a useful rate, and stakes older than the first rate, fall back on the fixed one.
    rates = table(spark, sf_dir, "orders").where(F.col("o_orderpriority").startswith("1")).groupBy(
        F.col("o_orderdate").cast("date").alias("day")).agg(
        (F.max(F.col("o_orderkey") % 10) / F.lit(10.0) + F.lit(7.0) * (F.min("o_orderkey") % 3)).alias("rate"))
    stakes = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_sub(F.col("l_shipdate").cast("date"), 700).alias("as_of"),
        F.col("l_quantity").alias("value_to_parent_hkd_mn"))
    return valuation.add_usd(stakes, rates).select("l_orderkey", "l_linenumber", "fx", "value_usd")


@query("upsert_last_wins", """WITH t AS (SELECT doc_id, CAST(n_chars AS BIGINT) AS score FROM documents),
u AS (SELECT doc_id, CAST(quality * 10 + toxic AS BIGINT) AS score FROM labels)
SELECT doc_id, coalesce(u.score, t.score) AS score FROM t FULL OUTER JOIN u USING (doc_id)""")
def upsert_last_wins(spark, sf_dir):
    from posledger.sources.tables import upsert
    target = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("long").alias("score"))
    updates = table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") * 10 + F.col("toxic")).cast("long").alias("score"))
    return upsert(target, updates, ["doc_id"], ["score"])


@query("filed_series", f"""WITH q AS (
  SELECT o_custkey AS ticker, {qend('o_orderdate')} AS period_end, max(CAST(o_orderdate AS DATE)) AS filed,
         CAST(sum(CAST(floor(o_totalprice * 100.0 + 0.5) AS HUGEINT)) AS DOUBLE) / 100.0 AS equity, count(*) AS shares
  FROM orders GROUP BY ALL)
SELECT ticker, filed, equity / shares AS bvps, CAST(shares AS DOUBLE) AS shares FROM q WHERE shares > 1
QUALIFY row_number() OVER (PARTITION BY ticker, filed ORDER BY period_end DESC) = 1""")
def filed_series(spark, sf_dir):
    from posledger.bindings.views import cents
    from posledger.sources.filings import book_per_share_series
    orders = table(spark, sf_dir, "orders")
    q = orders.groupBy(F.col("o_custkey").alias("ticker"), quarter_end("o_orderdate").alias("period_end")).agg(
        F.max(F.col("o_orderdate").cast("date")).alias("filed"), cents("o_totalprice").alias("equity"),
        F.count(F.lit(1)).cast("double").alias("shares"))
    q = q.withColumn("shares", F.when(F.col("shares") > 1, F.col("shares")).otherwise(F.lit(0.0)))
    return book_per_share_series(q)
