"""Queries on the position ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from posledger.bindings.registry import query
from posledger.bindings.views import (
    HIST, POS, cents, ledger, owned_lines, periods, positions, qend, snapshot_rows, sql_cents,
    table,
)
from posledger.functions.dates import quarter_end
from posledger.operators import ledger as ops, merge, snapshots
from posledger.plans import holdings

HIST_COLUMNS = [
    "parent_ticker", "investee_ticker", "period_end", "action", "shares_held", "market_value_usd",
    "shares_prev", "value_prev", "shares_delta", "value_delta", "first_seen_period", "exited_period",
]


@query("position_diff", f"WITH {HIST} SELECT {', '.join(HIST_COLUMNS)} FROM hist")
def position_diff(spark, sf_dir):
    return ledger(spark, sf_dir).select(*HIST_COLUMNS)


SUPPLIER_POS = f"""
pos AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS parent_ticker, p_brand AS investee_ticker,
         {qend('l_shipdate')} AS period_end, sum(l_quantity) AS shares_held,
         {sql_cents('l_extendedprice')} AS market_value_usd
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
)"""


@query("position_diff_by_supplier",
       f"WITH {HIST.replace(POS, SUPPLIER_POS)} SELECT {', '.join(HIST_COLUMNS)} FROM hist")
def position_diff_by_supplier(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    q = quarter_end("l_shipdate")
    pos = line.join(part, line.l_partkey == F.col("p_partkey")).groupBy(
        F.col("l_suppkey").cast("string").alias("parent_ticker"),
        F.col("p_brand").alias("investee_ticker"), q.alias("period_end"),
    ).agg(F.sum("l_quantity").alias("shares_held"), cents("l_extendedprice").alias("market_value_usd"))
    grid = line.select(F.col("l_suppkey").cast("string").alias("parent_ticker"), q.alias("period_end")
                       ).distinct().withColumns({
                           "filing_date": F.col("period_end"), "accession_no": F.lit(None).cast("string")})
    return ops.diff_snapshots(snapshot_rows(pos), grid, unique=True).select(*HIST_COLUMNS)


def _security_id(period, ticker):
    """Six-character issuer plus a series that changes every other year."""
    series = F.lpad((F.floor(F.year(period) / 2) % 10).cast("string"), 3, "0")
    return F.concat(F.rpad(F.regexp_replace(ticker, "[^A-Za-z0-9]", ""), 6, "X"), series)


@query("share_ratio_reclass", f"""WITH {HIST},
ids AS (
  SELECT *, rpad(regexp_replace(investee_ticker, '[^A-Za-z0-9]', '', 'g'), 6, 'X')
         || lpad(CAST(CAST(floor(year(period_end) / 2) AS INTEGER) % 10 AS VARCHAR), 3, '0') AS cusip
  FROM hist
),
near AS (
  SELECT *, last_value(CASE WHEN action <> 'exit' THEN cusip END IGNORE NULLS) OVER (
              PARTITION BY parent_ticker, investee_ticker ORDER BY period_end
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_id,
            lead(cusip) OVER (PARTITION BY parent_ticker, investee_ticker ORDER BY period_end) AS after_id
  FROM ids
),
judged AS (
  SELECT *, shares_prev / shares_held AS ratio,
         coalesce(before_id[1:6] = cusip[1:6] AND before_id <> cusip, false)
         OR coalesce(before_id[1:6] = after_id[1:6] AND before_id <> after_id, false)
         OR coalesce(cusip[1:6] = after_id[1:6] AND cusip <> after_id, false) AS moved
  FROM near
)
SELECT parent_ticker, investee_ticker, period_end, shares_prev, shares_held,
       CASE WHEN action = 'sell' AND moved AND ratio = floor(ratio) AND ratio >= 2
            THEN 'ratio_adj' ELSE action END AS action
FROM judged""")
def share_ratio_reclass(spark, sf_dir):
    hist = ledger(spark, sf_dir).withColumn("cusip", _security_id(F.col("period_end"), F.col("investee_ticker")))
    return ops.reclassify_share_ratio(hist).select(
        "parent_ticker", "investee_ticker", "period_end", "shares_prev", "shares_held", "action")


@query("open_positions", f"""WITH {HIST}
SELECT parent_ticker, investee_ticker, period_end, shares_held, market_value_usd
FROM (SELECT * FROM hist QUALIFY row_number() OVER (
        PARTITION BY parent_ticker, investee_ticker ORDER BY period_end DESC) = 1)
WHERE action <> 'exit'""")
def open_positions(spark, sf_dir):
    return ops.open_positions(ledger(spark, sf_dir)).select(
        "parent_ticker", "investee_ticker", "period_end", "shares_held", "market_value_usd")


@query("position_moves", f"""WITH {HIST}
SELECT parent_ticker, investee_ticker, period_end, action, shares_delta
FROM hist WHERE action IN ('new', 'buy', 'sell', 'exit')""")
def position_moves(spark, sf_dir):
    return ops.position_moves(ledger(spark, sf_dir)).select(
        "parent_ticker", "investee_ticker", "period_end", "action", "shares_delta")


@query("report_tail", f"""WITH {HIST}
SELECT parent_ticker, investee_ticker, period_end, action FROM hist
ORDER BY period_end DESC, investee_ticker DESC, parent_ticker DESC LIMIT 50""")
def report_tail(spark, sf_dir):
    # The report shows the last 50 rows; the parent breaks ties.
    hist = ledger(spark, sf_dir).withColumn("investee_name", F.col("parent_ticker"))
    return ops.recent_rows(hist, 50).select("parent_ticker", "investee_ticker", "period_end", "action")


@query("large_moves", f"""WITH {HIST},
known AS (SELECT *, lag(period_end) OVER w AS prev_period, lag(market_value_usd) OVER w AS prev_value_usd
          FROM hist WINDOW w AS (PARTITION BY parent_ticker, investee_ticker ORDER BY period_end))
SELECT parent_ticker, investee_ticker, prev_period, period_end, prev_value_usd, market_value_usd,
       market_value_usd - prev_value_usd AS change_usd
FROM known WHERE abs(market_value_usd - prev_value_usd) >= 100000""")
def large_moves(spark, sf_dir):
    return ops.large_moves(ledger(spark, sf_dir), 1e5)


@query("normalized_exits", f"""WITH {HIST}
SELECT parent_ticker, investee_ticker, period_end,
       CASE WHEN action = 'exit' AND hash_note THEN NULL ELSE market_value_usd END AS market_value_usd
FROM (SELECT *, ends_with(investee_ticker, '1') AS hash_note FROM hist)""")
def normalized_exits(spark, sf_dir):
    hist = ledger(spark, sf_dir)
    overlay = F.col("investee_ticker").endswith("1")
    hist = hist.withColumns({
        "note": F.when(overlay, F.lit("source=13g")).otherwise(F.col("note")),
        "market_value_usd": F.when(F.col("action") == "exit", F.lit(None)).otherwise(F.col("market_value_usd")),
    })
    return ops.normalize_export_rows(hist).select(
        "parent_ticker", "investee_ticker", "period_end", "market_value_usd")


# -- several sources -----------------------------------------------------------------------------

@query("merge_sources", f"""WITH flagged AS (
  SELECT n_name AS parent_ticker, p_brand AS investee_ticker, {qend('l_shipdate')} AS period_end,
         l_returnflag AS flag, sum(l_quantity) AS shares, {sql_cents('l_extendedprice')} AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey GROUP BY ALL
),
wide AS (
  SELECT parent_ticker, investee_ticker, period_end,
    max(CASE WHEN flag = 'A' THEN shares END) AS sa, max(CASE WHEN flag = 'N' THEN value END) AS vn,
    max(CASE WHEN flag = 'R' THEN shares END) AS sr, max(CASE WHEN flag = 'R' THEN value END) AS vr,
    bool_or(flag = 'A') AS has_a, bool_or(flag = 'N') AS has_n
  FROM flagged GROUP BY ALL
)
SELECT parent_ticker, investee_ticker, period_end, coalesce(sa, sr) AS shares_held,
       coalesce(vn, vr) AS market_value_usd,
       CASE WHEN has_a THEN 'source=13f' WHEN has_n THEN 'source=13g' ELSE 'value_source=20f_note' END
       || CASE WHEN has_a AND vn IS NULL AND vr IS NOT NULL THEN '; value_source=20f_note'
               WHEN NOT has_a AND has_n AND vn IS NULL AND vr IS NOT NULL THEN '; value_source=20f_note'
               ELSE '' END AS note
FROM wide""")
def merge_sources(spark, sf_dir):
    rows = positions(spark, sf_dir, extra=("l_returnflag",))
    rows = snapshot_rows(rows).withColumns({
        "cusip": F.lit(None).cast("string"), "ownership_pct": F.lit(None).cast("double"),
        "as_of_accession_no": F.lit(None).cast("string")})

    def source(flag, label, note, shares, value):
        picked = rows.where(F.col("l_returnflag") == flag).drop("l_returnflag")
        return picked.withColumns({
            "source": F.lit(label), "note": F.lit(note),
            "shares_held": F.col("shares_held") if shares else F.lit(None).cast("double"),
            "market_value_usd": F.col("market_value_usd") if value else F.lit(None).cast("double")})

    groups = [
        source("A", "13f", "source=13f", True, False),
        source("N", "13g", "source=13g", False, True),
        source("R", "20f_note", "value_source=20f_note", True, True),
    ]
    return merge.merge_sources(groups).select(
        "parent_ticker", "investee_ticker", "period_end", "shares_held", "market_value_usd", "note")


@query("merge_live", f"""WITH flagged AS (
  SELECT n_name AS parent_ticker, p_brand AS investee_ticker, l_returnflag AS flag,
         sum(l_quantity) AS shares, {sql_cents('l_extendedprice')} AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey GROUP BY ALL
)
SELECT parent_ticker, investee_ticker,
       coalesce(max(CASE WHEN flag = 'R' THEN shares END), max(CASE WHEN flag = 'A' THEN shares END)) AS shares_held,
       coalesce(max(CASE WHEN flag = 'R' THEN value END), max(CASE WHEN flag = 'N' THEN value END)) AS market_value_usd
FROM flagged GROUP BY ALL""")
def merge_live(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    rows = owned_lines(spark, sf_dir, line).groupBy(
        F.col("n_name").alias("parent_ticker"), F.col("p_brand").alias("investee_ticker"), "l_returnflag",
    ).agg(F.sum("l_quantity").alias("shares_held"), cents("l_extendedprice").alias("v"))
    none = F.lit(None).cast("double")
    base = rows.withColumns({"investee_name": F.col("investee_ticker"), "cusip": F.lit(None).cast("string")})
    own = base.where("l_returnflag = 'A'").withColumns(
        {"source": F.lit("13g"), "note": F.lit("source=13g"), "market_value_usd": none})
    notes = base.where("l_returnflag = 'N'").withColumns({
        "source": F.lit("20f_investments_table"), "note": F.lit("20f_investments_table"),
        "fair_value_disclosed_usd": F.col("v"), "shares_held": none, "market_value_usd": none})
    quarterly = base.where("l_returnflag = 'R'").withColumns(
        {"source": F.lit("13f"), "note": F.lit("source=13f"), "market_value_usd": F.col("v")})
    return merge.merge_live([g.drop("l_returnflag", "v") for g in (own, notes, quarterly)]).select(
        "parent_ticker", "investee_ticker", "shares_held", "market_value_usd")


@query("coalesce_period_ticker", f"""WITH {HIST},
twice AS (
  SELECT parent_ticker, period_end, upper(investee_ticker[1:7]) AS ticker, action, shares_held,
         market_value_usd, investee_ticker
  FROM hist
)
SELECT parent_ticker, period_end, ticker AS investee_ticker,
       arg_max(action, (going, shares, money, investee_ticker)) AS action,
       arg_max(investee_ticker, (going, shares, money, investee_ticker)) AS survivor,
       arg_max(shares_held, (going, shares, money, investee_ticker)) AS shares_held
FROM (SELECT *, CASE WHEN action = 'exit' THEN 0 ELSE 1 END AS going,
             CASE WHEN shares_held <> 0 THEN 1 ELSE 0 END AS shares,
             CASE WHEN market_value_usd IS NOT NULL THEN 1 ELSE 0 END AS money FROM twice)
GROUP BY ALL""")
def coalesce_period_ticker(spark, sf_dir):
    hist = ledger(spark, sf_dir).withColumns({
        "accession_no": F.col("investee_ticker"),
        "investee_ticker": F.upper(F.substring("investee_ticker", 1, 7))})
    return merge.coalesce_survivors(hist).select(
        "parent_ticker", "period_end", "investee_ticker", "action",
        F.col("accession_no").alias("survivor"), "shares_held")


# One group is a nation, a period and the first seven characters of a brand; its brands differ in value and note.
@query("coalesce_exported", f"""WITH {HIST},
noted AS (
  SELECT parent_ticker, period_end, upper(investee_ticker[1:7]) AS ticker, action, shares_held, market_value_usd AS mv, investee_ticker AS acc,
    CASE WHEN investee_ticker LIKE '%1' THEN 'source=13f' WHEN investee_ticker LIKE '%4' OR investee_ticker LIKE '%5' THEN 'line ' || investee_ticker
         WHEN shares_held > 0 THEN 'held' END AS note FROM hist),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY parent_ticker, period_end, ticker ORDER BY coalesce(mv, -1) DESC, coalesce(note, '') NOT LIKE '%13f%',
    action = 'exit', length(coalesce(note, '')) DESC, acc) AS rk FROM noted),
notes AS (
  SELECT parent_ticker, period_end, ticker, string_agg(note, '; ' ORDER BY rk) AS note
  FROM (SELECT parent_ticker, period_end, ticker, note, min(rk) AS rk FROM ranked WHERE note IS NOT NULL GROUP BY ALL) GROUP BY ALL)
SELECT r.parent_ticker, r.period_end, r.ticker AS investee_ticker, arg_min(action, rk) AS action, arg_min(acc, rk) AS survivor,
  arg_min(shares_held, rk) AS shares_held, arg_min(mv, rk) AS market_value_usd, any_value(n.note) AS note
FROM ranked r LEFT JOIN notes n USING (parent_ticker, period_end, ticker) GROUP BY ALL""")
def coalesce_exported(spark, sf_dir):
    brand = F.col("investee_ticker")
    note = F.when(brand.endswith("1"), F.lit("source=13f")).when(
        brand.endswith("4") | brand.endswith("5"), F.concat(F.lit("line "), brand)).when(F.col("shares_held") > 0, F.lit("held"))
    hist = ledger(spark, sf_dir).withColumns(
        {"accession_no": brand, "note": note, "filing_date": F.col("period_end")}).withColumn("investee_ticker", F.upper(F.substring(brand, 1, 7)))
    return merge.coalesce_for_export(hist).select(
        "parent_ticker", "period_end", "investee_ticker", "action", F.col("accession_no").alias("survivor"), "shares_held",
        "market_value_usd", "note")


# Suppliers hold parts by three sources; every seventh part's ownership filing repeats the percentage as shares.
@query("live_holdings", f"""WITH f AS (
  SELECT l_suppkey, l_partkey, l_returnflag AS flag, sum(l_quantity) AS sh, {sql_cents('l_extendedprice')} AS v, 20.0 * count(*) AS pct
  FROM lineitem GROUP BY ALL),
g AS (
  SELECT 'S' || l_suppkey AS parent_ticker, 'P' || l_partkey AS investee_ticker, bool_or(flag = 'A') AS a, bool_or(flag = 'N') AS n, bool_or(flag = 'R') AS r,
    max(CASE WHEN flag = 'A' THEN pct END) AS ownership_pct,
    coalesce(max(CASE WHEN flag = 'R' THEN sh END), max(CASE WHEN flag = 'A' THEN CASE WHEN l_partkey % 7 = 0 THEN pct ELSE sh END END)) AS sh,
    coalesce(max(CASE WHEN flag = 'R' THEN v END), max(CASE WHEN flag = 'N' THEN v END)) AS market_value_usd
  FROM f GROUP BY ALL),
b AS (
  SELECT *, CASE WHEN r AND a THEN '13f+13g' WHEN r AND n THEN '13f+20f_investments_table' WHEN r THEN '13f' WHEN a AND n THEN '13g+20f_investments_table'
      WHEN a THEN '13g' ELSE '20f_investments_table' END AS source,
    CASE WHEN a THEN 'source=13g' WHEN n THEN '20f_investments_table' ELSE 'source=13f' END
      || CASE WHEN r AND (a OR n) THEN '; merged 13f' WHEN a AND n THEN '; 20f_investments_table' ELSE '' END AS note,
    coalesce(sh = ownership_pct AND sh <= 100, FALSE) AS bad FROM g)
SELECT parent_ticker, investee_ticker, ownership_pct, CASE WHEN NOT bad THEN sh END AS shares_held, market_value_usd,
  CASE WHEN ownership_pct IS NULL THEN 'unclear' WHEN ownership_pct < 50 THEN 'equity_method' ELSE 'consolidated' END AS gaap_treatment,
  CASE WHEN ownership_pct IS NULL THEN 'unknown' WHEN ownership_pct < 50 THEN 'ge_20_lt_50' ELSE 'ge_50' END AS ownership_band,
  CASE WHEN contains(note, 'source=' || source) THEN '' ELSE 'source=' || source || '; ' END || note
    || CASE WHEN bad THEN '; scrubbed_shares_eq_ownership_pct' ELSE '' END AS note
FROM b""")
def live_holdings(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(
        F.concat(F.lit("S"), "l_suppkey").alias("parent_ticker"), F.concat(F.lit("P"), "l_partkey").alias("investee_ticker"),
        "l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("shares_held"), cents("l_extendedprice").alias("v"),
                                         (F.count(F.lit(1)) * 20.0).alias("pct"))
    none = F.lit(None).cast("double")
    base = rows.withColumns({"investee_name": F.col("investee_ticker"), "cusip": F.lit(None).cast("string")})

    def source(flag, name, note, **columns):
        return base.where(F.col("l_returnflag") == flag).withColumns({"source": F.lit(name), "note": F.lit(note), **columns}).drop(
            "l_returnflag", "l_partkey", "v", "pct")

    own = source("A", "13g", "source=13g", market_value_usd=none, ownership_pct=F.col("pct"),
                 shares_held=F.when(F.col("l_partkey") % 7 == 0, F.col("pct")).otherwise(F.col("shares_held")))
    notes = source("N", "20f_investments_table", "20f_investments_table", fair_value_disclosed_usd=F.col("v"), market_value_usd=none, shares_held=none)
    quarterly = source("R", "13f", "source=13f", market_value_usd=F.col("v"))
    return holdings.checked_holdings(holdings.live_holdings([own, notes, quarterly])).select(
        "parent_ticker", "investee_ticker", "ownership_pct", "shares_held", "market_value_usd", "gaap_treatment", "ownership_band", "note")


@query("reconcile_sources", f"""WITH a AS (
  SELECT n_name AS parent_ticker, p_brand AS ticker, {sql_cents('l_extendedprice')} AS value_a
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'A' GROUP BY ALL),
b AS (
  SELECT n_name AS parent_ticker, p_brand AS ticker, {sql_cents('l_extendedprice')} AS value_b
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT parent_ticker, ticker, value_a, value_b, abs(value_a - value_b) AS abs_diff
FROM a JOIN b USING (parent_ticker, ticker)
WHERE abs(value_a - value_b) > 50000
  AND abs(value_a - value_b) / greatest(abs(value_a), abs(value_b), 1.0) > 0.05""")
def reconcile_sources(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("A", "R"))
    both = owned_lines(spark, sf_dir, line).groupBy(
        F.col("n_name").alias("parent_ticker"), F.col("p_brand").alias("ticker"), "l_returnflag",
    ).agg(cents("l_extendedprice").alias("v"))
    a = both.where("l_returnflag = 'A'").select("parent_ticker", "ticker", F.col("v").alias("value_a"))
    b = both.where("l_returnflag = 'R'").select("parent_ticker", "ticker", F.col("v").alias("value_b"))
    return merge.reconcile(a, b, ["parent_ticker", "ticker"], tol_abs=50_000.0)


# -- snapshots and notes -------------------------------------------------------------------------

_EVENT_STATE = """daily AS (
  SELECT user_id, CAST(ts AS DATE) AS d,
         arg_max(event_type, (ts, event_id)) AS kind, arg_max(value, (ts, event_id)) AS value
  FROM events GROUP BY ALL
),
spans AS (
  SELECT *, lead(d) OVER (PARTITION BY user_id ORDER BY d) AS until FROM daily
)"""


def _amendments(spark, sf_dir):
    """User amendments grouped by the last digit of the user as filer; an error closes the position."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("filer"), F.col("user_id").alias("key"),
        F.col("ts").cast("date").alias("filing_date"), "ts", "event_id", "value",
        (F.col("event_type") == "error").alias("is_exit"))


@query("running_positions", f"""WITH {_EVENT_STATE},
days AS (SELECT DISTINCT user_id % 10 AS filer, CAST(ts AS DATE) AS snapshot_date FROM events)
SELECT filer, snapshot_date, user_id AS key, d AS amended_on, value
FROM days JOIN spans ON spans.user_id % 10 = filer AND snapshot_date >= d
     AND (until IS NULL OR snapshot_date < until)
WHERE kind <> 'error'""")
def running_positions(spark, sf_dir):
    return snapshots.running_positions(
        _amendments(spark, sf_dir), by=("filer",), order=("ts", "event_id")).select(
        "filer", "snapshot_date", "key", "amended_on", "value")


@query("latest_positions", """WITH last AS (
  SELECT user_id % 10 AS filer, user_id AS key, arg_max(event_type, (ts, event_id)) AS kind,
         arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL)
SELECT filer, key, value FROM last WHERE kind <> 'error'""")
def latest_positions(spark, sf_dir):
    return snapshots.latest_positions(
        _amendments(spark, sf_dir), by=("filer",), order=("ts", "event_id")).select("filer", "key", "value")


def _weekly_grid(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("filer"),
        F.date_add(F.trunc(F.col("ts").cast("date"), "week"), 6).alias("as_of")).distinct()


_WEEKLY = """weekly AS (
  SELECT DISTINCT user_id % 10 AS filer, CAST(date_trunc('week', ts) AS DATE) + 6 AS as_of FROM events)"""


@query("snapshot_as_of", f"""WITH {_EVENT_STATE}, {_WEEKLY}
SELECT weekly.filer, as_of, user_id AS key, value
FROM weekly JOIN spans ON user_id % 10 = weekly.filer AND as_of >= d AND (until IS NULL OR as_of < until)
WHERE kind <> 'error'""")
def snapshot_as_of(spark, sf_dir):
    snaps = snapshots.running_positions(
        _amendments(spark, sf_dir), by=("filer",), order=("ts", "event_id"))
    return snapshots.snapshot_as_of(snaps, _weekly_grid(spark, sf_dir), by=("filer",)).select(
        "filer", "as_of", "key", "value")


@query("positions_at", f"""WITH {_EVENT_STATE}, {_WEEKLY}
SELECT weekly.filer, as_of, user_id AS key, value
FROM weekly JOIN spans ON user_id % 10 = weekly.filer AND as_of >= d AND (until IS NULL OR as_of < until)
WHERE kind <> 'error'""")
def positions_at(spark, sf_dir):
    return snapshots.positions_at(
        _amendments(spark, sf_dir), _weekly_grid(spark, sf_dir), by=("filer",),
        order=("ts", "event_id")).select("filer", "as_of", "key", "value")


@query("exited_as_of", f"""WITH {_EVENT_STATE}, {_WEEKLY}
SELECT weekly.filer, as_of, user_id AS key
FROM weekly JOIN spans ON user_id % 10 = weekly.filer AND as_of >= d AND (until IS NULL OR as_of < until)
WHERE kind = 'error'""")
def exited_as_of(spark, sf_dir):
    return snapshots.positions_at(
        _amendments(spark, sf_dir), _weekly_grid(spark, sf_dir), by=("filer",),
        order=("ts", "event_id"), exited=True).select("filer", "as_of", "key")


@query("period_filings", f"""SELECT l_suppkey, {qend('l_shipdate')} AS period_end,
  max(CAST(l_shipdate AS DATE)) AS filing_date,
  arg_max(l_orderkey, (CAST(l_shipdate AS DATE), l_orderkey)) AS accession_no
FROM lineitem GROUP BY ALL""")
def period_filings(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", quarter_end("l_shipdate").alias("period_end"),
        F.col("l_shipdate").cast("date").alias("filing_date"), F.col("l_orderkey").alias("accession_no"))
    return snapshots.period_filings(line, "l_suppkey")


@query("latest_period_rows", f"""WITH q AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity,
  {qend('l_shipdate')} AS period_end FROM lineitem)
SELECT l_suppkey, period_end, l_orderkey, l_linenumber, l_quantity FROM q
WHERE (l_suppkey, period_end) IN (SELECT (l_suppkey, max(period_end)) FROM q GROUP BY l_suppkey)""")
def latest_period_rows(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", quarter_end("l_shipdate").alias("period_end"), "l_orderkey", "l_linenumber", "l_quantity")
    return snapshots.latest_period_rows(line, "l_suppkey")


@query("notes_as_of", f"""WITH notes AS (
  SELECT n_name AS parent_ticker, p_brand AS investee_ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS filed,
         max(CAST(l_shipdate AS DATE)) AS value_date, {sql_cents('l_extendedprice')} AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey GROUP BY ALL
),
dated AS (SELECT *, CASE WHEN day(value_date) % 5 = 0 THEN NULL ELSE value_date END AS vd FROM notes),
filings AS (SELECT parent_ticker, filed, row_number() OVER (PARTITION BY parent_ticker ORDER BY filed) AS f
            FROM (SELECT DISTINCT parent_ticker, filed FROM notes)),
grid AS (SELECT DISTINCT n_name AS parent_ticker, {qend('l_shipdate')} AS period_end
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
latest AS (SELECT g.parent_ticker, g.period_end, max(f) AS f FROM grid g JOIN filings s
           ON s.parent_ticker = g.parent_ticker AND s.filed <= g.period_end GROUP BY ALL),
cand AS (
  SELECT l.parent_ticker, l.period_end, d.investee_ticker, d.vd, d.value, s.f
  FROM latest l JOIN filings s ON s.parent_ticker = l.parent_ticker AND s.f BETWEEN l.f - 2 AND l.f
       JOIN dated d ON d.parent_ticker = s.parent_ticker AND d.filed = s.filed
  WHERE d.vd IS NULL OR d.vd <= l.period_end
),
ranked AS (
  SELECT *, max(CASE WHEN vd IS NULL THEN f END) OVER (
              PARTITION BY parent_ticker, period_end, investee_ticker) AS undated FROM cand
)
SELECT parent_ticker, period_end, investee_ticker, vd AS as_of_date, value AS market_value_usd
FROM ranked
QUALIFY row_number() OVER (PARTITION BY parent_ticker, period_end, investee_ticker ORDER BY
  CASE WHEN vd = period_end THEN 3 WHEN undated IS NULL OR f > undated THEN 2
       WHEN f = undated THEN 1 ELSE 0 END DESC, vd DESC NULLS LAST, f DESC) = 1""")
def notes_as_of(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    notes = owned_lines(spark, sf_dir, line).groupBy(
        F.col("n_name").alias("parent_ticker"), F.col("p_brand").alias("investee_ticker"),
        F.trunc(day, "month").alias("filing_date"),
    ).agg(F.max(day).alias("value_date"), cents("l_extendedprice").alias("market_value_usd"))
    notes = notes.select(
        "parent_ticker", "investee_ticker", "filing_date", F.lit("n").alias("accession_no"),
        F.when(F.day("value_date") % 5 != 0, F.col("value_date")).alias("as_of_date"),
        "market_value_usd", F.col("investee_ticker").alias("investee_name"),
        F.lit(None).cast("string").alias("cusip"), F.lit("20f_note").alias("note"))
    grid = periods(spark, sf_dir).select("parent_ticker", "period_end", F.col("period_end").alias("as_of"))
    return snapshots.notes_as_of(notes, grid, window=3).select(
        "parent_ticker", "period_end", "investee_ticker", "as_of_date", "market_value_usd")


# -- window edge ---------------------------------------------------------------------------------

_WINDOW = "DATE '1998-01-01'"


@query("edge_truncation", f"""WITH {POS},
inside AS (SELECT * FROM pos WHERE period_end >= {_WINDOW}),
before AS (SELECT * FROM pos WHERE period_end < {_WINDOW}),
edge AS (SELECT parent_ticker, investee_ticker FROM inside
         QUALIFY period_end = min(period_end) OVER (PARTITION BY parent_ticker)),
pre AS (SELECT b.* FROM before b SEMI JOIN edge e ON b.parent_ticker = e.parent_ticker
        AND b.investee_ticker = e.investee_ticker),
oldest AS (SELECT parent_ticker, investee_ticker FROM pre
           QUALIFY period_end = min(period_end) OVER (PARTITION BY parent_ticker))
SELECT parent_ticker, upper(investee_ticker) AS ticker FROM oldest
UNION
SELECT parent_ticker, upper(investee_ticker) FROM edge
WHERE parent_ticker NOT IN (SELECT parent_ticker FROM pre)""")
def edge_truncation(spark, sf_dir):
    rows = snapshot_rows(positions(spark, sf_dir))
    return snapshots.prewindow_backfill(rows, periods(spark, sf_dir), "1998-01-01")[2]


@query("prewindow_backfill", f"""WITH {POS},
edge AS (SELECT parent_ticker, investee_ticker FROM pos WHERE period_end >= {_WINDOW}
         QUALIFY period_end = min(period_end) OVER (PARTITION BY parent_ticker))
SELECT b.parent_ticker, b.investee_ticker, b.period_end, b.shares_held, b.market_value_usd
FROM pos b SEMI JOIN edge e ON b.parent_ticker = e.parent_ticker AND b.investee_ticker = e.investee_ticker
WHERE b.period_end < {_WINDOW}""")
def prewindow_backfill(spark, sf_dir):
    rows = snapshot_rows(positions(spark, sf_dir))
    return snapshots.prewindow_backfill(rows, periods(spark, sf_dir), "1998-01-01")[0].select(
        "parent_ticker", "investee_ticker", "period_end", "shares_held", "market_value_usd")


@query("exit_cutoffs", f"""WITH {POS},
cut AS (SELECT DISTINCT p_brand AS investee_ticker,
               CAST(make_date(1996 + CAST(right(p_brand, 1) AS INTEGER) % 5, 6, 30) AS DATE) AS cutoff FROM part)
SELECT parent_ticker, pos.investee_ticker, period_end, shares_held FROM pos JOIN cut USING (investee_ticker)
WHERE period_end <= cutoff""")
def exit_cutoffs(spark, sf_dir):
    cuts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("investee_ticker")).distinct().withColumn(
        "cutoff", F.make_date(F.lit(1996) + F.substring("investee_ticker", -1, 1).cast("int") % 5, F.lit(6), F.lit(30)))
    rows = snapshot_rows(positions(spark, sf_dir)).withColumn("accession_no", F.lit("x"))
    return ops.apply_exit_cutoffs(rows, cuts)[0].select(
        "parent_ticker", "investee_ticker", "period_end", "shares_held")


_CUTS = """cut AS (SELECT DISTINCT p_brand AS investee_ticker,
               CAST(make_date(1996 + CAST(right(p_brand, 1) AS INTEGER) % 5, 6, 30) AS DATE) AS cutoff FROM part)"""


def _cuts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("investee_ticker")).distinct().withColumn(
        "cutoff", F.make_date(F.lit(1996) + F.substring("investee_ticker", -1, 1).cast("int") % 5, F.lit(6), F.lit(30)))


def _filed(spark, sf_dir):
    """Snapshot rows and periods in which every parent files each period under its own number."""
    number = F.concat_ws("-", "parent_ticker", F.col("period_end").cast("string"))
    rows = snapshot_rows(positions(spark, sf_dir)).withColumns({
        "accession_no": number, "filing_date": F.col("period_end"), "note": F.lit("source=13g")})
    return rows, rows.select("parent_ticker", "period_end", "filing_date", "accession_no").distinct()


@query("exit_events", f"""WITH {POS}, {_CUTS}
SELECT parent_ticker, upper(investee_ticker) AS investee_ticker, min(period_end) AS filing_date,
       parent_ticker || '-' || CAST(min(period_end) AS VARCHAR) AS accession,
       'exit_reason=mna_acquired; mna_as_of=' || CAST(cutoff AS VARCHAR) AS note
FROM pos JOIN cut USING (investee_ticker) WHERE period_end > cutoff GROUP BY parent_ticker, investee_ticker, cutoff""")
def exit_events(spark, sf_dir):
    rows, _ = _filed(spark, sf_dir)
    return ops.apply_exit_cutoffs(rows, _cuts(spark, sf_dir))[1]


@query("exit_provenance", f"""WITH {POS}, {_CUTS},
late AS (SELECT parent_ticker, upper(investee_ticker) AS t, min(period_end) AS gone, cutoff
         FROM pos JOIN cut USING (investee_ticker) WHERE period_end > cutoff GROUP BY parent_ticker, investee_ticker, cutoff),
seen AS (SELECT parent_ticker, upper(investee_ticker) AS t, max(period_end) AS last_held
         FROM pos JOIN cut USING (investee_ticker) WHERE period_end <= cutoff GROUP BY ALL),
grid AS (SELECT DISTINCT parent_ticker, period_end FROM pos),
after AS (SELECT s.parent_ticker, s.t, min(g.period_end) AS period_end
          FROM seen s JOIN grid g ON g.parent_ticker = s.parent_ticker AND g.period_end > s.last_held GROUP BY ALL)
SELECT a.parent_ticker, a.t AS investee_ticker, a.period_end,
       l.parent_ticker || '-' || CAST(l.gone AS VARCHAR) AS accession_no, l.gone AS filing_date
FROM after a JOIN late l ON l.parent_ticker = a.parent_ticker AND l.t = a.t""")
def exit_provenance(spark, sf_dir):
    # Only the last exit of a name is followed: with gaps it has earlier ones, with the same document.
    rows, grid = _filed(spark, sf_dir)
    kept, exits = ops.apply_exit_cutoffs(rows, _cuts(spark, sf_dir))
    out = ops.diff_snapshots(kept, grid, exits).where("action = 'exit'")
    late = exits.select("parent_ticker", F.upper("investee_ticker").alias("investee_ticker"))
    last = out.groupBy("parent_ticker", F.upper("investee_ticker").alias("investee_ticker")).agg(
        F.max("period_end").alias("period_end"), F.max_by("accession_no", "period_end").alias("accession_no"),
        F.max_by("filing_date", "period_end").alias("filing_date"))
    return last.join(late, ["parent_ticker", "investee_ticker"], "left_semi")


@query("position_provenance", f"""WITH {HIST}
SELECT parent_ticker, investee_ticker, period_end, action, parent_ticker || '-' || CAST(period_end AS VARCHAR) AS accession_no,
  period_end AS filing_date, CASE WHEN action = 'exit' THEN period_end END AS exited_period,
  CASE WHEN action = 'exit' THEN 'source=13g; exit_inferred=missing_from_period' ELSE 'source=13g' END AS note FROM hist""")
def position_provenance(spark, sf_dir):
    return ops.diff_snapshots(*_filed(spark, sf_dir)).select(
        "parent_ticker", "investee_ticker", "period_end", "action", "accession_no", "filing_date", "exited_period", "note")
