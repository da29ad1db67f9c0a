"""Quality checks on driver tables with planted faults, compared finding by finding."""

from pyspark.sql import Window, functions as F

from posledger.bindings.registry import query
from posledger.bindings.views import HIST, POS, ledger, positions, table
from posledger.operators import quality, reporting, snapshots
from posledger.plans import precheck
from posledger.sources import fixed_values as fixed
from posledger.sources.filings import load_dims
from posledger.sources.tables import stage


def _counted(findings, *evidence):
    """Findings per check and the named evidence."""
    keys = [F.col("evidence")[e].alias(e) for e in evidence]
    return findings.groupBy("check_id", "severity", *keys).agg(F.count(F.lit(1)).alias("findings"))


@query("hidden_public_names", """WITH words AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS w FROM part),
aliases AS (SELECT w AS alias, 'W_' || upper(w) AS ticker FROM words WHERE w < 'p')
SELECT 'public_ticker_misclassified_as_private' AS check_id, 'fail' AS severity, 'PRIV_' || p_partkey AS was, min(ticker) AS investee_ticker, CAST(1 AS BIGINT) AS findings
FROM part JOIN aliases ON contains(p_name, alias) WHERE p_partkey % 2 = 0 GROUP BY p_partkey""")
def hidden_public_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    private = F.concat(F.when(F.col("p_partkey") % 2 == 0, F.lit("PRIV_")).otherwise(F.lit("T")), "p_partkey")
    rows = part.select(F.lit("P").alias("parent_ticker"), F.lit(None).cast("date").alias("period_end"),
                       F.col("p_name").alias("investee_name"), private.alias("investee_ticker"), F.lit(None).cast("string").alias("note"))
    words = part.select(F.split("p_name", " ")[1].alias("alias")).distinct().where("alias < 'p'")
    ticker = F.concat(F.lit("W_"), F.upper("alias"))
    dims = {"cusips": spark.createDataFrame([], "cusip string, ticker string"),
            "aliases": words.select("alias", ticker.alias("ticker"), ticker.alias("alias_order")),
            "hints": spark.createDataFrame([], "alias string, ticker string, alias_order string")}
    return _counted(quality.hidden_public_name(rows, dims), "was", "investee_ticker")


@query("anchor_findings", f"""WITH {POS}, a AS (SELECT *, market_value_usd * CASE month(period_end) WHEN 3 THEN 1.02 WHEN 6 THEN 1.2 ELSE 1.0 END AS expected FROM pos)
SELECT 'anchor_value_mismatch' AS check_id, 'fail' AS severity, parent_ticker, investee_ticker, count(*) AS findings FROM (
  SELECT parent_ticker, investee_ticker FROM a WHERE abs(market_value_usd - expected) > greatest(100.0, expected * 0.05)
  UNION ALL SELECT parent_ticker, 'MISSING' FROM (SELECT DISTINCT parent_ticker FROM pos)) GROUP BY ALL""")
def anchor_findings(spark, sf_dir):
    held = positions(spark, sf_dir)
    off = F.when(F.month("period_end") == 3, 1.02).when(F.month("period_end") == 6, 1.2).otherwise(1.0)
    known = held.select("parent_ticker", "period_end", "investee_ticker", (F.col("market_value_usd") * off).alias("expected_usd"))
    lost = held.select("parent_ticker").distinct().select(
        "parent_ticker", F.to_date(F.lit("1990-03-31")).alias("period_end"), F.lit("MISSING").alias("investee_ticker"), F.lit(1.0).alias("expected_usd"))
    return _counted(quality.anchor_values(held, known.unionByName(lost), 100.0, 0.05), "parent_ticker", "investee_ticker")


@query("catalog_findings", """SELECT check_id, severity, count(*) AS findings FROM (
  SELECT 'catalog_size' AS check_id, 'info' AS severity
  UNION ALL SELECT 'missing_url', 'fail' FROM supplier WHERE s_suppkey % 5 = 0
  UNION ALL SELECT 'missing_parser', 'fail' FROM supplier WHERE s_suppkey % 7 = 0
  UNION ALL SELECT 'missing_as_of', 'warn' FROM supplier WHERE s_suppkey % 11 = 0) GROUP BY ALL""")
def catalog_findings(spark, sf_dir):
    key = F.col("s_suppkey")
    catalog = table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("id"), F.lit("s").alias("series_id"), F.lit("P").alias("parent_ticker"),
        F.when(key % 5 != 0, F.lit("url")).otherwise(F.lit(" ")).alias("source_url"), F.when(key % 7 != 0, F.lit("p")).alias("parser"),
        F.when(key % 11 != 0, F.to_date(F.lit("2020-01-01"))).alias("as_of"))
    return _counted(quality.catalog_completeness(catalog))


@query("stake_findings", """WITH r AS (SELECT l_suppkey AS report_id, l_quantity * 5 AS pct, l_extendedprice * 100 AS v, l_linenumber AS n FROM lineitem),
few AS (SELECT report_id FROM r GROUP BY ALL HAVING count(*) < 600)
SELECT check_id, severity, count(*) AS findings FROM (
  SELECT 'too_few_rows' AS check_id, 'fail' AS severity FROM few
  UNION ALL SELECT 'value_unit_likely_wrong', 'fail' FROM r WHERE n <> 7 AND v > 5000000
  UNION ALL SELECT 'value_suspiciously_small', 'warn' FROM r WHERE n = 7
  UNION ALL SELECT 'stake_out_of_range', 'fail' FROM r WHERE NOT (pct > 0 AND pct <= 100)
  UNION ALL SELECT 'ticker_is_exchange_suffix', 'fail' FROM r WHERE n = 6
  UNION ALL SELECT 'outside_band', 'warn' FROM r WHERE n = 5 AND NOT pct BETWEEN 50 AND 200) GROUP BY ALL""")
def stake_findings(spark, sf_dir):
    n, value = F.col("l_linenumber"), F.col("l_extendedprice") * 100
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("report_id"), F.when(n == 6, F.lit(fixed.EXCHANGE_CODES[0])).otherwise(F.concat(F.lit("T"), n)).alias("investee_ticker"),
        F.lit("x").alias("investee_name"), (F.col("l_quantity") * 5).alias("ownership_pct"),
        F.when(n == 7, F.lit(5.0)).otherwise(value).alias("value_to_parent_hkd_mn"))
    bands = spark.createDataFrame([("T5", 50.0, 200.0, "warn", "outside_band")], "investee_ticker string, low double, high double, severity string, check_id string")
    return _counted(quality.stake_sanity(rows, 600, bands))


@query("fx_findings", """SELECT 'fx_roundtrip' AS check_id, 'fail' AS severity, CAST(l_suppkey AS VARCHAR) AS investee_ticker, count(*) AS findings
FROM lineitem WHERE l_linenumber = 3 GROUP BY l_suppkey""")
def fx_findings(spark, sf_dir):
    n = F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("investee_ticker"), F.to_date("l_shipdate").alias("as_of"), F.lit(7.8).alias("fx"),
        F.col("l_quantity").alias("value_to_parent_hkd_mn"),
        (F.col("l_quantity") * 1e6 / 7.8 * F.when(n == 3, 1.05).when(n == 4, 1.01).otherwise(1.0)).alias("value_usd"))
    return _counted(quality.fx_round_trip(rows), "investee_ticker")


@query("overlay_findings", f"""WITH {HIST}, r AS (SELECT *, investee_ticker LIKE '%1' AS stamped, investee_ticker LIKE '%11' AS big FROM hist)
SELECT check_id, severity, parent_ticker, count(*) AS findings FROM (
  SELECT 'child_mv_looks_like_parent' AS check_id, 'fail' AS severity, parent_ticker FROM r WHERE big
  UNION ALL SELECT 'missing_exclude', 'warn', parent_ticker FROM r WHERE stamped AND month(period_end) = 3) GROUP BY ALL""")
def overlay_findings(spark, sf_dir):
    t = F.col("investee_ticker")
    note = F.when(t.endswith("1"), F.concat(F.lit("value_source=broker_sotp"), F.when(
        F.month("period_end") != 3, F.lit("; excluded_from_portfolio_mv")).otherwise(F.lit(""))))
    rows = ledger(spark, sf_dir).withColumns({"note": note, "market_value_usd": F.when(t.endswith("11"), F.lit(61e9)).otherwise(F.lit(1.0))})
    return _counted(quality.overlay_checks(rows), "parent_ticker")


@query("composition_findings", """SELECT check_id, 'fail' AS severity, count(*) AS findings FROM (
  SELECT 'parent_vs_child_confusion_risk' AS check_id FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT 'child_equals_parent' FROM orders WHERE o_orderkey % 5 = 1
  UNION ALL SELECT 'child_looks_like_parent_agg' FROM orders WHERE o_orderkey % 5 IN (1, 2)
  UNION ALL SELECT 'child_mv_missing_join_keys' FROM orders WHERE o_orderkey % 5 = 3) GROUP BY ALL""")
def composition_findings(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    child = F.when(k == 1, 69e9).when(k == 2, 65e9).when(k > 2, 1e9)
    view = table(spark, sf_dir, "orders").select(
        F.lit("P").alias("parent_ticker"), F.when(k != 3, F.to_date("o_orderdate")).alias("period_end"), F.lit("C").alias("composition_parent"),
        F.concat(F.lit("c"), "o_orderkey").alias("child_ticker"), child.alias("child_market_value_usd"), F.lit(70e9).alias("parent_aggregate_market_value_usd"))
    residual = view.withColumn("child_ticker", F.lit("X_RESIDUAL"))
    return _counted(quality.composition_checks(view.unionByName(residual)))


@query("stage_verdicts", """SELECT o_orderpriority AS stage, count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority > '3') AS n_fail,
  count(*) FILTER (o_orderstatus = 'O') AS n_warn, count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority > '3') = 0 AS ok FROM orders GROUP BY ALL""")
def stage_verdicts(spark, sf_dir):
    severity = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") > "3"), F.lit("fail")).when(
        F.col("o_orderstatus") == "O", F.lit("warn")).otherwise(F.lit("info"))
    return quality.merge_reports(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("stage"), severity.alias("severity")))


@query("exit_sample", f"""WITH {HIST} SELECT period_end, investee_ticker, action, parent_ticker AS accession_no FROM hist WHERE action = 'exit'
ORDER BY period_end, investee_ticker, parent_ticker LIMIT 25""")
def exit_sample(spark, sf_dir):
    rows = ledger(spark, sf_dir).withColumn("accession_no", F.col("parent_ticker"))
    return quality.exit_sample(rows, 25).select("period_end", "investee_ticker", "action", "accession_no")


@query("truncation_stamps", f"""WITH {HIST} SELECT parent_ticker, investee_ticker, period_end, action,
  CASE WHEN investee_ticker NOT LIKE '%5' THEN 'n' WHEN action IN ('new', 'buy') THEN 'n; lookback_truncated=1; cost_basis=unknown_truncated'
       ELSE 'n; lookback_truncated=1' END AS note FROM hist""")
def truncation_stamps(spark, sf_dir):
    rows = ledger(spark, sf_dir).withColumn("note", F.lit("n"))
    cut = rows.where(F.col("investee_ticker").endswith("5")).select("parent_ticker", F.upper("investee_ticker").alias("ticker")).distinct()
    return snapshots.stamp_truncated(rows, cut).select("parent_ticker", "investee_ticker", "period_end", "action", "note")


@query("mechanical_precheck", f"""WITH {HIST},
d AS (SELECT parent_ticker, investee_ticker AS b, period_end, action, shares_held, market_value_usd,
        CASE WHEN investee_ticker LIKE '%1' THEN shares_held ELSE 12.5 END AS pct,
        CASE WHEN investee_ticker LIKE '%5' THEN 'source=13g; 13g_exit=1' WHEN investee_ticker LIKE '%6' THEN 'priced=shares*eodhd'
             WHEN investee_ticker LIKE '%8' THEN 'source=13g shares_proxy=presence' WHEN investee_ticker LIKE '%2' THEN 'value_estimate=eod_at_filing'
             ELSE '' END AS note FROM hist),
f AS (
  SELECT 'ownership_pct_stuffed_into_shares_held' AS check_id, parent_ticker FROM d WHERE shares_held > 0 AND shares_held <= 100 AND pct > 0 AND pct <= 100 AND abs(shares_held - pct) < 1e-6
  UNION ALL SELECT 'otc_invent_marker', parent_ticker FROM d WHERE note LIKE '%priced=shares*eodhd%'
  UNION ALL SELECT 'beneficial_ownership_used_as_value_source', parent_ticker FROM d WHERE market_value_usd > 0 AND note LIKE '%source=13g%'
  UNION ALL SELECT 'false_13g_exit_positive_stake', parent_ticker FROM d WHERE note LIKE '%13g_exit=1%' AND (pct > 0 OR shares_held > 0)
  UNION ALL SELECT 'shares_proxy_presence_invent', parent_ticker FROM d WHERE note LIKE '%shares_proxy=presence%'
  UNION ALL SELECT 'estimate_missing_excluded_from_portfolio_mv', parent_ticker FROM d WHERE b LIKE '%4'
  UNION ALL SELECT 'eod_estimate_as_market_value', parent_ticker FROM d WHERE note = 'value_estimate=eod_at_filing' AND market_value_usd IS NOT NULL
  UNION ALL SELECT 'overlay_exit_invented_zero', parent_ticker FROM d WHERE note LIKE '%source=13g%' AND action = 'exit' AND market_value_usd = 0
  UNION ALL SELECT 'placeholder_exchange_like_ticker', parent_ticker FROM d WHERE b LIKE '%3' AND month(period_end) = 6
  UNION ALL SELECT 'public_ticker_misclassified_as_private', parent_ticker FROM d WHERE b LIKE '%9'
  UNION ALL SELECT 'anchor_value_mismatch', parent_ticker FROM d WHERE b LIKE '%7' AND action <> 'exit' AND month(period_end) = 12)
SELECT check_id, 'fail' AS severity, parent_ticker, count(*) AS findings FROM f GROUP BY ALL""")
def mechanical_precheck(spark, sf_dir):
    t, value = F.col("investee_ticker"), F.col("market_value_usd")
    # One brand ending in 3 has a placeholder for its ticker in the second quarter of each year.
    brand = F.row_number().over(Window.partitionBy("parent_ticker", "period_end").orderBy("investee_ticker"))
    placeholder = t.endswith("3") & (F.month("period_end") == 6)
    history = stage(ledger(spark, sf_dir).withColumns({
        "ownership_pct": F.when(t.endswith("1"), F.col("shares_held")).otherwise(F.lit(12.5)),
        "note": F.when(t.endswith("5"), F.lit("source=13g; 13g_exit=1")).when(t.endswith("6"), F.lit("priced=shares*eodhd"))
        .when(t.endswith("8"), F.lit("source=13g shares_proxy=presence")).when(t.endswith("2"), F.lit("value_estimate=eod_at_filing"))
        .otherwise(F.lit("")),
        "cost_basis_est_usd": F.when(t.endswith("4"), F.lit(1.0)),
        "investee_name": F.when(t.endswith("9"), F.lit("DiDi Global Inc.")).otherwise(F.col("investee_name")),
    }), "prechecked")
    named = history.withColumn("investee_ticker", F.when(t.endswith("9"), F.concat(F.lit("PRIV_"), t)).otherwise(t))
    marked = named.withColumn("_nr", brand).withColumns({
        "investee_ticker": F.when(placeholder, F.lit("ANT")).otherwise(t),
        # Placeholders of a period stay apart: each has a period of its own, a day later.
        "period_end": F.when(placeholder, F.date_add("period_end", F.col("_nr"))).otherwise(F.col("period_end"))}).drop("_nr")
    portfolio = reporting.portfolio_by_period(history)
    off = F.when(F.month("period_end") == 12, value * 2 + 2e8).otherwise(value)
    anchors = portfolio.where(F.col("investee_ticker").endswith("7")).select(
        "parent_ticker", "period_end", "investee_ticker", off.alias("expected_usd"))
    return _counted(precheck.mechanical_precheck(marked, load_dims(spark), portfolio, anchors), "parent_ticker")
