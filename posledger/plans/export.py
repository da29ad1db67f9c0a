"""Checked export of the report tables.

An export gates first and publishes last: every table is written under one version, and only then is the version
entered, per parent, in the list that readers go by. A gate that fails, or a job that dies between two tables, leaves
the tables of the last complete version as they were. A version holds the parents of its export only; other parents
keep theirs, so nothing is rewritten for an export of one parent.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from posledger.functions.numbers import scrub_pct_as_shares
from posledger.operators import merge, quality, reporting, valuation
from posledger.plans.history import in_display_window
from posledger.plans.holdings import live_from_history
from posledger.plans.performance import performance_frames
from posledger.sources.tables import replace_by_key, stage

#: The list of complete versions: parent_ticker, version, tables.
PUBLISHED = "published"


def report_tables(live: DataFrame, history: DataFrame, ciks: DataFrame, window_start: str | Column,
                  income: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight report tables after coalescing and the gates.

    Positions and lots use the whole history, portfolio, chart and returns only the window.
    """
    rows = stage(reporting.normalized_keys(merge.coalesce_for_export(history)), "export")
    quality.enforce(quality.unique_period_ticker(rows))
    quality.enforce(quality.estimates_in_value(rows))
    current = stage(scrub_pct_as_shares(live), "current")
    quality.enforce(quality.pct_as_shares(current))
    quality.enforce(quality.estimates_in_value(current, "current"))
    shown = in_display_window(rows, window_start)
    frames = performance_frames(rows, income)
    quality.enforce(quality.mtm_identity(frames["returns_by_period"]))
    tables = {
        "current": current,
        "history": reporting.positions_frame(rows, ciks),
        "portfolio": reporting.portfolio_by_period(shown),
        "holdings_qoq_chart": chart_rows(shown),
        "returns_by_period": in_display_window(frames["returns_by_period"], window_start),
        "realized_pnl_qoq": frames["realized_pnl_qoq"],
        "holding_returns": frames["holding_returns"],
    }
    if "reported_vs_est" in frames:
        tables["reported_vs_est"] = frames["reported_vs_est"]
    return tables


def chart_rows(history: DataFrame) -> DataFrame:
    """Quarterly named sizing; parents without display values fall back on the portfolio."""
    named = reporting.quarterly_locf(history).select(
        "parent_ticker", "period_end", "investee_ticker", F.col("display_value_usd").alias("value_usd"),
        F.lit("display_estimate_or_broker").alias("chart_basis"))
    rest = reporting.portfolio_by_period(history).join(
        named.select("parent_ticker").distinct(), "parent_ticker", "left_anti")
    return named.unionByName(rest.select(
        "parent_ticker", "period_end", "investee_ticker", F.col("market_value_usd").alias("value_usd"),
        F.lit("portfolio_sot").alias("chart_basis")))


def export_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Write every table under ``folder``, replacing only the parents it contains."""
    for name, df in tables.items():
        replace_by_key(df, f"{folder}/{name}", "parent_ticker")


def live_rollup(current: DataFrame) -> DataFrame:
    """One row per parent of the live slice, dated by its newest row."""
    newest = current.groupBy("parent_ticker").agg(F.max("as_of_date").alias("as_of_date"))
    return valuation.rollup_parent(current).join(newest, "parent_ticker").withColumns({
        "accession_no": F.lit(None).cast("string"), "extract_error": F.lit(None).cast("string"),
    }).withColumnRenamed("parent_ticker", "ticker")


def new_version() -> str:
    """A version name; later ones are larger."""
    return f"v{datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"


def publish(tables: dict[str, DataFrame], parents: DataFrame, folder: str, version: str | None = None) -> str:
    """Write every table under one version, then enter the version for ``parents`` (parent_ticker)."""
    version = version or new_version()
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}/version={version}")
    # One task writes the entries of a version, so they appear together when its job is committed.
    entries = parents.select("parent_ticker").distinct().select(
        "parent_ticker", F.lit(version).alias("version"), F.array(*map(F.lit, sorted(tables))).alias("tables"))
    entries.coalesce(1).write.mode("append").parquet(f"{folder}/{PUBLISHED}")
    return version


def published_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The last complete version of every parent: parent_ticker, version, tables."""
    entries = spark.read.parquet(f"{folder}/{PUBLISHED}")
    return entries.groupBy("parent_ticker").agg(F.max(F.struct("version", "tables")).alias("e")).select("parent_ticker", "e.*")


def read_published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table as of every parent's last complete version, older columns missing from a version being NULL.

    Versions without an entry, whole or in part, are never seen: the version is the partition column, so the join
    with the entries prunes their files.
    """
    entries = published_versions(spark, folder).where(F.array_contains("tables", name)).select("parent_ticker", "version")
    rows = spark.read.option("mergeSchema", True).parquet(f"{folder}/{name}")
    by = "ticker" if "parent_ticker" not in rows.columns else "parent_ticker"
    return rows.join(entries.withColumnRenamed("parent_ticker", by), [by, "version"], "left_semi").drop("version")


def export_parents(history: DataFrame, ciks: DataFrame, folder: str, window_start: str | Column,
                   income: DataFrame | None = None, live: DataFrame | None = None, version: str | None = None) -> str:
    """From the history of some parents to their published reports; the version that was published.

    The live slice is that of the history unless it is given, and is published with its rollup, so that holdings,
    rollups and reports of a parent always belong to one run. Raises ``QualityError`` before anything is written.
    """
    rows = stage(history, "export-history")
    current = live_from_history(rows) if live is None else live
    tables = report_tables(current, rows, ciks, window_start, income)
    tables["rollups"] = live_rollup(tables["current"])
    return publish(tables, rows.select("parent_ticker"), folder, version)
