"""Live holdings and parent rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from posledger.functions.numbers import scrub_pct_as_shares
from posledger.functions.text import append_tags, holding_key, note_text
from posledger.functions.valuation import apply_gaap_and_adjustment
from posledger.operators import ledger, merge, quality, valuation
from posledger.operators.asof import Side, asof_join_many
from posledger.operators.screening import apply_allowlist
from posledger.schemas import HOLDINGS_DEFAULTS, HOLDINGS_SCHEMA, conform
from posledger.sources.tables import stage


def live_holdings(groups: Sequence[DataFrame]) -> DataFrame:
    """Merge current rows (highest priority first), keep disclosed values only, classify, scrub."""
    merged = merge.merge_live(groups)
    quarterly = F.lower(F.coalesce("source", F.lit(""))).rlike("(^|\\+)(13f|sec_api_13f)")
    allowed = merge.allows_disclosed_value(F.col("source"), F.col("note"))
    valued = merged.withColumn(
        "market_value_usd", F.when(quarterly | allowed, F.col("market_value_usd")))
    treated = apply_gaap_and_adjustment(valued)
    label = F.concat(F.lit("source="), F.col("source"))
    noted = treated.withColumn("note", F.when(
        F.col("source").isNotNull() & ~note_text("note").contains(label), F.concat_ws("; ", label, "note")
    ).otherwise(F.col("note")))
    return scrub_pct_as_shares(conform(noted, HOLDINGS_SCHEMA, HOLDINGS_DEFAULTS))


def live_from_history(history: DataFrame) -> DataFrame:
    """Open positions of the history in the live layout, with their provenance in the note."""
    rows = ledger.open_positions(history)

    def tag(name):
        value = F.col(name).cast("string")
        piece = F.concat(F.lit(f"{name}="), value)
        return (F.col(name).isNotNull(), piece, piece)

    estimate = ("value_estimate=eod_at_filing; estimate_role=cost_basis; "
                "not_fv_allocation; excluded_from_portfolio_mv")
    note = append_tags(
        "note", tag("composition_parent"), tag("composition_as_of"), tag("child_value_source"),
        tag("parent_aggregate_market_value_usd"), tag("cost_basis_est_usd"),
        (F.col("cost_basis_est_usd").isNotNull(), estimate, estimate))
    day = F.coalesce("period_end", "composition_as_of")
    live = rows.withColumns({
        "as_of_date": day, "as_of_accession_no": F.col("accession_no"),
        "first_filing_date": F.coalesce("first_seen_period", day), "first_accession_no": F.col("accession_no"),
        "confidence": F.lit("history_slice"), "note": note})
    return conform(live, HOLDINGS_SCHEMA, HOLDINGS_DEFAULTS)


def holdings_as_of(holdings: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows known at each (parent_ticker, as_of): of every name the newest dated on or before the date.

    A dated row holds until the name's next one; undated rows are known from the start. Rows are placed on the numbered
    dates of their parent, spread over the numbers they hold for and joined on equality, so a row never meets a date
    that it is not known at.
    """
    cusip = F.col("cusip") if "cusip" in holdings.columns else F.lit(None).cast("string")
    key = F.coalesce(holding_key("investee_ticker", cusip, "investee_name"), F.lit(""))
    asked = Window.partitionBy("parent_ticker").orderBy("as_of")
    grid = keys.select("parent_ticker", "as_of").distinct().withColumn("_i", F.row_number().over(asked))
    total = grid.groupBy("parent_ticker").agg(F.max("_i").alias("_n"))
    placed = asof_join_many(holdings.withColumn("_key", key), "parent_ticker", "as_of_date", {
        "_at": Side(grid.withColumnRenamed("as_of", "_day"), "_day", ("_i",), "forward")}).join(total, "parent_ticker")
    first = F.when(F.col("as_of_date").isNull(), 1).otherwise(F.coalesce(F.col("_at._i"), F.col("_n") + 1))
    w = Window.partitionBy("parent_ticker", "_key").orderBy(F.col("as_of_date").asc_nulls_first(), "as_of_accession_no")
    held = placed.withColumn("_first", first).withColumn("_last", F.coalesce(F.lead("_first").over(w) - 1, "_n"))
    spread = held.where(F.col("_first") <= F.col("_last")).withColumn("_i", F.explode(F.sequence("_first", "_last")))
    return spread.join(grid, ["parent_ticker", "_i"]).select(*holdings.columns, "as_of")


def holdings_universe(parents: DataFrame, holdings: DataFrame, allow: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Holdings of the asked parents and one rollup row per parent, or per parent and date.

    ``parents``: ticker, price, book_value, shares and, for the backtest, as_of; with it only holdings known
    at that date count, and both results carry it. A parent without any holding still gets its row, with the
    reason.
    """
    asked = apply_allowlist(parents, allow) if allow is not None else parents
    dated = "as_of" in asked.columns
    by = ["parent_ticker", "as_of"] if dated else ["parent_ticker"]
    keyed = asked.select(
        F.col("ticker").alias("parent_ticker"), "price", F.col("book_value").alias("bvps"), "shares", *by[1:])
    if dated:
        mine = holdings_as_of(holdings, keyed.select(*by))
    else:
        mine = holdings.join(keyed.select("parent_ticker").distinct(), "parent_ticker", "left_semi")
    seen = mine.groupBy(*by).agg(
        F.max("as_of_date").alias("_last"),
        F.max_by("as_of_accession_no", F.when(F.col("as_of_accession_no").isNotNull(), F.col("as_of_date"))).alias("accession_no"))
    rolled = valuation.rollup_parent(mine, keyed, tuple(by)).join(seen, by, "left")
    error = F.when(F.col("holdings_count") == 0, F.lit("no holdings from 13F/13G/notes"))
    rollups = rolled.withColumns({
        "as_of_date": F.col("as_of") if dated else F.col("_last"), "extract_error": error,
    }).drop("_last", "as_of").withColumnRenamed("parent_ticker", "ticker")
    return mine, rollups


def backtest_parents(crossings: DataFrame) -> DataFrame:
    """Parents of the backtest: prices and book at the crossing, holdings as of the deletion."""
    return crossings.select(
        "ticker", F.col("buy_price").alias("price"), F.col("bvps_at_crossing").alias("book_value"),
        F.col("shares_at_crossing").alias("shares"), F.col("deletion_date").alias("as_of"))


def checked_holdings(holdings: DataFrame) -> DataFrame:
    """Scrubbed rows; raises if a share count still repeats a percentage.

    They are staged, so the check and whoever reads them do not work the holdings out again.
    """
    clean = stage(scrub_pct_as_shares(holdings), "checked-holdings")
    quality.enforce(quality.pct_as_shares(clean))
    return clean
