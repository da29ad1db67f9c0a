"""Position history of all parents from landed filings.

Intermediates that several branches read are written once to the shared folder: inputs are parsed
once, plans stay small, and a lost executor costs a re-read instead of a re-computation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from posledger.functions.dates import lookback_start
from posledger.functions.text import filing_url, holding_key, normalize_ticker
from posledger.operators import ledger, merge, snapshots, text, valuation
from posledger.operators.identity import drop_self_issuer, resolve_identity
from posledger.schemas import HISTORY_SCHEMA, SNAPSHOT_SCHEMA, conform
from posledger.sources import fixed_values as fixed
from posledger.sources.filings import flatten_13f_json, history_strategy, parse_13f_json
from posledger.sources.tables import stage


def quarterly_snapshots(payloads: DataFrame, dims: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Snapshot rows and reporting periods from quarterly report payloads (parent_ticker, payload)."""
    reports = parse_13f_json(payloads)
    chosen = stage(snapshots.period_filings(reports), "reports")
    rows = stage(flatten_13f_json(chosen), "holdings")
    named = resolve_identity(rows, dims["cusips"], dims["aliases"], dims["hints"])
    return stage(named, "quarterly"), chosen.select("parent_ticker", "period_end", "filing_date", "accession_no")


def ownership_events(filings: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Dated amendments from ownership filings (parent_ticker, cik, form, filing_date, accession_no,
    body); filings about the parent itself are dropped."""
    parsed = text.extract_ownership_filing(filings.where(F.col("form").isin(*fixed.OWNERSHIP_FORMS)))
    rows = parsed.withColumnsRenamed({"issuer_name": "investee_name", "ticker": "investee_ticker"})
    foreign = drop_self_issuer(rows.where(F.col("investee_name").isNotNull()), dims["parent_hints"])
    named = resolve_identity(stage(foreign.drop("body"), "ownership"), dims["cusips"], dims["aliases"], dims["hints"])
    positions = text.ownership_positions(named)
    return stage(positions.withColumn("key", holding_key("investee_ticker", "cusip", "investee_name")).where(
        F.col("key").isNotNull()), "amendments")


def note_snapshots(filings: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Note rows from annual and interim filings (parent_ticker, form, filing_date, accession_no, body)."""
    meta = ["parent_ticker", "form", "filing_date", "accession_no"]
    base = filings.where(F.col("form").isin("20-F", "10-K", "10-Q")).select(*meta, "body")
    notes = text.extract_investment_notes(base).withColumns({
        "investee_ticker": F.lit(None).cast("string"), "as_of_date": F.col("filing_date"), "cusip": F.lit(None).cast("string")})
    tables = text.extract_investments_table(base).withColumn("cusip", F.lit(None).cast("string"))
    both = stage(notes.unionByName(tables, allowMissingColumns=True), "note-facts")
    named = resolve_identity(both, dims["cusips"], dims["aliases"], dims["hints"])
    positions = text.note_positions(named).withColumn("as_of_accession_no", F.col("accession_no"))
    return stage(conform(positions, SNAPSHOT_SCHEMA), "notes")


def exit_event_table(events: DataFrame) -> DataFrame:
    """Last explicit exit per parent and ticker."""
    return events.where(F.col("is_exit") & normalize_ticker("investee_ticker").isNotNull()).groupBy(
        "parent_ticker", normalize_ticker("investee_ticker").alias("investee_ticker")).agg(
        F.max_by(F.struct(F.col("accession_no").alias("accession"), "filing_date"),
                 F.struct("filing_date", "accession_no")).alias("e")).select(
        "parent_ticker", "investee_ticker", "e.accession", "e.filing_date")


def build_history(quarterly: DataFrame, periods: DataFrame, events: DataFrame, notes: DataFrame,
                  window_start: str | Column, ciks: DataFrame, note_window: int | None = None) -> DataFrame:
    """Quarterly grid with ownership and note overlays, pre-window inception and truncation tags.

    Parents without quarterly reports use their ownership filing dates as the grid. Pre-window
    periods carry edge-held quarterly rows only.
    """
    start = F.lit(window_start).cast("date")
    inside, _ = snapshots.split_window(periods, start)
    pre_rows, pre_periods, truncated = snapshots.prewindow_backfill(quarterly, periods, start)
    recent = events.where(F.col("filing_date") >= start)
    recent_notes = notes.where(F.col("filing_date") >= start)

    grid = inside.select("parent_ticker", "period_end", F.coalesce("filing_date", "period_end").alias("as_of"))
    held = snapshots.positions_at(recent, grid)
    gone = snapshots.positions_at(
        recent.where(normalize_ticker("investee_ticker").isNotNull()).withColumn("tkey", normalize_ticker("investee_ticker")),
        grid, key="tkey", exited=True)
    known = snapshots.notes_as_of(recent_notes, grid, note_window)
    fresh = ledger.suppress_exited(known, gone, ["parent_ticker", "period_end"])

    main = quarterly.join(inside.select("parent_ticker", "period_end"), ["parent_ticker", "period_end"], "left_semi")
    parts = [conform(df, SNAPSHOT_SCHEMA).drop("filing_date", "accession_no") for df in (main, held, fresh)]
    merged = stage(merge.merge_sources(parts), "merged")
    dated = merged.join(inside, ["parent_ticker", "period_end"])
    rows = conform(dated, SNAPSHOT_SCHEMA).unionByName(conform(pre_rows, SNAPSHOT_SCHEMA))
    all_periods = inside.unionByName(pre_periods)

    lonely = recent.join(inside.select("parent_ticker").distinct(), "parent_ticker", "left_anti")
    own_rows, own_periods = ownership_grid(lonely)
    history = stage(ledger.diff_snapshots(
        rows.unionByName(own_rows), all_periods.unionByName(own_periods)), "difference")
    clean = ledger.normalize_export_rows(merge.coalesce_for_export(merge.coalesce_survivors(history)))
    return stage(snapshots.stamp_truncated(stamp_urls(clean, ciks), truncated), "history")


def ownership_grid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Running ownership snapshots as rows and periods, one per filing date."""
    running = snapshots.running_positions(events).withColumns({
        "period_end": F.col("snapshot_date"), "filing_date": F.col("snapshot_date"),
        "accession_no": F.col("snapshot_accession")})
    w = events.groupBy("parent_ticker", F.col("filing_date").alias("period_end")).agg(F.max("accession_no").alias("accession_no"))
    periods = w.select("parent_ticker", "period_end", F.col("period_end").alias("filing_date"), "accession_no")
    return conform(running, SNAPSHOT_SCHEMA), periods


def stamp_urls(history: DataFrame, ciks: DataFrame) -> DataFrame:
    known = ciks.select("parent_ticker", F.col("cik").alias("_cik"))
    return history.join(known, "parent_ticker", "left").withColumn(
        "filing_url", filing_url("_cik", "accession_no", "filing_url")).select(*history.columns)


def build_aggregate_history(events: DataFrame, annual: DataFrame, stakes: DataFrame, prices: DataFrame,
                            cutoffs: DataFrame, ciks: DataFrame, window_start: str | Column | None = None) -> DataFrame:
    """History of parents that publish annual aggregates: running ownership snapshots, exits after
    delisting, aggregates, composition, broker values and filing-date marks."""
    rows_in = events if window_start is None else events.where(F.col("filing_date") >= F.lit(window_start).cast("date"))
    rows, periods = ownership_grid(rows_in)
    rows = stage(rows, "running")
    kept, late_exits = ledger.apply_exit_cutoffs(rows, cutoffs)
    explicit = exit_event_table(rows_in)
    exits = explicit.withColumn("note", F.lit(None).cast("string")).unionByName(
        late_exits.join(explicit.select("parent_ticker", "investee_ticker"), ["parent_ticker", "investee_ticker"], "left_anti"))
    difference = stage(ledger.diff_snapshots(kept, periods, exits), "difference")
    history = merge.coalesce_for_export(difference)
    aggregates = text.annual_history_rows(annual)
    if window_start is not None:
        aggregates = aggregates.where(F.col("period_end") >= F.lit(window_start).cast("date"))
    full = stage(history.unionByName(conform(aggregates, HISTORY_SCHEMA)), "with-aggregates")
    stamped = stage(valuation.stamp_composition(full), "stamped")
    overlaid = stage(valuation.overlay_values(stamped, stakes), "overlaid")
    final = stage(valuation.finalize_composition(valuation.stamp_composition(overlaid)), "restamped")
    marked = valuation.filing_marks(final, prices)
    return stage(stamp_urls(conform(marked, HISTORY_SCHEMA), ciks), "history")


def history_of_parents(payloads: DataFrame, filings: DataFrame, annual_pages: DataFrame, dims: dict[str, DataFrame], as_of: Column,
                       stakes: DataFrame, prices: DataFrame, cutoffs: DataFrame, years: int = 5, aggregate_years: int = 8,
                       note_window: int | None = None) -> DataFrame:
    """History of every parent of the landed tables, each by its own strategy, in one plan.

    Parents that publish annual aggregates take the dates of their ownership filings as grid, with aggregates,
    composition, published stakes and marks; all others take their quarterly reports, overlaid with ownership filings
    and notes, or the ownership dates where there are no quarterly reports in the window. Every landed table is read
    and parsed once for all parents. ``strategy`` and ``grid`` (13f or 13g) say how a parent's rows came about.

    ``payloads``: parent_ticker, payload; ``filings``: parent_ticker, cik, form, filing_date, accession_no, body;
    ``annual_pages``: parent_ticker, as_of_date, source_url, text; ``stakes``, ``prices`` and ``cutoffs`` as in
    ``build_aggregate_history``. The window ends at ``as_of`` and is longer for parents with aggregates.
    """
    aggregate = F.col("parent_ticker").isin(*fixed.AGGREGATE_PARENTS)
    events = ownership_events(filings, dims)
    quarterly, periods = quarterly_snapshots(payloads.where(~aggregate), dims)
    notes = note_snapshots(filings.where(~aggregate), dims)
    start = lookback_start(as_of, years)
    standard = build_history(quarterly, periods, events.where(~aggregate), notes, start, dims["ciks"], note_window)
    annual = text.extract_annual_aggregates(annual_pages.where(aggregate))
    published = build_aggregate_history(events.where(aggregate), annual, stakes, prices, cutoffs, dims["ciks"],
                                        lookback_start(as_of, aggregate_years))
    inside, _ = snapshots.split_window(periods, start)
    gridded = inside.select("parent_ticker", F.lit("13f").alias("grid")).distinct()
    both = standard.unionByName(published, allowMissingColumns=True).join(gridded, "parent_ticker", "left")
    return both.withColumns({
        "strategy": history_strategy("parent_ticker"), "grid": F.coalesce("grid", F.lit("13g"))})


def window_of(as_of, years: int):
    """Start of the display window as a column."""
    return lookback_start(as_of, years)


def in_display_window(history: DataFrame, window_start: str | Column) -> DataFrame:
    return history.where(F.col("period_end") >= F.lit(window_start).cast("date"))

