"""Dated amendments, whole-snapshot lookups and the look-back window edge.

Interval state is kept as one row per change; a state reaches every grid date it covers through a
number range and an equi-join, so nothing compares all dates with all states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.functions.text import append_tag, holding_key, normalize_ticker
from posledger.operators.asof import asof_join
from posledger.sources.tables import stage


def period_filings(filings: DataFrame, filer: str = "parent_ticker") -> DataFrame:
    """One filing per reporting period: the latest filed wins, then the higher accession."""
    period = F.coalesce("period_end", "filing_date")
    body = F.struct(*[c for c in filings.columns if c not in (filer, "period_end")])
    return (
        filings.where(period.isNotNull())
        .groupBy(filer, period.alias("period_end"))
        .agg(F.max_by(body, F.struct("filing_date", "accession_no")).alias("f"))
        .select(filer, "period_end", "f.*")
    )


def latest_period_rows(rows: DataFrame, filer: str = "parent_ticker") -> DataFrame:
    """All rows of the newest period of every filer."""
    newest = rows.groupBy(filer).agg(F.max("period_end").alias("period_end"))
    return rows.join(newest, [filer, "period_end"], "left_semi")


def amendment_intervals(events: DataFrame, by: Sequence[str], key: str, date: str = "filing_date",
                        order: Sequence[str] = ("accession_no",),
                        exit_flag: str = "is_exit") -> DataFrame:
    """State changes per key: the last amendment of a day and the day the next one replaces it."""
    body = F.struct(*[c for c in events.columns if c not in (*by, key, date)])
    daily = events.groupBy(*by, key, date).agg(F.max_by(body, F.struct(*order)).alias("state"))
    w = Window.partitionBy(*by, key).orderBy(date)
    return daily.withColumn("valid_to", F.lead(date).over(w)).withColumn(
        "gone", F.coalesce(F.col(f"state.{exit_flag}"), F.lit(False)))


def running_positions(events: DataFrame, by: Sequence[str] = ("parent_ticker",), key: str = "key",
                      date: str = "filing_date", order: Sequence[str] = ("accession_no",),
                      exit_flag: str = "is_exit") -> DataFrame:
    """The open set after every filing date, one snapshot per date.

    An amendment replaces the previous state of its key, an exit removes it. The snapshot carries
    the last accession of its day.
    """
    by = list(by)
    dates = events.groupBy(*by, date).agg(F.max(F.struct(*order)).alias("_last"))
    w = Window.partitionBy(*by).orderBy(date)
    numbered = dates.select(*by, F.col(date).alias("snapshot_date"),
                            F.col(f"_last.{order[-1]}").alias("snapshot_accession"),
                            F.row_number().over(w).alias("_i"))
    total = numbered.groupBy(*by).agg(F.max("_i").alias("_n"))
    spans = amendment_intervals(events, by, key, date, order, exit_flag).where(~F.col("gone"))
    start = numbered.select(*by, F.col("snapshot_date").alias(date), F.col("_i").alias("_from"))
    end = numbered.select(*by, F.col("snapshot_date").alias("valid_to"), F.col("_i").alias("_to"))
    placed = spans.join(start, [*by, date]).join(end, [*by, "valid_to"], "left").join(total, by)
    last = F.coalesce(F.col("_to") - 1, F.col("_n"))
    filled = placed.withColumn("_i", F.explode(F.sequence(F.col("_from"), last)))
    return filled.join(numbered, [*by, "_i"]).select(
        *by, "snapshot_date", "snapshot_accession", key, F.col(date).alias("amended_on"),
        "state.*").drop(exit_flag)


def latest_positions(events: DataFrame, by: Sequence[str] = ("parent_ticker",), key: str = "key",
                     date: str = "filing_date", order: Sequence[str] = ("accession_no",),
                     exit_flag: str = "is_exit") -> DataFrame:
    """Newest amendment per key unless it is an exit."""
    body = F.struct(*[c for c in events.columns if c not in (*by, key)])
    last = events.groupBy(*by, key).agg(F.max_by(body, F.struct(date, *order)).alias("s"))
    return last.where(~F.coalesce(F.col(f"s.{exit_flag}"), F.lit(False))).select(*by, key, "s.*")


def positions_at(events: DataFrame, grid: DataFrame, by: Sequence[str] = ("parent_ticker",),
                 key: str = "key", date: str = "filing_date", as_of: str = "as_of",
                 order: Sequence[str] = ("accession_no",), exit_flag: str = "is_exit",
                 exited: bool = False) -> DataFrame:
    """Open (or, with ``exited``, closed) keys at every grid date.

    Same as looking up the last running snapshot per grid row, without building the snapshots.
    """
    by = list(by)
    w = Window.partitionBy(*by).orderBy(as_of)
    points = grid.select(*by, as_of).distinct().withColumn("_i", F.row_number().over(w))
    total = points.groupBy(*by).agg(F.max("_i").alias("_n"))
    spans = amendment_intervals(events, by, key, date, order, exit_flag).where(
        F.col("gone") if exited else ~F.col("gone"))
    probe = points.select(*by, F.col(as_of).alias("_p"), "_i")
    first = asof_join(spans, probe, by, date, "_p", "forward", columns=["_i"]).withColumnsRenamed(
        {"_i": "_from"}).drop("_p")
    after = asof_join(first, probe, by, "valid_to", "_p", "forward", columns=["_i"]).withColumnsRenamed(
        {"_i": "_to"}).drop("_p").join(total, by)
    last = F.coalesce(F.col("_to") - 1, F.col("_n"))
    spread = after.where(F.col("_from").isNotNull() & (F.col("_from") <= last)).withColumn(
        "_i", F.explode(F.sequence(F.col("_from"), last)))
    return spread.join(points, [*by, "_i"]).join(grid, [*by, as_of]).select(
        *grid.columns, key, F.col(date).alias("amended_on"), "state.*").drop(exit_flag)


def snapshot_as_of(snapshots: DataFrame, grid: DataFrame, by: Sequence[str] = ("parent_ticker",),
                   snapshot_date: str = "snapshot_date", as_of: str = "as_of") -> DataFrame:
    """Rows of the latest whole snapshot taken on or before each grid date."""
    by = list(by)
    dates = snapshots.select(*by, snapshot_date).distinct()
    picked = asof_join(grid, dates, by, as_of, snapshot_date, "backward", columns=[])
    return picked.join(snapshots, [*by, snapshot_date])


def notes_as_of(notes: DataFrame, grid: DataFrame, window: int | None = None,
                order_by: str | None = None) -> DataFrame:
    """Note positions known at each grid row (parent_ticker, period_end, as_of).

    Takes all note filings up to the as-of date (or the last ``window`` if stated), drops values dated after the period, and keeps one row
    per identity: a value dated exactly at the period end, else the newest value date (an undated
    value of a later filing replaces what came before it), else the later filing.
    """
    by = ["parent_ticker"]
    w = Window.partitionBy(*by).orderBy("filing_date", "accession_no")
    filings = notes.select(*by, "filing_date", "accession_no").distinct().withColumn(
        "_f", F.row_number().over(w))
    latest = filings.groupBy(*by, "filing_date").agg(F.max("_f").alias("_f"))
    points = asof_join(
        grid.select(*by, "period_end", "as_of"), latest.withColumnRenamed("filing_date", "_fd"),
        by, "as_of", "_fd", "backward", columns=["_f"])
    oldest = F.lit(1) if window is None else F.greatest(F.lit(1), F.col("_f") - (window - 1))
    span = F.sequence(oldest, F.col("_f"))
    wanted = points.where(F.col("_f").isNotNull()).select(
        *by, "period_end", "as_of", F.explode(span).alias("_f"))
    numbered = notes.withColumn(
        "_key", holding_key("investee_ticker", "cusip", "investee_name")
    ).where(F.col("_key").isNotNull()).join(filings, [*by, "filing_date", "accession_no"])
    row_order = [order_by] if order_by else ["as_of_date", "note"]
    candidates = wanted.join(numbered.withColumnRenamed("period_end", "_pe")
                             if "period_end" in notes.columns else numbered, [*by, "_f"]).where(
        F.col("as_of_date").isNull() | (F.col("as_of_date") <= F.col("period_end")))
    order = F.struct("_f", *row_order)
    group = Window.partitionBy(*by, "period_end", "as_of", "_key")
    last_undated = F.max(F.when(F.col("as_of_date").isNull(), order)).over(group)
    rank = (
        F.when(F.col("as_of_date") == F.col("period_end"), 3)
        .when(last_undated.isNull() | (order > last_undated), 2)
        .when(order == last_undated, 1).otherwise(0)
    )
    body = F.struct(*[c for c in notes.columns if c not in ("parent_ticker", "period_end")])
    return (
        candidates.withColumns({"_rank": rank, "_row": body, "_o": order})
        .groupBy(*by, "period_end", "as_of", "_key")
        .agg(F.max_by("_row", F.struct("_rank", "as_of_date", "_o")).alias("r"))
        .select(*by, "period_end", "as_of", "r.*")
    )


# -- look-back window ----------------------------------------------------------------------------

def _inside(start) -> Column:
    start = F.lit(start).cast("date") if isinstance(start, str) else start
    return F.coalesce(F.col("period_end") >= start, F.lit(False)) | F.coalesce(
        F.col("filing_date") >= start, F.lit(False))


def split_window(periods: DataFrame, start) -> tuple[DataFrame, DataFrame]:
    """Reporting periods inside the window (by period or filing date) and before it."""
    inside = _inside(start)
    return periods.where(inside), periods.where(~inside)


def prewindow_backfill(rows: DataFrame, periods: DataFrame, start) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Earlier periods of edge-held names: (rows, periods, truncated names).

    Edge-held are names with shares in the oldest period of the window. Empty periods before the first and
    after the last appearance are dropped. A name is truncated when the oldest kept period still holds it, or
    when nothing before the window is known. Rows are marked in one pass, a group being the periods of one
    name, and what matters is written once for the three results.
    """
    inside = _inside(start)
    of_parent = Window.partitionBy("parent_ticker")
    grid = periods.groupBy("parent_ticker", "period_end").agg(
        F.max(inside).alias("_in"), F.max(~inside).alias("_before"))
    grid = grid.withColumn("_oldest", F.min(F.when(F.col("_in"), F.col("period_end"))).over(of_parent))
    marked = rows.withColumn("_t", normalize_ticker("investee_ticker")).where(F.col("_t").isNotNull()).join(
        grid, ["parent_ticker", "period_end"])
    has_shares = F.coalesce(F.col("shares_held") > 0, F.lit(False))
    marked = marked.withColumn("_edge", F.col("_in") & (F.col("period_end") == F.col("_oldest")) & has_shares)
    held = F.max("_edge").over(Window.partitionBy("parent_ticker", "_t"))
    kept = stage(marked.withColumn("_held", held).where(F.col("_held") & (F.col("_before") | F.col("_edge"))), "prewindow")

    pre = kept.where("_before")
    span = pre.groupBy("parent_ticker").agg(F.min("period_end").alias("_lo"), F.max("period_end").alias("_hi"))
    pre_periods = periods.where(~inside).join(span, "parent_ticker").where(
        F.col("period_end").between(F.col("_lo"), F.col("_hi"))).select(*periods.columns)
    still = pre.join(span, "parent_ticker").where((F.col("period_end") == F.col("_lo")) & has_shares)
    unknown = kept.where("_edge").join(span, "parent_ticker", "left_anti")
    names = ["parent_ticker", F.col("_t").alias("ticker")]
    truncated = still.select(*names).unionByName(unknown.select(*names)).distinct()
    return pre.select(*rows.columns), pre_periods, truncated


def stamp_truncated(history: DataFrame, truncated: DataFrame) -> DataFrame:
    """Tag rows of truncated names; their opening rows have an unknown cost basis."""
    marks = truncated.select("parent_ticker", F.col("ticker").alias("_t"), F.lit(True).alias("_cut"))
    joined = history.withColumn("_t", normalize_ticker("investee_ticker")).join(
        marks, ["parent_ticker", "_t"], "left")
    tagged = append_tag("note", "lookback_truncated=1")
    opened = F.col("action").isin("new", "buy")
    note = F.when(F.col("_cut") & opened, append_tag(tagged, "cost_basis=unknown_truncated")).when(
        F.col("_cut"), tagged).otherwise(F.col("note"))
    return joined.withColumn("note", note).select(*history.columns)
