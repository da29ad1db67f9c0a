"""The position ledger: period-over-period differences of disclosed snapshots.

After de-duplication a (parent, identity) group holds at most one row per reporting period, so the
windows below are bounded by the number of periods, whatever the size of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.functions.numbers import share_ratio
from posledger.functions.text import (
    append_tag, append_tags, holding_key, is_overlay_note, normalize_ticker,
)
from posledger.schemas import HISTORY_SCHEMA, SNAPSHOT_SCHEMA, conform

_FIELDS = [
    "investee_name", "investee_ticker", "cusip", "shares_held", "market_value_usd",
    "ownership_pct", "as_of_date", "as_of_accession_no", "note",
]


def classify_quantity(prev: Column, cur: Column) -> Column:
    """Action from two comparable quantities (missing counts as zero)."""
    p, c = F.coalesce(prev, F.lit(0.0)), F.coalesce(cur, F.lit(0.0))
    return (
        F.when((p <= 0) & (c > 0), F.lit("new"))
        .when((p > 0) & (c <= 0), F.lit("exit"))
        .when(c > p, F.lit("buy"))
        .when(c < p, F.lit("sell"))
        .otherwise(F.lit("hold"))
    )


def classify_action(has_prev: Column, has_cur: Column, shares_prev: Column, shares: Column,
                    pct_prev: Column, pct: Column) -> Column:
    """Shares against shares, else percent against percent; mixed units never make a trade."""
    return (
        F.when(~has_prev, F.lit("new"))
        .when(~has_cur, F.lit("exit"))
        .when(shares_prev.isNotNull() & shares.isNotNull(), classify_quantity(shares_prev, shares))
        .when(pct_prev.isNotNull() & pct.isNotNull(), classify_quantity(pct_prev, pct))
        .otherwise(F.lit("hold"))
    )


def number_periods(periods: DataFrame, unique: bool = False) -> DataFrame:
    """Reporting periods per parent with their neighbours; the latest filing describes a period.

    A parent has as many rows here as it has periods, so the window stays small.
    """
    filing = F.struct("filing_date", "accession_no")
    if unique:
        one = periods.select("parent_ticker", "period_end", filing.alias("f"))
    else:
        one = periods.groupBy("parent_ticker", "period_end").agg(F.max(filing).alias("f"))
    w = Window.partitionBy("parent_ticker").orderBy("period_end")
    at = F.struct("period_end", "f.filing_date", "f.accession_no")
    return one.select(
        "parent_ticker", "period_end", at.alias("at"), F.lead(at).over(w).alias("next_at"),
        F.lag("period_end").over(w).alias("period_before"))


def diff_snapshots(rows: DataFrame, periods: DataFrame | None = None,
                   exit_events: DataFrame | None = None, order_by: str | None = None,
                   unique: bool = False) -> DataFrame:
    """Difference consecutive periods of every parent into new / buy / sell / hold / exit rows.

    ``periods`` lists every reporting period, including empty ones (they close positions);
    without it the periods are those of ``rows``. ``order_by`` names the input order: of several
    rows of one identity in one period the last wins. ``unique`` skips de-duplication when the caller
    guarantees one row per identity and period and one filing per period. ``exit_events`` (parent_ticker, investee_ticker, accession, filing_date, note) documents
    explicit exits.
    """
    order_columns = [order_by] if order_by else []
    base = conform(rows, SNAPSHOT_SCHEMA, keep=order_columns)
    own_periods = periods is None
    if own_periods:
        periods = base.select("parent_ticker", "period_end", "filing_date", "accession_no")
    grid = number_periods(periods, unique and not own_periods)

    keyed = base.withColumn("_key", holding_key("investee_ticker", "cusip", "investee_name")).where(
        F.col("_key").isNotNull())
    body = F.struct(*_FIELDS)
    if unique:
        one = keyed.select("parent_ticker", "period_end", "_key", body.alias("cur"))
    else:
        order = F.struct(*order_columns, "filing_date", *_FIELDS)
        one = keyed.groupBy("parent_ticker", "period_end", "_key").agg(F.max_by(body, order).alias("cur"))

    placed = one.join(grid, ["parent_ticker", "period_end"])
    qty = F.coalesce(F.col("cur.shares_held"), F.col("cur.ownership_pct"), F.lit(0.0))
    w = Window.partitionBy("parent_ticker", "_key").orderBy("period_end")
    linked = placed.select(
        "parent_ticker", "_key", "at", "next_at", "cur",
        F.when(F.lag("period_end").over(w) == F.col("period_before"), F.lag("cur").over(w)).alias("prev"),
        F.coalesce(F.lead("period_end").over(w) == F.col("next_at.period_end"), F.lit(False)).alias("_stays"),
        F.min(F.when(qty > 0, F.col("period_end"))).over(
            w.rowsBetween(Window.unboundedPreceding, 0)).alias("first_seen_period"),
    )
    # A row without a successor closes in the next reporting period, if there is one.
    nothing = F.lit(None).cast(placed.schema["cur"].dataType)
    present = F.struct(F.col("at").alias("at"), F.col("cur").alias("cur"), F.col("prev").alias("prev"))
    gone = F.struct(F.col("next_at").alias("at"), nothing.alias("cur"), F.col("cur").alias("prev"))
    closes = ~F.col("_stays") & F.col("next_at").isNotNull()
    dated = linked.select(
        "parent_ticker", "_key", "first_seen_period",
        F.explode(F.when(closes, F.array(present, gone)).otherwise(F.array(present))).alias("s"),
    ).select(
        "parent_ticker", "_key", "first_seen_period", F.col("s.at.period_end").alias("period_end"),
        F.col("s.at.filing_date").alias("grid_filing_date"),
        F.col("s.at.accession_no").alias("grid_accession_no"),
        F.col("s.cur").alias("cur"), F.col("s.prev").alias("prev"))
    cur_qty = F.coalesce(F.col("cur.shares_held"), F.col("cur.ownership_pct"), F.lit(0.0))
    dated = dated.where(F.col("prev").isNotNull() | (cur_qty > 0))
    # Same partitioning as the difference itself, so this adds no shuffle.
    rows = reclassify_share_ratio(_ledger_rows(dated, exit_events), partition="_key")
    return conform(rows, HISTORY_SCHEMA)


def _ledger_rows(dated: DataFrame, exit_events: DataFrame | None) -> DataFrame:
    has_prev, has_cur = F.col("prev").isNotNull(), F.col("cur").isNotNull()
    sh, sh_prev = F.col("cur.shares_held"), F.col("prev.shares_held")
    pct, pct_prev = F.col("cur.ownership_pct"), F.col("prev.ownership_pct")
    value, value_prev = F.col("cur.market_value_usd"), F.col("prev.market_value_usd")
    action = classify_action(has_prev, has_cur, sh_prev, sh, pct_prev, pct)
    face = {name: F.when(has_cur, F.col(f"cur.{name}")).otherwise(F.col(f"prev.{name}"))
            for name in ("investee_name", "investee_ticker", "cusip", "note")}

    base = dated.select(
        "parent_ticker", "_key", "period_end", "grid_filing_date", "grid_accession_no",
        "first_seen_period", "cur", "prev", action.alias("action"),
        *[c.alias(n) for n, c in face.items()],
        is_overlay_note(face["note"]).alias("_overlay"),
    )
    if exit_events is not None:
        extra = [c for c in ("note",) if c in exit_events.columns]
        events = exit_events.select(
            "parent_ticker", normalize_ticker("investee_ticker").alias("_t"),
            F.struct(F.col("accession"), F.col("filing_date"),
                     *([F.col("note")] if extra else [F.lit(None).cast("string").alias("note")])
                     ).alias("_event"))
        base = base.withColumn("_t", normalize_ticker("investee_ticker")).join(
            events, ["parent_ticker", "_t"], "left")
    else:
        base = base.withColumn("_event", F.lit(None).cast(
            "struct<accession:string,filing_date:date,note:string>"))

    act, overlay = F.col("action"), F.col("_overlay")
    is_exit = act == "exit"
    documented = F.col("_event.accession").isNotNull()
    prev_acc = F.col("prev.as_of_accession_no")
    accession = (
        F.when(is_exit & documented, F.col("_event.accession"))
        .when(is_exit & overlay, F.coalesce(prev_acc, F.col("grid_accession_no")))
        .when(is_exit, F.coalesce(F.col("grid_accession_no"), prev_acc))
        .otherwise(F.coalesce(F.col("cur.as_of_accession_no"), prev_acc, F.col("grid_accession_no")))
    )
    filing = (
        F.when(overlay & is_exit, F.coalesce(
            F.col("_event.filing_date"), F.col("prev.as_of_date"), F.col("grid_filing_date")))
        .when(overlay, F.coalesce(
            F.col("cur.as_of_date"), F.col("prev.as_of_date"), F.col("grid_filing_date")))
        .otherwise(F.col("grid_filing_date"))
    )
    both_shares = sh.isNotNull() & sh_prev.isNotNull()
    delta = (
        F.when(~has_prev, sh)
        .when(is_exit & (~has_cur | ~both_shares), F.lit(0.0) - sh_prev)
        .when(both_shares, sh - sh_prev)
    )
    no_money = value.isNull() & value_prev.isNull()
    out_value = F.when(is_exit & overlay & no_money, F.lit(None)).when(
        is_exit, F.lit(0.0)).otherwise(value)
    value_delta = F.when(~no_money, F.when(is_exit, F.lit(0.0)).otherwise(
        F.coalesce(value, F.lit(0.0))) - F.coalesce(value_prev, F.lit(0.0)))

    start_note = F.coalesce(
        F.col("note"), F.concat(F.lit("QoQ "), F.col("period_end").cast("string")))
    exit_tag = F.coalesce(F.col("_event.note"), F.lit("13g_exit=1"))
    by_pct = (
        delta.isNull() & act.isin("buy", "sell", "hold") & (sh.isNull() | sh_prev.isNull())
        & pct.isNotNull() & pct_prev.isNotNull()
    )
    overlay_exit = is_exit & overlay
    unmarked = ~start_note.rlike("13g_exit=1|exit_reason=mna")
    inferred = "exit_inferred=missing_from_period"
    note = append_tags(
        start_note,
        (overlay_exit & documented & unmarked, exit_tag, exit_tag),
        (overlay_exit & ~documented, inferred, inferred),
        (by_pct, "qoq_continuity=ownership_pct", "qoq_continuity=ownership_pct"),
    )

    return base.select(
        "parent_ticker", "_key", "period_end", filing.alias("filing_date"),
        accession.alias("accession_no"), "investee_name", "investee_ticker", "cusip",
        F.when(is_exit, F.lit(0.0)).otherwise(sh).alias("shares_held"),
        F.when(is_exit, F.lit(0.0)).otherwise(pct).alias("ownership_pct"),
        out_value.alias("market_value_usd"), sh_prev.alias("shares_prev"),
        delta.alias("shares_delta"), value_prev.alias("value_prev"),
        value_delta.alias("value_delta"), "action", "first_seen_period",
        F.when(is_exit, F.col("period_end")).alias("exited_period"), note.alias("note"),
    )


def reclassify_share_ratio(history: DataFrame, partition: str | None = None) -> DataFrame:
    """Whole-number share consolidations with a new security id are restatements, not sales.

    ``partition`` names a column that already groups the rows of one ticker.
    """
    cusip = F.nullif(F.upper(F.trim("cusip")), F.lit(""))
    keyed = history.withColumns({"_t": normalize_ticker("investee_ticker"), "_id": cusip})
    # Rows without a ticker are never restated; they are spread instead of meeting in one group.
    alone = F.when(F.col("_t").isNull(), F.xxhash64("investee_name", "period_end", "accession_no", "shares_held"))
    by = [partition] if partition else ["_t", "_alone"]
    keyed = keyed.withColumn("_alone", alone)
    w = Window.partitionBy("parent_ticker", *by).orderBy("period_end", "accession_no")
    before = F.last(F.when(F.col("action") != "exit", F.col("_id")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, -1))
    keyed = keyed.withColumns({"_before": before, "_after": F.lead("_id").over(w)})

    def moved(a: str, b: str) -> Column:
        return F.coalesce(
            (F.substring(a, 1, 6) == F.substring(b, 1, 6)) & (F.col(a) != F.col(b)), F.lit(False))

    ratio = share_ratio("shares_prev", "shares_held")
    restated = (
        (F.col("action") == "sell") & F.col("_t").isNotNull() & ratio.isNotNull()
        & (moved("_before", "_id") | moved("_before", "_after") | moved("_id", "_after"))
    )
    stamp = F.concat(F.lit("ads_ratio="), ratio.cast("string"), F.lit(":1; restatement_not_disposal"))
    return keyed.withColumns({
        "action": F.when(restated, F.lit("ratio_adj")).otherwise(F.col("action")),
        "note": F.when(restated, append_tag("note", stamp)).otherwise(F.col("note")),
    }).select(*history.columns)


def normalize_export_rows(history: DataFrame) -> DataFrame:
    """Exits are worth zero, except overlay exits that never had money: they stay NULL."""
    silent = is_overlay_note("note") & F.col("market_value_usd").isNull()
    value = F.when((F.col("action") == "exit") & ~silent, F.lit(0.0)).otherwise(
        F.col("market_value_usd"))
    return history.withColumn("market_value_usd", value)


def apply_exit_cutoffs(rows: DataFrame, cutoffs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop names from snapshots after their cut-off date and record each parent's first dropped period.

    ``cutoffs`` is (investee_ticker, cutoff): the date is a fact about the name, the exit one about the
    parent that held it. Returns the kept rows and the exit events per parent.
    """
    cuts = cutoffs.select(normalize_ticker("investee_ticker").alias("_t"), F.col("cutoff").alias("_cut"))
    marked = rows.withColumn("_t", normalize_ticker("investee_ticker")).join(cuts, "_t", "left")
    late = F.coalesce(F.col("period_end") > F.col("_cut"), F.lit(False))
    kept = marked.where(~late).select(*rows.columns)
    events = marked.where(late).groupBy("parent_ticker", F.col("_t").alias("investee_ticker")).agg(
        F.min_by(F.struct(
            F.col("accession_no").alias("accession"), F.col("period_end").alias("filing_date"),
            F.concat(F.lit("exit_reason=mna_acquired; mna_as_of="), F.col("_cut").cast("string")).alias("note"),
        ), F.struct("period_end", "accession_no")).alias("e"),
    ).select("parent_ticker", "investee_ticker", "e.accession", "e.filing_date", "e.note")
    return kept, events


def suppress_exited(notes: DataFrame, exited: DataFrame, on: list[str]) -> DataFrame:
    """A name that has left may not come back through a stale note."""
    gone = exited.select(*on, normalize_ticker("investee_ticker").alias("_t"))
    return notes.withColumn("_t", normalize_ticker("investee_ticker")).join(
        gone, [*on, "_t"], "left_anti").drop("_t")


def open_positions(history: DataFrame) -> DataFrame:
    """Latest row per parent and ticker unless that row is an exit."""
    t = normalize_ticker("investee_ticker")
    body = F.struct(*history.columns)
    # An exit of the same period sorts first, so a continuing row of that period survives.
    order = F.struct("period_end", F.when(F.col("action") == "exit", 0).otherwise(1), "accession_no", "note")
    latest = history.where(t.isNotNull()).groupBy("parent_ticker", t.alias("_t")).agg(
        F.max_by(body, order).alias("r"))
    return latest.where(F.col("r.action") != "exit").select("r.*")


def position_moves(history: DataFrame) -> DataFrame:
    return history.where(F.col("action").isin("new", "buy", "sell", "exit"))


def recent_rows(history: DataFrame, n: int) -> DataFrame:
    """Last ``n`` rows of a report, by period and ticker."""
    return history.orderBy(F.col("period_end").desc(), F.col("investee_ticker").desc(),
                           F.col("investee_name").desc()).limit(n)


def large_moves(history: DataFrame, threshold: float = 1e8) -> DataFrame:
    """Consecutive known values of a name that differ by at least ``threshold``."""
    known = history.where(F.col("market_value_usd").isNotNull() & F.col("investee_ticker").isNotNull())
    w = Window.partitionBy("parent_ticker", "investee_ticker").orderBy("period_end", "accession_no")
    moved = known.withColumns({
        "prev_period": F.lag("period_end").over(w),
        "prev_value_usd": F.lag("market_value_usd").over(w),
    })
    jump = F.col("market_value_usd") - F.col("prev_value_usd")
    return moved.where(F.abs(jump) >= threshold).select(
        "parent_ticker", "investee_ticker", "prev_period", "period_end", "prev_value_usd",
        "market_value_usd", jump.alias("change_usd"))
