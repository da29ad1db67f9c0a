"""Flows, disposals and returns on the position ledger.

The ledger holds one row per parent, period and name, so windows per (parent, name) and per parent
are bounded by the number of periods. Money sums use fixed-point integers: the result does not
depend on how the rows were partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.functions.numbers import (
    cagr, dietz, divide, holding_periods, money_sum, money_sum_over, period_price, share_delta,
)
from posledger.functions.text import has_tag, ledger_ticker
from posledger.sources import fixed_values as fixed

_EPS = 1e-9


def is_residual(ticker) -> Column:
    t = F.upper(F.trim(F.coalesce(F.col(ticker) if isinstance(ticker, str) else ticker, F.lit(""))))
    return t.startswith("PRIV_HK_") & t.endswith("_RESIDUAL")


def excluded_from_portfolio(ticker="investee_ticker", note="note") -> Column:
    """Residual rows and rows tagged as mirrors never count towards the portfolio value."""
    return is_residual(ticker) | has_tag(note, "excluded_from_portfolio_mv", "residual_of_aggregate")


def _ledger(history: DataFrame) -> DataFrame:
    """Only the columns the performance layer needs, with its ticker, price and share change."""
    return history.select(
        "parent_ticker", "period_end", "action", "accession_no", "filing_url", "investee_name",
        "market_value_usd", "shares_held", "shares_prev", "note",
        ledger_ticker("investee_ticker", "investee_name").alias("ticker"),
        period_price("action", "market_value_usd", "shares_held", "value_prev", "shares_prev").alias("px"),
        share_delta("action", "shares_delta", "shares_held", "shares_prev").alias("delta"),
        excluded_from_portfolio().alias("excluded"),
    )


# -- disposals -----------------------------------------------------------------------------------

def realized_events(history: DataFrame) -> DataFrame:
    """Disposal events by average cost (primary) and first-in-first-out.

    Closed form on one shuffle: buys and sells are laid on a common axis of cumulative shares in
    pre-split units. Selling more than is held is dropped. Every stretch between two neighbouring
    marks on that axis belongs to exactly one lot and one sale.
    """
    rows = _ledger(history).where(F.col("ticker").isNotNull() & F.col("period_end").isNotNull())
    buy_side = F.when(F.col("action").isin("new", "buy"), 0).otherwise(1)
    timeline = [F.col("period_end"), buy_side, F.col("accession_no"), F.col("investee_name")]
    w = Window.partitionBy("parent_ticker", "ticker").orderBy(*timeline)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    ratio = divide("shares_prev", "shares_held")
    factor = F.when(
        (F.col("action") == "ratio_adj") & (F.col("shares_held") > 0) & (ratio >= 2.0 - 1e-9), ratio
    ).otherwise(F.lit(1.0))
    rows = rows.withColumns({
        "seq": F.row_number().over(w),
        "split": F.product(factor).over(upto),
    })
    trade = (F.col("action") != "ratio_adj") & F.col("px").isNotNull()
    unknown_lot = has_tag("note", "lookback_truncated=1", "cost_basis=unknown_truncated")
    zero = F.lit(0.0)
    rows = rows.withColumns({
        "bought": F.when(trade & (F.col("delta") > 0) & ~unknown_lot, F.col("delta") * F.col("split")).otherwise(zero),
        "sold": F.when(trade & (F.col("delta") < -1e-12), -F.col("delta") * F.col("split")).otherwise(zero),
        "unit_px": F.col("px") / F.col("split"),
    }).where((F.col("bought") > 0) | (F.col("sold") > 0))
    rows = rows.withColumns({
        "a": F.sum("bought").over(upto),
        "n": F.sum("sold").over(upto),
        "cost_in": money_sum_over(F.col("bought") * F.col("unit_px"), upto),
    })
    # Sales beyond the holding are dropped for good, not carried forward.
    dropped = F.greatest(zero, F.max(F.col("n") - F.col("a")).over(upto))
    rows = rows.withColumn("c", F.col("n") - dropped)
    is_sale = F.col("sold") > 0
    rows = rows.withColumn("mark", F.when(is_sale, F.col("c")).otherwise(F.col("a")))

    axis = Window.partitionBy("parent_ticker", "ticker").orderBy("mark", "seq")
    # The next lot and the next sale from here on: running values read from the far end.
    ahead = Window.partitionBy("parent_ticker", "ticker").orderBy(
        F.col("mark").desc(), F.col("seq").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lot = F.last(F.when(~is_sale, F.struct(
        F.col("period_end").alias("opened"), F.col("unit_px").alias("px"))), ignorenulls=True).over(ahead)
    sale = F.last(F.when(is_sale, F.struct(
        "seq", "period_end", "px", "split", "filing_url", "accession_no", "investee_name")),
        ignorenulls=True).over(ahead)
    eps = F.greatest(F.lit(_EPS), F.col("a") * 1e-12)
    laid = rows.withColumns({"lot": lot, "sale": sale}).withColumn(
        "qty", F.col("mark") - F.coalesce(F.lag("mark").over(axis), zero))
    matched = (F.col("qty") > eps) & F.col("lot").isNotNull() & F.col("sale").isNotNull()
    laid = laid.withColumns({
        "matched": matched,
        "taken": F.when(matched, F.col("qty") * F.col("lot.px")).otherwise(zero),
    })
    laid = laid.withColumn(
        "consumed", money_sum_over("taken", axis.rowsBetween(Window.unboundedPreceding, 0)))
    before = axis.rowsBetween(Window.unboundedPreceding, -1)
    per_sale = Window.partitionBy("parent_ticker", "ticker", "sale.seq")
    laid = laid.withColumns({
        "c_prev": F.coalesce(F.last(F.when(is_sale, F.col("c")), ignorenulls=True).over(before), zero),
        "consumed_prev": F.coalesce(
            F.last(F.when(is_sale, F.col("consumed")), ignorenulls=True).over(before), zero),
        "oldest": F.min(F.when(F.col("matched"), F.col("lot.opened"))).over(per_sale),
    })

    open_shares = F.col("a") - F.col("c_prev")
    has_lots = open_shares > eps
    avg_px = (F.col("cost_in") - F.col("consumed_prev")) / open_shares * F.col("split")
    need = -F.col("delta")
    fifo = F.struct(
        F.col("sale.period_end").alias("period_end"),
        F.col("sale.investee_name").alias("investee_name"),
        (F.col("qty") / F.col("sale.split")).alias("shares_sold"),
        (F.col("lot.px") * F.col("sale.split")).alias("cost_px"),
        F.col("sale.px").alias("exit_px"),
        (F.col("qty") / F.col("sale.split")
         * (F.col("sale.px") - F.col("lot.px") * F.col("sale.split"))).alias("realized_pnl_est"),
        F.lit("fifo").alias("cost_method"),
        holding_periods("lot.opened", "sale.period_end").alias("holding_periods"),
        F.col("lot.opened").alias("lot_opened_period"),
        F.col("sale.filing_url").alias("filing_url"),
        F.col("sale.accession_no").alias("accession_no"),
        F.lit(fixed.NOTE_ESTIMATE).alias("note"),
    )
    average = F.struct(
        F.col("period_end"), F.col("investee_name"), need.alias("shares_sold"),
        F.when(has_lots, avg_px).alias("cost_px"), F.col("px").alias("exit_px"),
        F.when(has_lots, need * (F.col("px") - avg_px)).alias("realized_pnl_est"),
        F.lit("avg").alias("cost_method"),
        F.when(has_lots, holding_periods(F.coalesce("oldest", "period_end"), "period_end")).alias("holding_periods"),
        F.when(has_lots, F.col("oldest")).alias("lot_opened_period"),
        F.col("filing_url"), F.col("accession_no"),
        F.when(has_lots, F.lit(fixed.NOTE_ESTIMATE)).otherwise(
            F.lit(fixed.NOTE_ESTIMATE + "; cost_basis=unknown_truncated")).alias("note"),
    )
    truncated = has_tag("note", "lookback_truncated=1")
    events = F.filter(F.array(
        F.when(F.col("matched"), fifo),
        F.when(is_sale & (has_lots | truncated), average),
    ), lambda e: e.isNotNull())
    return laid.select("parent_ticker", F.col("ticker").alias("investee_ticker"),
                       F.explode(events).alias("e")).select(
        "parent_ticker", "e.period_end", "investee_ticker", "e.investee_name", "e.shares_sold",
        "e.cost_px", "e.exit_px", "e.realized_pnl_est", "e.cost_method", "e.holding_periods",
        "e.lot_opened_period", "e.filing_url", "e.accession_no", "e.note")


def realized_by_period(events: DataFrame) -> DataFrame:
    """Realized totals per parent and period, one column per cost method."""
    pnl = F.coalesce("realized_pnl_est", F.lit(0.0))
    return events.groupBy("parent_ticker", "period_end").agg(
        F.coalesce(money_sum(F.when(F.col("cost_method") == "avg", pnl)), F.lit(0.0)).alias("realized_avg"),
        F.coalesce(money_sum(F.when(F.col("cost_method") == "fifo", pnl)), F.lit(0.0)).alias("realized_fifo"),
    )


def realized_by_ticker(events: DataFrame, max_tickers: int | None, min_abs_usd: float,
                       by: tuple[str, ...] = ("parent_ticker",)) -> DataFrame:
    """Average-cost totals per ticker in millions, of at least a size; the largest ones if a number is stated."""
    total = (
        events.where((F.col("cost_method") == "avg") & F.col("realized_pnl_est").isNotNull())
        .groupBy(*by, "investee_ticker").agg(money_sum("realized_pnl_est").alias("usd"))
        .where(F.abs("usd") >= min_abs_usd)
    )
    w = Window.partitionBy(*by).orderBy(F.abs("usd").desc(), "investee_ticker") if by else None
    if max_tickers is None:
        kept = total
    elif w is None:
        kept = total.orderBy(F.abs("usd").desc(), "investee_ticker").limit(max_tickers)
    else:
        kept = total.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_tickers)
    return kept.select(*by, "investee_ticker", (F.col("usd") / F.lit(1e6)).alias("realized_pnl_m"))


# -- values and flows ----------------------------------------------------------------------------

def portfolio_value(history: DataFrame) -> DataFrame:
    """Portfolio value per period: valued rows that are neither exits nor excluded."""
    return (
        history.where((F.coalesce("action", F.lit("")) != "exit") & ~excluded_from_portfolio()
                      & F.col("market_value_usd").isNotNull() & F.col("period_end").isNotNull())
        .groupBy("parent_ticker", "period_end")
        .agg(money_sum("market_value_usd").alias("portfolio_mv"))
    )


def _cells(history: DataFrame) -> DataFrame:
    """One row per parent, period and name: values, share flow and whether it has shares."""
    rows = _ledger(history).where(F.col("period_end").isNotNull())
    action = F.coalesce("action", F.lit(""))
    counted = ~F.col("excluded")
    named = F.col("ticker").isNotNull()
    adj = action == "ratio_adj"
    valued = (action != "exit") & F.col("market_value_usd").isNotNull()
    flow = F.when(counted & named & ~adj & F.col("px").isNotNull() & (F.abs("delta") >= 1e-12),
                  F.col("delta") * F.col("px"))
    has_shares = counted & named & ~adj & (
        F.coalesce(F.col("shares_held") > 0, F.lit(False))
        | F.coalesce(F.col("shares_prev") > 0, F.lit(False)))
    return rows.groupBy("parent_ticker", "period_end", "ticker").agg(
        money_sum(F.when(counted & valued, F.col("market_value_usd"))).alias("port_mv"),
        money_sum(F.when(named & valued, F.col("market_value_usd"))).alias("own_mv"),
        money_sum(F.when(counted & named & ~adj & valued, F.col("market_value_usd"))).alias("cover_mv"),
        money_sum(flow).alias("share_flow"),
        F.max(has_shares).alias("has_shares"),
        F.max_by(F.struct("investee_name", "filing_url"),
                 F.when(named & valued, F.struct("accession_no", "investee_name"))).alias("face"),
    )


def _neighbours(cells: DataFrame, value: str) -> DataFrame:
    """Periods with any such value, with the period before and after, per parent (one row each)."""
    periods = cells.where(F.col(value).isNotNull()).select("parent_ticker", "period_end").distinct()
    w = Window.partitionBy("parent_ticker").orderBy("period_end")
    return periods.select("parent_ticker", "period_end", F.lag("period_end").over(w).alias("period_before"),
                          F.lead("period_end").over(w).alias("period_after"))


def flows(history: DataFrame) -> DataFrame:
    """External flow per period and name, and whether the period breaks the series.

    Share changes are priced at the period price. Names that only ever had a value enter with it
    and leave with their last one, unless some enter and others leave in the same period: that is
    a change of disclosure (``series_break``), not money.
    """
    return _flows_from_cells(_cells(history))


def _flows_from_cells(cells: DataFrame) -> DataFrame:
    """One pass over the cells of each name; only the short list of periods is joined to it."""
    by_name = Window.partitionBy("parent_ticker", "ticker")
    w = by_name.orderBy("period_end")
    covered = F.when(F.col("cover_mv").isNotNull(), F.col("period_end"))
    named = cells.where(F.col("ticker").isNotNull()).select(
        "parent_ticker", "ticker", "period_end", "cover_mv", "share_flow",
        F.max("has_shares").over(by_name).alias("share_based"),
        F.last(covered, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.last(covered, ignorenulls=True).over(by_name.orderBy(F.col("period_end").desc()).rowsBetween(
            Window.unboundedPreceding, -1)).alias("_after"))
    index = _neighbours(cells.where(F.col("ticker").isNotNull()), "cover_mv")
    rows = named.join(index, ["parent_ticker", "period_end"], "left")
    value_only = ~F.col("share_based") & F.col("cover_mv").isNotNull()
    enters = value_only & ~F.coalesce(F.col("_before") == F.col("period_before"), F.lit(False))
    leaves = value_only & F.col("period_after").isNotNull() & ~F.coalesce(
        F.col("_after") == F.col("period_after"), F.lit(False))

    def move(when, period, amount, entered, left):
        return F.when(when, F.struct(F.col(period).alias("period_end"), amount.alias("flow"),
                                     F.lit(entered).alias("enters"), F.lit(left).alias("leaves")))

    moves = F.filter(F.array(
        move(F.col("share_flow").isNotNull(), "period_end", F.col("share_flow"), 0, 0),
        move(enters, "period_end", F.col("cover_mv"), 1, 0),
        move(leaves, "period_after", -F.col("cover_mv"), 0, 1),
    ), lambda m: m.isNotNull())
    spread = rows.select("parent_ticker", "ticker", F.explode_outer(moves).alias("m")).where(
        F.col("m").isNotNull()).select("parent_ticker", "ticker", "m.*")
    per_name = spread.groupBy("parent_ticker", "period_end", "ticker").agg(
        money_sum(F.when(F.col("enters") + F.col("leaves") == 0, F.col("flow"))).alias("_shares"),
        money_sum(F.when(F.col("enters") + F.col("leaves") == 1, F.col("flow"))).alias("_cover"),
        F.max("enters").alias("enters"), F.max("leaves").alias("leaves"))
    breaks = per_name.groupBy("parent_ticker", "period_end").agg(
        ((F.max("enters") == 1) & (F.max("leaves") == 1)).alias("broken"))
    zero = F.lit(0.0)
    cover = F.when(F.col("broken"), zero).otherwise(F.coalesce("_cover", zero))
    touched = F.col("enters") + F.col("leaves") > 0
    return per_name.join(breaks, ["parent_ticker", "period_end"]).select(
        "parent_ticker", "period_end", "ticker", (F.coalesce("_shares", zero) + cover).alias("flow"),
        (F.col("broken") & touched).alias("series_break"))


# -- returns -------------------------------------------------------------------------------------

def portfolio_returns(history: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """One row per parent and period: value, flow, revaluation, realized, Dietz, linked growth."""
    cells = _cells(history)
    value = cells.where(F.col("port_mv").isNotNull()).groupBy("parent_ticker", "period_end").agg(
        money_sum("port_mv").alias("end_mv"))
    per_period = _flows_from_cells(cells).groupBy("parent_ticker", "period_end").agg(
        money_sum("flow").alias("net_flow"), F.max("series_break").alias("broken"))
    realized = realized_by_period(events if events is not None else realized_events(history))
    key = ["parent_ticker", "period_end"]
    base = value.join(per_period, key, "left").join(realized, key, "left").na.fill(
        0.0, ["net_flow", "realized_avg", "realized_fifo"]).na.fill(False, ["broken"])

    w = Window.partitionBy("parent_ticker").orderBy("period_end")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = base.withColumn("start_mv", F.lag("end_mv").over(w))
    first = F.col("start_mv").isNull()
    breaks = F.col("broken") & ~first
    fresh = first | breaks
    base = base.withColumns({
        "breaks": breaks,
        "portfolio_mv_start": F.when(~fresh, F.col("start_mv")),
        "net_external_flow": F.when(fresh, F.col("end_mv")).otherwise(F.col("net_flow")),
        "mtm_pnl": F.when(fresh, F.lit(0.0)).otherwise(
            F.col("end_mv") - F.col("start_mv") - F.col("net_flow")),
        "dietz_return": F.when(~fresh, dietz("start_mv", "end_mv", "net_flow")),
        "segment": F.sum(F.when(breaks, 1).otherwise(0)).over(upto),
        "cum_avg": money_sum_over("realized_avg", upto),
        "cum_fifo": money_sum_over("realized_fifo", upto),
    })
    seg = Window.partitionBy("parent_ticker", "segment").orderBy("period_end").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    growth = F.product(F.lit(1.0) + F.coalesce("dietz_return", F.lit(0.0))).over(seg)
    note = F.when(F.col("breaks"), F.lit(
        fixed.NOTE_ESTIMATE + "; series_break=coverage_basis; disclosure_switch_not_cash")
    ).otherwise(F.lit(fixed.NOTE_ESTIMATE))
    return base.select(
        "parent_ticker", "period_end", "portfolio_mv_start",
        F.col("end_mv").alias("portfolio_mv_end"), "net_external_flow", "mtm_pnl",
        F.col("realized_avg").alias("realized_pnl_avg_est"),
        F.col("realized_fifo").alias("realized_pnl_fifo_est"),
        F.col("realized_avg").alias("realized_pnl_est"), "dietz_return",
        F.col("cum_avg").alias("cum_realized_pnl_avg_est"),
        F.col("cum_fifo").alias("cum_realized_pnl_fifo_est"),
        F.col("cum_avg").alias("cum_realized_pnl_est"),
        F.when(F.col("start_mv").isNull(), F.lit(None)).when(F.col("breaks"), F.lit(1.0))
        .otherwise(growth).alias("cum_dietz_growth"),
        note.alias("note"),
    )


def holding_returns(history: DataFrame, events: DataFrame | None = None,
                    reference_weights: bool = True) -> DataFrame:
    """Per name and period: weight, Dietz, contribution, revaluation and realized amounts.

    ``reference_weights`` keeps excluded rows in the numerator of the weights (their total never
    contains them); switch it off to leave them out on both sides.
    """
    cells = _cells(history)
    own = "own_mv" if reference_weights else "port_mv"
    key = ["parent_ticker", "period_end"]
    totals = cells.where(F.col("port_mv").isNotNull()).groupBy(*key).agg(
        money_sum("port_mv").alias("port_end"))
    w = Window.partitionBy("parent_ticker").orderBy("period_end")
    grid = totals.withColumn("_i", F.row_number().over(w))
    flow = _flows_from_cells(cells)
    breaks = flow.groupBy(*key).agg(F.max("series_break").alias("broken"))

    held = cells.where(F.col("ticker").isNotNull() & F.col(own).isNotNull()).select(
        *key, "ticker", F.col(own).alias("mv"), "face").join(grid.select(*key, "_i"), key)
    by_name = Window.partitionBy("parent_ticker", "ticker").orderBy("_i")
    held = held.withColumns({
        "_prev": F.lag(F.struct("_i", "mv")).over(by_name), "_next": F.lead("_i").over(by_name)})
    start = F.when(F.col("_prev._i") == F.col("_i") - 1, F.col("_prev.mv")).otherwise(F.lit(0.0))
    stay = F.struct(F.col("_i").alias("i"), start.alias("start"), F.col("mv").alias("end"),
                    F.col("face").alias("face"))
    leave = F.struct((F.col("_i") + 1).alias("i"), F.col("mv").alias("start"), F.lit(0.0).alias("end"),
                     F.lit(None).cast(held.schema["face"].dataType).alias("face"))
    gone = F.col("_next").isNull() | (F.col("_next") > F.col("_i") + 1)
    steps = held.select("parent_ticker", "ticker", F.explode(
        F.when(gone, F.array(stay, leave)).otherwise(F.array(stay))).alias("s")).select(
        "parent_ticker", "ticker", F.col("s.i").alias("_i"), F.col("s.start").alias("start_mv"),
        F.col("s.end").alias("end_mv"), F.col("s.face").alias("face"))

    pnl = F.coalesce("realized_pnl_est", F.lit(0.0))
    ev = (events if events is not None else realized_events(history)).groupBy(
        "parent_ticker", "period_end", F.col("investee_ticker").alias("ticker")).agg(
        money_sum(F.when(F.col("cost_method") != "fifo", pnl)).alias("avg_r"),
        money_sum(F.when(F.col("cost_method") == "fifo", pnl)).alias("fifo_r"))
    rows = (
        steps.join(grid, ["parent_ticker", "_i"])
        .join(flow.select(*key, "ticker", "flow"), [*key, "ticker"], "left")
        .join(breaks, key, "left").join(ev, [*key, "ticker"], "left")
        .na.fill(0.0, ["flow", "avg_r", "fifo_r"]).na.fill(False, ["broken"])
    )
    start_mv, end_mv, net = F.col("start_mv"), F.col("end_mv"), F.col("flow")
    rows = rows.where(~((start_mv <= 0) & (end_mv <= 0) & (F.abs(net) < 1e-6))).where(
        ~(F.col("broken") & (end_mv <= 0) & (start_mv > 0)))
    opened = start_mv > 0
    ret = F.when(opened, dietz(start_mv, end_mv, net))
    weight = F.when(F.col("port_end") > 0, end_mv / F.col("port_end"))
    note = F.when(F.col("broken") & ~opened, F.lit(
        fixed.NOTE_ESTIMATE + "; series_break=coverage_basis")).otherwise(F.lit(fixed.NOTE_ESTIMATE))
    return rows.select(
        "parent_ticker", "period_end", F.col("ticker").alias("investee_ticker"),
        F.col("face.investee_name").alias("investee_name"),
        F.when(end_mv > 0, end_mv).alias("market_value_usd"), weight.alias("weight"),
        ret.alias("holding_dietz_return"), (weight * ret).alias("contribution"),
        F.when(opened, end_mv - start_mv - net).otherwise(F.lit(0.0)).alias("mtm_pnl"),
        F.col("avg_r").alias("realized_pnl_avg_est"), F.col("fifo_r").alias("realized_pnl_fifo_est"),
        F.col("avg_r").alias("realized_pnl_est"), F.col("face.filing_url").alias("filing_url"),
        note.alias("note"))


def linked_cagr(returns: DataFrame) -> DataFrame:
    """Annualised linked growth of the last unbroken segment, per parent."""
    broken = has_tag("note", "series_break=coverage_basis")
    grown = F.col("cum_dietz_growth").isNotNull()
    ends = returns.groupBy("parent_ticker").agg(
        F.min("period_end").alias("_first"),
        F.max(F.when(grown, F.col("period_end"))).alias("end_period"),
        F.max(F.when(broken, F.col("period_end"))).alias("_break"),
        F.max_by("cum_dietz_growth", F.when(grown, F.col("period_end"))).alias("_last_growth"),
    )
    use_break = F.coalesce(F.col("_break") <= F.col("end_period"), F.lit(False))
    ends = ends.withColumn("start_period", F.when(F.col("end_period").isNotNull(), F.when(
        use_break, F.col("_break")).otherwise(F.col("_first"))))
    # A break row restarts the index at 1, so growth since the start is the last index value.
    years = F.datediff("end_period", "start_period") / F.lit(365.25)
    return ends.select(
        "parent_ticker", cagr(F.col("_last_growth"), years).alias("cagr"), years.alias("years"),
        F.col("_last_growth").alias("cum_end"), "start_period", "end_period")


def returns_chart(returns: DataFrame) -> DataFrame:
    return returns.select(
        "parent_ticker", "period_end", (F.col("dietz_return") * F.lit(100.0)).alias("dietz_return_pct"),
        F.col("cum_dietz_growth").alias("cum_growth_index"))


def returns_chart_with_footer(returns: DataFrame) -> DataFrame:
    """Chart rows, a blank row, the growth-rate row and its note, in ``line_no`` order."""
    w = Window.partitionBy("parent_ticker").orderBy("period_end")
    chart = returns_chart(returns).select(
        "parent_ticker", F.row_number().over(w).cast("long").alias("line_no"),
        F.col("period_end").cast("string").alias("period_end"), "dietz_return_pct", "cum_growth_index")
    # The footer is numbered after the last row of the parent's chart.
    last = chart.groupBy("parent_ticker").agg(F.max("line_no").alias("_last"))
    info = linked_cagr(returns).join(last, "parent_ticker")
    known = F.col("cagr").isNotNull()
    note = F.when(known, F.concat(
        F.lit("years="), F.format_string("%.2f", "years"), F.lit("; "),
        F.col("start_period").cast("string"), F.lit("→"), F.col("end_period").cast("string"),
        F.lit("; estimated; Modified Dietz; not tax/GAAP"))).otherwise(
        F.lit("note=estimated; Modified Dietz; not tax/GAAP"))
    nothing = F.lit(None).cast("double")

    def line(no, text, value):
        return F.struct((F.col("_last") + no).alias("line_no"), text.alias("period_end"),
                        value.alias("dietz_return_pct"), nothing.alias("cum_growth_index"))

    footer = info.select("parent_ticker", F.inline(F.array(
        line(1, F.lit(""), nothing),
        line(2, F.lit("CAGR (estimated Dietz)"), F.col("cagr") * 100.0),
        line(3, note, nothing))))
    return chart.unionByName(footer)


def realized_chart(returns: DataFrame) -> DataFrame:
    return returns.select(
        "parent_ticker", "period_end",
        (F.col("realized_pnl_est") / F.lit(1e6)).alias("realized_pnl_qoq_m"),
        (F.col("cum_realized_pnl_est") / F.lit(1e6)).alias("cum_realized_pnl_m"))


def reported_vs_estimated(income: DataFrame, returns: DataFrame,
                          history: DataFrame | None = None) -> DataFrame:
    """Company-reported income against our summed revaluation in the same calendar interval.

    Both sides are keyed by (parent, calendar year) before the interval test, so an interval only
    meets periods of the years it touches. Parents without an income table fall back on the
    annual aggregate years of ``history``, which are identities by construction.
    """
    years = F.sequence(F.year("calendar_start"), F.year("calendar_end"))
    spread = income.withColumn("_id", F.struct("parent_ticker", "period_label", "calendar_start", "calendar_end")
                               ).withColumn("_y", F.explode(years))
    per = returns.select("parent_ticker", "period_end", "mtm_pnl", F.year("period_end").alias("_y"))
    inside = spread.join(per, ["parent_ticker", "_y"]).where(
        F.col("period_end").between(F.col("calendar_start"), F.col("calendar_end")))
    mtm = inside.groupBy("_id").agg(money_sum("mtm_pnl").alias("_mtm"))
    rows = income.withColumn(
        "_id", F.struct("parent_ticker", "period_label", "calendar_start", "calendar_end")
    ).join(mtm, "_id", "left")
    our = F.coalesce("_mtm", F.lit(0.0))
    out = rows.select(
        "parent_ticker", "period_label", "fiscal_year_end",
        F.col("amount_usd").alias("company_reported_usd"),
        F.col("amount_rmb_million").alias("company_reported_rmb_million"),
        our.alias("our_mtm_sum_usd"), (our - F.col("amount_usd")).alias("residual_usd"),
        F.lit(fixed.NOTE_RECONCILIATION).alias("note"))
    if history is None:
        return out
    stamped = history.where(has_tag("note", "value_source=hk_annual_note22", "source=hk_annual")).select(
        "parent_ticker", "period_end").distinct().join(
        income.select("parent_ticker").distinct(), "parent_ticker", "left_anti")
    years_only = stamped.join(portfolio_value(history), ["parent_ticker", "period_end"]).select(
        "parent_ticker",
        F.concat(F.lit("FY"), F.year("period_end").cast("string"), F.lit(" Note22 FV")).alias("period_label"),
        F.col("period_end").alias("fiscal_year_end"),
        F.col("portfolio_mv").alias("company_reported_usd"),
        F.lit(None).cast("double").alias("company_reported_rmb_million"),
        F.col("portfolio_mv").alias("our_mtm_sum_usd"), F.lit(0.0).alias("residual_usd"),
        F.lit("hk_annual_note22 portfolio FV vs sheet portfolio_mv_end; "
              "not investment-income recon").alias("note"))
    return out.unionByName(years_only)


def mtm_identity_breaks(returns: DataFrame, tol: float = 1.0) -> DataFrame:
    """Rows whose revaluation is not end minus start minus flow."""
    expected = F.col("portfolio_mv_end") - F.col("portfolio_mv_start") - F.col("net_external_flow")
    return returns.where(F.col("portfolio_mv_start").isNotNull() & (F.abs(F.col("mtm_pnl") - expected) > tol))

