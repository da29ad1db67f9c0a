"""Frames behind the reports: stacks, quarter grids, pivots, stake tables, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.functions.dates import quarter_end, quarter_end_on_or_before
from posledger.functions.numbers import money_sum
from posledger.functions.text import filing_url, normalize_ticker
from posledger.operators.performance import excluded_from_portfolio
from posledger.schemas import POSITIONS_COLUMNS


def _label() -> Column:
    return F.coalesce(
        F.nullif(F.upper(F.trim("investee_ticker")), F.lit("")), F.col("investee_name"), F.lit("UNKNOWN"))


def positions_frame(history: DataFrame, ciks: DataFrame) -> DataFrame:
    """Export columns in order; missing filing links are built from the parent's CIK."""
    known = ciks.select("parent_ticker", F.col("cik").alias("_cik"))
    rows = history.join(known, "parent_ticker", "left")
    return rows.withColumn("filing_url", filing_url("_cik", "accession_no", "filing_url")).select(*POSITIONS_COLUMNS)


def portfolio_by_period(history: DataFrame) -> DataFrame:
    """Value per period and name without exits, mirrors, residuals and unknown values."""
    rows = history.where((F.coalesce("action", F.lit("")) != "exit") & ~excluded_from_portfolio()
                         & F.col("market_value_usd").isNotNull())
    return rows.groupBy("parent_ticker", "period_end", _label().alias("investee_ticker")).agg(
        money_sum("market_value_usd").alias("market_value_usd"))


def display_stack(history: DataFrame) -> DataFrame:
    """Chart sizing per period and public name: the disclosed value, else the filing-date mark."""
    label = F.upper(_label())
    value = F.coalesce("market_value_usd", "mark_at_filing_est_usd")
    rows = history.where((F.lower(F.coalesce("action", F.lit(""))) != "exit") & value.isNotNull()
                         & ~label.startswith("PRIV_") & ~label.endswith("_RESIDUAL") & (label != "NAN"))
    return rows.groupBy("parent_ticker", "period_end", label.alias("investee_ticker")).agg(
        money_sum(value).alias("display_value_usd"))


def quarterly_locf(history: DataFrame, include_open_quarter: bool = False) -> DataFrame:
    """Last display value of every name at each calendar quarter end of the parent's span.

    A name stops at its earliest exit, even if it comes back. A span without a quarter end gives
    the last period itself. Each value fills its own quarters, so the work grows with the output.
    ``include_open_quarter`` extends the span to the end of its last quarter.
    """
    stack = display_stack(history)
    span = stack.groupBy("parent_ticker").agg(F.min("period_end").alias("_lo"), F.max("period_end").alias("_hi"))
    exits = history.where(F.lower(F.coalesce("action", F.lit(""))) == "exit").groupBy(
        "parent_ticker", F.upper(F.trim("investee_ticker")).alias("investee_ticker")).agg(
        F.min(F.coalesce("exited_period", "period_end")).alias("_exit"))
    w = Window.partitionBy("parent_ticker", "investee_ticker").orderBy("period_end")
    rows = stack.withColumn("_next", F.lead("period_end").over(w)).join(span, "parent_ticker").join(
        exits, ["parent_ticker", "investee_ticker"], "left")
    top = quarter_end("_hi") if include_open_quarter else quarter_end_on_or_before("_hi")
    lonely = quarter_end("_lo") > top
    last = F.least(top, quarter_end_on_or_before(F.date_sub("_next", 1)),
                   quarter_end_on_or_before(F.date_sub("_exit", 1)))
    first = quarter_end("period_end")
    quarters = F.when(~lonely & (first <= last), F.transform(
        F.sequence(F.trunc(first, "quarter"), F.trunc(last, "quarter"), F.expr("interval 3 months")),
        lambda q: F.date_sub(F.add_months(q, 3), 1)))
    open_at_end = F.col("_next").isNull() & (F.col("_exit").isNull() | (F.col("_exit") > F.col("_hi")))
    points = F.when(lonely & open_at_end, F.array("_hi")).otherwise(quarters)
    return rows.select("parent_ticker", F.explode(points).alias("period_end"), "investee_ticker", "display_value_usd")


def rank_series(long: DataFrame, value: str, by: Sequence[str] = (),
                exclude: Sequence[str] = (), top_n: int | None = None) -> DataFrame:
    """Names in chart order: by size in the latest period, then by their largest earlier value.

    One row per name, so ranking never sorts the data itself; with ``top_n`` every partition only
    passes its own best names on.
    """
    rows = long.where(~F.upper("investee_ticker").isin(*exclude)) if exclude else long
    cells = rows.groupBy(*by, "period_end", "investee_ticker").agg(money_sum(value).alias("_v"))
    latest = cells.groupBy(*by).agg(F.max("period_end").alias("_latest"))
    marked = cells.join(latest, list(by)) if by else cells.withColumn("_latest", F.lit(latest.scalar()))
    per_name = marked.groupBy(*by, "investee_ticker").agg(
        F.max(F.when(F.col("period_end") == F.col("_latest"), F.col("_v"))).alias("latest_value"),
        F.max("_v").alias("max_value"))
    order = [F.col("latest_value").desc_nulls_last(), F.col("max_value").desc(), F.col("investee_ticker")]
    if not by and top_n is not None:
        per_name = per_name.orderBy(*order).limit(top_n)
    ranked = per_name.withColumn("series_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked if top_n is None else ranked.where(F.col("series_rank") <= top_n)


def top_series(long: DataFrame, value: str, top_n: int, by: Sequence[str] = ("parent_ticker",)) -> DataFrame:
    """Rows of the ``top_n`` names by latest value."""
    keep = rank_series(long, value, by, top_n=top_n).where(F.col("latest_value").isNotNull())
    return long.join(keep.select(*by, "investee_ticker", "series_rank"), [*by, "investee_ticker"])


def pivot_stack(long: DataFrame, value: str, top_n: int | None = None, series: Sequence[str] | None = None,
                exclude: Sequence[str] = ()) -> DataFrame:
    """Wide matrix in millions: one row per period, one column per name in chart order, zero filled.

    Columns are the named ``series`` or the first ``top_n``, one of which the caller states. Only that list
    reaches the driver, and a wide table cannot be described without it.
    """
    if series is None and top_n is None:
        raise ValueError("state the series or their number")
    rows = long.where(~F.upper("investee_ticker").isin(*exclude)) if exclude else long
    if series is None:
        ranked = rank_series(long, value, exclude=exclude, top_n=top_n)
        if top_n is not None:
            ranked = ranked.where(F.col("latest_value").isNotNull())
        series = [r[0] for r in ranked.orderBy("series_rank").select("investee_ticker").collect()]
    names = list(series)
    wide = rows.where(F.col("investee_ticker").isin(names)).groupBy("period_end").pivot(
        "investee_ticker", names).agg(money_sum(value))
    return wide.select("period_end", *[
        F.round(F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) / 1e6, 2).alias(c) for c in names])


def stake_wide(rows: DataFrame, vintages: Sequence[str]) -> DataFrame:
    """Stake percentage per vintage as columns, with the number of vintages known."""
    cells = [F.max(F.when(F.col("as_of") == F.lit(v).cast("date"), F.col("ownership_pct"))).alias(v) for v in vintages]
    wide = rows.groupBy("series_id", "investee_ticker", "broker").agg(*cells)
    known = sum((F.when(F.col(f"`{v}`").isNotNull(), 1).otherwise(0) for v in vintages), F.lit(0))
    return wide.withColumn("n_vintages", known.cast("long"))


def holdings_overview(history: DataFrame) -> DataFrame:
    """Per parent: rows, names, valued rows and first and last period."""
    return history.groupBy("parent_ticker").agg(
        F.count(F.lit(1)).alias("num_rows"), F.count_distinct("investee_ticker").alias("num_names"),
        F.count("market_value_usd").alias("num_valued"),
        F.min("period_end").alias("first_period"), F.max("period_end").alias("last_period"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with more than one row; rows without a complete key do not count."""
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def normalized_keys(history: DataFrame) -> DataFrame:
    return history.withColumn("investee_ticker", normalize_ticker("investee_ticker"))
