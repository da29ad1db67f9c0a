"""All performance frames of a history."""

from __future__ import annotations

from pyspark.sql import DataFrame

from posledger.operators import performance as perf
from posledger.sources.tables import stage


def performance_frames(history: DataFrame, income: DataFrame | None = None, staged: bool = True,
                       max_tickers: int | None = None, min_abs_usd: float = 0.0) -> dict[str, DataFrame]:
    """Returns, disposals, holding returns and charts by name.

    The chart of realized totals has every ticker unless the caller states a number or a floor.

    The history and the disposal events feed several frames, so they are written once.
    """
    rows = stage(history, "history") if staged else history
    events = perf.realized_events(rows)
    if staged:
        events = stage(events, "realized")
    returns = perf.portfolio_returns(rows, events)
    if staged:
        returns = stage(returns, "returns")
    frames = {
        "returns_by_period": returns,
        "realized_pnl_qoq": events,
        "holding_returns": perf.holding_returns(rows, events),
        "returns_chart": perf.returns_chart_with_footer(returns),
        "realized_chart": perf.realized_chart(returns),
        "realized_by_ticker_chart": perf.realized_by_ticker(events, max_tickers, min_abs_usd),
    }
    if income is not None:
        frames["reported_vs_est"] = perf.reported_vs_estimated(income, returns, rows)
    return frames
