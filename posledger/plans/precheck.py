"""The mechanical check of a history before it is shipped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from posledger.operators import merge, quality
from posledger.sources.tables import stage


def mechanical_precheck(history: DataFrame, dims: dict[str, DataFrame], portfolio: DataFrame | None = None,
                        anchors: DataFrame | None = None) -> DataFrame:
    """Findings of all mechanical checks; ``anchors`` are known values of single parents.

    All checks on single rows share one scan; only duplicates, hidden names and anchors need an exchange of their own.
    """
    rows = stage(merge.coalesce_for_export(history), "checked")
    checks = [
        quality.row_findings(rows, quality.history_checks(rows)), quality.unique_period_ticker(rows),
        quality.hidden_public_name(rows, dims),
    ]
    if portfolio is not None and anchors is not None:
        checks.append(quality.anchor_values(portfolio, anchors))
    return reduce(DataFrame.unionByName, checks)
