"""Explicit table schemas. Quantities and money are doubles, dates are DateType."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_S, _D, _DT, _B, _I, _L = (
    T.StringType(), T.DoubleType(), T.DateType(), T.BooleanType(), T.IntegerType(), T.LongType()
)


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


# One disclosed holding inside one snapshot (filing) of one parent.
SNAPSHOT_SCHEMA = _fields(
    ("parent_ticker", _S), ("period_end", _DT), ("filing_date", _DT), ("accession_no", _S),
    ("investee_name", _S), ("investee_ticker", _S), ("cusip", _S),
    ("shares_held", _D), ("market_value_usd", _D), ("ownership_pct", _D),
    ("as_of_date", _DT), ("as_of_accession_no", _S), ("source", _S), ("note", _S),
)

# The grid: a filing without rows is still a period and closes positions.
PERIODS_SCHEMA = _fields(
    ("parent_ticker", _S), ("period_end", _DT), ("filing_date", _DT), ("accession_no", _S),
)

# The central fact table: one row per parent, period and investee.
HISTORY_SCHEMA = _fields(
    ("parent_ticker", _S), ("period_end", _DT), ("filing_date", _DT), ("accession_no", _S),
    ("filing_url", _S), ("investee_name", _S), ("investee_ticker", _S), ("cusip", _S),
    ("shares_held", _D), ("ownership_pct", _D), ("market_value_usd", _D),
    ("shares_prev", _D), ("shares_delta", _D), ("value_prev", _D), ("value_delta", _D),
    ("action", _S), ("first_seen_period", _DT), ("exited_period", _DT), ("note", _S),
    ("composition_parent", _S), ("composition_as_of", _DT), ("child_value_source", _S),
    ("parent_aggregate_market_value_usd", _D),
    ("cost_basis_est_usd", _D), ("cost_basis_est_price", _D), ("cost_basis_est_as_of", _DT),
    ("cost_basis_est_source", _S), ("mark_at_filing_est_usd", _D),
)

# Live (current) holdings with their accounting treatment.
HOLDINGS_SCHEMA = _fields(
    ("parent_ticker", _S), ("as_of_date", _DT), ("as_of_accession_no", _S),
    ("investee_name", _S), ("investee_ticker", _S), ("investee_exchange", _S),
    ("ownership_pct", _D), ("shares_held", _D), ("acquired_date", _DT),
    ("first_filing_date", _DT), ("first_accession_no", _S), ("gaap_treatment", _S),
    ("influence_disclosed", _B), ("ownership_band", _S), ("impacts_parent_ni", _B),
    ("ni_mechanism", _S), ("carrying_usd", _D), ("fair_value_disclosed_usd", _D),
    ("market_price", _D), ("market_value_usd", _D), ("price_as_of", _DT), ("price_source", _S),
    ("market_vs_carrying", _S), ("suggested_adj_usd", _D), ("include_in_book_adj", _B),
    ("lookthrough_mtm_usd", _D), ("already_at_market", _B), ("adj_rationale", _S),
    ("source_quote", _S), ("confidence", _S), ("note", _S),
    ("cost_basis_est_usd", _D), ("cost_basis_est_price", _D), ("cost_basis_est_as_of", _DT),
    ("cost_basis_est_source", _S),
)
HOLDINGS_DEFAULTS = {
    "influence_disclosed": False, "impacts_parent_ni": False,
    "include_in_book_adj": False, "already_at_market": False,
}

POSITIONS_COLUMNS = [
    "parent_ticker", "period_end", "investee_ticker", "investee_name", "cusip", "action",
    "shares_held", "ownership_pct", "shares_prev", "shares_delta", "market_value_usd",
    "value_prev", "value_delta", "filing_date", "accession_no", "filing_url",
    "first_seen_period", "exited_period", "composition_parent", "composition_as_of",
    "child_value_source", "parent_aggregate_market_value_usd", "cost_basis_est_usd",
    "cost_basis_est_price", "cost_basis_est_as_of", "cost_basis_est_source",
    "mark_at_filing_est_usd", "note",
]

CROSSING_SCHEMA = _fields(
    ("ticker", _S), ("deletion_date", _DT), ("source_index", _S), ("status", _S),
    ("crossing_date", _DT), ("buy_price", _D), ("bvps_at_crossing", _D),
    ("shares_at_crossing", _D), ("pb_ratio_at_crossing", _D), ("bvps_source", _S),
    ("profitable_at_crossing", _B), ("net_income_at_crossing", _D), ("earnings_source", _S),
    ("note", _S),
)

OWNERSHIP_SCHEMA = _fields(
    ("ticker", _S), ("deletion_date", _DT), ("as_of_date", _DT), ("percent_insiders", _D),
    ("percent_institutions", _D), ("percent_non_institutions", _D), ("insider_shares", _D),
    ("institutional_shares", _D), ("shares_outstanding", _D), ("shares_float", _D),
    ("insider_owner_count", _L), ("institutional_holder_count", _L), ("filings_considered", _L),
    ("institutional_period", _DT), ("source", _S), ("note", _S),
)

BUYBACK_SCHEMA = _fields(
    ("ticker", _S), ("deletion_date", _DT), ("as_of_date", _DT), ("period_end", _DT),
    ("filing_date", _DT), ("sale_purchase_of_stock_ttm", _D), ("net_buyback_usd_ttm", _D),
    ("gross_repurchase_usd_ttm", _D), ("issuance_of_capital_stock_ttm", _D),
    ("treasury_stock", _D), ("quarters_used", _L), ("source", _S), ("note", _S),
)

LIFO_SCHEMA = _fields(
    ("ticker", _S), ("accession_no", _S), ("filing_date", _DT), ("accounting_basis", _S),
    ("method", _S), ("lifo_reserve_disclosed", _B), ("lifo_reserve_usd", _D),
    ("method_change_disclosed", _B), ("quirk_notes", _S), ("source_quote", _S),
    ("confidence", _S), ("adjusted_bvps", _D), ("adjusted_pb_ratio", _D),
)

DESCRIPTION_SCHEMA = _fields(
    ("ticker", _S), ("accession_no", _S), ("filing_date", _DT), ("description", _S),
    ("source_quote", _S),
)

MEMBERSHIP_SCHEMA = _fields(("ticker", _S), ("index_name", _S), ("snapshot_date", _DT))

RECONSTITUTION_SCHEMA = _fields(
    ("company", _S), ("ticker", _S), ("industry", _S), ("reconstitution_date", _DT),
    ("source_index", _S),
)

STAKE_SCHEMA = _fields(
    ("parent_ticker", _S), ("series_id", _S), ("source_id", _S), ("broker", _S),
    ("as_of_date", _DT), ("investee_name", _S), ("investee_ticker", _S), ("stake_pct", _D),
    ("mkt_cap_usd_mn", _D), ("value_hkd_mn", _D), ("market_value_usd", _D), ("fx", _D),
    ("source_url", _S), ("citation", _S), ("parser", _S), ("note", _S),
)

INCOME_SCHEMA = _fields(
    ("parent_ticker", _S), ("period_label", _S), ("fiscal_year_end", _DT),
    ("calendar_start", _DT), ("calendar_end", _DT), ("amount_rmb_million", _D),
    ("amount_usd", _D), ("line_item", _S), ("source_url", _S), ("note", _S),
)

FINDINGS_SCHEMA = _fields(
    ("stage", _S), ("severity", _S), ("check_id", _S), ("message", _S),
    ("evidence", T.MapType(_S, _S)),
)


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None,
            keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Select ``schema`` in order: cast what is there, add the rest as typed NULL (or default).

    ``keep`` names further columns to carry along unchanged; defaults are booleans.
    """
    have, defaults = set(df.columns), defaults or {}

    def pick(field: T.StructField) -> str:
        name, kind = f"`{field.name}`", field.dataType.simpleString()
        literal = {True: "true", False: "false", None: "null"}.get(defaults.get(field.name))
        if field.name not in have:
            return f"cast({literal} as {kind}) as {name}"
        if field.name in defaults:
            return f"coalesce(cast({name} as {kind}), {literal}) as {name}"
        return f"cast({name} as {kind}) as {name}"

    return df.selectExpr(*[pick(field) for field in schema.fields], *keep)


def evolve(df: DataFrame, new_columns: dict[str, str]) -> DataFrame:
    """Additive evolution: append the named columns as typed NULL where they are missing."""
    missing = {k: F.lit(None).cast(v) for k, v in new_columns.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df
