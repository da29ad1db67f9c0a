"""Accounting treatment, book adjustments and inventory-method adjustment as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _flag(value) -> Column:
    return F.coalesce(_as_col(value).cast("boolean"), F.lit(False))


def ownership_band(pct) -> Column:
    p = _as_col(pct)
    return (
        F.when(p.isNull() | F.isnan(p) | (p < 0), F.lit("unknown"))
        .when(p < 20, F.lit("lt_20"))
        .when(p < 50, F.lit("ge_20_lt_50"))
        .otherwise(F.lit("ge_50"))
    )


# Filing hints per treatment.
HINTS_CONSOLIDATED = ("consolidated", "consolidate", "subsidiary")
HINTS_EQUITY = ("equity_method", "equity method", "significant_influence")
HINTS_FAIR_VALUE = ("fv_ni", "fair_value", "fair value", "asc_321")
HINTS_COST = ("measurement_alternative", "measurement_alternative_cost", "cost", "cost_method")

# Treatment -> (net income affected, mechanism, in book adjustment).
TREATMENTS = {
    "consolidated": (True, "consolidated_subsidiary", False),
    "equity_method": (True, "equity_earnings", False),
    "fv_ni": (True, "fv_changes", False),
    "measurement_alternative_cost": (False, "none_until_sale", True),
    "unclear": (False, "unclear", False),
}

# Rationale texts by deciding rule.
RATIONALES = {
    "consolidated_disclosed":
        "Control/consolidation: investee in consolidated NI; exclude from investment MTM book adj",
    "consolidated_band":
        "Ownership >= 50%: default consolidate; exclude from investment MTM book adj",
    "equity_disclosed":
        "Equity method: earnings pick-up in NI; lookthrough MTM informational only",
    "fair_value_disclosed":
        "Already FV-NI on books; store market for audit, no additional book adj",
    "cost_disclosed":
        "Cost / measurement alternative: book adj = market − carrying when market known",
    "equity_band":
        "Ownership 20–50%: default equity method; lookthrough MTM informational only",
    "fair_value_band":
        "Ownership < 20%: default ASC 321 FV-NI; no extra book adj unless cost alternative disclosed",
    "unclear": "Insufficient ownership / disclosure to assign GAAP treatment",
}


def gaap_treatment(pct, influence=None, consolidated=None, fair_value=None, cost=None,
                   hint=None) -> Column:
    """Struct of treatment, band, income effect, mechanism, book-adjustment flag and rationale.

    The first rule that applies decides: disclosed control, majority band, disclosed influence,
    disclosed fair value, disclosed cost, then the band default.
    """
    band = ownership_band(pct)
    no = F.lit(False)
    text = F.lower(F.trim(F.coalesce(_as_col(hint), F.lit("")))) if hint is not None else F.lit("")

    def disclosed(flag, hints):
        return (_flag(flag) if flag is not None else no) | text.isin(*hints)

    rules = [
        ("consolidated_disclosed", "consolidated", disclosed(consolidated, HINTS_CONSOLIDATED), "ge_50"),
        ("consolidated_band", "consolidated", band == "ge_50", "ge_50"),
        ("equity_disclosed", "equity_method", disclosed(influence, HINTS_EQUITY), "ge_20_lt_50"),
        ("fair_value_disclosed", "fv_ni", disclosed(fair_value, HINTS_FAIR_VALUE), "lt_20"),
        ("cost_disclosed", "measurement_alternative_cost", disclosed(cost, HINTS_COST), "lt_20"),
        ("equity_band", "equity_method", band == "ge_20_lt_50", "ge_20_lt_50"),
        ("fair_value_band", "fv_ni", band == "lt_20", "lt_20"),
        ("unclear", "unclear", F.lit(True), "unknown"),
    ]

    def outcome(rule, treatment, band_if_unknown):
        affects, mechanism, included = TREATMENTS[treatment]
        return F.struct(
            F.lit(treatment).alias("gaap_treatment"),
            F.when(band == "unknown", F.lit(band_if_unknown)).otherwise(band).alias("ownership_band"),
            F.lit(affects).alias("impacts_parent_ni"),
            F.lit(mechanism).alias("ni_mechanism"),
            F.lit(included).alias("include_in_book_adj"),
            F.lit(RATIONALES[rule]).alias("adj_rationale"),
        )

    case = None
    for rule, treatment, condition, default_band in rules:
        value = outcome(rule, treatment, default_band)
        case = F.when(condition, value) if case is None else case.when(condition, value)
    return case


def market_vs_carrying(lookthrough) -> Column:
    x = _as_col(lookthrough)
    return (
        F.when(x.isNull(), F.lit("unknown")).when(x > 0, F.lit("above"))
        .when(x < 0, F.lit("below")).otherwise(F.lit("flat"))
    )


def book_adjustment(treatment, included, carrying, fair_value, market_value, force=None) -> Column:
    """Struct of look-through, comparison, already-at-market, inclusion and suggested amount."""
    treatment, included = _as_col(treatment), _flag(included)
    reference = F.coalesce(_as_col(fair_value), _as_col(market_value))
    look = reference - _as_col(carrying)
    forced = (treatment == "unclear") & (_flag(force) if force is not None else F.lit(False))
    cost_like = (treatment == "measurement_alternative_cost") | forced
    applies = cost_like & look.isNotNull()
    keep = applies | (included & look.isNotNull())
    return F.struct(
        look.alias("lookthrough_mtm_usd"),
        market_vs_carrying(look).alias("market_vs_carrying"),
        (treatment == "fv_ni").alias("already_at_market"),
        keep.alias("include_in_book_adj"),
        F.when(keep, look).when(~included & look.isNotNull(), F.lit(0.0)).alias("suggested_adj_usd"),
        (applies & forced).alias("forced"),
    )


def apply_gaap_and_adjustment(df):
    """Treatment (F16) then book adjustment (F17) on a holdings frame."""
    def opt(name):
        return F.col(name) if name in df.columns else F.lit(None)

    hint = F.coalesce(opt("filing_gaap_hint").cast("string"), opt("gaap_treatment").cast("string"))
    gaap = gaap_treatment(
        F.col("ownership_pct"), opt("influence_disclosed"), opt("consolidated_disclosed"),
        opt("fair_value_through_earnings"), opt("measurement_alternative"), hint,
    )
    out = df.withColumn("_gaap", gaap)
    out = out.withColumn("_adj", book_adjustment(
        F.col("_gaap.gaap_treatment"), F.col("_gaap.include_in_book_adj"),
        F.col("carrying_usd"), F.col("fair_value_disclosed_usd"), F.col("market_value_usd"),
        opt("force_cost_adj"),
    ))
    return out.withColumns({
        "gaap_treatment": F.col("_gaap.gaap_treatment"),
        "ownership_band": F.col("_gaap.ownership_band"),
        "impacts_parent_ni": F.col("_gaap.impacts_parent_ni"),
        "ni_mechanism": F.col("_gaap.ni_mechanism"),
        "adj_rationale": F.when(
            F.col("_adj.forced"),
            F.concat(F.col("_gaap.adj_rationale"), F.lit("; forced cost-like adj")),
        ).otherwise(F.col("_gaap.adj_rationale")),
        "lookthrough_mtm_usd": F.col("_adj.lookthrough_mtm_usd"),
        "market_vs_carrying": F.col("_adj.market_vs_carrying"),
        "already_at_market": F.col("_adj.already_at_market"),
        "include_in_book_adj": F.col("_adj.include_in_book_adj"),
        "suggested_adj_usd": F.col("_adj.suggested_adj_usd"),
    }).drop("_gaap", "_adj")


# Explanation texts.
NOTE_IFRS = "IFRS reporting basis: LIFO not permitted; LIFO→FIFO book adjustment not applied."
NOTE_NO_AMOUNT = "LIFO reserve mentioned but no dollar amount; adjustment not applied."
NOTE_NO_INPUTS = "LIFO reserve found but price/book/shares missing; adjustment not applied."


def accounting_basis(value) -> Column:
    text = F.regexp_replace(F.upper(F.trim(F.coalesce(_as_col(value), F.lit("")))), " ", "_")
    return (
        F.when(text.isin("US_GAAP", "USGAAP", "GAAP"), F.lit("US_GAAP"))
        .when(text.isin("IFRS", "IAS"), F.lit("IFRS"))
        .when(text == "OTHER", F.lit("other"))
        .otherwise(F.lit("unclear"))
    )


def lifo_adjustment(basis, disclosed, reserve, price, book, shares, notes=None) -> Column:
    """Inventory-reserve adjustment: all three amounts together or none, with the reason."""
    kind = accounting_basis(basis)
    reserve, price, book, shares = (_as_col(c) for c in (reserve, price, book, shares))
    note = _as_col(notes) if notes is not None else F.lit(None).cast("string")
    usable = F.coalesce(
        (reserve > 0) & price.isNotNull() & (book > 0) & (shares > 0) & (kind != "IFRS"), F.lit(False))
    adjusted = book + reserve / shares
    reason = (
        F.when(kind == "IFRS", F.lit(NOTE_IFRS))
        .when(usable, F.lit(None).cast("string"))
        .when(_flag(disclosed) & reserve.isNull(), F.lit(NOTE_NO_AMOUNT))
        .when(reserve.isNotNull(), F.lit(NOTE_NO_INPUTS))
    )
    return F.struct(
        kind.alias("accounting_basis"),
        F.when(usable, reserve).alias("lifo_reserve_usd"),
        F.when(usable, adjusted).alias("adjusted_bvps"),
        F.when(usable, price / adjusted).alias("adjusted_pb_ratio"),
        F.when(reason.isNull(), note)
        .otherwise(F.trim(F.concat_ws(" ", F.nullif(note, F.lit("")), reason))).alias("quirk_notes"),
    )
