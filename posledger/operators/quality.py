"""Data-quality checks as findings frames. ``enforce`` refuses to go on when one fails."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from posledger.functions.numbers import looks_like_pct_as_shares, to_number
from posledger.functions.text import has_tag, is_overlay_note, normalize_ticker, note_text
from posledger.operators.identity import resolve_identity
from posledger.operators.performance import mtm_identity_breaks
from posledger.operators.reporting import duplicates, normalized_keys
from posledger.schemas import FINDINGS_SCHEMA, conform
from posledger.sources import fixed_values as fixed

# Exchange-like placeholders and pricing markers.
PLACEHOLDER_TICKERS = ("ANT", "CHINA", "MANGO", "MEINIAN", "YTO", "ALIEXPRESS", "MOONSHOT")
INVENTED_PRICING = r"(?i)priced=shares\*eodhd|shares\*price|share×price"
NON_OWNERSHIP_SOURCES = r"(?i)investments_table|13f|value_source=|20f_note|10[kq]_note"
REAL_VALUE_TAGS = (
    "value_source=broker_sotp", "value_source=13f", "value_source=hk_annual_note22", "source=13f",
    "investments_table",
)
AGGREGATE_SIZE_USD = 60e9


def _evidence(columns: Sequence[str]) -> Column:
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])


def finding(df: DataFrame, stage: str, check_id: str, message: str | Column, severity: str = "fail",
            columns: Sequence[str] = ("parent_ticker", "period_end", "investee_ticker")) -> DataFrame:
    """Turn offending rows into findings with the named columns as evidence."""
    text = message if isinstance(message, Column) else F.lit(message)
    have = [c for c in columns if c in df.columns]
    return conform(df.select(
        F.lit(stage).alias("stage"), F.lit(severity).alias("severity"), F.lit(check_id).alias("check_id"),
        text.alias("message"), _evidence(have).alias("evidence")), FINDINGS_SCHEMA)


@dataclass(frozen=True)
class RowCheck:
    """A check that a row passes or fails by itself."""

    check_id: str
    message: str
    bad: Column
    columns: tuple[str, ...] = ("parent_ticker", "period_end", "investee_ticker")
    stage: str = "history"
    severity: str = "fail"


def row_findings(rows: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Findings of any number of row checks in one scan: each row gives an array of them, exploded once."""
    def found(check: RowCheck) -> Column:
        have = [c for c in check.columns if c in rows.columns]
        return F.when(check.bad, F.struct(
            F.lit(check.stage).alias("stage"), F.lit(check.severity).alias("severity"), F.lit(check.check_id).alias("check_id"),
            F.lit(check.message).alias("message"), _evidence(have).alias("evidence")))

    hits = rows.select(F.array_compact(F.array(*map(found, checks))).alias("_found"))
    return conform(hits.select(F.inline("_found")), FINDINGS_SCHEMA)


def unique_period_ticker(history: DataFrame) -> DataFrame:
    dup = duplicates(normalized_keys(history), ["parent_ticker", "period_end", "investee_ticker"])
    return finding(dup, "history", "duplicate_ticker_same_period", "more than one row for a period and ticker",
                   columns=("parent_ticker", "period_end", "investee_ticker", "rows"))


def pct_check(stage: str = "live") -> RowCheck:
    return RowCheck("ownership_pct_stuffed_into_shares_held", "share count repeats the ownership percentage",
                    looks_like_pct_as_shares("shares_held", "ownership_pct"),
                    ("parent_ticker", "investee_ticker", "investee_name", "shares_held", "ownership_pct"), stage)


def pct_as_shares(rows: DataFrame, stage: str = "live") -> DataFrame:
    return row_findings(rows, [pct_check(stage)])


def estimate_checks(rows: DataFrame, stage: str = "history") -> list[RowCheck]:
    """Estimates need the exclusion tag, and an estimate tag next to a value needs a real source."""
    estimated = F.col("cost_basis_est_usd").isNotNull() | (
        F.col("mark_at_filing_est_usd").isNotNull() if "mark_at_filing_est_usd" in rows.columns else F.lit(False))
    columns = ("parent_ticker", "period_end", "investee_ticker", "market_value_usd")
    return [
        RowCheck("estimate_missing_excluded_from_portfolio_mv", "estimate without exclusion tag",
                 estimated & ~has_tag("note", "excluded_from_portfolio_mv"), columns, stage),
        RowCheck("eod_estimate_as_market_value", "estimate used as a value",
                 has_tag("note", "value_estimate=eod_at_filing") & F.col("market_value_usd").isNotNull()
                 & ~has_tag("note", *REAL_VALUE_TAGS), columns, stage)]


def estimates_in_value(rows: DataFrame, stage: str = "history") -> DataFrame:
    return row_findings(rows, estimate_checks(rows, stage))


def mtm_identity(returns: DataFrame, tol: float = 1.0) -> DataFrame:
    return finding(mtm_identity_breaks(returns, tol), "returns", "mtm_identity",
                   "revaluation is not end minus start minus flow",
                   columns=("parent_ticker", "period_end", "mtm_pnl", "portfolio_mv_start", "portfolio_mv_end"))


def invented_check() -> RowCheck:
    return RowCheck("otc_invent_marker", "note has an invented pricing marker", note_text("note").rlike(INVENTED_PRICING))


def invented_pricing(history: DataFrame) -> DataFrame:
    return row_findings(history, [invented_check()])


def ownership_value_check() -> RowCheck:
    bad = (F.col("market_value_usd") > 0) & note_text("note").rlike("(?i)source=13g") & ~note_text("note").rlike(NON_OWNERSHIP_SOURCES)
    return RowCheck("beneficial_ownership_used_as_value_source", "value backed by an ownership filing only", bad,
                    ("parent_ticker", "period_end", "investee_ticker", "market_value_usd"))


def ownership_as_value_source(history: DataFrame) -> DataFrame:
    return row_findings(history, [ownership_value_check()])


def false_exit_check() -> RowCheck:
    held = F.coalesce(F.col("ownership_pct") > 0, F.lit(False)) | F.coalesce(F.col("shares_held") > 0, F.lit(False))
    return RowCheck("false_13g_exit_positive_stake", "exit tag on a positive stake", note_text("note").rlike("(?i)13g_exit=1") & held,
                    ("parent_ticker", "period_end", "investee_ticker", "shares_held", "ownership_pct"))


def false_exit(history: DataFrame) -> DataFrame:
    return row_findings(history, [false_exit_check()])


def hidden_public_name(history: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Private identities whose name resolves to a public ticker."""
    t = normalize_ticker("investee_ticker")
    private = (t.startswith("PRIV_") | note_text("note").rlike("(?i)ticker=private_note")) & ~t.startswith("PRIV_HK_")
    names = history.where(private).select("parent_ticker", "period_end", "investee_name", t.alias("was"))
    asked = names.withColumns({"investee_ticker": F.lit(None).cast("string"), "cusip": F.lit(None).cast("string")})
    found = resolve_identity(asked, dims["cusips"], dims["aliases"], dims["hints"])
    bad = found.where(F.col("investee_ticker").isNotNull() & ~F.col("investee_ticker").startswith("PRIV_")
                      & (F.col("investee_ticker") != F.col("was")))
    return finding(bad, "history", "public_ticker_misclassified_as_private", "private identity of a public name",
                   columns=("parent_ticker", "period_end", "was", "investee_name", "investee_ticker"))


def presence_check() -> RowCheck:
    return RowCheck("shares_proxy_presence_invent", "share count invented from presence", note_text("note").rlike("(?i)shares_proxy=presence"))


def presence_proxy(history: DataFrame) -> DataFrame:
    return row_findings(history, [presence_check()])


def overlay_exit_check() -> RowCheck:
    return RowCheck("overlay_exit_invented_zero", "overlay exit forced to a zero value",
                    is_overlay_note("note") & (F.lower("action") == "exit") & (F.col("market_value_usd") == 0.0))


def overlay_exit_zero(history: DataFrame) -> DataFrame:
    return row_findings(history, [overlay_exit_check()])


_PLACEHOLDER = ("placeholder_exchange_like_ticker", "invented exchange-like ticker")
_NAMED = ("parent_ticker", "period_end", "investee_ticker", "investee_name")


def _own_ticker() -> Column:
    return ~normalize_ticker("investee_ticker").startswith("PRIV_") & ~note_text("note").rlike("(?i)ticker=private_note")


def placeholder_check() -> RowCheck:
    return RowCheck(*_PLACEHOLDER, _own_ticker() & normalize_ticker("investee_ticker").isin(*PLACEHOLDER_TICKERS), _NAMED)


def placeholder_tickers(history: DataFrame, deny: DataFrame | None = None) -> DataFrame:
    """Exchange-like first words used as tickers; ``deny(ticker)`` replaces the built-in list."""
    if deny is None:
        return row_findings(history, [placeholder_check()])
    rows = history.where(_own_ticker()).withColumn("_t", normalize_ticker("investee_ticker"))
    bad = rows.join(deny.select(F.upper("ticker").alias("_t")).distinct(), "_t", "left_semi")
    return finding(bad, "history", *_PLACEHOLDER, columns=_NAMED)


def history_checks(history: DataFrame) -> list[RowCheck]:
    """The checks that a row of the history passes or fails by itself."""
    return [invented_check(), ownership_value_check(), false_exit_check(), presence_check(), overlay_exit_check(), pct_check("history"),
            placeholder_check(), *estimate_checks(history)]


def anchor_values(portfolio: DataFrame, anchors: DataFrame, tol_usd: float = 50e6, tol_pct: float = 0.05) -> DataFrame:
    """Known values (parent_ticker, period_end, investee_ticker, expected_usd) must be met."""
    key = ["parent_ticker", "period_end", "investee_ticker"]
    both = anchors.join(portfolio.select(*key, "market_value_usd"), key, "left")
    off = F.abs(F.col("market_value_usd") - F.col("expected_usd"))
    bad = both.where(F.col("market_value_usd").isNull() | (off > F.greatest(F.lit(tol_usd), F.col("expected_usd") * tol_pct)))
    return finding(bad, "portfolio", "anchor_value_mismatch", "value is far from the known one",
                   columns=(*key, "market_value_usd", "expected_usd"))


def catalog_completeness(catalog: DataFrame) -> DataFrame:
    columns = ("id", "series_id", "parent_ticker")

    def blank(c):
        return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""

    count = catalog.agg(F.count(F.lit(1)).alias("n"))
    return reduce(DataFrame.unionByName, [
        finding(count.where("n = 0"), "catalog", "empty_catalog", "no enabled catalog entries", columns=("n",)),
        finding(count.where("n > 0"), "catalog", "catalog_size", "reports in the catalog", "info", ("n",)),
        finding(catalog.where(blank("source_url")), "catalog", "missing_url", "entry without url", columns=columns),
        finding(catalog.where(blank("parser")), "catalog", "missing_parser", "entry without parser", columns=columns),
        finding(catalog.where(F.col("as_of").isNull()), "catalog", "missing_as_of", "entry without date", "warn", columns),
    ])


def stake_sanity(rows: DataFrame, min_rows: int = 10, bands: DataFrame | None = None) -> DataFrame:
    """Units, ranges and row counts of parsed stakes per report.

    ``bands``: investee_ticker, low, high, severity, check_id - plausible stakes of known names.
    """
    value, stake = to_number("value_to_parent_hkd_mn"), to_number("ownership_pct")
    columns = ("report_id", "investee_ticker", "investee_name", "value_to_parent_hkd_mn", "ownership_pct")
    t = normalize_ticker("investee_ticker")
    few = rows.groupBy("report_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < min_rows)
    parts = [
        finding(few, "parse", "too_few_rows", "too few named rows", columns=("report_id", "n")),
        finding(rows.where(value > 5_000_000), "parse", "value_unit_likely_wrong", "value is not in millions", columns=columns),
        finding(rows.where((value > 0) & (value < 10)), "parse", "value_suspiciously_small", "tiny value", "warn", columns),
        finding(rows.where(value.isNotNull() & stake.isNotNull() & ~((stake > 0) & (stake <= 100))), "parse",
                "stake_out_of_range", "stake outside (0, 100]", columns=columns),
        finding(rows.where(t.isin(*fixed.EXCHANGE_CODES)), "parse", "ticker_is_exchange_suffix",
                "ticker is an exchange code", columns=columns),
    ]
    if bands is not None:
        banded = rows.withColumn("_t", t).join(
            bands.withColumnRenamed("investee_ticker", "_t"), "_t").where(~stake.between(F.col("low"), F.col("high")))
        parts.append(conform(banded.select(
            F.lit("parse").alias("stage"), "severity", "check_id", F.lit("stake outside its usual band").alias("message"),
            _evidence(columns).alias("evidence")), FINDINGS_SCHEMA))
    return reduce(DataFrame.unionByName, parts)


def fx_round_trip(rows: DataFrame, tol_pct: float = 2.0) -> DataFrame:
    """Dollars times the rate must give back the local amount."""
    expected = F.col("value_to_parent_hkd_mn") * 1e6
    err = F.abs(F.col("value_usd") * F.col("fx") - expected) / expected * 100.0
    bad = rows.where((expected > 0) & (err > tol_pct))
    return finding(bad, "fx", "fx_roundtrip", "round trip error",
                   columns=("investee_ticker", "as_of", "value_usd", "fx", "value_to_parent_hkd_mn"))


def overlay_checks(rows: DataFrame, stage: str = "overlay_history") -> DataFrame:
    """Overlay stamps exist, and no stamped child carries an aggregate-sized value."""
    stamped = rows.where(has_tag("note", "value_source=broker_sotp"))
    none = stamped.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    t = normalize_ticker("investee_ticker")
    columns = ("parent_ticker", "investee_ticker", "market_value_usd")
    return reduce(DataFrame.unionByName, [
        finding(none, stage, "no_broker_stamps", "no overlay-stamped rows", columns=("n",)),
        finding(stamped.where((F.col("market_value_usd") > AGGREGATE_SIZE_USD) & ~t.isin(*fixed.LISTED_AGGREGATE_TICKERS)),
                stage, "child_mv_looks_like_parent", "child value looks like an aggregate", columns=columns),
        finding(stamped.where(~has_tag("note", "excluded_from_portfolio_mv")), stage, "missing_exclude",
                "overlay value without exclusion tag", "warn", columns),
    ])


def composition_checks(view: DataFrame) -> DataFrame:
    """Named parts against their aggregate: value missing, equal to it, or without join keys."""
    child, parent = F.col("child_market_value_usd"), F.col("parent_aggregate_market_value_usd")
    rows = view.where(~F.coalesce(F.col("child_ticker").endswith("_RESIDUAL"), F.lit(False)))
    columns = ("parent_ticker", "period_end", "composition_parent", "child_ticker", "child_market_value_usd",
               "parent_aggregate_market_value_usd")
    no_keys = F.col("period_end").isNull() | F.col("composition_parent").isNull() | parent.isNull()
    return reduce(DataFrame.unionByName, [
        finding(rows.where((parent > 50e9) & child.isNull()), "composition", "parent_vs_child_confusion_risk",
                "no child value under a large aggregate", columns=columns),
        finding(rows.where(F.abs(child - parent) / parent < 0.05), "composition", "child_equals_parent",
                "child value is about the aggregate", columns=columns),
        finding(rows.where(child > AGGREGATE_SIZE_USD), "composition", "child_looks_like_parent_agg",
                "child value looks like an aggregate", columns=columns),
        finding(rows.where(child.isNotNull() & no_keys), "composition", "child_mv_missing_join_keys",
                "child value without join keys", columns=columns),
    ])


def merge_reports(findings: DataFrame) -> DataFrame:
    """Verdict per stage: failures, warnings and whether the stage is fine."""
    fails = F.count_if(F.col("severity") == "fail")
    return findings.groupBy("stage").agg(
        fails.alias("n_fail"), F.count_if(F.col("severity") == "warn").alias("n_warn"), (fails == 0).alias("ok"))


def verdict(findings: DataFrame) -> DataFrame:
    fails = F.count_if(F.col("severity") == "fail")
    return findings.agg(
        (fails == 0).alias("ok"), fails.alias("n_fail"), F.count_if(F.col("severity") == "warn").alias("n_warn"),
        F.when(fails == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("verdict"),
        F.when(fails == 0, F.lit(100)).otherwise(F.lit(0)).alias("score"))


def exit_sample(history: DataFrame, n: int) -> DataFrame:
    """First exit rows for a report."""
    exits = history.where((F.lower("action") == "exit") | has_tag("note", "13g_exit=1"))
    return exits.select(
        "period_end", "investee_ticker", "action", "shares_held", "ownership_pct", "market_value_usd",
        "accession_no", "filing_date", "note").orderBy(
        "period_end", "investee_ticker", "accession_no").limit(n)


class QualityError(ValueError):
    """Raised when a check that must hold has findings."""


def enforce(findings: DataFrame, limit: int = 10) -> None:
    """Raise with a few examples when any finding fails; this is an action."""
    bad = findings.where(F.col("severity") == "fail").select("check_id", "message", "evidence").limit(limit).collect()
    if bad:
        raise QualityError("; ".join(f"{r.check_id}: {r.message} {dict(r.evidence or {})}" for r in bad))
