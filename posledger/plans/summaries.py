"""Wide summaries of the screener and of the deletion backtest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from posledger.functions.numbers import from_fixed
from posledger.functions.valuation import lifo_adjustment
from posledger.operators import ownership as own, screening
from posledger.operators.asof import Side, asof_join_many
from posledger.plans import holdings
from posledger.schemas import BUYBACK_SCHEMA, DESCRIPTION_SCHEMA, LIFO_SCHEMA, OWNERSHIP_SCHEMA
from posledger.sources.tables import latest_per_key, stage

# Columns each enrichment contributes.
LIFO_COLUMNS = ("accounting_basis", "method", "lifo_reserve_disclosed", "lifo_reserve_usd", "method_change_disclosed",
                "quirk_notes", "confidence", "adjusted_bvps", "adjusted_pb_ratio", "lifo_source_quote")
DESCRIPTION_COLUMNS = ("description", "description_source_quote")
OWNERSHIP_COLUMNS = ("percent_insiders", "percent_institutions", "percent_non_institutions", "insider_shares",
                     "institutional_shares", "shares_outstanding", "insider_owner_count", "institutional_holder_count",
                     "institutional_period", "as_of_date")
BUYBACK_COLUMNS = ("sale_purchase_of_stock_ttm", "net_buyback_usd_ttm", "gross_repurchase_usd_ttm",
                   "issuance_of_capital_stock_ttm", "treasury_stock", "buyback_period_end", "buyback_filing_date",
                   "buyback_quarters_used")
HOLDINGS_COLUMNS = ("holdings_count", "holdings_book_adj_usd", "bvps_holdings_adj", "pb_holdings_adj",
                    "holdings_lookthrough_mtm_usd", "holdings_above_count", "holdings_below_count",
                    "holdings_ni_impact_count")
_HOLDINGS_TYPES = dict.fromkeys(HOLDINGS_COLUMNS, "double") | dict.fromkeys(
    ("holdings_count", "holdings_above_count", "holdings_below_count", "holdings_ni_impact_count"), "bigint")


def enrich(base: DataFrame, side: DataFrame | None, on: Sequence[str], columns: Sequence[str],
           types: dict[str, str]) -> DataFrame:
    """Left join named columns; a missing side or column becomes typed NULL."""
    if side is None:
        return base.withColumns({c: F.lit(None).cast(types[c]) for c in columns})
    have = [c for c in columns if c in side.columns]
    out = base.join(side.select(*on, *have), list(on), "left")
    missing = {c: F.lit(None).cast(types[c]) for c in columns if c not in have}
    return out.withColumns(missing) if missing else out


def _types(schema, renamed: dict[str, str] | None = None) -> dict[str, str]:
    names = {v: k for k, v in (renamed or {}).items()}
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    return types | {new: types[old] for new, old in names.items()}


_LIFO_NAMES = {"source_quote": "lifo_source_quote"}
_DESCRIPTION_NAMES = {"source_quote": "description_source_quote"}
_BUYBACK_NAMES = {"period_end": "buyback_period_end", "filing_date": "buyback_filing_date",
                  "quarters_used": "buyback_quarters_used"}


def _latest(df: DataFrame | None, keys: Sequence[str], order: Sequence[str], names: dict[str, str] | None = None):
    if df is None:
        return None
    newest = latest_per_key(df, list(keys), list(order))
    return newest.withColumnsRenamed(names) if names else newest


def _with_texts(base: DataFrame, lifo: DataFrame | None, descriptions: DataFrame | None) -> DataFrame:
    order = ["filing_date", "accession_no"]
    out = enrich(base, _latest(lifo, ["ticker"], order, _LIFO_NAMES), ["ticker"], LIFO_COLUMNS, _types(LIFO_SCHEMA, _LIFO_NAMES))
    return enrich(out, _latest(descriptions, ["ticker"], order, _DESCRIPTION_NAMES), ["ticker"], DESCRIPTION_COLUMNS,
                  _types(DESCRIPTION_SCHEMA, _DESCRIPTION_NAMES))


def stock_summary(screened: DataFrame, dropouts: DataFrame, lifo: DataFrame | None = None,
                  descriptions: DataFrame | None = None, ownership: DataFrame | None = None,
                  buybacks: DataFrame | None = None, rollups: DataFrame | None = None) -> DataFrame:
    """One row per screened ticker with its newest enrichments and the drop-out flag."""
    flagged = screening.flag_exists(screened, dropouts, ["ticker"], "is_index_dropout")
    out = _with_texts(flagged, lifo, descriptions)
    out = enrich(out, _latest(ownership, ["ticker"], ["as_of_date"]), ["ticker"], OWNERSHIP_COLUMNS, _types(OWNERSHIP_SCHEMA))
    out = enrich(out, _latest(buybacks, ["ticker"], ["as_of_date"], _BUYBACK_NAMES), ["ticker"], BUYBACK_COLUMNS,
                 _types(BUYBACK_SCHEMA, _BUYBACK_NAMES))
    return enrich(out, rollups, ["ticker"], HOLDINGS_COLUMNS, _HOLDINGS_TYPES)


def backtest_summary(crossings: DataFrame, outcomes: DataFrame | None = None, lifo: DataFrame | None = None,
                     descriptions: DataFrame | None = None, ownership: DataFrame | None = None,
                     buybacks: DataFrame | None = None, rollups: DataFrame | None = None) -> DataFrame:
    """Every crossing attempt, whatever its status, with outcome and enrichments of its date."""
    pair = ["ticker", "deletion_date"]
    out = crossings
    if outcomes is not None:
        renamed = outcomes.withColumnsRenamed({
            "status": "return_status", "buy_price": "return_buy_price", "note": "return_note"})
        extra = [c for c in renamed.columns if c not in crossings.columns]
        out = out.join(renamed.select(*pair, *extra), pair, "left")
    out = _with_texts(out, lifo, descriptions)
    out = enrich(out, ownership, pair, OWNERSHIP_COLUMNS, _types(OWNERSHIP_SCHEMA))
    if rollups is not None and "deletion_date" not in rollups.columns:
        rollups = rollups.withColumnRenamed("as_of_date", "deletion_date")
    renamed_bb = buybacks.withColumnsRenamed(_BUYBACK_NAMES) if buybacks is not None else None
    out = enrich(out, renamed_bb, pair, BUYBACK_COLUMNS, _types(BUYBACK_SCHEMA, _BUYBACK_NAMES))
    return enrich(out, rollups, pair, HOLDINGS_COLUMNS, _HOLDINGS_TYPES)


def run_screener(quotes: DataFrame, members: DataFrame, lookback_days: int, known_holdings: DataFrame,
                 lifo: DataFrame | None = None, descriptions: DataFrame | None = None, ownership: DataFrame | None = None,
                 buybacks: DataFrame | None = None) -> DataFrame:
    """From the universe to the enriched summary in one plan.

    ``quotes``: ticker, price, book_value, shares, pb_ratio; ``members``: ticker, index_name, snapshot_date.
    Tickers below book stay, those that left their index are flagged, and their holdings are rolled up.
    """
    screened = screening.screening_candidates(screening.price_book_screen(quotes))
    dropouts = screening.index_dropouts(members, lookback_days)
    _, rollups = holdings.holdings_universe(screened.select("ticker", "price", "book_value", "shares"), known_holdings)
    return stock_summary(screened, dropouts, lifo, descriptions, ownership, buybacks, rollups)


def summary_counts(summary: DataFrame) -> DataFrame:
    """Coverage of a summary: rows and how many carry each enrichment."""
    known = {"num_lifo_adjusted": "adjusted_bvps", "num_with_adjusted_pb": "adjusted_pb_ratio",
             "num_with_insiders": "percent_insiders", "num_with_non_inst": "percent_non_institutions",
             "num_with_buybacks": "net_buyback_usd_ttm"}
    return summary.agg(
        F.count(F.lit(1)).alias("num_rows"), *[F.count(c).alias(n) for n, c in known.items()],
        F.count_if(F.coalesce(F.col("holdings_count") > 0, F.lit(False))).alias("num_with_holdings"))


def run_backtest(deletions: DataFrame, additions: DataFrame, prices: DataFrame, book: DataFrame, earnings: DataFrame,
                 as_of, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Crossings of the deletions not done yet, and the outcome of all profitable crossers."""
    todo = deletions if done is None else screening.pending(deletions, done, ["ticker", "deletion_date"])
    fresh = stage(screening.first_crossing(todo, prices, book, earnings), "crossings")
    crossings = fresh if done is None else done.unionByName(fresh, allowMissingColumns=True)
    crossed = crossings.where(F.col("status") == "crossed")
    joined = screening.attach_reentry(crossed, screening.reentry_dates(crossings, additions))
    return crossings, screening.trade_outcome(joined, prices, as_of)


def enrich_as_of(keys: DataFrame, insiders: DataFrame, institutions: DataFrame, outstanding: DataFrame, cash_flow: DataFrame,
                 balance: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ownership and buybacks of every (ticker, deletion_date) as known on that date, all series in one pass.

    ``insiders``: ticker, owner, filing_date, shares; ``institutions``: ticker, manager, period_end, filing_date, shares;
    ``outstanding``: ticker, shares_date, shares_outstanding; ``cash_flow`` and ``balance`` as in ``buybacks_ttm``.
    """
    dated = keys.select("ticker", F.col("deletion_date").alias("as_of")).distinct()
    sides = {
        "insider": Side(own.insider_totals(insiders), "day", ("s", "n")),
        "count": Side(outstanding, "shares_date", ("shares_outstanding",)),
        "cash": Side(own.buyback_totals(cash_flow), "filing_date", ("q",)),
        "sheet": Side(own.balance_days(balance), "bs_filed", ("b",)),
    }
    carried = stage(asof_join_many(dated, "ticker", "as_of", sides), "carried")
    held = own.institutional_holders(institutions, dated)
    rows = carried.withColumns({
        "insider_shares": F.when(F.col("insider.n") > 0, from_fixed("insider.s")),
        "insider_owner_count": F.coalesce("insider.n", F.lit(0)),
        "shares_outstanding": F.col("count.shares_outstanding")}).join(held, ["ticker", "as_of"], "left")
    bought = own.buyback_columns(carried, ["ticker", "as_of"]).withColumnRenamed("as_of", "deletion_date")
    return own.ownership_rates(rows), bought


def lifo_at_crossing(crossings: DataFrame, facts: DataFrame) -> DataFrame:
    """Inventory-reserve adjustment of each ticker by its newest classified filing.

    ``facts``: ticker, accession_no, filing_date, basis, method, lifo_reserve_disclosed, lifo_reserve_usd. Price, book and
    shares are those of the ticker's last crossing; the classified method and quote pass through.
    """
    last = crossings.groupBy("ticker").agg(F.max(F.struct(
        "deletion_date", "buy_price", "bvps_at_crossing", "shares_at_crossing")).alias("c"))
    newest = latest_per_key(facts, ["ticker"], ["filing_date", "accession_no"]).join(last, "ticker")
    adjusted = lifo_adjustment("basis", "lifo_reserve_disclosed", "lifo_reserve_usd", F.col("c.buy_price"), F.col("c.bvps_at_crossing"),
                               F.col("c.shares_at_crossing"))
    kept = ("basis", "lifo_reserve_usd", "c")
    return newest.withColumn("_a", adjusted).select(*[c for c in newest.columns if c not in kept], "_a.*")


def run_backtest_summary(deletions: DataFrame, additions: DataFrame, prices: DataFrame, book: DataFrame, earnings: DataFrame, as_of,
                         insiders: DataFrame, institutions: DataFrame, outstanding: DataFrame, cash_flow: DataFrame, balance: DataFrame,
                         lifo_facts: DataFrame, descriptions: DataFrame, known_holdings: DataFrame,
                         done: DataFrame | None = None) -> DataFrame:
    """From index deletions to the enriched summary in one plan.

    Every crossing attempt keeps its row, whatever its status, with its outcome and with ownership, buybacks and
    parent rollup as of its deletion; inventory and text facts are the ticker's newest.
    """
    crossings, outcomes = run_backtest(deletions, additions, prices, book, earnings, as_of, done)
    rows = stage(crossings, "all-crossings")
    owned, bought = enrich_as_of(rows, insiders, institutions, outstanding, cash_flow, balance)
    _, rollups = holdings.holdings_universe(holdings.backtest_parents(rows), known_holdings)
    return backtest_summary(rows, outcomes, lifo_at_crossing(rows, lifo_facts), descriptions, owned, bought, rollups)
