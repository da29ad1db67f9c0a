"""Insider and institutional ownership and trailing buybacks as of a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.functions.dates import filed_quarter_end
from posledger.functions.numbers import from_fixed, money_sum, pct_capped, pct_complement, to_fixed
from posledger.operators.asof import Side, asof_join, asof_join_many, dealt, lookup_value
from posledger.schemas import OWNERSHIP_SCHEMA, conform

# Words that rule out common equity, and plain names that mean it.
NOT_COMMON = ("preferred", " pref", "warrant", "option", "right", "unit", "debt")
COMMON_NAMES = ("com", "common stock", "ordinary shares")
INSIDER_LOOKBACK_YEARS = 3


def is_common_equity(title) -> Column:
    t = F.lower(F.coalesce(F.col(title) if isinstance(title, str) else title, F.lit("")))
    barred = F.lit(False)
    for word in NOT_COMMON:
        barred = barred | t.contains(word)
    return ~barred & (t.contains("common") | F.trim(t).isin(*COMMON_NAMES))


def is_officer_or_director(officer, director) -> Column:
    return F.coalesce(officer, F.lit(False)) | F.coalesce(director, F.lit(False))


def is_share_position(title, put_call, amount_type) -> Column:
    """Plain share holdings: no options, no principal amounts."""
    text = F.upper(F.coalesce(title, F.lit("")))
    return (
        (F.coalesce(put_call, F.lit("")) == "") & ~text.contains("PUT") & ~text.contains("CALL")
        & (F.upper(F.coalesce(F.nullif(amount_type, F.lit("")), F.lit("SH"))) == "SH")
    )


def _running(moves: DataFrame, by: list[str], day: str) -> DataFrame:
    """Running totals of dated changes: one row per group and day, so the window is bounded."""
    daily = moves.groupBy(*by, day).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    w = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(*by, day, F.sum("s").over(w).alias("s"), F.sum("n").over(w).alias("n"))


def institutional_holders(filings: DataFrame, keys: DataFrame, lag_days: int = 45) -> DataFrame:
    """Shares and number of reporting managers for the last due quarter of every key.

    ``filings``: ticker, manager, period_end, filing_date, shares (share positions only).
    ``keys``: ticker, as_of. Reports filed after ``as_of`` are unknown; of several reports of one
    manager the latest counts. If a quarter has no holder the quarter before is used, once.
    """
    quarter = filed_quarter_end("as_of", lag_days)
    before = filed_quarter_end(F.date_sub("_q0", 1), lag_days)
    tries = keys.withColumn("_q0", quarter).withColumn("_q1", before).select(
        *keys.columns, F.posexplode(F.array("_q0", "_q1")).alias("_try", "period_end"))
    per_filing = filings.groupBy("ticker", "period_end", "manager", "filing_date").agg(
        F.sum(to_fixed("shares")).alias("s"))
    w = Window.partitionBy("ticker", "period_end", "manager").orderBy("filing_date")
    # A report replaces the manager's previous one, so running totals move by the difference.
    moves = per_filing.select(
        "ticker", "period_end", "filing_date", (F.col("s") - F.coalesce(F.lag("s").over(w), F.lit(0))).alias("s"),
        F.when(F.lag("s").over(w).isNull(), 1).otherwise(0).alias("n"))
    totals = _running(moves, ["ticker", "period_end"], "filing_date")
    found = asof_join(tries, totals, ["ticker", "period_end"], "as_of", "filing_date").where(F.col("n") > 0)
    chosen = found.groupBy("ticker", "as_of").agg(
        F.min(F.struct("_try", "period_end", from_fixed("s").alias("s"), "n")).alias("c"))
    return keys.join(chosen, ["ticker", "as_of"], "left").select(
        *keys.columns,
        F.col("c.s").alias("institutional_shares"),
        F.coalesce("c.n", F.lit(0)).alias("institutional_holder_count"),
        # With no holder at all, the second quarter tried is reported.
        F.coalesce("c.period_end", filed_quarter_end(F.date_sub(quarter, 1), lag_days)).alias(
            "institutional_period"))


def insider_filing_shares(holdings: DataFrame) -> DataFrame:
    """Common shares after each ownership report.

    ``holdings``: filing key columns plus title, shares, kind (0 = holding, 1 = transaction), day
    and pos. Per title the last transaction wins over holdings; titles are summed.
    """
    keys = [c for c in holdings.columns if c not in ("title", "shares", "kind", "day", "pos")]
    last = holdings.where(is_common_equity("title") & F.col("shares").isNotNull()).groupBy(*keys, "title").agg(
        F.max_by("shares", F.struct("kind", "day", "pos")).alias("shares"))
    return last.groupBy(*keys).agg(money_sum("shares").alias("shares"))


def insider_totals(filings: DataFrame, lookback_years: int = INSIDER_LOOKBACK_YEARS) -> DataFrame:
    """(ticker, day, s, n): insider shares, fixed-point, and owners from each day on.

    ``filings``: ticker, owner, filing_date, shares. An owner's latest report counts until it is too old.
    """
    daily = filings.groupBy("ticker", "owner", "filing_date").agg(F.max("shares").alias("shares"))
    w = Window.partitionBy("ticker", "owner").orderBy("filing_date")
    # A report counts until the owner's next one, or until it is older than the look-back.
    until = F.least(F.lead("filing_date").over(w), F.date_add("filing_date", 365 * lookback_years + 1))
    held = daily.withColumn("until", until).where(F.col("shares") > 0)
    moves = held.select("ticker", F.inline(F.array(
        F.struct(F.col("filing_date").alias("day"), to_fixed("shares").alias("s"), F.lit(1).alias("n")),
        F.struct(F.col("until").alias("day"), (-to_fixed("shares")).alias("s"), F.lit(-1).alias("n")))))
    return _running(moves, ["ticker"], "day")


def insider_shares(filings: DataFrame, keys: DataFrame,
                   lookback_years: int = INSIDER_LOOKBACK_YEARS) -> DataFrame:
    """Insider total per key: latest report per owner by ``as_of``, dropped when too old.

    ``filings``: ticker, owner, filing_date, shares. ``keys``: ticker, as_of.
    """
    total = asof_join(keys, insider_totals(filings, lookback_years), "ticker", "as_of", "day").select(
        "ticker", "as_of", F.when(F.col("n") > 0, from_fixed("s")).alias("insider_shares"), "n")
    return keys.join(total, ["ticker", "as_of"], "left").select(
        *keys.columns, "insider_shares", F.coalesce("n", F.lit(0)).alias("insider_owner_count"))


def ownership_as_of(keys: DataFrame, insiders: DataFrame, institutions: DataFrame,
                    shares_outstanding: DataFrame, explicit_zero: bool = False,
                    fallback: str = "none") -> DataFrame:
    """Ownership percentages per key, capped at 100; keys without data keep typed NULLs and a note.

    ``explicit_zero`` reports known-empty institutions as 0 % / 100 %; ``fallback="forward"``
    uses the first share count after the date when none is known before.
    """
    base = keys.join(insiders.select("ticker", "as_of", "insider_shares", "insider_owner_count"),
                     ["ticker", "as_of"], "left").join(
        institutions.select("ticker", "as_of", "institutional_shares", "institutional_holder_count",
                            "institutional_period"), ["ticker", "as_of"], "left")
    rows = lookup_value(base, shares_outstanding, "ticker", "as_of", "shares_date", "shares_outstanding", fallback)
    return ownership_rates(rows, explicit_zero)


def ownership_rates(rows: DataFrame, explicit_zero: bool = False) -> DataFrame:
    """Percentages and notes of rows that carry insider and institutional totals and the share count."""
    out = F.when(F.col("shares_outstanding") > 0, F.col("shares_outstanding"))
    inst = F.col("institutional_shares")
    if explicit_zero:
        inst = F.coalesce(inst, F.when(F.col("institutional_holder_count") == 0, F.lit(0.0)))
    insider_pct = F.when(F.col("insider_owner_count") > 0, pct_capped(F.lit(100.0) * F.col("insider_shares") / out))
    inst_pct = pct_capped(F.lit(100.0) * inst / out)
    note = F.concat_ws(
        "; ",
        F.when(F.col("insider_owner_count") == 0, F.lit("no active officer/director common positions within lookback")),
        F.when(out.isNull(), F.lit("no shares outstanding as-of")),
        F.when(F.coalesce("institutional_holder_count", F.lit(0)) == 0, F.concat(
            F.lit("no 13F holders period "), F.coalesce(F.col("institutional_period").cast("string"), F.lit("?")))))
    return conform(rows.withColumns({
        "deletion_date": F.col("as_of"), "as_of_date": F.col("as_of"),
        "percent_insiders": insider_pct, "percent_institutions": inst_pct,
        "percent_non_institutions": pct_complement(inst_pct),
        "source": F.lit("sec_api_form4_and_13f"), "note": F.nullif(note, F.lit("")),
    }), OWNERSHIP_SCHEMA)


def buyback_totals(cash_flow: DataFrame, quarters: int = 4) -> DataFrame:
    """(ticker, filing_date, q): what the last ``quarters`` periods known at each filing day add up to.

    ``cash_flow``: ticker, period_end, filing_date, sale_purchase, issuance. A period may be filed again: a day sees
    each period as last filed by then. The sums are made once per filing day of a ticker, from its versions of
    reporting periods (one row each, so the calendar bounds them).
    """
    spent = F.col("sale_purchase")
    versions = cash_flow.where(F.col("filing_date").isNotNull()).groupBy("ticker", "period_end", "filing_date").agg(
        F.max(F.struct("sale_purchase", "issuance")).alias("r")).select("ticker", "period_end", "filing_date", "r.*")
    entry = F.struct(
        "period_end", "filing_date", to_fixed(spent).alias("sale"),
        to_fixed(F.when(spent < 0, -spent).when(spent.isNotNull(), F.lit(0.0))).alias("gross"),
        to_fixed("issuance").alias("issue"))
    # Sorted rows see their ticker's list one ticker at a time; lists of all tickers are never held or spread together.
    whole = Window.partitionBy("ticker").orderBy("period_end", "filing_date").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    listed = dealt(versions.select("ticker", "period_end", "filing_date", entry.alias("_v")), "ticker").withColumn(
        "_all", F.collect_list("_v").over(whole))
    # Of the versions filed on a day the one of the latest period stands for the day.
    filed = F.filter("_all", lambda v: v["filing_date"] == F.col("filing_date"))
    days = listed.where(F.element_at(filed, -1)["period_end"].eqNullSafe(F.col("period_end")))
    known = days.withColumn("_known", F.filter("_all", lambda v: v["filing_date"] <= F.col("filing_date")))
    newest = known.withColumn("_known", F.filter("_known", lambda v, i: ~F.get("_known", i + 1)["period_end"].eqNullSafe(
        v["period_end"])))
    last = newest.withColumn("_known", F.slice(
        "_known", F.greatest(F.lit(1), F.size("_known") - (quarters - 1)), F.lit(quarters)))

    def total(name):
        some = F.filter(F.transform("_known", lambda v: v[name]), lambda x: x.isNotNull())
        return F.when(F.size(some) > 0, F.aggregate(some, F.lit(0).cast("decimal(38,0)"), lambda acc, x: (
            acc + x).cast("decimal(38,0)")))

    return last.select("ticker", "filing_date", F.struct(
        F.element_at("_known", -1)["period_end"].alias("period_end"), total("sale").alias("_sale"),
        total("gross").alias("_gross"), total("issue").alias("_issue"),
        F.size("_known").cast("long").alias("quarters_used")).alias("q"))


def balance_days(balance: DataFrame) -> DataFrame:
    """(ticker, bs_filed, b): the newest balance sheet of each filing day."""
    return balance.where(F.col("filing_date").isNotNull()).groupBy(
        "ticker", F.col("filing_date").alias("bs_filed")).agg(
        F.max(F.struct("period_end", "treasury_stock")).alias("b"))


def buybacks_ttm(cash_flow: DataFrame, balance: DataFrame, keys: DataFrame, quarters: int = 4) -> DataFrame:
    """Trailing net and gross buybacks over the last ``quarters`` filed rows known at ``as_of``.

    ``cash_flow`` as in ``buyback_totals``; ``balance``: ticker, period_end, filing_date, treasury_stock; ``keys``:
    ticker, as_of. A key looks up the last filing day by its date, of both in one pass.
    """
    hit = asof_join_many(keys, "ticker", "as_of", {
        "cash": Side(buyback_totals(cash_flow, quarters), "filing_date", ("q",)),
        "sheet": Side(balance_days(balance), "bs_filed", ("b",))})
    return buyback_columns(hit, keys.columns)


def buyback_columns(hit: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Buyback columns of rows that carry ``cash`` and ``sheet`` as of their date."""
    hit = hit.select(*keep, F.col("cash.filing_date").alias("filing_date"), F.col("cash.q").alias("q"),
                     F.col("sheet.bs_filed").alias("bs_filed"), F.col("sheet.b").alias("b"))
    sale = from_fixed("q._sale")
    has_cf = F.col("filing_date").isNotNull()
    note = F.concat_ws("; ", F.when(has_cf, F.concat(
        F.lit("TTM salePurchaseOfStock over "), F.col("q.quarters_used").cast("string"),
        F.lit(" quarters (filed ≤ "), F.col("as_of").cast("string"),
        F.lit("); negative sale_purchase = net buyback; gross_repurchase = sum of repurchase-only quarters"))
        ).otherwise(F.lit("no cash-flow quarters filed on/before as_of")),
        F.when(F.col("bs_filed").isNotNull(), F.concat(
            F.lit("treasuryStock filed "), F.col("bs_filed").cast("string"))))
    return hit.select(
        *keep,
        F.when(has_cf, F.col("q.period_end")).otherwise(F.col("b.period_end")).alias("period_end"),
        F.coalesce("filing_date", "bs_filed").alias("filing_date"),
        sale.alias("sale_purchase_of_stock_ttm"),
        F.when(sale.isNotNull(), F.greatest(F.lit(0.0), -sale)).alias("net_buyback_usd_ttm"),
        from_fixed("q._gross").alias("gross_repurchase_usd_ttm"),
        from_fixed("q._issue").alias("issuance_of_capital_stock_ttm"),
        F.col("b.treasury_stock").alias("treasury_stock"),
        F.coalesce("q.quarters_used", F.lit(0)).alias("quarters_used"),
        note.alias("note"))
