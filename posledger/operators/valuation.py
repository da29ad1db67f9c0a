"""Parent rollups, broker overlays, aggregate composition and filing-date marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.functions.numbers import money_sum, to_number
from posledger.functions.text import (
    append_tag, append_tags, clean_null, extract_tag, has_tag, infer_value_source,
    normalize_ticker, note_text,
)
from posledger.operators.asof import asof_join, last_close
from posledger.operators.performance import is_residual
from posledger.schemas import HISTORY_SCHEMA
from posledger.sources import fixed_values as fixed

_COMPOSITION = ["composition_parent", "composition_as_of", "child_value_source",
                "parent_aggregate_market_value_usd"]


def rollup_parent(holdings: DataFrame, parents: DataFrame | None = None,
                  by: tuple[str, ...] = ("parent_ticker",)) -> DataFrame:
    """Parent-level totals; ``parents`` (the keys ``by``, price, bvps, shares) adds the per-share view.

    Look-through amounts are summed over rows that are not in the book adjustment.
    """
    included = F.coalesce("include_in_book_adj", F.lit(False))
    zero = F.lit(0.0)
    rolled = holdings.groupBy(*by).agg(
        F.count(F.lit(1)).alias("holdings_count"),
        F.coalesce(money_sum(F.when(included, F.col("suggested_adj_usd"))), zero).alias("holdings_book_adj_usd"),
        F.coalesce(money_sum(F.when(~included, F.col("lookthrough_mtm_usd"))), zero).alias("holdings_lookthrough_mtm_usd"),
        F.count_if(F.coalesce(F.col("market_vs_carrying") == "above", F.lit(False))).alias("holdings_above_count"),
        F.count_if(F.coalesce(F.col("market_vs_carrying") == "below", F.lit(False))).alias("holdings_below_count"),
        F.count_if(F.coalesce("impacts_parent_ni", F.lit(False))).alias("holdings_ni_impact_count"),
    )
    if parents is None:
        return rolled.withColumns({"bvps_holdings_adj": F.lit(None).cast("double"),
                                   "pb_holdings_adj": F.lit(None).cast("double")})
    base = parents.join(rolled, list(by), "left")
    counts = ["holdings_count", "holdings_above_count", "holdings_below_count", "holdings_ni_impact_count"]
    base = base.na.fill(0, counts).na.fill(0.0, ["holdings_book_adj_usd", "holdings_lookthrough_mtm_usd"])
    adj = F.col("holdings_book_adj_usd")
    bvps = F.when(F.col("shares") > 0, F.col("bvps") + adj / F.col("shares")).when(adj == 0, F.col("bvps"))
    return base.withColumn("bvps_holdings_adj", bvps).withColumn(
        "pb_holdings_adj", F.when(F.col("bvps_holdings_adj") > 0, F.col("price") / F.col("bvps_holdings_adj"))
    ).select(*rolled.columns, "bvps_holdings_adj", "pb_holdings_adj")


# -- broker overlay ------------------------------------------------------------------------------

def add_usd(broker: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Value to parent in dollars: millions of local currency over the rate of its date.

    ``rates`` is (day, rate) local per dollar; a missing or useless rate falls back on the fixed one.
    """
    if rates is None:
        priced = broker.withColumn("rate", F.lit(None).cast("double"))
    else:
        # Rates are looked up once per distinct date, so stakes of one vintage do not meet on a key.
        days = broker.where(F.col("as_of").isNotNull()).select("as_of", F.lit(1).alias("_one")).distinct()
        known = asof_join(days, rates.withColumn("_one", F.lit(1)), "_one", "as_of", "day", columns=["rate"]).select("as_of", "rate")
        priced = broker.join(known, "as_of", "left").select(*broker.columns, "rate")
    fx = F.when(F.col("rate") > 0, F.col("rate")).otherwise(F.lit(fixed.HKD_PER_USD_FALLBACK))
    return priced.withColumns({
        "fx": fx, "value_usd": F.col("value_to_parent_hkd_mn") * 1e6 / fx}).drop("rate")


def overlay_values(rows: DataFrame, broker: DataFrame, mode: str = "history") -> DataFrame:
    """Full-outer overlay of published stakes on ledger (or live) rows.

    Ownership is filled when missing; the value is filled when missing and stamped with its source.
    Names the ledger does not have are added. If the parent has any listed aggregate, at any time,
    overlay values are stamped as excluded from the portfolio. Live mode uses the newest vintage
    per parent and matches by ticker alone.
    """
    period = "period_end" if mode == "history" else "as_of_date"
    usable = broker.where(normalize_ticker("investee_ticker").isNotNull() & F.col("as_of").isNotNull())
    if mode == "live":
        newest = usable.groupBy("parent_ticker").agg(F.max("as_of").alias("as_of"))
        usable = usable.join(newest, ["parent_ticker", "as_of"], "left_semi")
    match = ["parent_ticker", "_t", "_pe"] if mode == "history" else ["parent_ticker", "_t"]
    fields = ["investee_name", "ownership_pct", "value_usd", "fx", "report_id", "citation", "source_url"]
    stakes = usable.select(
        "parent_ticker", normalize_ticker("investee_ticker").alias("_t"), F.col("as_of").alias("_pe"), *fields,
    ).groupBy(*match).agg(F.min(F.struct("report_id", *[f for f in fields if f != "report_id"],
                                         *(["_pe"] if mode == "live" else []))).alias("b"))
    aggregated = rows.where(normalize_ticker("investee_ticker").isin(*fixed.LISTED_AGGREGATE_TICKERS)).select(
        "parent_ticker").distinct().withColumn("_agg", F.lit(True))

    t = normalize_ticker("investee_ticker")
    keyed = rows.withColumns({"_t": F.when(~t.startswith("PRIV_"), t), "_ours": F.lit(True)})
    if mode == "history":
        keyed = keyed.withColumn("_pe", F.col(period))
    # One full join: a stake without a row of ours becomes a row.
    both = keyed.join(stakes, match, "full").join(aggregated, "parent_ticker", "left")
    ours, day = F.coalesce("_ours", F.lit(False)), F.col("_pe" if mode == "history" else "b._pe")
    both = both.withColumn("_day", F.when(ours, F.col(period) if mode == "history" else day).otherwise(day))
    stamp = _broker_stamp("_day", F.coalesce("_agg", F.lit(False)))
    fills = F.col("b.value_usd").isNotNull() & F.col("market_value_usd").isNull()
    kept = {
        "ownership_pct": F.coalesce("ownership_pct", "b.ownership_pct"),
        "note": F.when(fills, append_tag("note", stamp)).otherwise(F.col("note")),
        "market_value_usd": F.coalesce("market_value_usd", "b.value_usd"),
    }
    added = {
        "parent_ticker": F.col("parent_ticker"), "investee_name": F.col("b.investee_name"), "investee_ticker": F.col("_t"),
        "ownership_pct": F.col("b.ownership_pct"), "market_value_usd": F.col("b.value_usd"), "note": stamp,
    }
    if mode == "history":
        added |= {"period_end": F.col("_day"), "filing_date": F.col("_day"), "action": F.lit("hold"),
                  "first_seen_period": F.col("_day"), "filing_url": F.col("b.source_url")}
    else:
        added |= {"as_of_date": F.col("_day"), "price_source": F.lit("broker_sotp")}
    return both.select(*[
        F.when(ours, kept.get(c, F.col(c))).otherwise(added.get(c, F.lit(None))).cast(rows.schema[c].dataType).alias(c)
        for c in rows.columns])


def _broker_stamp(day: str, exclude: Column) -> Column:
    return F.concat_ws(
        "; ", F.lit("value_source=broker_sotp"),
        F.concat(F.lit("report_id="), F.coalesce("b.report_id", F.lit("None"))),
        F.concat(F.lit("cite="), F.coalesce("b.citation", F.lit("None"))),
        F.concat(F.lit("as_of="), F.col(day).cast("string")),
        F.concat(F.lit("fx_hkd_per_usd="), F.format_string("%.4f", "b.fx")),
        F.lit("not_fv_allocation"), F.when(exclude, F.lit("excluded_from_portfolio_mv")))


# -- composition ---------------------------------------------------------------------------------

def _is_aggregate() -> Column:
    return F.coalesce(normalize_ticker("investee_ticker").isin(*fixed.AGGREGATE_TICKERS), F.lit(False))


def _aggregate_values(history: DataFrame) -> DataFrame:
    """Value of every aggregate bucket per parent and year end."""
    value = F.coalesce(*[F.col(c) for c in ("market_value_usd", "fair_value_disclosed_usd", "carrying_usd")
                         if c in history.columns])
    return history.where(_is_aggregate() & value.isNotNull()).groupBy(
        "parent_ticker", F.col("period_end").alias("year_end"), normalize_ticker("investee_ticker").alias("bucket"),
    ).agg(F.max(value).alias("bucket_value"))


def stamp_composition(history: DataFrame) -> DataFrame:
    """Tie named rows to the annual aggregates they are part of and add residual mirror rows.

    At every aggregate year end the latest continuing row of a name at or before it is stamped with
    its bucket: unlisted names under unlisted, others under listed investees, or the associates
    bucket when only that one was reported. A row latest for several year ends keeps the last
    stamp. Stamping twice gives the same rows.
    """
    rows = history.where(~is_residual("investee_ticker"))
    for c in _COMPOSITION:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(HISTORY_SCHEMA[c].dataType))
    columns = rows.columns
    values = _aggregate_values(rows)
    ends = rows.where(_is_aggregate()).select("parent_ticker", F.col("period_end").alias("year_end")).distinct()
    per_end = ends.join(values, ["parent_ticker", "year_end"], "left").groupBy("parent_ticker", "year_end").agg(
        F.map_from_entries(F.array_compact(F.collect_list(F.when(
            F.col("bucket").isNotNull(), F.struct("bucket", "bucket_value"))))).alias("buckets"))
    # One short array per parent: as many entries as there are annual reports.
    years = per_end.groupBy("parent_ticker").agg(F.collect_list(F.struct("year_end", "buckets")).alias("_years"))
    years = years.select("parent_ticker", F.array_sort("_years", lambda a, b: F.when(
        a["year_end"] < b["year_end"], -1).when(a["year_end"] > b["year_end"], 1).otherwise(0)).alias("_years"))

    t = normalize_ticker("investee_ticker")
    child = t.isNotNull() & ~_is_aggregate() & (F.coalesce("action", F.lit("")) != "exit")
    w = Window.partitionBy("parent_ticker", "_t").orderBy("period_end", "accession_no", "note")
    marked = rows.withColumn("_t", F.when(child, t))
    named = marked.where(F.col("_t").isNotNull()).withColumn("_next", F.lead("period_end").over(w)).join(
        years, "parent_ticker", "left")
    stamps = F.filter("_years", lambda y: (y["year_end"] >= F.col("period_end")) & (
        F.col("_next").isNull() | (y["year_end"] < F.col("_next"))))
    private = F.col("_t").startswith("PRIV_")

    def bucket(y: Column) -> Column:
        preferred = F.when(private, F.lit(fixed.UNLISTED_INVESTEES)).otherwise(F.lit(fixed.LISTED_INVESTEES))
        second = F.when(private, F.lit(fixed.UNLISTED_ASSOCIATES)).otherwise(F.lit(fixed.LISTED_ASSOCIATES))
        return F.when(F.map_contains_key(y["buckets"], preferred), preferred).when(
            F.map_contains_key(y["buckets"], second), second).otherwise(preferred)

    named = named.withColumn("_s", F.transform(F.coalesce(stamps, F.array().cast(
        "array<struct<year_end:date,buckets:map<string,double>>>")), lambda y: F.struct(
        y["year_end"].alias("year_end"), bucket(y).alias("bucket"),
        F.try_element_at(y["buckets"], bucket(y)).alias("value"))))
    last = F.try_element_at("_s", F.lit(-1))
    fragments = F.transform("_s", lambda s: F.concat(
        F.lit("composition_parent="), s["bucket"], F.lit("; composition_as_of="), s["year_end"].cast("string"),
        F.lit("; " + fixed.NOTE_COMPOSITION)))
    noted = F.aggregate(fragments, F.trim(note_text("note")), lambda acc, f: F.when(
        acc.contains(f), acc).when(acc == "", f).otherwise(F.concat(acc, F.lit("; "), f)))
    stamped = F.size("_s") > 0
    named = named.withColumns({
        "note": F.when(stamped, noted).otherwise(F.col("note")),
        "composition_parent": F.when(stamped, last["bucket"]).otherwise(F.col("composition_parent")),
        "composition_as_of": F.when(stamped, last["year_end"]).otherwise(F.col("composition_as_of")),
        "parent_aggregate_market_value_usd": F.when(stamped, last["value"]).otherwise(
            F.col("parent_aggregate_market_value_usd")),
    }).select(*columns)
    out = named.unionByName(marked.where(F.col("_t").isNull()).select(*columns))

    valued = named.where(F.col("market_value_usd").isNotNull() & F.col("composition_parent").isNotNull()).select(
        "parent_ticker").distinct().withColumn("_named", F.lit(True))
    tail = F.when(F.col("_named"), F.lit("; some_named_children_have_broker_or_filing_$")).otherwise(
        F.lit("; named_children_have_null_$"))
    pe, name = F.col("year_end"), F.col("bucket")
    residual = values.join(valued, "parent_ticker", "left").select(
        "parent_ticker", pe.alias("period_end"), pe.alias("filing_date"),
        F.concat(F.lit("Residual of "), name, F.lit(" (aggregate SoT mirror)")).alias("investee_name"),
        F.concat(name, F.lit("_RESIDUAL")).alias("investee_ticker"),
        F.col("bucket_value").alias("market_value_usd"), F.lit("hold").alias("action"),
        pe.alias("first_seen_period"), F.concat(F.lit(fixed.NOTE_RESIDUAL), tail).alias("note"),
        name.alias("composition_parent"), pe.alias("composition_as_of"),
        F.lit("residual_of_aggregate").alias("child_value_source"),
        F.col("bucket_value").alias("parent_aggregate_market_value_usd"))
    return out.unionByName(residual, allowMissingColumns=True).select(*columns)


def finalize_composition(history: DataFrame) -> DataFrame:
    """Read missing composition columns from the note and name the source of every value."""
    residual = is_residual("investee_ticker")
    source = F.when(residual, F.coalesce("child_value_source", F.lit("residual_of_aggregate"))).when(
        F.col("market_value_usd").isNotNull(),
        F.coalesce(infer_value_source("note"), "child_value_source", F.lit("row"))).otherwise(F.col("child_value_source"))
    from_note = extract_tag("note", "composition_parent", "[A-Z0-9_]+")
    day = extract_tag("note", "composition_as_of", r"\d{4}-\d{2}-\d{2}").try_cast("date")
    return history.withColumns({
        "composition_as_of": F.when(~residual & F.col("composition_parent").isNull(), F.coalesce("composition_as_of", day)).otherwise(F.col("composition_as_of")),
        "composition_parent": F.when(residual, F.col("composition_parent")).otherwise(F.coalesce("composition_parent", from_note)),
        "child_value_source": source,
    }).select(*history.columns)


def composition_view(history: DataFrame) -> DataFrame:
    """Named parts of every aggregate with their value: own, else the broker's as of the date, else
    any broker value; residual rows pass through and are added where missing."""
    values = _aggregate_values(history)
    parent = F.coalesce(clean_null("composition_parent"), extract_tag("note", "composition_parent", "[A-Z0-9_]+"))
    as_of = F.coalesce("composition_as_of", extract_tag(
        "note", "composition_as_of", r"\d{4}-\d{2}-\d{2}").try_cast("date"), "period_end")
    t = normalize_ticker("investee_ticker")
    base = history.withColumns({"_parent": parent, "_as_of": as_of, "_t": t, "_res": is_residual("investee_ticker")}
                               ).where(F.col("_parent").isNotNull() & F.col("_as_of").isNotNull())
    broker = history.where(
        has_tag("note", "value_source=broker_sotp") & t.isNotNull() & ~_is_aggregate()
        & ~is_residual("investee_ticker") & F.col("market_value_usd").isNotNull()).groupBy(
        "parent_ticker", t.alias("_t"), F.col("period_end").alias("_bd")).agg(F.max("market_value_usd").alias("_bv"))
    newest = broker.groupBy("parent_ticker", "_t").agg(F.max_by("_bv", "_bd").alias("_any"))
    kids = base.where(~F.col("_res"))
    kids = asof_join(kids, broker, ["parent_ticker", "_t"], "_as_of", "_bd", columns=["_bv"])
    kids = kids.join(newest, ["parent_ticker", "_t"], "left").join(
        values.select("parent_ticker", F.col("year_end").alias("_as_of"), F.col("bucket").alias("_parent"), "bucket_value"),
        ["parent_ticker", "_as_of", "_parent"], "left")
    own = F.col("market_value_usd")
    source = F.coalesce(
        clean_null("child_value_source"),
        F.when(own.isNotNull(), F.coalesce(infer_value_source("note"), F.lit("row"))),
        F.when(F.col("_any").isNotNull(), F.lit("broker_sotp")))
    note = F.concat_ws("; ", F.lit(fixed.NOTE_COMPOSITION), F.concat(F.lit("child_value_source="), source))
    children = kids.select(
        "parent_ticker", F.col("_as_of").alias("period_end"), F.col("_parent").alias("composition_parent"),
        F.col("_t").alias("child_ticker"), F.col("investee_name").alias("child_name"), "ownership_pct", "shares_held",
        F.coalesce(own, "_bv", "_any").alias("child_market_value_usd"), source.alias("child_value_source"),
        F.coalesce("parent_aggregate_market_value_usd", "bucket_value").alias("parent_aggregate_market_value_usd"),
        note.alias("note"))
    mirror = F.coalesce("market_value_usd", "parent_aggregate_market_value_usd")
    nothing = F.lit(None).cast("double")
    residual = base.where("_res").select(
        "parent_ticker", F.col("_as_of").alias("period_end"), F.col("_parent").alias("composition_parent"),
        F.col("_t").alias("child_ticker"), F.col("investee_name").alias("child_name"), nothing.alias("ownership_pct"),
        nothing.alias("shares_held"), mirror.alias("child_market_value_usd"),
        F.coalesce("child_value_source", F.lit("residual_of_aggregate")).alias("child_value_source"),
        F.coalesce("parent_aggregate_market_value_usd", mirror).alias("parent_aggregate_market_value_usd"),
        F.coalesce("note", F.lit("residual_of_aggregate; excluded_from_portfolio_mv")).alias("note"))
    seen = residual.select("parent_ticker", "period_end", "composition_parent")
    missing = values.select(
        "parent_ticker", F.col("year_end").alias("period_end"), F.col("bucket").alias("composition_parent"), "bucket_value",
    ).join(seen, ["parent_ticker", "period_end", "composition_parent"], "left_anti").select(
        "parent_ticker", "period_end", "composition_parent",
        F.concat("composition_parent", F.lit("_RESIDUAL")).alias("child_ticker"),
        F.concat(F.lit("Residual of "), "composition_parent", F.lit(" (aggregate SoT mirror)")).alias("child_name"),
        nothing.alias("ownership_pct"), nothing.alias("shares_held"),
        F.col("bucket_value").alias("child_market_value_usd"), F.lit("residual_of_aggregate").alias("child_value_source"),
        F.col("bucket_value").alias("parent_aggregate_market_value_usd"), F.lit(fixed.NOTE_RESIDUAL).alias("note"))
    return children.unionByName(residual).unionByName(missing)


# -- filing-date marks ---------------------------------------------------------------------------

def is_public_priceable(ticker) -> Column:
    t = F.coalesce(normalize_ticker(ticker), F.lit(""))
    return (t != "") & ~t.isin(*fixed.EXCHANGE_CODES) & ~t.startswith("PRIV_") & ~is_residual(t)


def filing_marks(history: DataFrame, prices: DataFrame) -> DataFrame:
    """Estimated mark and cost basis of share positions without a disclosed value.

    ``prices``: ticker, date, close (and optionally source). The basis is the mark of the last
    opening row, or of the first priced row, and is carried to later rows of the name. The value
    column itself is never written.
    """
    estimates = ["cost_basis_est_usd", "cost_basis_est_price", "cost_basis_est_as_of",
                 "cost_basis_est_source", "mark_at_filing_est_usd"]
    base = history
    for c in estimates:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast(HISTORY_SCHEMA[c].dataType))
    columns = base.columns
    t = normalize_ticker("investee_ticker")
    eligible = is_public_priceable("investee_ticker") & (F.lower(F.coalesce("action", F.lit(""))) != "exit") & (
        to_number("shares_held") > 0)
    keyed = base.withColumns({"_t": F.when(F.coalesce(eligible, F.lit(False)), t),
                              "_day": F.coalesce("period_end", "filing_date")})
    priced = last_close(keyed.where(F.col("_t").isNotNull()), prices.select(
        F.upper("ticker").alias("_t"), "date", "close"), "_t", "_day")
    marked = F.col("market_value_usd").isNull() & F.col("market_price").isNotNull()
    mark = F.col("shares_held") * F.col("market_price")
    w = Window.partitionBy("parent_ticker", "_t").orderBy("period_end", "accession_no", "note").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    own = F.struct(mark.alias("usd"), F.col("market_price").alias("px"), F.col("price_as_of").alias("day"))
    basis = F.coalesce(
        F.last(F.when(marked & (F.col("action") == "new"), own), ignorenulls=True).over(w),
        F.first(F.when(marked, own), ignorenulls=True).over(w))
    opening = marked & ((F.col("action") == "new") | (F.count(F.when(marked, 1)).over(w) == 1))
    rows = priced.withColumns({"_basis": basis, "_marked": marked, "_opening": opening})
    has_basis = F.col("_basis").isNotNull()
    role = F.when(F.col("_marked") & ~F.col("_opening"), F.lit("mark_at_filing")).otherwise(F.lit("cost_basis"))
    fragment = F.concat(F.lit(fixed.NOTE_FILING_MARK + "; estimate_role="), role,
                        F.lit("; cost_basis_est_source=eod"))
    touched = F.col("_marked") | (has_basis & ~has_tag("note", "excluded_from_portfolio_mv"))
    out = rows.withColumns({
        "mark_at_filing_est_usd": F.when(F.col("_marked"), mark).otherwise(F.col("mark_at_filing_est_usd")),
        "cost_basis_est_usd": F.when(has_basis, F.col("_basis.usd")).otherwise(F.col("cost_basis_est_usd")),
        "cost_basis_est_price": F.when(has_basis, F.col("_basis.px")).otherwise(F.col("cost_basis_est_price")),
        "cost_basis_est_as_of": F.when(has_basis, F.col("_basis.day")).otherwise(F.col("cost_basis_est_as_of")),
        "cost_basis_est_source": F.when(has_basis, F.lit("eod")).otherwise(F.col("cost_basis_est_source")),
        "note": append_tags("note", (touched & has_basis, fragment, fragment)),
    }).select(*columns)
    return out.unionByName(keyed.where(F.col("_t").isNull()).select(*columns))

