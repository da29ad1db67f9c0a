"""Coalescing merges: the first source wins, later sources fill what is missing.

Every merge is one grouped aggregation with a map-side combine (``min_by`` over non-null values),
so a hot key is combined before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.functions.text import append_tag, has_tag, holding_key, normalize_ticker, note_text
from posledger.sources import fixed_values as fixed


def first_by(value: str, order: Column, where: Column | None = None) -> Column:
    """First non-null value of a column in the given order."""
    ok = F.col(value).isNotNull()
    if where is not None:
        ok = ok & where
    return F.min_by(F.col(value), F.when(ok, order))


def union_sources(groups: Sequence[DataFrame]) -> DataFrame:
    """Stack sources in priority order (0 = first) under ``_prio``."""
    tagged = [g.withColumn("_prio", F.lit(i)) for i, g in enumerate(groups)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def is_disclosed_value(source, note) -> Column:
    text = F.lower(F.concat_ws(" ", F.col(source), F.col(note)))
    return reduce(lambda a, b: a | b, [text.contains(m) for m in fixed.DISCLOSED_VALUE_MARKERS])


def allows_disclosed_value(source, note) -> Column:
    """Only investment tables and annual aggregates may put their fair value into the ledger."""
    text = F.lower(F.concat_ws(" ", F.coalesce(source, F.lit("")), F.coalesce(note, F.lit(""))))
    table = text.contains("investments_table") | text.contains("hk_annual")
    return table


def merge_sources(groups: Sequence[DataFrame], by: Sequence[str] = ("parent_ticker", "period_end"),
                  order_by: Sequence[str] = ()) -> DataFrame:
    """Merge period rows of several sources (highest priority first) per identity.

    The note of the first source stays; the note of the row that filled the ownership percentage
    is appended, and a disclosed value filled from a later source brings its provenance along.
    """
    rows = union_sources(groups)
    key = holding_key("investee_ticker", "cusip", "investee_name")
    skip = {*by, "_prio", "source", "note"}
    values = [c for c in rows.columns if c not in skip and c not in order_by]
    # Ties inside one source are settled by the row's own values.
    order = F.struct("_prio", *order_by, F.struct(*values, "source", "note"))
    row = F.struct("_prio", "source", "note", "as_of_accession_no", *order_by)
    merged = rows.where(key.isNotNull()).groupBy(*by, key.alias("_key")).agg(
        *[first_by(c, order).alias(c) for c in values],
        F.min_by(row, order).alias("_base"),
        F.min_by(row, F.when(F.col("ownership_pct").isNotNull(), order)).alias("_pct"),
        F.min_by(row, F.when(F.col("market_value_usd").isNotNull(), order)).alias("_val"),
    )
    base_note = F.col("_base.note")
    pct_note = F.col("_pct.note")
    with_pct = F.when(
        (F.col("_pct._prio") > F.col("_base._prio")) & (note_text(pct_note) != ""),
        append_tag(base_note, pct_note)).otherwise(base_note)
    value_text = F.lower(note_text("_val.note"))
    noted = reduce(lambda a, b: a | b, [value_text.contains(m) for m in fixed.DISCLOSED_VALUE_MARKERS])
    src = F.lower(F.coalesce(F.col("_val.source"), F.lit("")))
    sourced = reduce(lambda a, b: a | b, [src.contains(m) for m in fixed.DISCLOSED_VALUE_MARKERS])
    later = (F.col("_val._prio") > F.col("_base._prio")) & (noted | sourced)
    stamp = F.when(noted, F.col("_val.note")).otherwise(
        F.concat(F.lit("value_source="), F.coalesce(F.col("_val.source"), F.lit("disclosed_fv"))))
    fresh = ~has_tag(with_pct, "investments_table", "_note", "value_source=")
    stamped = F.when(
        later & (fresh | stamp.contains("investments_table")), append_tag(with_pct, stamp)
    ).otherwise(with_pct)
    source = F.when(
        later & F.col("_val.source").isNotNull() & F.col("_base.source").isNotNull()
        & (F.col("_val.source") != F.col("_base.source")),
        F.concat_ws("+", "_base.source", "_val.source"),
    ).otherwise(F.coalesce("_base.source", "_val.source"))
    accession = F.when(later, F.coalesce("_val.as_of_accession_no", "as_of_accession_no")).otherwise(
        F.col("as_of_accession_no"))
    return merged.withColumns({
        "note": stamped, "source": source, "as_of_accession_no": accession,
    }).select(*by, *values, "source", "note")


# Market fields a quarterly report overrides, and source ranks for quotes.
MARKET_FIELDS = (
    "shares_held", "market_value_usd", "market_price", "fair_value_disclosed_usd",
    "investee_ticker", "price_source", "price_as_of", "cusip",
)
SOURCE_RANKS = {
    "13f": 3, "sec_api_13f": 3, "20f_note": 2, "10k_note": 2, "10q_note": 2,
    "20f_investments_table": 2, "10k_investments_table": 2, "10q_investments_table": 2,
    "investments_table": 2, "filing_note": 1, "13g": 2, "hk_annual": 1,
}


def _outermost(rows: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Of the rows of an identity that lack the same values the first and the last, numbered in order (``_nr``).

    What a merge takes is the first or last row among those that have a value, so no other row is ever taken. They are
    combined before the shuffle and few whatever a key's size; numbers then stand for the order, so an aggregate of
    them does not hold a whole row beside each value. ``by`` begins with a hash of the identity, which sorts by a number.
    """
    lacks = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in [*values, "_disclosed"]])
    body = F.struct("_prio", F.struct(*values, "source", "note").alias("r"), "_disclosed")
    quote = F.struct("source_quote", F.struct("_rank", "_prio").alias("by"))
    ends = rows.groupBy(*by, "_q", lacks.alias("_lacks")).agg(
        F.min(body).alias("_low"), F.max(body).alias("_high"),
        F.max_by(quote, F.when(F.col("source_quote").isNotNull(), quote["by"])).alias("_quote"))
    both = ends.withColumn("_row", F.explode(
        F.when(F.col("_low") == F.col("_high"), F.array("_low")).otherwise(F.array("_low", "_high"))))
    nr = F.row_number().over(Window.partitionBy(*by).orderBy("_row"))
    return both.select(*by, "_q", "_quote", nr.alias("_nr"), "_row._prio", "_row.r.*", "_row._disclosed")


def merge_live(groups: Sequence[DataFrame], by: Sequence[str] = ("parent_ticker",)) -> DataFrame:
    """Merge current rows; quarterly-report rows override market fields wherever they come.

    A missing market value is only filled from sources that may disclose one, and the quote comes
    from the highest ranked source.
    """
    rows = union_sources(groups)
    for column in ("market_price", "price_source", "price_as_of", "source_quote",
                   "carrying_usd", "fair_value_disclosed_usd", "note", "source"):
        if column not in rows.columns:
            rows = rows.withColumn(column, F.lit(None).cast(
                "double" if column.endswith(("usd", "price")) else "string"))
    key = holding_key("investee_ticker", "cusip", "investee_name")
    quarterly = F.lower(F.coalesce("source", F.lit(""))).rlike("^(13f|sec_api_13f)")
    allowed = allows_disclosed_value(F.col("source"), F.col("note"))
    disclosed = F.coalesce(
        F.when(quarterly, F.col("market_value_usd")),
        F.when(allowed, F.coalesce("market_value_usd", "fair_value_disclosed_usd", "carrying_usd")))
    rank = F.lit(0)
    for name, value in SOURCE_RANKS.items():
        rank = F.when(F.col("source") == name, value).otherwise(rank)
    rows = rows.where(key.isNotNull()).withColumns({"_key": key, "_q": quarterly, "_disclosed": disclosed, "_rank": rank})
    identity = ["_hash", *by, "_key"]
    rows = rows.withColumn("_hash", F.xxhash64(*identity[1:]))
    values = [c for c in rows.columns
              if c not in {*identity, "_prio", "_q", "_disclosed", "_rank", "note", "source", "source_quote"}]
    rows = _outermost(rows, identity, values)
    aggs = []
    for c in values:
        if c == "market_value_usd":
            aggs.append(F.coalesce(
                F.max_by(c, F.when(F.col(c).isNotNull() & F.col("_q"), F.col("_nr"))),
                F.min_by("_disclosed", F.when(F.col("_disclosed").isNotNull(), F.col("_nr"))),
            ).alias(c))
        elif c in MARKET_FIELDS:
            aggs.append(F.coalesce(
                F.max_by(c, F.when(F.col(c).isNotNull() & F.col("_q"), F.col("_nr"))),
                first_by(c, F.col("_nr"))).alias(c))
        else:
            aggs.append(first_by(c, F.col("_nr")).alias(c))
    row = F.struct("_prio", "source", "note")
    merged = rows.groupBy(*identity).agg(
        *aggs,
        F.min_by(row, "_nr").alias("_base"),
        F.min_by(row, F.when(F.col("_disclosed").isNotNull(), F.col("_nr"))).alias("_val"),
        F.max(F.when(F.col("_q"), F.col("_prio"))).alias("_qprio"),
        F.max_by("source", F.when(F.col("_q"), F.col("_nr"))).alias("_qsource"),
        F.max_by("_quote.source_quote", "_quote.by").alias("source_quote"),
    )
    late_q = F.col("_qprio") > F.col("_base._prio")
    late_v = (F.col("_val._prio") > F.col("_base._prio")) & F.col("_qprio").isNull()
    stamp = F.coalesce(F.col("_val.note"), F.concat(F.lit("value_source="), F.col("_val.source")))
    fresh = ~has_tag("_base.note", "investments_table", "value_source=")
    note = (
        F.when(late_q, append_tag("_base.note", "merged 13f"))
        .when(late_v & fresh, append_tag("_base.note", stamp))
        .otherwise(F.col("_base.note"))
    )
    source = (
        F.when(late_q, F.concat_ws("+", "_qsource", "_base.source"))
        .when(late_v & (F.col("_val.source") != F.col("_base.source")),
              F.concat_ws("+", "_base.source", "_val.source"))
        .otherwise(F.col("_base.source"))
    )
    return merged.withColumns({"note": note, "source": source}).select(
        *by, *values, "source", "source_quote", "note")


def _rows_of_period(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    t = normalize_ticker("investee_ticker")
    ok = t.isNotNull() & F.col("period_end").isNotNull()
    return history.where(ok).withColumn("_t", t), history.where(~ok)


def coalesce_survivors(history: DataFrame) -> DataFrame:
    """One row per period and ticker: continuing rows first, then shares, then value.

    Siblings fill the security id and the ownership percentage, and the value unless the surviving
    row is an exit. Rows without ticker pass through.
    """
    keyed, rest = _rows_of_period(history)
    going = F.when(F.col("action") == "exit", 0).otherwise(1)
    shares = F.when(F.coalesce("shares_held", F.lit(0.0)) != 0, 1).otherwise(0)
    money = F.when(F.col("market_value_usd").isNotNull(), 1).otherwise(0)
    body = F.struct(*history.columns)
    rank = F.struct(going, shares, money, "filing_date", "accession_no", "note")
    order = F.struct("filing_date", "accession_no", "action", "note")
    one = keyed.groupBy("parent_ticker", "period_end", "_t").agg(
        F.max_by(body, rank).alias("b"),
        first_by("cusip", order).alias("f_cusip"),
        first_by("ownership_pct", order).alias("f_pct"),
        first_by("market_value_usd", order).alias("f_value"),
    )
    fill = {
        "cusip": F.coalesce("b.cusip", "f_cusip"),
        "ownership_pct": F.coalesce("b.ownership_pct", "f_pct"),
        "market_value_usd": F.when(F.col("b.action") == "exit", F.col("b.market_value_usd"))
        .otherwise(F.coalesce("b.market_value_usd", "f_value")),
    }
    out = one.select(*[fill.get(c, F.col(f"b.{c}")).alias(c) for c in history.columns])
    return out.unionByName(rest)


def coalesce_for_export(history: DataFrame) -> DataFrame:
    """One row per period and ticker for export: largest value first, then quarterly-report rows,
    continuing rows and longer notes; every missing column is filled in that order and the
    distinct notes are joined."""
    keyed, rest = _rows_of_period(history)
    note = note_text("note")
    rank = F.struct(
        -F.coalesce("market_value_usd", F.lit(-1.0)),
        F.when(F.lower(note).contains("13f"), 0).otherwise(1),
        F.when(F.col("action") == "exit", 1).otherwise(0),
        -F.length(note),
        "filing_date", "accession_no", note,
    )
    ranked = keyed.withColumn("_rank", rank)
    value_columns = [c for c in history.columns if c not in ("parent_ticker", "period_end", "note")]

    def present(c: str) -> Column:
        ok = F.col(c).isNotNull()
        return ok & (F.col(c) != "") if keyed.schema[c].dataType.typeName() == "string" else ok

    one = ranked.groupBy("parent_ticker", "period_end", "_t").agg(
        *[F.min_by(c, F.when(present(c), F.col("_rank"))).alias(c) for c in value_columns],
        F.array_sort(F.collect_set(F.struct("_rank", "note"))).alias("_notes"),
    )
    joined = F.aggregate(
        F.transform("_notes", lambda x: F.coalesce(x["note"], F.lit(""))), F.lit(""),
        lambda acc, n: F.when((n == "") | acc.contains(n), acc)
        .when(acc == "", n).otherwise(F.concat(acc, F.lit("; "), n)))
    out = one.withColumn("note", F.nullif(joined, F.lit(""))).select(*history.columns)
    return out.unionByName(rest)


def reconcile(a: DataFrame, b: DataFrame, by: Sequence[str] = ("ticker",), value_a: str = "value_a",
              value_b: str = "value_b", tol_pct: float = 0.05, tol_abs: float = 50_000_000.0) -> DataFrame:
    """Names on both sides whose values differ by more than both tolerances."""
    both = a.join(b, list(by)).where(F.col(value_a).isNotNull() & F.col(value_b).isNotNull())
    diff = F.abs(F.col(value_a) - F.col(value_b))
    base = F.greatest(F.abs(value_a), F.abs(value_b), F.lit(1.0))
    return both.withColumn("abs_diff", diff).where((diff > tol_abs) & (diff / base > tol_pct))
