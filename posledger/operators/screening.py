"""Price-to-book screen, index drop-outs and the deletion backtest, without look-ahead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.operators.asof import asof_join, first_after, positive_as_of


def price_book_screen(df: DataFrame, ratio: str = "pb_ratio") -> DataFrame:
    """Strictly between zero and one; unknown ratios drop out."""
    return df.where((F.col(ratio) > 0) & (F.col(ratio) < 1))


def screening_candidates(df: DataFrame) -> DataFrame:
    """Fan-in of the screen: the candidates are the screened rows."""
    return df.select("*")


def cap_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def cap_with_forced(df: DataFrame, key: str, limit: int, forced: Sequence[str],
                    order: Sequence[str]) -> DataFrame:
    """Rows of at most ``limit`` distinct keys in first-seen order; forced keys always count first.

    Only the best ``limit`` keys of every partition travel, then at most limit + forced are ranked.
    """
    firsts = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_first")).withColumn(
        "_forced", F.col(key).isin(list(forced)) if forced else F.lit(False))
    best = firsts.where(~F.col("_forced")).orderBy("_first", key).limit(limit)
    some = firsts.where("_forced").unionByName(best)
    w = Window.orderBy(F.col("_forced").desc(), "_first", key)
    keep = some.withColumn("_r", F.row_number().over(w)).where(F.col("_forced") | (F.col("_r") <= limit))
    return df.join(keep.select(key), key, "left_semi")


def apply_allowlist(df: DataFrame, allow: DataFrame, key: str = "ticker") -> DataFrame:
    """Exactly the allow-listed keys; those absent from ``df`` appear with NULL measures."""
    listed = allow.select(F.upper(F.trim(key)).alias(key)).distinct()
    mine = df.withColumn(key, F.upper(F.trim(key)))
    return listed.join(mine, key, "left").select(*df.columns)


def recent_filings(df: DataFrame, forms: Sequence[str], as_of, n: int, filer: str = "cik",
                   form: str = "form", filed: str = "filing_date", tie: str = "accession_no") -> DataFrame:
    """Newest ``n`` filings per filer among the given forms, filed by ``as_of``."""
    known = df.where(F.col(form).isin(list(forms)) & (F.col(filed) <= F.lit(as_of).cast("date")))
    w = Window.partitionBy(filer).orderBy(F.col(filed).desc(), F.col(tie).desc())
    return known.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def index_dropouts(snapshots: DataFrame, lookback_days: int, key: str = "ticker",
                   group: str = "index_name", date: str = "snapshot_date") -> DataFrame:
    """Members of the baseline snapshot that are missing from the newest one.

    The baseline is the newest snapshot at least ``lookback_days`` old; without one the result is
    empty.
    """
    dates = snapshots.select(date).distinct()
    today = dates.agg(F.max(date)).scalar()
    baseline = dates.where(F.col(date) <= F.date_sub(today, lookback_days)).agg(F.max(date)).scalar()
    then = snapshots.where(F.col(date) == baseline)
    now = snapshots.where(F.col(date) == today).select(key)
    return then.join(now, key, "left_anti").select(
        key, group, F.col(date).alias("last_seen_date")).distinct()


def pending(keys: DataFrame, done: DataFrame, on: Sequence[str],
            required: Sequence[str] = ()) -> DataFrame:
    """Work list: keys without a finished row. Rows lacking a required value are not finished."""
    finished = done
    for column in required:
        finished = finished.where(F.col(column).isNotNull())
    return keys.join(finished.select(*on), list(on), "left_anti")


def flag_exists(df: DataFrame, other: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Boolean column: does the key occur in the other frame."""
    marks = other.select(*on).distinct().withColumn(name, F.lit(True))
    return df.join(marks, list(on), "left").withColumn(name, F.coalesce(name, F.lit(False))).select(
        *df.columns, name)


def force_reclassify(existing: DataFrame) -> DataFrame:
    """Tickers whose rows must be redone: LIFO with a disclosed reserve but no amount."""
    return existing.where(
        (F.col("method") == "LIFO") & F.col("lifo_reserve_disclosed") & F.col("lifo_reserve_usd").isNull()
    ).select("ticker").distinct()


def pending_classifications(filings: DataFrame, existing: DataFrame) -> DataFrame:
    """Filings (ticker, accession_no) to classify: unseen ones and all of tickers to redo."""
    redo = force_reclassify(existing)
    valid = existing.join(redo, "ticker", "left_anti")
    return filings.join(valid.select("ticker", "accession_no"), ["ticker", "accession_no"], "left_anti")


# -- crossing, re-entry and outcome --------------------------------------------------------------

# Notes of the crossing states.
NOTE_NO_PRICES = "No monthly price history after deletion date."
NOTE_NO_BOOK = "EODHD fundamentals exist but lack quarterly equity/shares."
NOTE_UNPROFITABLE = "0<P/B<1 at crossing, but most recent net income was negative (P/E <= 0)."
NOTE_UNKNOWN = "0<P/B<1 at crossing, but no earnings data available as of that date."
CROSSED = ("crossed", "crossed_unprofitable", "crossed_earnings_unknown")


def price_book_hits(prices: DataFrame, book: DataFrame) -> DataFrame:
    """Price bars with 0 < close / book < 1, using only book values filed by the bar's date."""
    extra = [c for c in ("shares",) if c in book.columns]
    known = asof_join(prices, book, "ticker", "date", "filed", columns=["bvps", *extra])
    ratio = F.col("close") / F.col("bvps")
    return known.where(F.col("bvps") > 0).withColumn("pb_ratio", ratio).where(
        (F.col("pb_ratio") > 0) & (F.col("pb_ratio") < 1)).select(
        "ticker", F.col("date").alias("crossing_date"), F.col("close").alias("buy_price"),
        F.col("bvps").alias("bvps_at_crossing"), F.col("pb_ratio").alias("pb_ratio_at_crossing"),
        (F.col("shares") if extra else F.lit(None).cast("double")).alias("shares_at_crossing"))


def first_crossing(deletions: DataFrame, prices: DataFrame, book: DataFrame,
                   earnings: DataFrame) -> DataFrame:
    """First bar on or after each deletion that trades below book, with a status.

    The book value joins the bars once; each deletion then takes the next hit, so several
    deletions of one ticker cost one look-up each.
    """
    hits = price_book_hits(prices, book)
    crossing = asof_join(deletions, hits, "ticker", "deletion_date", "crossing_date", "forward")
    signed = positive_as_of(
        crossing, earnings, "ticker", "crossing_date", "filed", "net_income", "profitable_at_crossing")
    last_price = prices.groupBy("ticker").agg(F.max("date").alias("_last"))
    has_book = book.select("ticker").distinct().withColumn("_book", F.lit(True))
    rows = signed.join(last_price, "ticker", "left").join(has_book, "ticker", "left")
    hit = F.col("crossing_date").isNotNull()
    profitable = F.col("profitable_at_crossing")
    no_price = F.coalesce(F.col("_last") < F.col("deletion_date"), F.lit(True))
    status = (
        F.when(no_price, F.lit("insufficient_data"))
        .when(F.col("_book").isNull(), F.lit("insufficient_data"))
        .when(~hit, F.lit("never_crossed"))
        .when(profitable, F.lit("crossed"))
        .when(~profitable, F.lit("crossed_unprofitable"))
        .otherwise(F.lit("crossed_earnings_unknown"))
    )
    note = (
        F.when(no_price, F.lit(NOTE_NO_PRICES))
        .when(F.col("_book").isNull(), F.lit(NOTE_NO_BOOK))
        .when(F.col("status") == "crossed_unprofitable", F.lit(NOTE_UNPROFITABLE))
        .when(F.col("status") == "crossed_earnings_unknown", F.lit(NOTE_UNKNOWN))
    )
    return rows.withColumn("status", status).withColumn("note", note).select(
        *deletions.columns, "status", "crossing_date", "buy_price", "bvps_at_crossing",
        "shares_at_crossing", "pb_ratio_at_crossing", "profitable_at_crossing",
        F.when(hit, F.col("net_income")).alias("net_income_at_crossing"), "note")


def reentry_dates(crossings: DataFrame, additions: DataFrame) -> DataFrame:
    """Earliest index addition strictly after the crossing of profitable crossers."""
    crossed = crossings.where(F.col("status") == "crossed").select("ticker", "deletion_date", "crossing_date")
    return first_after(crossed, additions, "ticker", "crossing_date", "added_date", "reentry_date").select(
        "ticker", "deletion_date", "reentry_date")


def attach_reentry(crossed: DataFrame, reentry: DataFrame) -> DataFrame:
    return crossed.join(reentry, ["ticker", "deletion_date"], "left")


def trade_outcome(crossed: DataFrame, prices: DataFrame, as_of: Column, hold_days: int = 365,
                  recent_days: int = 10) -> DataFrame:
    """Outcome per crossed ticker: best close within a year of re-entry (earliest on a tie), else
    the last close of the recent days.

    The year is cut into calendar months, so bars meet only the intervals of their own month.
    """
    best_of = crossed.where(F.col("reentry_date").isNotNull()).select(
        "ticker", "deletion_date", "reentry_date",
        F.date_add("reentry_date", hold_days).alias("_end"))
    months = F.sequence(F.trunc("reentry_date", "month"), F.trunc("_end", "month"), F.expr("interval 1 month"))
    spread = best_of.withColumn("_m", F.explode(months))
    bars = prices.select("ticker", "date", "close", F.trunc("date", "month").alias("_m"))
    inside = spread.join(bars, ["ticker", "_m"]).where(F.col("date").between(F.col("reentry_date"), F.col("_end")))
    best = inside.groupBy("ticker", "deletion_date").agg(
        F.max(F.struct("close", (-F.unix_date("date")).alias("_neg"))).alias("b")).select(
        "ticker", "deletion_date", F.col("b.close").alias("_best"),
        F.date_from_unix_date(-F.col("b._neg")).alias("_best_date"))
    recent = prices.where(F.col("date") >= F.date_sub(as_of, recent_days)).groupBy("ticker").agg(
        F.max(F.struct("date", "close")).alias("r")).select(
        "ticker", F.col("r.close").alias("_last"), F.col("r.date").alias("_last_date"))
    rows = crossed.join(best, ["ticker", "deletion_date"], "left").join(recent, "ticker", "left")
    back = F.col("reentry_date").isNotNull()
    price = F.when(back, F.col("_best")).otherwise(F.col("_last"))
    known = price.isNotNull()
    buy = F.col("buy_price")
    return rows.select(
        "ticker", "deletion_date",
        F.when(~known, F.lit("insufficient_data")).when(back, F.lit("realized"))
        .otherwise(F.lit("still_holding")).alias("status"),
        F.when(known, F.col("crossing_date")).alias("buy_date"),
        F.when(known, buy).alias("buy_price"),
        F.when(known, F.col("reentry_date")).alias("reentry_date"),
        F.when(back, F.col("_best_date")).otherwise(F.col("_last_date")).alias("sell_date"),
        price.alias("sell_price"),
        ((price - buy) / buy * F.lit(100.0)).alias("return_pct"),
        F.when(~known & back, F.lit("Re-entered the index but no price history in the 12mo window after."))
        .when(~known, F.lit("No re-entry and no current price available (likely delisted).")).alias("note"))


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("rows"))


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """Counts per outcome and the mean return of realized and open trades."""
    priced = F.col("status").isin("realized", "still_holding")
    return outcomes.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(F.col("status") == "realized").alias("num_realized"),
        F.count_if(F.col("status") == "still_holding").alias("num_still_holding"),
        F.avg(F.when(priced, F.col("return_pct"))).alias("avg_return_pct"))
