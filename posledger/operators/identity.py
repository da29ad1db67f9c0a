"""Resolving investee names to tickers with small dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from posledger.functions.text import (
    clean_issuer_name, dash_share_class, normalize_ticker, private_ticker,
)

def _substrings(text, lengths):
    """All substrings of a text that have one of the lengths."""
    return F.array_distinct(F.flatten(F.transform(lengths, lambda size: F.when(
        size <= F.length(text), F.transform(
            F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(text, i, size))
    ).otherwise(F.array().cast("array<string>")))))


def substring_match(names: DataFrame, aliases: DataFrame, name: str, either_way: bool = True) -> DataFrame:
    """First alias (by ``alias_order``) contained in the name, or containing it.

    Distinct names are joined by equality: a name is cut into its substrings of the lengths that aliases
    have, which meet whole aliases, and an alias, the other way round, into its substrings of all lengths,
    which meet whole names. Only true hits meet, so a frequent fragment makes no key hot; the list of
    alias lengths is a scalar of the dimension table.
    """
    distinct = names.select(F.col(name).alias("_n")).where(F.length(name) > 0).distinct()
    known = aliases.where(F.length("alias") > 0).select("alias", "ticker", "alias_order")
    lengths = known.agg(F.sort_array(F.collect_set(F.length("alias"))).alias("l")).scalar()
    sized = distinct.withColumn("_sizes", lengths)
    hits = sized.select("_n", F.explode(_substrings(F.col("_n"), F.col("_sizes"))).alias("alias")).join(known, "alias")
    if either_way:
        size = F.length("alias")
        cut = known.select(F.explode(_substrings(F.col("alias"), F.sequence(F.lit(1), size))).alias("_n"), "ticker", "alias_order")
        hits = hits.select("_n", "ticker", "alias_order").unionByName(distinct.join(cut, "_n"))
    return hits.groupBy("_n").agg(F.min(F.struct("alias_order", "ticker")).alias("h")).select(
        F.col("_n").alias(name), F.col("h.ticker").alias("matched_ticker"),
        F.col("h.alias_order").alias("matched_order"))


def resolve_identity(rows: DataFrame, cusips: DataFrame, aliases: DataFrame, hints: DataFrame,
                     name: str = "investee_name", ticker: str = "investee_ticker",
                     cusip: str = "cusip", keep_unresolved: bool = True) -> DataFrame:
    """Ticker by: own value, security-id map, exact alias, substring alias, name hint.

    A hint without symbol marks a private company and gives a ``PRIV_`` identity. Tables:
    ``cusips(cusip, ticker)``, ``aliases(alias, ticker, alias_order)``,
    ``hints(alias, ticker, alias_order)``; alias texts are lower case.
    """
    clean = clean_issuer_name(name)
    base = rows.withColumns({
        "_own": F.when(normalize_ticker(ticker).isNotNull(), dash_share_class(normalize_ticker(ticker))),
        "_clean": clean,
        "_lower": F.lower(F.trim(clean)),
        "_cusip": F.upper(F.trim(F.col(cusip))),
    })
    by_cusip = cusips.select(F.upper("cusip").alias("_cusip"), F.col("ticker").alias("_by_cusip"))
    exact = aliases.groupBy(F.col("alias").alias("_lower")).agg(
        F.min_by("ticker", "alias_order").alias("_by_alias"))
    step = base.join(by_cusip, "_cusip", "left").join(exact, "_lower", "left")

    known = F.coalesce("_own", "_by_cusip", "_by_alias").isNotNull()
    open_names = step.where(~known & F.col("_lower").isNotNull()).select("_lower")
    near = substring_match(open_names, aliases, "_lower").select(
        "_lower", F.col("matched_ticker").alias("_by_part"))
    hinted = substring_match(open_names, hints, "_lower", either_way=False).select(
        "_lower", F.col("matched_ticker").alias("_hint"), F.lit(True).alias("_hinted"))
    step = step.join(near, "_lower", "left").join(hinted, "_lower", "left")
    by_hint = F.when(F.nullif("_hint", F.lit("")).isNotNull(), F.col("_hint")).when(
        F.col("_hinted"), private_ticker("_clean"))
    found = F.coalesce("_own", "_by_cusip", "_by_alias", "_by_part", by_hint)
    if not keep_unresolved:
        found = F.coalesce(found, private_ticker("_clean"))
    return step.withColumns({name: F.coalesce("_clean", name), ticker: found}).select(*rows.columns)


def drop_self_issuer(rows: DataFrame, hints: DataFrame) -> DataFrame:
    """Remove filings whose issuer is the parent itself.

    ``hints(parent_ticker, hint)`` lists further name fragments of a parent, lower case.
    """
    name = F.lower(F.coalesce(F.trim("investee_name"), F.lit("")))
    own = F.coalesce(normalize_ticker("investee_ticker") == F.col("parent_ticker"), F.lit(False))
    in_name = name.contains(F.lower("parent_ticker")) | name.contains(
        F.translate(F.lower("parent_ticker"), "-", " "))
    extra = hints.groupBy("parent_ticker").agg(F.collect_set("hint").alias("_hints"))
    joined = rows.join(extra, "parent_ticker", "left")
    hinted = F.coalesce(F.exists("_hints", lambda h: name.contains(h)), F.lit(False))
    return joined.where(~(own | in_name | hinted)).select(*rows.columns)
