"""Text jobs over tables of raw filings: windows, cover pages, tables and notes.

Everything stays inside one row of text, in JVM string and array functions: no shuffle, no Python,
and one long filing is never more than one row of work. Arrays are exploded with the outer form, so
the optimizer does not repeat the search in a pushed-down filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from posledger.functions import patterns as pat
from posledger.functions.dates import month_day_year
from posledger.functions.text import append_tags, exchange_ticker
from posledger.sources import fixed_values as fixed

_SPANS = "array<struct<lo:int,hi:int>>"
SEPARATOR = "\n\n---\n\n"


def _as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _pick(text: Column, pattern: str, group: int = 1) -> Column:
    # The search stands in the expression once: in a branch, nullif would make it twice.
    return F.get(F.filter(F.array(F.regexp_extract(text, pattern, group)), lambda hit: hit != ""), F.lit(0))


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def strip_html(body) -> Column:
    """Visible text of a page: scripts, styles, tags and numeric entities gone, blanks squeezed."""
    raw = _as_col(body)

    def step(text: Column, pattern: str, value: str) -> Column:
        # A step can only find what the page has: every step leaves a blank, so none forms the mark of another.
        mark = pat.HTML_MARKS.get(pattern)
        done = F.regexp_replace(text, pattern, value)
        return done if mark is None else F.when(F.lower(raw).contains(mark), done).otherwise(text)

    return F.trim(reduce(lambda t, s: step(t, *s), pat.HTML_STEPS, raw))


def strip_tag_runs(text, suffix: str = "Member", at_least: int = 3) -> Column:
    """Drop runs of tokens ending in ``suffix`` so the prose around them can be searched."""
    source = _as_col(text)
    cleaned = F.regexp_replace(source, r"(?:[A-Za-z0-9:._-]*" + suffix + r"\s+){" + str(at_least) + ",}", " ")
    if suffix.isalnum():
        cleaned = F.when(source.contains(suffix), cleaned).otherwise(source)
    return F.regexp_replace(cleaned, r"\s{3,}", "\n")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often and however deep in lambdas it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(values: Column, combine, start: Column, kind: str = "int") -> Column:
    """Running results of an associative ``combine`` over an array, one per element.

    Appending to an array copies it, so a plain fold is quadratic. Here blocks of a square root of the elements are
    folded by themselves, then the block ends, and every block is shifted by what comes before it.
    """
    def walk(items: Column) -> Column:
        begin = F.struct(start.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(items, begin, lambda acc, v: F.struct(
            combine(acc["at"], v).alias("at"), F.array_append(acc["out"], combine(acc["at"], v)).alias("out")))["out"]

    def blocks(items: Column) -> Column:
        n = F.size(items)
        return _let(F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double"))).cast("int")), lambda width: F.when(n > 0, F.transform(
            F.sequence(F.lit(0), F.ceil(n / width).cast("int") - 1), lambda b: F.slice(items, b * width + 1, width))
        ).otherwise(F.array().cast(f"array<array<{kind}>>")))

    def shifted(inner: Column) -> Column:
        ends = walk(F.transform(inner, lambda x: F.element_at(x, -1)))
        return _let(ends, lambda before: F.flatten(F.transform(inner, lambda x, i: F.when(i == 0, x).otherwise(
            F.transform(x, lambda v: combine(F.get(before, i - 1), v))))))

    return _let(values, lambda items: _let(F.transform(blocks(items), walk), shifted))


def match_spans(text, pattern: str) -> Column:
    """Zero-based [lo, hi) spans of all non-overlapping matches, in order."""
    source = _as_col(text)
    gaps = F.transform(F.split(source, pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(source, F.lit(pattern), F.lit(0)), F.length)

    def spans(sizes: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda gap, hit: gap + hit)
        return F.zip_with(_scan(steps, lambda a, b: a + b, F.lit(0)), sizes, lambda hi, hit: F.struct(
            (hi - hit).alias("lo"), hi.alias("hi")))

    return _let(hits, spans)


def merge_spans(spans: Column) -> Column:
    """Union of overlapping or touching spans."""
    none = F.array().cast(_SPANS)

    def islands(ordered: Column) -> Column:
        reach = _scan(F.transform(ordered, lambda s: s["hi"]), lambda a, b: F.greatest(a, b), F.lit(-1))
        # An island starts where nothing so far reaches, and ends at the furthest reach before the next one starts.
        steps = F.arrays_zip(ordered.alias("s"), F.concat(F.array(F.lit(-1)), reach).alias("before"))
        marked = F.filter(F.transform(steps, lambda x: F.when(
            x["s"].isNull() | (x["s"]["lo"] > x["before"]), F.struct(x["s"]["lo"].alias("lo"), x["before"].alias("hi")))),
            lambda x: x.isNotNull())
        return _let(marked, lambda m: F.zip_with(
            F.slice(F.transform(m, lambda x: x["lo"]), 1, F.size(m) - 1), F.slice(F.transform(m, lambda x: x["hi"]), 2, F.size(m) - 1),
            lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))))

    return _let(spans, lambda found: F.when(F.size(found) > 0, _let(F.array_sort(found), islands)).when(found.isNotNull(), none))


def _around(text: Column, hits: Column, width: int) -> Column:
    return _let(F.length(text), lambda size: F.transform(hits, lambda s: F.struct(
        F.greatest(F.lit(0), s["lo"] - width).alias("lo"), F.least(size, s["hi"] + width).alias("hi"))))


def keyword_spans(text, keywords: Sequence[str], width: int) -> Column:
    """Merged windows of ``width`` characters around literal, case-insensitive keyword hits."""
    source = _as_col(text)
    lower = F.lower(source)
    none = F.array().cast(_SPANS)
    # A plain substring test first: most texts lack most keywords.
    hits = F.flatten(F.array(*[
        F.when(lower.contains(k.lower()), match_spans(lower, "\\Q" + k.lower() + "\\E")).otherwise(none)
        for k in keywords]))
    return merge_spans(_around(source, hits, width))


def _cut(text: Column, span: Column) -> Column:
    return F.substr(text, span["lo"] + 1, span["hi"] - span["lo"])


def _outside(spans: str, others: str) -> Column:
    """The spans that lie inside none of the others; both are in order."""
    tag = lambda c, later: F.transform(c, lambda s: F.struct(
        s["lo"].alias("lo"), F.lit(later).alias("later"), s["hi"].alias("hi")))

    def fresh(both: Column) -> Column:
        reach = _scan(F.transform(both, lambda x: F.when(x["later"] == 0, x["hi"]).otherwise(F.lit(-1))),
                      lambda a, b: F.greatest(a, b), F.lit(-1))
        return F.zip_with(both, reach, lambda x, r: F.when(
            (x["later"] == 1) & (x["hi"] > r), F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"))))

    seen = _let(F.array_sort(F.concat(tag(others, 0), tag(spans, 1))), fresh)
    return F.when(F.size(F.col(spans)) == 0, F.col(spans)).when(F.size(F.col(others)) == 0, F.col(spans)).otherwise(
        F.filter(seen, lambda s: s.isNotNull()))


def keyword_windows(df: DataFrame, text: str, keywords: Sequence[str] = pat.INVENTORY_KEYWORDS,
                    priority: Sequence[str] = pat.INVENTORY_PRIORITY_KEYWORDS, width: int = 2500,
                    name: str = "excerpt") -> DataFrame:
    """Text near the keywords, windows around priority words first; the whole text if it has none.

    A secondary window inside a priority one is left out. Nothing else is: every hit is in the result.
    """
    rest = [k for k in keywords if k not in priority]
    staged = df.withColumns({
        "_first": keyword_spans(text, priority, width),
        "_second": keyword_spans(text, rest, width) if rest else F.array().cast(_SPANS)})
    fresh = _outside("_second", "_first")
    chunks = F.filter(F.transform(F.concat("_first", fresh), lambda s: _strip(_cut(F.col(text), s))),
                      lambda c: c != "")
    none = (F.size("_first") == 0) & (F.size(fresh) == 0)
    return staged.withColumn(name, F.when(none, _strip(F.col(text))).otherwise(
        F.array_join(chunks, SEPARATOR))).drop("_first", "_second")


def ownership_slices(df: DataFrame, text: str, width: int = 4500, name: str = "slices") -> DataFrame:
    """All windows around ownership disclosures, merged, in text order."""
    source = F.col(text)

    def spans(patterns):
        hits = F.flatten(F.array(*[match_spans(source, "(?i)" + p) for p in patterns]))
        return merge_spans(_around(source, hits, width))

    staged = df.withColumn("_s", spans(pat.OWNERSHIP_PATTERNS))
    staged = staged.withColumn("_s", F.when(F.size("_s") > 0, F.col("_s")).otherwise(spans(pat.OWNERSHIP_FALLBACK_PATTERNS)))
    joined = F.array_join(F.transform("_s", lambda s: _cut(source, s)), SEPARATOR)
    return staged.withColumn(name, F.coalesce(joined, F.lit(""))).drop("_s")


# -- ownership filings ---------------------------------------------------------------------------

def _exit_flag(pct: Column, shares: Column, text: Column | None) -> Column:
    held = F.coalesce((shares > 0) & (pct > 0), F.lit(False))
    zero = F.coalesce(pct <= 0, F.lit(False)) | F.coalesce(shares <= 0, F.lit(False))
    told = F.lit(False) if text is None else text.rlike(pat.DISPOSAL) | text.rlike(pat.ITEM_FIVE_CHECKED)
    return ~held & (zero | told)


def _xml_value(body: Column, names: Sequence[str]) -> Column:
    return _pick(body, r"(?is)<(?:\w+:)?(?:" + "|".join(names) + r")(?:\s[^>]*)?>\s*([^<]+?)\s*<")


def extract_ownership_filing(df: DataFrame, body: str = "body") -> DataFrame:
    """Issuer, security id, percent, shares, symbol and exit flag of an ownership filing."""
    raw = F.col(body)
    is_xml = raw.rlike(r"(?is)^\s*<\?xml") & ~raw.rlike(r"(?i)<html")
    staged = df.withColumns({"_text": strip_html(raw), "_xml": is_xml})
    text = F.col("_text")
    pct = F.when(F.col("_xml"), F.regexp_replace(F.split(_xml_value(raw, pat.XML_PERCENT), r"\s")[0], "[^0-9.]", "").try_cast("double")
                 ).otherwise(F.coalesce(_pick(text, pat.COVER_PERCENT), _pick(text, pat.COVER_PERCENT_LOOSE)).try_cast("double"))
    shares = F.when(F.col("_xml"), F.regexp_replace(_xml_value(raw, pat.XML_SHARES), "[^0-9.]", "").try_cast("double")
                    ).otherwise(_number(F.coalesce(_pick(text, pat.COVER_AMOUNT), _pick(text, pat.COVER_VOTING))))
    parsed = staged.withColumns({
        "issuer_name": F.when(F.col("_xml"), _xml_value(raw, pat.XML_ISSUER)).otherwise(F.trim(_pick(text, pat.COVER_NAME))),
        "cusip": F.when(F.col("_xml"), _xml_value(raw, pat.XML_CUSIP)).otherwise(F.upper(_pick(text, pat.COVER_CUSIP))),
        "ownership_pct": pct, "shares": shares,
        "ticker": F.when(F.col("_xml"), F.upper(_xml_value(raw, pat.XML_SYMBOL))).otherwise(_pick(text, pat.COVER_SYMBOL)),
    })
    exit_flag = F.when(F.col("_xml"), _exit_flag(F.col("ownership_pct"), F.col("shares"), None)).otherwise(
        _exit_flag(F.col("ownership_pct"), F.col("shares"), text))
    return parsed.withColumn("exit_flag", exit_flag).drop("_text", "_xml")


def ownership_positions(parsed: DataFrame) -> DataFrame:
    """Snapshot rows from parsed ownership filings (tickers already resolved).

    A percentage never becomes a share count; without any quantity a row only survives as an exit,
    and an exit is worth nothing.
    """
    pct, shares = F.col("ownership_pct"), F.col("shares")
    held = F.coalesce((shares > 0) & (pct > 0), F.lit(False))
    gone = ~held & (F.coalesce("exit_flag", F.lit(False)) | F.coalesce(pct <= 0, F.lit(False))
                    | F.coalesce(shares <= 0, F.lit(False)))
    note = F.concat_ws(
        "; ", F.concat(F.lit("source=13g form="), F.coalesce("form", F.lit("")), F.lit(" cik="), F.coalesce("cik", F.lit(""))),
        F.when(F.coalesce(F.col("investee_ticker").startswith("PRIV_"), F.lit(False)), F.lit("ticker=private_note")),
        F.when(~gone & shares.isNull() & pct.isNotNull(), F.lit("qoq_continuity=ownership_pct")),
        F.when(gone, F.lit("13g_exit=1")))
    rows = parsed.where(F.col("investee_name").isNotNull() & (gone | shares.isNotNull() | pct.isNotNull()))
    return rows.withColumns({
        "is_exit": gone,
        "shares_held": F.when(gone, F.lit(0.0)).otherwise(shares),
        "ownership_pct": F.when(gone, F.coalesce(pct, F.lit(0.0))).otherwise(pct),
        "market_value_usd": F.lit(None).cast("double"), "note": note, "source": F.lit("13g"),
        "as_of_date": F.col("filing_date"), "as_of_accession_no": F.col("accession_no"),
    }).drop("exit_flag", "shares")


def ownership_live_rows(parsed: DataFrame) -> DataFrame:
    """Current rows from parsed ownership filings; a stake of 20 % or more means influence."""
    pct = F.coalesce("ownership_pct", F.lit(0.0))
    return ownership_positions(parsed).where(~F.col("is_exit")).withColumns({
        "influence_disclosed": pct >= 20,
        "filing_gaap_hint": F.when(pct < 20, F.lit("fv_ni")),
        "confidence": F.lit("medium"),
        "first_filing_date": F.col("filing_date"), "first_accession_no": F.col("accession_no"),
        "source_quote": F.concat_ws(" ", "form", "accession_no", "investee_name"),
    })


# -- investments tables and notes ----------------------------------------------------------------

def _source_label(form: Column, kind: str) -> Column:
    prefix = F.when(F.upper(form).isin("20-F", "10-Q", "10-K"), F.lower(F.replace(form, F.lit("-"), F.lit(""))))
    plain = "investments_table" if kind == "investments_table" else "filing_note"
    return F.coalesce(F.concat(prefix, F.lit("_" + kind)), F.lit(plain))


def _plain_row(html: Column) -> Column:
    text = F.regexp_replace(html, "<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&#160;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _table_dates(text: Column) -> Column:
    def day(offset):
        return month_day_year(F.concat(
            F.initcap(F.regexp_extract(text, pat.TWO_DATES, offset)), F.lit(" "),
            F.regexp_extract(text, pat.TWO_DATES, offset + 1), F.lit(", "),
            F.regexp_extract(text, pat.TWO_DATES, offset + 2)))
    return F.when(text.rlike(pat.TWO_DATES), F.struct(day(1).alias("a"), day(4).alias("b")))


def extract_investments_table(df: DataFrame, body: str = "body",
                              names: Sequence[tuple[str, str]] = pat.INVESTMENT_NAMES) -> DataFrame:
    """Named rows of two-date investment tables (millions): one row per name and date.

    Table markup is read first; filings without any table row fall back on their prose, where each
    date header holds up to the next one or the end. ``names`` lists the labels to look for with their tickers.
    """
    labels = "|".join(n.replace(" ", r"\s+") for n, _ in names)
    row = (r"(?i)(" + labels + r")(?:\s*\([^)]*\))?\s*\$?\s*([\d,]+(?:\.\d+)?)\s*\$?\s*([\d,]+(?:\.\d+)?)")
    keep = [c for c in df.columns if c != body]
    raw = F.col(body)
    tables = F.regexp_extract_all(raw, F.lit(r"(?is)<table\b[^>]*>.*?</table>"), F.lit(0))
    first = "|".join(n.split(" ")[0] for n, _ in names)
    in_tables = F.flatten(F.transform(tables, lambda t: F.when(
        _plain_row(t).rlike(pat.INVESTMENT_TABLE_HINT) | _plain_row(t).rlike(r"(?i)\b(" + first + r")\b"),
        F.transform(F.regexp_extract_all(t, F.lit(r"(?is)<tr\b[^>]*>.*?</tr>"), F.lit(0)), lambda r: F.struct(
            _table_dates(_plain_row(t)).alias("dates"), F.regexp_extract(_plain_row(r), row, 0).alias("hit"))))
        .otherwise(F.array().cast("array<struct<dates:struct<a:date,b:date>,hit:string>>"))))
    usable = F.filter(in_tables, lambda x: x["dates"].isNotNull() & (x["hit"] != ""))
    prose = _plain_row(strip_tag_runs(raw))
    staged = df.withColumns({"_rows": usable, "_prose": F.when(F.size(usable) == 0, prose)})
    headers = match_spans("_prose", pat.TWO_DATES)
    sections = F.transform(headers, lambda h, i: F.substr(
        F.col("_prose"), h["lo"] + 1,
        F.coalesce(F.get(headers, i + 1)["lo"], F.length("_prose")) - h["lo"]))
    from_prose = F.flatten(F.transform(sections, lambda t: F.transform(
        F.regexp_extract_all(t, F.lit(row), F.lit(0)),
        lambda h: F.struct(_table_dates(t).alias("dates"), h.alias("hit")))))
    rows = staged.select(*keep, F.posexplode_outer(
        F.coalesce(F.when(F.size("_rows") > 0, F.col("_rows")), from_prose)).alias("_pos", "x")).where(F.col("x").isNotNull())
    name = F.regexp_replace(F.trim(F.regexp_extract("x.hit", row, 1)), r"\s+", " ")
    symbol = F.create_map(*[F.lit(v) for pair in names for v in pair])[F.lower(name)]
    pairs = rows.select(*keep, "_pos", name.alias("investee_name"), symbol.alias("investee_ticker"), F.posexplode(F.array(
        F.struct(F.col("x.dates.a").alias("day"), _number(F.regexp_extract("x.hit", row, 2)).alias("mn")),
        F.struct(F.col("x.dates.b").alias("day"), _number(F.regexp_extract("x.hit", row, 3)).alias("mn")))).alias("_side", "v"))
    usd = F.col("v.mn") * 1e6
    facts = pairs.where(F.col("v.day").isNotNull() & usd.isNotNull()).withColumns({
        "as_of_date": F.col("v.day"), "fair_value_disclosed_usd": usd, "carrying_usd": usd,
        "_name": F.upper(F.coalesce("investee_ticker", "investee_name"))})
    values = ["investee_name", "investee_ticker", "fair_value_disclosed_usd", "carrying_usd"]
    once = facts.groupBy(*keep, "_name", "as_of_date").agg(
        F.min_by(F.struct(*values), F.struct("_pos", "_side")).alias("r")).select(*keep, "as_of_date", "r.*")
    source = _source_label(F.col("form") if "form" in keep else F.lit(None).cast("string"), "investments_table")
    return once.withColumn("source", source).withColumn("note", F.concat(
        F.lit("source="), "source", F.lit(" as_of="), F.col("as_of_date").cast("string"),
        F.lit(" fv_usd="), F.col("fair_value_disclosed_usd").cast("decimal(38,0)").cast("string")))


def _found(kind: Column, lo: Column, name: Column, short: Column, pct: Column, amount: Column) -> Column:
    return F.struct(kind.alias("kind"), lo.alias("lo"), name.alias("investee_name"), short.alias("short_name"),
                    pct.try_cast("double").alias("ownership_pct"), amount.alias("carrying_usd"))


def extract_investment_notes(df: DataFrame, body: str = "body") -> DataFrame:
    """Named investment sections and held-stake sentences of annual and interim notes.

    A section runs to the next heading or the end and needs a percentage or an amount; month names
    and one or two letter labels are not names. Several hits of one name are merged, the one with
    more facts first.
    """
    keep = [c for c in df.columns if c != body]
    text = F.col("_text")
    # Headings are searched once a page; in the lambdas below they are a column, not a search of their own a hit.
    staged = df.withColumn("_text", strip_tag_runs(body)).withColumn("_heads", match_spans(text, pat.INVESTMENT_IN))
    months = [m.lower() for m in pat.MONTHS]
    none = F.lit(None).cast("string")

    def section(lo: Column, window: Column) -> Column:
        def fact(head: Column) -> Column:
            name, short = head["name"], head["short"]
            junk = (F.length(short) <= 2) | F.lower(short).isin(*months) | short.rlike(r"^[eE]\s*&?$") | F.lower(
                F.split(name, r"\s+")[0]).isin(*months)
            amount = F.coalesce(_pick(window, pat.USD_BILLION).try_cast("double") * 1e9,
                                _pick(window, pat.USD_MILLION).try_cast("double") * 1e6)
            return F.when(~junk, _found(F.lit("section"), lo, name, short, _pick(window, pat.PERCENT_EQUITY), amount))

        return _let(F.struct(F.trim(F.regexp_extract(window, pat.INVESTMENT_IN, 1)).alias("name"),
                             F.trim(F.regexp_extract(window, pat.INVESTMENT_IN, 2)).alias("short")), fact)

    def held(kind, pattern, word):
        hits = F.transform(match_spans(text, pattern), lambda s: _found(
            F.lit(kind), s["lo"], F.lit(pat.HELD_NAME), none, _pick(_cut(text, s), pattern), F.lit(None).cast("double")))
        return F.when(F.lower(text).contains(word), hits).otherwise(F.array().cast(hit_type))

    hit_type = ("array<struct<kind:string,lo:int,investee_name:string,short_name:string,ownership_pct:double,"
                "carrying_usd:double>>")
    sections = F.transform("_heads", lambda s, i: _let(
        F.substr(text, s["lo"] + 1, F.coalesce(F.get("_heads", i + 1)["lo"], F.length(text)) - s["lo"]),
        lambda window: section(s["lo"], window)))
    hits = F.filter(F.concat(sections, held("issued", pat.NEWLY_ISSUED, "newly"), held("held", pat.WE_HELD, "held")), lambda h: (
        h["ownership_pct"].isNotNull() | h["carrying_usd"].isNotNull()))
    rows = staged.select(*keep, F.explode_outer(hits).alias("h")).where(F.col("h").isNotNull()).select(*keep, "h.*")
    order_of = F.when(F.col("kind") == "section", 0).when(F.col("kind") == "issued", 1).otherwise(2)
    facts = F.when(F.col("ownership_pct").isNotNull(), 1).otherwise(0) + F.when(F.col("carrying_usd").isNotNull(), 1).otherwise(0)
    rank = F.struct(-facts, -order_of, -F.col("lo"))
    merged = rows.groupBy(*keep, F.lower("investee_name").alias("_key")).agg(
        F.min_by(F.struct("investee_name", "short_name"), rank).alias("n"),
        F.min_by("ownership_pct", F.when(F.col("ownership_pct").isNotNull(), rank)).alias("ownership_pct"),
        F.min_by("carrying_usd", F.when(F.col("carrying_usd").isNotNull(), rank)).alias("carrying_usd"))
    influence = F.coalesce(F.col("ownership_pct") >= 20, F.lit(False))
    source = _source_label(F.col("form") if "form" in keep else F.lit(None).cast("string"), "note")
    return merged.select(
        *keep, F.col("n.investee_name").alias("investee_name"), F.col("n.short_name").alias("short_name"),
        "ownership_pct", "carrying_usd", influence.alias("influence_disclosed"),
        F.when(influence, F.lit("equity_method")).alias("filing_gaap_hint"), source.alias("source"),
        F.concat(F.lit("source="), source, F.coalesce(F.concat(F.lit(" short="), "n.short_name"), F.lit(""))).alias("note"))


def note_positions(notes: DataFrame) -> DataFrame:
    """Snapshot rows from note facts: only investment tables set a value, never a percentage shares.

    Unresolved names get a private identity.
    """
    from posledger.functions.text import normalize_ticker, private_ticker

    def opt(name, kind="double"):
        return F.col(name) if name in notes.columns else F.lit(None).cast(kind)

    blob = F.lower(F.concat_ws(" ", "source", "note"))
    table = blob.contains("investments_table")
    ticker = normalize_ticker(opt("investee_ticker", "string"))
    value = F.when(table, F.coalesce(opt("fair_value_disclosed_usd"), opt("carrying_usd")))
    shares = opt("shares_held")
    pct = opt("ownership_pct")
    private = ticker.isNull()
    note = append_tags(
        "note", (shares.isNull() & pct.isNotNull(), "qoq_continuity=ownership_pct", "qoq_continuity=ownership_pct"),
        (private, "ticker=private_note", "ticker=private_note"))
    return notes.withColumns({
        "investee_ticker": F.coalesce(ticker, private_ticker("investee_name")),
        "shares_held": shares, "ownership_pct": pct, "market_value_usd": value,
        "cusip": F.lit(None).cast("string"), "note": F.coalesce(note, F.concat(F.lit("source="), F.col("source")))})


def extract_annual_aggregates(df: DataFrame, text: str = "text", as_of: str = "as_of_date",
                              url: str = "source_url", rate: float = fixed.RMB_PER_USD) -> DataFrame:
    """Up to four portfolio aggregates of an annual report, in dollars.

    The listed-associates value is part of all listed investees, so it loses its portfolio value
    when the wider one is known. Rows of a report that states fewer than two aggregates say so.
    """
    body, day = F.col(text), F.col(as_of)
    line = F.regexp_extract(F.col("_line"), r"(?i)Listed entities(?:\s*\(Note\))?\s+([^\n]+)", 1)
    cells = F.regexp_extract_all(line, F.lit(r"\(?([\d,]+)\)?"), F.lit(1))
    # The pattern depends on the year of the row, so the year's line is cut out first.
    year_line = F.expr(f"regexp_extract({text}, concat('(?i)', year({as_of}), '\\\\s+Listed entities(?:\\\\s*\\\\(Note\\\\))?\\\\s+[^\\\\n]+'), 0)")
    # A report is searched for what it has the words of only; the words are found at a fraction of a search.
    low, loose, strict = F.col("_low"), F.col("_loose"), F.col("_strict")
    staged = df.withColumn("_low", F.lower(body)).withColumn("_loose", low.contains("listed entities")).withColumns({
        "_line": F.when(loose, year_line).otherwise(F.lit("")),
        "_strict": loose & low.contains("investments in associates") & body.rlike(pat.ANNUAL_BREAKDOWN)})
    million, billion = 1e6, 1e9
    listed_carry = F.when(strict, _number(_pick(body, pat.ANNUAL_BREAKDOWN, 1))).when(
        loose, _number(_pick(body, pat.ANNUAL_BREAKDOWN_LOOSE, 1))) * million
    unlisted_carry = F.when(strict, _number(_pick(body, pat.ANNUAL_BREAKDOWN, 2))).when(
        loose, _number(_pick(body, pat.ANNUAL_BREAKDOWN_LOOSE, 3))) * million
    staged = staged.withColumns({
        "_la_fv": F.when(F.size(cells) >= 7, _number(F.get(cells, F.lit(6)))) * million,
        "_la": listed_carry, "_ua": unlisted_carry,
        "_li": F.when(low.contains("in listed investee"), _number(_pick(body, pat.ANNUAL_LISTED_VALUE))) * billion,
        "_ui": F.when(low.contains("in unlisted"), _number(_pick(body, pat.ANNUAL_UNLISTED_VALUE))) * billion})

    def usd(name):
        return F.col(name) / F.lit(rate)

    none = F.lit(None).cast("double")
    base = F.concat(F.lit("source=hk_annual; form=hkex_annual_report; as_of="), day.cast("string"), F.lit("; url="),
                    F.coalesce(F.col(url), F.lit("")), F.lit("; value_source=hk_annual_note22; ticker=private_note; "))
    nested = F.col("_la_fv").isNotNull() & F.col("_li").isNotNull()

    def row(present, name, ticker, carrying, fair, value, hint, tail):
        return F.when(F.col(present).isNotNull(), F.struct(
            F.lit(name).alias("investee_name"), F.lit(ticker).alias("investee_ticker"), carrying.alias("carrying_usd"),
            fair.alias("fair_value_disclosed_usd"), value.alias("market_value_usd"), F.lit(hint).alias("filing_gaap_hint"),
            F.concat(base, tail).alias("note")))

    rows = F.array_compact(F.array(
        row("_la", "Listed associates (aggregate, HK annual report Note 22)", fixed.LISTED_ASSOCIATES, usd("_la"),
            usd("_la_fv"), F.when(F.col("_li").isNull(), usd("_la_fv")), "equity_method",
            F.concat(F.lit("HKEX annual report aggregate; names not disclosed"),
                     F.when(nested, F.lit("; nested_in=listed_investees_fv; excluded_from_portfolio_mv")).otherwise(F.lit("")))),
        row("_ua", "Unlisted associates (aggregate, HK annual report Note 22)", fixed.UNLISTED_ASSOCIATES, usd("_ua"),
            none, none, "equity_method", F.lit("No observable market; lookthrough MTM unknown")),
        row("_li", "All listed investees excl. subsidiaries (aggregate FV)", fixed.LISTED_INVESTEES, none, usd("_li"),
            usd("_li"), "fv_ni", F.lit("Includes FVPL/FVOCI + listed associates on attributable basis")),
        row("_ui", "Unlisted investees excl. subsidiaries (aggregate carrying)", fixed.UNLISTED_INVESTEES, usd("_ui"),
            none, none, "cost", F.lit("No market; cannot invent MTM adj"))))
    keep = [c for c in df.columns if c != text]
    few = append_tags("note", (F.col("_n") < 2, "aggregates=incomplete", "aggregates=incomplete"))
    # The outer form: the plain one has a filter on the array inferred, which repeats every search below it.
    return staged.withColumn("_rows", rows).select(
        *keep, F.size("_rows").alias("_n"), F.inline_outer("_rows")).where(F.col("investee_ticker").isNotNull()).withColumn(
        "note", few).drop("_n").withColumn("source", F.lit("hk_annual"))


def annual_history_rows(aggregates: DataFrame) -> DataFrame:
    """Ledger rows of annual aggregates: one holding row per year end."""
    day = F.col("as_of_date")
    return aggregates.withColumns({
        "period_end": day, "filing_date": day, "first_seen_period": day, "action": F.lit("hold"),
        "filing_url": F.col("source_url")})


# -- broker stake tables -------------------------------------------------------------------------

def _stake_struct(text: Column, pattern: str) -> Column:
    """One stake of a line or mark; every part is matched once and bound for the steps that follow."""
    codes = "|".join(fixed.EXCHANGE_CODES)
    peel = r"(?i)^(.+?)\s+(\d{3,6}|[A-Z][A-Z0-9.]{0,9})$"
    symbols = F.create_map(*[F.lit(v) for pair in pat.STAKE_NAMES for v in pair])

    def peeled(part: Column) -> Column:
        name, raw = part["name"], part["raw"]
        cut = F.upper(raw).isin(*fixed.EXCHANGE_CODES) & name.rlike(peel)
        return F.struct(
            name.alias("whole"), F.when(cut, F.trim(F.regexp_extract(name, peel, 1))).otherwise(name).alias("name"),
            F.when(cut, F.concat(F.regexp_extract(name, peel, 2), F.lit(" "), F.upper(raw))).otherwise(raw).alias("raw"))

    def named(part: Column) -> Column:
        name, raw, low = part["name"], part["raw"], F.lower(part["whole"])
        clean_key = F.lower(F.regexp_replace(name, rf"(?i)\s+\d{{3,6}}\s+(?:{codes})\s*$", ""))
        ticker = exchange_ticker(raw, name, F.coalesce(symbols[F.lower(name)], symbols[F.trim(clean_key)]))
        shown = F.trim(F.regexp_replace(name, rf"(?i)\s+(?:\d{{3,6}}|[A-Z][A-Z0-9.]{{0,9}})\s+(?:{codes})\s*$", ""))
        junk = low.startswith("name") | low.contains("stake")
        for stop in pat.STAKE_STOPS:
            junk = junk | low.startswith(stop)
        return F.when(~junk & (low != ""), F.struct(
            shown.alias("investee_name"), raw.alias("investee_ticker_raw"), ticker.alias("investee_ticker"),
            F.regexp_extract(text, pattern, 3).try_cast("double").alias("ownership_pct"),
            _number(F.regexp_extract(text, pattern, 4)).alias("mkt_cap_usd_mn"),
            _number(F.regexp_extract(text, pattern, 5)).alias("value_to_parent_hkd_mn")))

    parts = F.struct(F.trim(F.regexp_extract(text, pattern, 1)).alias("name"), F.trim(F.regexp_extract(text, pattern, 2)).alias("raw"))
    return _let(_let(parts, peeled), named)


def extract_stake_table(df: DataFrame, text: str = "text") -> DataFrame:
    """Named stakes between the table heading and its totals, from table lines and from running text."""
    lines = F.filter(F.transform(F.split(F.col(text), r"\r?\n"), lambda l: F.trim(F.regexp_replace(l, r"\s+", " "))),
                     lambda l: l != "")
    staged = df.withColumn("_lines", lines)

    def heading(l):
        low = F.lower(l)
        return (low.contains("strategic investment") & (low.contains("stake") | low.contains("mkt cap") | low.contains("ticker"))) | (
            low.contains("tencent's stake") & low.contains("mkt cap"))

    start = F.array_position(F.transform("_lines", heading), F.lit(True))
    row_start = F.array_position(F.transform("_lines", lambda l: l.rlike(pat.STAKE_ROW) & F.lower(l).contains("pdd")), F.lit(True))
    first = F.when(start > 0, start + 1).when(row_start > 0, F.greatest(row_start, F.lit(2)))
    staged = staged.withColumn("_body", F.when(first.isNotNull(), F.slice(
        "_lines", first.cast("int"), F.greatest(F.size("_lines"), F.lit(1)))))

    def stop(l):
        low = F.lower(l)
        return reduce(lambda a, b: a | b, [low.startswith(s) for s in pat.STAKE_STOPS])

    def walk(frame, items, row, name):
        """``frame`` with the rows up to the first stop that follows a row; flags and places are columns, made once."""
        kinds = F.transform(items, lambda l: F.when(stop(l), 1).when(l.rlike(row), 2).otherwise(0))
        flagged = frame.withColumn("_kinds", kinds).withColumn("_row", F.array_position("_kinds", F.lit(2)))
        after = F.array_position(F.slice("_kinds", (F.col("_row") + 1).cast("int"), F.size("_kinds")), F.lit(1))
        ended = flagged.withColumn("_stop", F.when((F.col("_row") > 0) & (after > 0), F.col("_row") + after).otherwise(F.size("_kinds") + 1))
        pairs = F.arrays_zip(items.alias("item"), F.col("_kinds").alias("kind"))
        kept = F.filter(pairs, lambda p, i: (p["kind"] == 2) & (i + 1 < F.col("_stop")))
        return ended.withColumn(name, F.transform(kept, lambda p: p["item"])).drop("_kinds", "_row", "_stop")

    staged = staged.withColumn("_body", F.coalesce("_body", F.array().cast("array<string>")))
    staged = walk(staged, F.col("_body"), pat.STAKE_ROW, "_rows")
    staged = staged.withColumn("_table", F.array_compact(F.transform("_rows", lambda l: _stake_struct(l, pat.STAKE_ROW))))
    blob = F.regexp_replace(F.col(text), r"\s+", " ")
    title = "valuation of strategic investments"
    titled = F.locate(title, F.lower(blob)) > 0
    after = F.when(titled, F.substr(blob, F.locate(title, F.lower(blob)) + len(title), F.length(blob))).otherwise(blob)
    # Stakes and stops of the running text in order; a text without heading and table lines has no section to close.
    closing = r"(?i:\b(?:" + "|".join(pat.STAKE_STOPS) + "))"
    marks = F.regexp_extract_all(after, F.lit(f"{pat.STAKE_INLINE}|{closing}"), F.lit(0))
    staged = walk(staged.withColumn("_marks", marks), F.col("_marks"), pat.STAKE_INLINE, "_inside")
    found = F.when(titled | (F.size("_table") > 0), F.col("_inside")).otherwise(F.filter("_marks", lambda m: ~stop(m)))
    inline = F.array_compact(F.transform(found, lambda m: _stake_struct(m, pat.STAKE_INLINE)))
    none = F.array().cast(staged.schema["_table"].dataType)
    staged = staged.withColumn("_all", F.concat(F.col("_table"), F.coalesce(inline, none)))
    # Lines come first, so of several hits of one ticker the line wins, then the first inline hit: hits are sorted by
    # name and place, and one counts where the name before it is another.
    keyed = F.array_sort(F.transform("_all", lambda x, i: F.struct(
        F.coalesce(x["investee_ticker"], x["investee_name"]).alias("name"), i.alias("place"), x.alias("hit"))))
    staged = staged.withColumn("_keyed", keyed)
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform("_keyed", lambda k: k["name"]))
    paired = F.arrays_zip(F.col("_keyed").alias("own"), before.alias("before"))
    once = F.filter(paired, lambda p: p["own"].isNotNull() & ~p["own"]["name"].eqNullSafe(p["before"]))
    keep = [c for c in df.columns if c != text]
    return staged.select(*keep, F.inline(F.transform(once, lambda p: p["own"]["hit"])))


# Parsers of published tables by name: each maps a frame of texts to a frame of stakes.
STAKE_PARSERS = {"cmbigm_strategic_investments": extract_stake_table}


# -- small extractors ----------------------------------------------------------------------------

def period_of_report(body) -> Column:
    """Report period in a filing header, as MM-DD-YYYY or ISO date."""
    value = F.regexp_extract(_as_col(body), pat.REPORT_PERIOD, 1)
    us = r"^(\d{1,2})-(\d{1,2})-(\d{4})"
    american = F.concat(F.regexp_extract(value, us, 3), F.lit("-"), F.lpad(F.regexp_extract(value, us, 1), 2, "0"),
                        F.lit("-"), F.lpad(F.regexp_extract(value, us, 2), 2, "0")).try_cast("date")
    iso = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(value, 1, 10).try_cast("date"))
    return F.coalesce(F.when(value.rlike(us), american), iso)


def reconstitution_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """``COMPANY  TICKER  INDUSTRY`` lines of an index change list."""
    keep = [c for c in df.columns if c != text]
    hits = F.regexp_extract_all(F.col(text), F.lit(pat.RECONSTITUTION_ROW), F.lit(0))
    rows = df.select(*keep, F.explode_outer(hits).alias("_l")).where(F.col("_l").isNotNull())
    return rows.select(*keep, *[
        F.trim(F.regexp_extract("_l", pat.RECONSTITUTION_ROW, i)).alias(n)
        for i, n in enumerate(("company", "ticker", "industry"), 1)])
