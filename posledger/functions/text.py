"""String rules: tickers, names, identity keys, filing URLs and ``k=v`` note tags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from posledger.sources import fixed_values as fixed


def _as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_null(value) -> Column:
    """Trimmed text; blanks and the textual spellings of missing become NULL."""
    text = F.trim(_as_col(value).cast("string"))
    return F.when(~F.lower(text).isin("", *fixed.MISSING_TEXTS), text)


def normalize_ticker(value) -> Column:
    """Upper-case ticker or NULL."""
    return F.upper(clean_null(value))


def dash_share_class(value) -> Column:
    """``BRK.B`` -> ``BRK-B``; exchange suffixes (.HK, .US, .L) stay."""
    t = F.upper(F.trim(_as_col(value)))
    return F.when(t.rlike(r"\.(HK|US|L)$"), t).otherwise(F.translate(t, ".", "-"))


def squeeze_name(value) -> Column:
    """Lower-case letters and digits only (identity of last resort)."""
    return F.regexp_replace(F.lower(F.coalesce(_as_col(value), F.lit(""))), "[^a-z0-9]", "")


def holding_key(ticker, cusip, name) -> Column:
    """Identity across periods: ticker, then CUSIP, then squeezed name; NULL when none."""
    t = normalize_ticker(ticker)
    c = F.nullif(F.upper(F.trim(_as_col(cusip))), F.lit(""))
    n = F.nullif(squeeze_name(name), F.lit(""))
    return F.coalesce(
        F.concat(F.lit("t:"), t), F.concat(F.lit("c:"), c), F.concat(F.lit("n:"), n)
    )


def ledger_ticker(ticker, name) -> Column:
    """Grouping key of the performance layer: ticker, else upper-cased name."""
    return F.coalesce(
        normalize_ticker(ticker), F.nullif(F.upper(F.trim(_as_col(name))), F.lit(""))
    )


def clean_issuer_name(value) -> Column:
    """Drop cover-page boilerplate in front of an issuer name unless only a suffix is left."""
    raw = F.nullif(F.trim(_as_col(value)), F.lit(""))
    cut = F.btrim(F.regexp_replace(raw, fixed.COVER_PAGE_PREFIX, ""), F.lit(" ,;-"))
    # Cut once: the filter drops a cut that leaves no name.
    kept = F.filter(F.array(cut), lambda c: (c != "") & ~F.lower(c).isin(*fixed.BARE_COMPANY_SUFFIXES))
    return F.coalesce(F.get(kept, F.lit(0)), raw)


def private_ticker(name) -> Column:
    """``PRIV_`` identity for an unlisted name (never an exchange symbol)."""
    slug = F.regexp_replace(F.lower(F.coalesce(_as_col(name), F.lit(""))), "[^a-z0-9]+", "_")
    slug = F.upper(F.btrim(slug, F.lit("_")))
    return F.when(slug != "", F.concat(F.lit("PRIV_"), slug)).otherwise(F.lit("PRIV_UNKNOWN"))


def exchange_ticker(raw, name=None, name_lookup: Column | None = None) -> Column:
    """Broker-table symbols: ``780 HK`` -> ``0780.HK``, ``1234 JP`` -> ``1234.T``, and so on.

    ``name_lookup`` is an already joined symbol for the name (see identity.lookup_names). A bare
    exchange code is never a ticker: the joined symbol wins, else the code stuck to the name.
    """
    text = F.trim(F.regexp_replace(F.coalesce(_as_col(raw), F.lit("")), r"\s+", " "))
    name_text = F.coalesce(_as_col(name), F.lit("")) if name is not None else F.lit("")
    lookup = name_lookup if name_lookup is not None else F.lit(None).cast("string")
    exchanges = "|".join(fixed.EXCHANGE_CODES)

    def suffix(code: Column, exchange: Column) -> Column:
        return (
            F.when(exchange == "US", F.upper(code))
            .when(exchange == "HK", F.concat(
                F.when(code.rlike(r"^\d+$"), F.lpad(code, 4, "0")).otherwise(code), F.lit(".HK")))
            .when(exchange == "JP", F.concat(code, F.lit(".T")))
            .when(exchange.isin("CH", "SZ", "SS"), F.concat(
                code, F.when(code.startswith("0"), F.lit(".SZ")).otherwise(F.lit(".SS"))))
            .otherwise(F.concat(code, F.lit("."), exchange))
        )

    two = rf"^(\S+) ({exchanges})$"
    tail = rf"(?i)(\d{{3,6}})\s+({exchanges})\s*$"
    bare = F.upper(text).rlike(rf"^({exchanges})$")
    tail_code = F.regexp_extract(name_text, tail, 1)
    tail_exchange = F.upper(F.regexp_extract(name_text, tail, 2))
    return (
        F.when(bare, F.coalesce(
            lookup, F.when(tail_code != "", suffix(tail_code, tail_exchange)), F.upper(text)))
        .when(text.rlike(two), suffix(F.regexp_extract(text, two, 1), F.regexp_extract(text, two, 2)))
        .otherwise(F.coalesce(lookup, F.translate(text, " ", ".")))
    )


def cik_strip(value) -> Column:
    digits = F.regexp_replace(F.coalesce(_as_col(value).cast("string"), F.lit("")), r"\D", "")
    return F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.lit("0"))


def cik_pad(value) -> Column:
    return F.lpad(cik_strip(value), 10, "0")


def filing_url(cik, accession, existing=None) -> Column:
    """Index page of a filing from CIK and accession; a proper existing URL is kept."""
    acc = F.trim(_as_col(accession).cast("string"))
    number = cik_strip(cik)
    ok = (
        _as_col(cik).isNotNull() & (number != "0")
        & acc.isNotNull() & ~F.lower(acc).isin("", "nan", "none", "null")
    )
    built = F.when(ok, F.concat(
        F.lit(fixed.FILING_INDEX_ROOT), number, F.lit("/"), F.translate(acc, "-", ""),
        F.lit("/"), acc, F.lit("-index.htm")))
    if existing is None:
        return built
    url = F.trim(_as_col(existing))
    good = url.startswith("http") & ~F.lower(url).contains("nan")
    return F.when(F.coalesce(good, F.lit(False)), _as_col(existing)).otherwise(built)


# -- note tags ---------------------------------------------------------------------------------

def note_text(note) -> Column:
    return F.coalesce(_as_col(note), F.lit(""))


def has_tag(note, *fragments: str) -> Column:
    """Any of the fragments occurs in the note (case-sensitive)."""
    text = note_text(note)
    hit = F.lit(False)
    for fragment in fragments:
        hit = hit | text.contains(fragment)
    return hit


def append_tag(note, fragment, unless: str | None = None) -> Column:
    """Idempotent ``; ``-separated append; ``unless`` is an alternative marker to look for."""
    text = F.trim(note_text(note))
    frag = fragment if isinstance(fragment, Column) else F.lit(fragment)
    marker = F.lit(unless) if unless is not None else frag
    joined = F.when(text == "", frag).otherwise(F.concat(text, F.lit("; "), frag))
    return F.when(text.contains(marker), text).otherwise(joined)


def append_tags(note, *tags: tuple) -> Column:
    """Append several ``(condition, fragment, marker)`` tags; a tag whose marker is there is skipped.

    One flat concatenation, so the expression grows with the number of tags only.
    """
    base = _as_col(note)
    text = F.coalesce(base, F.lit(""))
    parts = [
        F.when(condition & ~text.contains(marker), fragment if isinstance(fragment, Column) else F.lit(fragment))
        for condition, fragment, marker in tags
    ]
    joined = F.concat_ws("; ", F.nullif(F.trim(text), F.lit("")), *parts)
    return F.when(joined != "", joined).otherwise(base)


def extract_tag(note, key: str, pattern: str = r"[^;\s]+") -> Column:
    return F.nullif(F.regexp_extract(note_text(note), f"{key}=({pattern})", 1), F.lit(""))


def note_map(note) -> Column:
    """All ``k=v`` tags of a legacy note as a map."""
    return F.str_to_map(note_text(note), F.lit("; "), F.lit("="))


def is_overlay_note(note) -> Column:
    """Ownership filings and annual notes overlay the grid; they never invent exit money."""
    text = F.lower(note_text(note))
    hit = F.lit(False)
    for marker in fixed.OVERLAY_MARKERS:
        hit = hit | text.contains(marker)
    return hit


def infer_value_source(note) -> Column:
    """Where a row's money came from; ownership filings are not a money source."""
    text = note_text(note)
    tag = F.nullif(F.regexp_extract(text, "value_source=([a-z0-9_]+)", 1), F.lit(""))
    return (
        F.when(text.contains("value_source=broker_sotp"), F.lit("broker_sotp"))
        .when(has_tag(text, "value_source=hk_annual_note22", "source=hk_annual"),
              F.lit("hk_annual_note22"))
        .when(has_tag(text, "value_source=13f", "source=13f"), F.lit("13f"))
        .when(has_tag(text, "source=13g", "form=SC 13", "SCHEDULE 13"),
              F.lit(None).cast("string"))
        .otherwise(tag)
    )
