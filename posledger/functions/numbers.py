"""Numeric rules: tolerant parsing, ratios, returns and order-independent money sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from posledger.functions.text import append_tag
from posledger.sources import fixed_values as fixed

MONEY_SCALE = 10_000


def _as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value) -> Column:
    """Double or NULL: text that is not a number, blanks and NaN are missing."""
    x = F.trim(_as_col(value).cast("string")).try_cast("double")
    return F.when(~F.isnan(x), x)


def digits_number(value) -> Column:
    """Number from text after dropping everything but digits and dots."""
    return F.regexp_replace(F.coalesce(_as_col(value), F.lit("")), "[^0-9.]", "").try_cast("double")


def to_fixed(value) -> Column:
    """Money as an exact integer of 1/10,000: sums no longer depend on the order of rows."""
    return F.floor(_as_col(value) * F.lit(float(MONEY_SCALE)) + F.lit(0.5)).cast("decimal(20,0)")


def from_fixed(value) -> Column:
    return _as_col(value).cast("double") / F.lit(float(MONEY_SCALE))


def money_sum(value) -> Column:
    """Order-independent sum of a money column (NULL when nothing is summed)."""
    return from_fixed(F.sum(to_fixed(value)))


def money_sum_over(value, window) -> Column:
    return from_fixed(F.sum(to_fixed(value)).over(window))


def divide(a, b) -> Column:
    """Division that gives NULL for a zero or missing divisor."""
    b = _as_col(b)
    return F.when(b != 0, _as_col(a) / b)


def pct_capped(value) -> Column:
    """At most 100; an unknown percentage stays unknown."""
    value = _as_col(value)
    return F.when(value.isNotNull(), F.least(value, F.lit(100.0)))


def pct_complement(value) -> Column:
    value = _as_col(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.lit(100.0) - value))


def period_price(action, value, shares, value_prev, shares_prev) -> Column:
    """Money per share at the period end; an exit falls back on the previous row."""
    action, value, shares = _as_col(action), _as_col(value), _as_col(shares)
    value_prev, shares_prev = _as_col(value_prev), _as_col(shares_prev)
    own = F.when(shares > 0, value / shares)
    previous = F.when((action == "exit") & (shares_prev > 0), value_prev / shares_prev)
    return F.coalesce(own, previous)


def share_delta(action, delta, shares, shares_prev) -> Column:
    zero = F.lit(0.0)
    prev = F.coalesce(_as_col(shares_prev), zero)
    return F.coalesce(
        _as_col(delta),
        F.when(_as_col(action) == "exit", -prev).otherwise(
            F.coalesce(_as_col(shares), zero) - prev),
    )


def dietz(start, end, flow) -> Column:
    """Modified Dietz with the flow at mid-period; NULL for a vanishing base."""
    start, end, flow = _as_col(start), _as_col(end), _as_col(flow)
    base = start + flow / F.lit(2.0)
    return F.when(F.abs(base) >= 1e-6, (end - start - flow) / base)


def cagr(growth, years) -> Column:
    growth, years = _as_col(growth), _as_col(years)
    return F.when((years > 0) & (growth > 0), F.pow(growth, F.lit(1.0) / years) - F.lit(1.0))


def share_ratio(prev, cur) -> Column:
    """Whole consolidation factor R >= 2 when prev/cur is an integer within tolerance."""
    p, c = _as_col(prev), _as_col(cur)
    ratio = F.when((p > 0) & (c > 0) & (p > c), p / c)
    whole = F.rint(ratio)
    exact = (
        (whole >= 2)
        & (F.abs(ratio - whole) <= F.lit(1e-6) * F.greatest(F.lit(1.0), ratio))
        & (F.abs(p - whole * c) <= F.greatest(F.lit(1e-3), F.lit(1e-9) * p))
    )
    return F.when(exact, whole.cast("int"))


def to_usd(amount_mn, rate=None, fallback: float = fixed.HKD_PER_USD_FALLBACK) -> Column:
    """Millions of local currency to USD at ``rate`` local per USD (fallback when unusable)."""
    fx = F.lit(fallback) if rate is None else F.when(_as_col(rate) > 0, _as_col(rate)).otherwise(
        F.lit(fallback))
    return _as_col(amount_mn) * F.lit(1e6) / fx


def holding_periods(opened, closed) -> Column:
    """Calendar quarters between two period ends, rounded, never negative."""
    o, c = _as_col(opened), _as_col(closed)
    months = (F.year(c) - F.year(o)) * 12 + (F.month(c) - F.month(o))
    return F.greatest(F.lit(0), F.rint(months / F.lit(3.0)).cast("int"))


def looks_like_pct_as_shares(shares, pct) -> Column:
    """A share count that merely repeats the ownership percentage."""
    return _repeats_pct(to_number(shares), to_number(pct))


def _repeats_pct(s: Column, p: Column) -> Column:
    hit = (s > 0) & (s <= 100) & (p > 0) & (p <= 100) & (F.abs(s - p) < 1e-6)
    return F.coalesce(hit, F.lit(False))


def scrub_pct_as_shares(df, shares="shares_held", pct="ownership_pct", note="note"):
    """Blank such share counts and tag the row."""
    # A double is its own number: written out and read again it is the same, at many times the cost.
    s, p = (F.when(~F.isnan(c), F.col(c)) if df.schema[c].dataType.typeName() == "double" else to_number(c) for c in (shares, pct))
    bad = _repeats_pct(s, p)
    return df.withColumns({
        shares: F.when(~bad, F.col(shares)),
        note: F.when(bad, append_tag(note, "scrubbed_shares_eq_ownership_pct")).otherwise(F.col(note)),
    })
