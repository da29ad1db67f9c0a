"""As-of, nearest and first-after joins that stay balanced when one key is hot.

Both sides are cut into time buckets. The right side is folded to one row per (key, bucket) with
a map-side combine, the buckets of a key are linked by a small carry window (one row per bucket),
and only then do left rows look inside their own bucket. No task ever holds a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

_T, _B, _P = "__t", "__bucket", "__payload"


def _is_date(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "date"


def _bucket(ts: Column, is_date: bool, unit: str) -> Column:
    return ts if is_date else F.date_trunc(unit, ts)


def _fold(right: DataFrame, by: Sequence[str], forward: bool) -> DataFrame:
    """One carry row per key and bucket: the last (or first) payload inside the bucket."""
    pick = F.min_by if forward else F.max_by
    order = F.struct(_T, _P)
    return right.groupBy(*by, _B).agg(pick(F.struct(F.col(_T), F.col(_P)), order).alias("__in"))


def _carry(folded: DataFrame, left_buckets: DataFrame, by: Sequence[str], forward: bool) -> DataFrame:
    """For every key and bucket: what the bucket holds and what lies beyond it."""
    all_buckets = folded.unionByName(left_buckets, allowMissingColumns=True)
    merged = all_buckets.groupBy(*by, _B).agg(F.first("__in", ignorenulls=True).alias("__in"))
    if forward:
        w = Window.partitionBy(*by).orderBy(F.col(_B).desc())
    else:
        w = Window.partitionBy(*by).orderBy(_B)
    outside = F.last("__in", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return merged.withColumn("__out", outside)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    left_on: str,
    right_on: str,
    direction: str = "backward",
    columns: Sequence[str] | None = None,
    tolerance_days: int | None = None,
    allow_exact: bool = True,
    bucket: str = "hour",
) -> DataFrame:
    """Left join on the latest right row at or before (``backward``), the earliest at or after
    (``forward``) or the closest (``nearest``, a tie goes backward) in time within each key.

    ``columns`` are taken from the right side next to ``right_on``; unmatched rows get NULL.
    Right rows sharing a time are resolved by their column values, so the result does not depend
    on input order. ``bucket`` is the width used for timestamps; dates use the day itself.
    """
    by = [by] if isinstance(by, str) else list(by)
    columns = [c for c in (columns or right.columns) if c not in (*by, right_on)]
    if direction == "nearest":
        return _nearest(left, right, by, left_on, right_on, columns, tolerance_days, bucket)
    forward = direction == "forward"
    is_date = _is_date(left, left_on) and _is_date(right, right_on)

    rhs = right.where(F.col(right_on).isNotNull()).select(
        *by, F.col(right_on).alias(_T), F.struct(F.lit(1).alias("__x"), *columns).alias(_P),
    ).withColumn(_B, _bucket(F.col(_T), is_date, bucket))
    lhs = left.withColumn(_B, _bucket(F.col(left_on), is_date, bucket))

    carry = _carry(_fold(rhs, by, forward), lhs.select(*by, _B).distinct(), by, forward)

    if is_date:
        # A bucket is one day: the fold already is the answer for every row of that day.
        found = F.coalesce(F.col("__in"), F.col("__out")) if allow_exact else F.col("__out")
        joined = _join_on(lhs, carry, by)
        out = joined.withColumn("__hit", found)
    else:
        out = _inside_bucket(lhs, rhs, carry, by, left_on, forward, allow_exact)

    hit = F.col("__hit")
    if tolerance_days is not None:
        gap = F.abs(F.datediff(F.col(left_on), hit[_T]))
        out = out.withColumn("__hit", F.when(gap <= tolerance_days, hit))
    return out.select(
        *[F.col(c) for c in left.columns],
        F.col("__hit")[_T].alias(right_on),
        *[F.col("__hit")[_P][c].alias(c) for c in columns],
    )


def _join_on(lhs: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    return lhs.join(carry, [*by, _B], "left")


def _inside_bucket(lhs, rhs, carry, by, left_on, forward, allow_exact) -> DataFrame:
    """Rows of one (key, bucket) only: union, order by time, take the neighbour."""
    left_rows = lhs.select(
        *by, _B, F.col(left_on).alias(_T), F.struct(*lhs.columns).alias("__row"))
    right_rows = rhs.select(*by, _B, _T, _P)
    both = left_rows.unionByName(right_rows, allowMissingColumns=True)
    is_right = F.col("__row").isNull()
    # Exact matches count when the right row sorts before the left row in scan direction.
    side = F.when(is_right, 0).otherwise(1) if allow_exact else F.when(is_right, 1).otherwise(0)
    time = F.col(_T).desc() if forward else F.col(_T).asc()
    payload = F.col(_P).desc() if forward else F.col(_P).asc()
    w = (
        Window.partitionBy(*by, _B).orderBy(time, side, payload)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    near = F.last(F.when(is_right, F.struct(F.col(_T), F.col(_P))), ignorenulls=True).over(w)
    probed = both.withColumn("__near", near).where(F.col("__row").isNotNull())
    joined = probed.join(carry.select(*by, _B, "__out"), [*by, _B], "left")
    return joined.select(
        *[F.col("__row")[c].alias(c) for c in lhs.columns],
        F.coalesce("__near", "__out").alias("__hit"),
    )


def dealt(rows: DataFrame, *by: str) -> DataFrame:
    """The rows dealt out by ``by`` over all shuffle partitions.

    Narrow rows pack so well that adaptive execution lays very many of them into one task, which then sorts or hashes
    them all; a given number of partitions is kept as it is.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


@dataclass(frozen=True)
class Side:
    """A dated series to look up: its rows, their date and the columns wanted."""

    rows: DataFrame
    on: str
    columns: tuple[str, ...] = ()
    #: ``backward``, ``forward`` or ``nearest`` (a tie goes backward).
    direction: str = "backward"
    tolerance_days: int | None = None


def asof_join_many(left: DataFrame, by: str | Sequence[str], left_on: str, sides: dict[str, Side]) -> DataFrame:
    """``left`` with one struct per side: the date and the columns of the row that counts as of ``left_on``, or NULL.

    All sides and both directions are carried in one pass: rows of all series are folded to one row per key and day,
    one window over the days of a key carries every side, and the left rows are joined once. Dates only; rows of one
    side and day are resolved by their column values. As in ``asof_join`` no task holds more than the days of a key.
    """
    by = [by] if isinstance(by, str) else list(by)
    body = {n: F.struct(F.col(s.on).alias(s.on), *[c for c in s.columns if c != s.on]) for n, s in sides.items()}
    marks = dealt(left.where(F.col(left_on).isNotNull()).select(*by, F.col(left_on).alias(_B)), *by, _B).distinct()
    rows = None
    for name, side in sides.items():
        known = side.rows.where(F.col(side.on).isNotNull())
        dated = known.select(*by, F.col(side.on).alias(_B), body[name].alias(name))
        rows = dated if rows is None else rows.unionByName(dated, allowMissingColumns=True)
    # Of several rows of a day the last counts looking back and the first looking ahead, as in asof_join.
    back, ahead = ([n for n, s in sides.items() if s.direction != d] for d in ("forward", "backward"))
    days = rows.groupBy(*by, _B).agg(*[F.max(n).alias(f"__b_{n}") for n in back], *[F.min(n).alias(f"__a_{n}") for n in ahead])
    # The days asked for carry nothing, so they join after the fold; on a day they follow its rows in both directions.
    asked = days.withColumn("__asked", F.lit(False)).unionByName(marks.withColumn("__asked", F.lit(True)), allowMissingColumns=True)
    # Both frames grow from the start: one that ends at the last day would be read anew for every day of a key.
    before, after = (Window.partitionBy(*by).orderBy(o, "__asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
                     for o in (F.col(_B).asc(), F.col(_B).desc()))
    carried = asked.select(
        *by, _B, "__asked", *[F.last(f"__b_{n}", ignorenulls=True).over(before).alias(f"__before_{n}") for n in back],
        *[F.last(f"__a_{n}", ignorenulls=True).over(after).alias(f"__after_{n}") for n in ahead]).where("__asked").drop("__asked")
    joined = left.withColumn(_B, F.col(left_on)).join(carried, [*by, _B], "left")
    return joined.select(*left.columns, *[_counting(n, s, left_on).alias(n) for n, s in sides.items()])


def _counting(name: str, side: Side, left_on: str) -> Column:
    """The row of a side that counts: of the carried ones the closer, if it is close enough."""
    gap = lambda hit: F.abs(F.datediff(F.col(left_on), hit[side.on]))
    if side.direction == "nearest":
        before, after = F.col(f"__before_{name}"), F.col(f"__after_{name}")
        hit = F.when(before.isNotNull() & (after.isNull() | (gap(before) <= gap(after))), before).otherwise(after)
    else:
        hit = F.col(f"__{'before' if side.direction == 'backward' else 'after'}_{name}")
    return hit if side.tolerance_days is None else F.when(gap(hit) <= side.tolerance_days, hit)


def _nearest(left, right, by, left_on, right_on, columns, tolerance_days, bucket) -> DataFrame:
    if _is_date(left, left_on) and _is_date(right, right_on):
        side = Side(right, right_on, tuple(columns), "nearest", tolerance_days)
        hit = asof_join_many(left, by, left_on, {"__hit": side})
        return hit.select(*left.columns, *[F.col("__hit")[c].alias(c) for c in (right_on, *columns)])
    back = asof_join(
        left, right, by, left_on, right_on, "backward", columns, None, True, bucket)
    packed = back.select(
        *left.columns, F.struct(F.col(right_on).alias(_T), *columns).alias("__before"))
    ahead = asof_join(
        packed, right, by, left_on, right_on, "forward", columns, None, True, bucket)
    after = F.struct(F.col(right_on).alias(_T), *columns)
    both = ahead.select(*left.columns, "__before", after.alias("__after"))

    def gap(side):
        micros = F.unix_micros(F.col(left_on).cast("timestamp")) - F.unix_micros(
            F.col(side)[_T].cast("timestamp"))
        return F.abs(micros)

    use_before = F.col("__after")[_T].isNull() | (gap("__before") <= gap("__after"))
    pick = F.when(F.col("__before")[_T].isNotNull() & use_before, F.col("__before")).otherwise(
        F.col("__after"))
    out = both.withColumn("__hit", pick)
    if tolerance_days is not None:
        micros = F.abs(
            F.unix_micros(F.col(left_on).cast("timestamp"))
            - F.unix_micros(F.col("__hit")[_T].cast("timestamp")))
        out = out.withColumn(
            "__hit", F.when(micros <= F.lit(tolerance_days * 86_400_000_000), F.col("__hit")))
    return out.select(
        *left.columns, F.col("__hit")[_T].alias(right_on),
        *[F.col("__hit")[c].alias(c) for c in columns],
    )


def first_after(left: DataFrame, right: DataFrame, by, left_on: str, right_on: str,
                name: str) -> DataFrame:
    """Earliest right time strictly after the left time, NULL when there is none."""
    by = [by] if isinstance(by, str) else list(by)
    hit = asof_join(
        left, right.select(*by, F.col(right_on).alias(name)), by, left_on, name,
        "forward", columns=[], allow_exact=False)
    return hit


def last_close(left: DataFrame, prices: DataFrame, by, left_on: str, date: str = "date",
               close: str = "close", days_back: int = 21, days_ahead: int = 1) -> DataFrame:
    """Close on or before a date within ``days_back``; else the first bar just after it.

    A picked bar without a positive price gives no price at all.
    """
    by = [by] if isinstance(by, str) else list(by)
    bars = prices.select(*by, F.col(date).alias("__d"), F.col(close).alias("__c"))
    both = asof_join_many(left, by, left_on, {
        "__before": Side(bars, "__d", ("__c",), "backward", days_back), "__after": Side(bars, "__d", ("__c",), "forward", days_ahead)})
    bar = F.coalesce("__before", "__after")
    return both.select(
        *left.columns,
        F.when(bar["__c"] > 0, bar["__d"]).alias("price_as_of"),
        F.when(bar["__c"] > 0, bar["__c"]).alias("market_price"),
    )


def lookup_value(left: DataFrame, series: DataFrame, by, left_on: str, right_on: str, value: str,
                 fallback: str = "none", current: str | None = None) -> DataFrame:
    """Scalar as-of lookup: latest value at or before; ``fallback="forward"`` then tries the first
    value after and finally the ``current`` column of the left frame."""
    by = [by] if isinstance(by, str) else list(by)
    if fallback == "none":
        return asof_join(left, series, by, left_on, right_on, "backward", columns=[value])
    hit = asof_join_many(left, by, left_on, {
        "__before": Side(series, right_on, (value,)), "__after": Side(series, right_on, (value,), "forward")})
    last = F.col(current) if current else F.lit(None)
    return hit.select(
        *left.columns,
        F.coalesce(F.col("__before")[right_on], F.col("__after")[right_on]).alias(right_on),
        F.coalesce(F.col("__before")[value], F.col("__after")[value], last).alias(value),
    )


def positive_as_of(left: DataFrame, series: DataFrame, by, left_on: str, right_on: str,
                   value: str, name: str) -> DataFrame:
    """Three-valued sign of the latest known value: true, false, or NULL when unknown."""
    hit = lookup_value(left, series, by, left_on, right_on, value)
    return hit.withColumn(name, F.col(value) > 0)
