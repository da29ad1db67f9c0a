import datetime as dt
import random

import pytest

from posledger.operators import asof
from tests.helpers import collect, day


def brute(left, right, direction):
    out = []
    for k, t in left:
        c = [(rt, v) for rk, rt, v in right if rk == k and (rt <= t if direction == "backward" else rt >= t)]
        out.append((k, t, *(max(c) if direction == "backward" and c else min(c) if c else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["date", "timestamp"])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_hot_key_matches_brute_force(spark, kind, direction):
    rng = random.Random(4)

    def t():
        base = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 20))
        return base.date() if kind == "date" else base

    # One key holds most rows on both sides.
    left = sorted({(rng.choice("AAAAAB"), t()) for _ in range(150)})
    right = list({(k, w): (k, w, float(i)) for i, (k, w) in enumerate((rng.choice("AAAAAC"), t()) for _ in range(60))}.values())
    lt = spark.createDataFrame(left, f"k string, t {kind}")
    rt = spark.createDataFrame(right, f"k string, r {kind}, v double").repartition(5)
    got = sorted((tuple(x) for x in asof.asof_join(lt, rt, "k", "t", "r", direction).collect()), key=str)
    assert got == brute(left, right, direction)


def test_nearest_tie_goes_backward_and_tolerance(spark):
    lt = spark.createDataFrame([("A", day("2024-01-10")), ("A", day("2025-01-01"))], "k string, t date")
    rt = spark.createDataFrame([("A", day("2024-01-05"), 1.0), ("A", day("2024-01-15"), 2.0)], "k string, r date, v double")
    got = collect(asof.asof_join(lt, rt, "k", "t", "r", "nearest", tolerance_days=100), "t")
    assert [r["v"] for r in got] == [1.0, None]


def test_first_after_is_strict(spark):
    lt = spark.createDataFrame([("A", day("2024-01-05")), ("B", day("2024-01-05"))], "k string, t date")
    rt = spark.createDataFrame([("A", day("2024-01-05")), ("A", day("2024-02-05"))], "k string, r date")
    got = {r["k"]: r["x"] for r in collect(asof.first_after(lt, rt, "k", "t", "r", "x"))}
    assert got == {"A": day("2024-02-05"), "B": None}


def test_last_close_window_and_forward_bar(spark):
    rows = [("A", day("2024-03-10")), ("B", day("2024-03-10")), ("C", day("2024-03-10")), ("D", day("2024-03-10"))]
    bars = [("A", day("2024-03-01"), 5.0), ("B", day("2024-01-01"), 6.0), ("B", day("2024-03-11"), 7.0),
            ("C", day("2024-03-20"), 8.0), ("D", day("2024-03-09"), 0.0)]
    got = {r["k"]: (r["market_price"], r["price_as_of"]) for r in collect(asof.last_close(
        spark.createDataFrame(rows, "k string, t date"), spark.createDataFrame(bars, "k string, date date, close double"), "k", "t"))}
    assert got == {"A": (5.0, day("2024-03-01")), "B": (7.0, day("2024-03-11")), "C": (None, None), "D": (None, None)}


def test_unknown_is_not_a_loss(spark):
    lt = spark.createDataFrame([("A", day("2024-01-01")), ("A", day("2024-06-01")), ("B", day("2024-06-01"))], "k string, t date")
    rt = spark.createDataFrame([("A", day("2024-03-01"), -1.0), ("B", day("2024-03-01"), 2.0)], "k string, filed date, net double")
    got = {(r["k"], str(r["t"])): r["p"] for r in collect(asof.positive_as_of(lt, rt, "k", "t", "filed", "net", "p"))}
    assert got == {("A", "2024-01-01"): None, ("A", "2024-06-01"): False, ("B", "2024-06-01"): True}


def test_many_sides_in_one_pass_match_brute_force(spark):
    """Each side and direction as if joined alone, for a hot key, ties of a day, missing keys and missing dates."""
    rng = random.Random(6)
    days = [day("2024-01-01") + dt.timedelta(days=i) for i in range(40)]
    left = [(rng.choice("AAAAB"), rng.choice(days)) for _ in range(60)] + [("C", days[3]), ("A", None)]
    sides = {n: [(rng.choice("AAAAB"), rng.choice(days), float(i)) for i in range(25)] for n in ("x", "y", "z")}
    frames = {n: spark.createDataFrame(r, f"k string, {n}_day date, v double").repartition(3) for n, r in sides.items()}
    got = asof.asof_join_many(spark.createDataFrame(left, "k string, t date"), "k", "t", {
        "x": asof.Side(frames["x"], "x_day", ("v",)), "y": asof.Side(frames["y"], "y_day", ("v",), "forward"),
        "z": asof.Side(frames["z"], "z_day", ("v",), "nearest", 4)}).collect()

    def hit(k, t, rows, direction):
        back = [(d, v) for q, d, v in rows if q == k and t is not None and d <= t]
        ahead = [(d, v) for q, d, v in rows if q == k and t is not None and d >= t]
        before, after = max(back, default=None), min(ahead, default=None)
        if direction != "nearest":
            return before if direction == "backward" else after
        best = min([h for h in (before, after) if h], key=lambda h: (abs((h[0] - t).days), h is after and h is not before), default=None)
        return best if best and abs((best[0] - t).days) <= 4 else None

    want = sorted(((k, t, *(hit(k, t, sides[n], d) for n, d in (("x", "backward"), ("y", "forward"), ("z", "nearest")))) for k, t in left), key=str)
    assert sorted(((r.k, r.t, *(None if r[n] is None else tuple(r[n]) for n in "xyz")) for r in got), key=str) == want


def test_both_directions_share_one_window_exchange(spark):
    lt = spark.createDataFrame([("A", day("2024-01-10"))], "k string, t date")
    rt = spark.createDataFrame([("A", day("2024-01-05"), 1.0)], "k string, r date, v double")
    plan = asof.asof_join(lt, rt, "k", "t", "r", "nearest")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_many_sides_carry_forward_in_one_pass_over_a_key(spark):
    """A window frame that ends at the last row is read anew for every row of a key."""
    rng = random.Random(3)
    days = [day("2024-01-01") + dt.timedelta(days=i) for i in range(300)]
    left = [("A", d) for d in days]
    right = list({d: ("A", d, float(i)) for i, d in enumerate(rng.choices(days, k=80))}.values())
    rt = spark.createDataFrame(right, "k string, r date, v double")
    got = asof.asof_join_many(spark.createDataFrame(left, "k string, t date"), "k", "t", {
        "b": asof.Side(rt, "r", ("v",)), "f": asof.Side(rt, "r", ("v",), "forward")})
    assert "UNBOUNDED FOLLOWING" not in got._jdf.queryExecution().optimizedPlan().toString().upper().replace("UNBOUNDEDFOLLOWING", "UNBOUNDED FOLLOWING")
    for name, direction in (("b", "backward"), ("f", "forward")):
        rows = sorted(((r["k"], r["t"], *(r[name] or (None, None))) for r in got.collect()), key=str)
        assert rows == brute(left, right, direction)
