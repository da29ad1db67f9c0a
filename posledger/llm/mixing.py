"""Mixing sources to target weights by cube-method balanced sampling.

A source is to contribute ``target`` words, a multiple r of what it has. Every document of it is taken
floor(r) times, and once more with inclusion probability r - floor(r). That last pick is drawn by the cube
method: probabilities move through the null-space of the balancing constraints, so that the expected number
of documents *and* of words of the source stays exact at every step, until each lies at 0 or 1.

The flight is local: a source's rows are dealt to blocks, a block streams through with three undecided documents
at a time, and each step decides at least one of them. What a block cannot decide, at most two documents, goes to
the next level, which has a two-thousandth of the rows. A source that is down to one block leaves a landing problem
of at most two documents, which are rounded to the word total that misses the expectation least.

Defined results: a null text has size 0. Sources with a null name come last. A source without words has target 0
and its documents are not taken. Repeated rows are drawn apart from each other. The draw is seeded and rows are
put in a fixed order, so reruns agree. No document is taken more than ``MAX_REPEAT`` times.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from posledger.llm.common import text_of, unused, word_count
from posledger.sources.tables import stage

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = 17
BLOCK = 4096
EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets of a table (source, source_size), one row per source.

    Weights repeat over the sources in code-point order. Shares of the whole are capped at ``max_repeat`` times a
    source's size and the excess is shared again by weight. With sources sorted by size per weight, those below some
    place are capped and the rest divide what is left, so one pass of running sums finds the split. The table has a
    row per source, not per document, and is windowed without a key.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight.cast("long"), "cap": F.col("source_size") * max_repeat})
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    split = ranked.withColumns({
        "left": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "open_weight": F.sum("weight").over(after)})
    # Capped are the places whose cap is below their share of what the places before them leave.
    capped = F.col("cap") * F.col("open_weight") <= F.col("left") * F.col("weight")
    split = split.withColumn("capped", capped)
    first_open = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "rank", "left", "open_weight")))
    split = split.withColumn("level", first_open.over(whole))
    share = F.col("level.left").cast("double") * F.col("weight") / F.col("level.open_weight")
    target = F.when(F.col("capped") | F.col("level").isNull(), F.col("cap").cast("double")).otherwise(share)
    return split.select("source", "source_size", "weight", target.alias("target"))


def _uniform(key: int, n: int) -> float:
    """A number in [0, 1) fixed by a row's hash and a counter (the splitmix64 finalizer)."""
    mask = (1 << 64) - 1
    z = (key + (n + 1) * 0x9E3779B97F4A7C15) & mask
    z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & mask
    z = ((z ^ z >> 27) * 0x94D049BB133111EB) & mask
    return ((z ^ z >> 31) >> 11) / (1 << 53)


def _step(units: list[list], draw: float) -> None:
    """Move three probabilities (third value; the second is the size) along the null-space of (1, 1, 1) and the sizes until one is 0 or 1."""
    sizes = [u[1] for u in units]
    way = [sizes[2] - sizes[1], sizes[0] - sizes[2], sizes[1] - sizes[0]]
    if not any(way):
        way = [1, -1, 0]
    moves = [(u, float(w)) for u, w in zip(units, way) if w]
    up = min(((1 - u[2]) if w > 0 else u[2]) / abs(w) for u, w in moves)
    down = min((u[2] if w > 0 else (1 - u[2])) / abs(w) for u, w in moves)
    by = up if draw * (up + down) < down else -down
    for u, w in moves:
        p = u[2] + by * w
        u[2] = 0.0 if p < EPS else 1.0 if p > 1 - EPS else p


def _land(units: list[list]) -> None:
    """Round the last one or two so that the words taken miss their expectation least."""
    want = sum(u[1] * u[2] for u in units)
    picks = [tuple(n >> i & 1 for i in range(len(units))) for n in range(1 << len(units))]
    expected = sum(u[2] for u in units)
    best = min(picks, key=lambda p: (abs(sum(u[1] * x for u, x in zip(units, p)) - want), abs(sum(p) - expected), p))
    for u, x in zip(units, best):
        u[2] = float(x)


def _fly(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stream rows sorted by (rank, block): three undecided documents are held, whatever a block's size.

    A source with a single block lands here; else what stays undecided is marked for the next level.
    """
    names, group, active, steps = None, None, [], 0
    for frame in frames:
        names, done = list(frame.columns), []
        at = {n: i for i, n in enumerate(names)}
        # Work on [row, size, p]; the row's other values are only carried.
        for row in frame.itertuples(index=False, name=None):
            if (row[at["rank"]], row[at["block"]]) != group:
                done += _close(active, at)
                group, active, steps = (row[at["rank"]], row[at["block"]]), [], 0
            active.append([row, row[at["size"]], row[at["p"]]])
            if len(active) == 3:
                _step(active, _uniform(row[at["key"]], steps))
                steps += 1
                done += [u for u in active if u[2] in (0.0, 1.0)]
                active = [u for u in active if u[2] not in (0.0, 1.0)]
        yield _frame(done, names, at)
    if names:
        yield _frame(_close(active, at), names, at)


def _close(active: list[list], at: dict) -> list[list]:
    if active and active[0][0][at["blocks"]] == 1:
        _land(active)
    return active


def _frame(units: list[list], names: list[str], at: dict) -> pd.DataFrame:
    out = pd.DataFrame([u[0] for u in units], columns=names)
    out["p"] = [u[2] for u in units]
    return out.astype({"p": "float64"})


def balanced_picks(rows: DataFrame, largest: int, block: int = BLOCK) -> DataFrame:
    """Draw ``rows`` (rank, key, size, p, n and any carried columns): p becomes 0 or 1 for every row.

    n is the number of rows of the rank, ``largest`` the largest of them; they only decide the number of blocks.
    """
    blocks = lambda c: F.ceil(c / F.lit(float(block))).cast("long")
    rows = rows.withColumns({"blocks": F.greatest(blocks(F.col("n")), F.lit(1)), "block": F.lit(0).cast("long")})
    open_ = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    decided = [rows.where(~open_).withColumn("p", F.round("p"))]
    rows, level, most = rows.where(open_), 0, -(-largest // block)
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(level)), F.col("blocks")))
        dealt = dealt.repartition("rank", "block").sortWithinPartitions("rank", "block", "key", "size")
        flown = stage(dealt.mapInPandas(_fly, dealt.schema), "cube-level")
        decided.append(flown.where("p = 0 or p = 1"))
        if most <= 1:
            break
        rows = flown.where("p > 0 and p < 1").withColumn("blocks", F.greatest(blocks(2 * F.col("blocks")), F.lit(1)))
        level, most = level + 1, -(-2 * most // block)
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED,
        block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, mark (of its text), source, size, source_size, target, copies, taken."""
    body = text_of(text)
    sized = stage(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(body).alias("size"),
        F.xxhash64(body).alias("mark")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    totals = stage(sizes, "mix-sources")
    targets = source_targets(totals.select("source", "source_size"), weights, max_repeat)
    plan = stage(targets.join(totals.drop("source_size"), targets.source.eqNullSafe(totals.source)).select(
        targets.source, F.xxhash64(targets.source, F.lit("rank")).alias("rank"), "source_size", "target", "n"),
        "mix-plan")
    largest = plan.agg(F.max("n")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sized.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "mark", "source", "size", "source_size", "target", "rank", "n",
        F.xxhash64("doc_id", "mark", F.lit(seed)).alias("key"),
        F.floor(ratio).cast("long").alias("whole"), (ratio - F.floor(ratio)).alias("p"))
    copies = F.col("whole") + F.col("p").cast("long")
    return balanced_picks(rows, largest, block).select(
        "doc_id", "mark", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: ``docs`` with every document as often as it is taken, columns as they were."""
    keys = unused(docs, "id_key", "mark", "copies", "nth")
    id_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    picks = mix(docs, doc_id, text, source, **options)
    picks = stage(picks.groupBy(id_key("doc_id").alias("id"), "mark").agg(
        F.sum("copies").alias("all"), F.count(F.lit(1)).alias("rows")).where("all > 0"), "mix-picks")
    picks = picks.select("id", "mark", "all").toDF(*keys[:3])
    rows = docs.withColumns({keys[0]: id_key(doc_id), keys[1]: F.xxhash64(text_of(text))})
    joined = rows.join(picks, keys[:2]).dropDuplicates(keys[:2])
    return joined.withColumn(keys[3], F.explode(F.sequence(F.lit(1).cast("long"), F.col(keys[2])))).select(*docs.columns)
