"""Near-duplicates of the corpus pipeline: linked by the fingerprints of ``simhash``, or by a Jaccard of 0.8 or more.

With ``fingerprints`` the whole of ``simhash`` comes first: fingerprints at two or fewer differing bits are links, found
by its byte index. At a Jaccard of 0.8 of their sets of five-word shingles two 64-bit fingerprints differ in about ten
bits, which can lie in all eight bytes, so the byte index cannot find such pairs at any tally. They are linked as well:
candidates share one of ``BANDS`` bands of ``ROWS`` minimum hashes, which a pair at 0.8 does with probability
1 - (1 - 0.8 ** 6) ** 28 = 0.9998, a closer one with more. Every link of this kind is verified by the exact Jaccard of
the shingle sets. Components are those of both kinds together.

Pairs of a band list are not all compared. Every member of a list is first compared with the list's hub, the member
that stands in the most and longest lists: copies of one text meet in that text, so a group of any size costs a few
comparisons a member. What is left are lists whose members lie in different components:

* lists of at most ``LONG`` members compare the members of different components;
* the texts of longer lists are listed anew by the shingles that they have in common with one another, and those lists
  compared. The shingles of a text are numbered from the most frequent one, and it stands in the lists of those numbered
  0.8 of its size or higher. That loses no pair: what two texts have in common is at least as frequent as the rarest
  shingle of it, whose number in either text is thus no less than the count of it, and that is at least 0.8 of the
  larger text at a Jaccard of 0.8. Texts that share most of their words, but have more than a fifth of their own, part.

So no list is cut, no partner dropped and no pair of a list left out for its length, and no list gives more rows than it
has members. The members carry their minima and sizes into their list, where all pairs of different components are
sifted by them in place; members of a pair that may reach the least Jaccard come again with their shingles, and the pairs
are verified there. What becomes a row is the link that joins two components of the list, so pairs that are far after
all, or connected already, give none. A list of more than ``BLOCK`` members, or as many times ``WEIGHT`` shingles, is
compared block by block, so a task holds two blocks of a list at most.

Defined results: a null text counts as empty; words and case folding are those of ``simhash``; fewer than five words
make one shingle; texts without words are copies of each other; texts of any length are read whole. Rows that repeat
an id and a text are one document. Null ids are ignored for the kept document unless a component has no other; ties
go to the smaller digest. Extra columns pass through untouched, whatever their names; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from posledger.llm import simhash
from posledger.llm.common import text_of, unused
from posledger.llm.components import components
from posledger.sources.tables import stage

SHINGLE = 5
JACCARD_PERCENT = 80
SEED = 42
BANDS, ROWS = 28, 6
LONG = 48
#: Members of a list that are compared as one block, and pairs whose minima are compared at once.
BLOCK, PAIRS = 1024, 8192
#: With its shingles, a member counts as one more for every so many.
WEIGHT = 1024
#: Slots by which the frequency of shingles is told.
SLOTS = 1 << 18
#: Shingles whose minimum hashes are taken at once.
SLICE = 512
#: Of the minima, a pair at the least Jaccard agrees in 134 of 168, standard deviation 5.2; below this, which it is with a
#: probability of 4e-6, it is taken for far without its shingles.
LEAST_AGREED = 110
_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingles_of(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of UTF-8 bytes."""
    words = text.lower().split()
    grams = zip(*(words[i:] for i in range(size))) if len(words) >= size else [words] if words else []
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(SEED))
    return np.unique(np.fromiter(hashes, np.uint64))


def minima_of(shingles: np.ndarray) -> np.ndarray:
    """The low halves of the minimum hashes; texts without shingles share all of them."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SLICE):
        np.minimum(least, (shingles[at:at + SLICE, None] * _FACTORS + _SHIFTS).min(0), out=least)
    return least.astype(np.uint32).view(np.int32)


@arrow_udf(T.ArrayType(T.IntegerType()))
def _minima(texts: pa.Array) -> pa.Array:
    return pa.array([minima_of(shingles_of(t.as_py())) for t in texts], pa.list_(pa.int32()))


@arrow_udf(T.ArrayType(T.LongType()))
def _shingles(texts: pa.Array) -> pa.Array:
    return pa.array([shingles_of(t.as_py()).view(np.int64) for t in texts], pa.list_(pa.int64()))


def mark_of(text: str | Column) -> Column:
    """A 128-bit digest that stands for the text."""
    return F.unhex(F.md5(text_of(text).cast("binary")))


def band_lists(nodes: DataFrame) -> DataFrame:
    """(key, mark) for every band of every node."""
    minima = [F.element_at("minima", i + 1) for i in range(BANDS * ROWS)]
    keys = [F.xxhash64(F.lit(b), *minima[b * ROWS:(b + 1) * ROWS]) for b in range(BANDS)]
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "mark")


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the shingles of a partition meet each slot."""
    tally = np.zeros(SLOTS, np.int64)
    for batch in batches:
        tally += np.bincount(_slots(batch["shingles"].flatten().to_numpy()), minlength=SLOTS)
    met = np.flatnonzero(tally)
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(tally[met])], ["slot", "n"])


def _slots(shingles: np.ndarray) -> np.ndarray:
    return shingles.view(np.uint64) % np.uint64(SLOTS)


def tally_of(sets: DataFrame) -> np.ndarray:
    """The number of shingles in each of ``SLOTS`` slots: the only thing that is read back, of one size for any table."""
    rows = sets.select("shingles").mapInArrow(_tallied, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found, tally = rows.toArrow(), np.zeros(SLOTS, np.int64)
    tally[found["slot"].to_numpy()] = found["n"].to_numpy()
    return tally


def rare_of(shingles: np.ndarray, tally: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text numbered, from the most frequent one, 0.8 of its size or higher, and their numbers."""
    order = np.lexsort((shingles, -tally[_slots(shingles)]))
    number = np.arange(1, len(order) + 1)
    rare = number * 100 >= len(order) * JACCARD_PERCENT
    return shingles[order[rare]], number[rare]


def part_lists(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, mark, root, most): the texts of the lists by the shingles, as key, that near ones have in common.

    Two texts that reach the least Jaccard meet at least in the list of the rarest shingle of both, and have no more in
    common than the ``most`` of either there. Shingles are as frequent as their slots, equal slots go by the shingles:
    any order of all shingles loses no pair, and this one keeps the lists short.
    """
    texts = sets.join(lists.select("mark", "root").distinct(), "mark")
    tally = tally_of(texts)

    @arrow_udf("array<struct<key: long, most: int>>")
    def rare(column: pa.Array) -> pa.Array:
        found = [rare_of(shingles.values.to_numpy(), tally) for shingles in column]
        ends = np.cumsum([0, *(len(keys) for keys, _ in found)])
        keys, most = (np.concatenate([*part, np.empty(0, np.int64)]) for part in zip(*found)) if found else ([], [])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(most, pa.int32())], ["key", "most"]))

    return texts.select("mark", "root", F.explode(rare("shingles")).alias("of")).select("of.key", "mark", "root", "of.most")


def shared_lists(lists: DataFrame, name: str) -> DataFrame:
    """(key, mark, n) of the lists of n > 1 members."""
    sizes = lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stage(lists.join(sizes, "key"), name)


def labels(links: DataFrame, steps: int = 3) -> DataFrame:
    """(node, root): the smallest node within ``steps`` links, equal for the members of a star.

    Cheaper than whole components; nodes of one component whose labels differ are only compared in vain.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    for _ in range(1, steps):
        near = both.join(known.select(F.col("a").alias("b"), "root"), "b")
        known = near.select("a", "root").groupBy("a").agg(F.least(F.min("root"), F.col("a")).alias("root"))
    return known.withColumnRenamed("a", "node")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def hub_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): every member of a list with the list's hub."""
    weights = lists.groupBy("mark").agg(F.sum("n").alias("weight"))
    hubs = lists.join(weights, "mark").groupBy("key").agg(F.max_by("mark", F.struct("weight", "mark")).alias("hub"))
    return lists.join(hubs, "key").where("mark <> hub").select(*_ordered("mark", "hub")).distinct()


def open_lists(lists: DataFrame, name: str) -> DataFrame:
    """``lists``, n and low of the lists whose n members lie in different components, low being the least.

    ``lists``: key, mark, root and others.
    """
    mixed = lists.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"))
    return stage(lists.join(mixed.where("low < high").select("key", "n", "low"), "key"), name)


def cells(lists: DataFrame) -> DataFrame:
    """(cell, asks, told) and the columns of (key, mark, root, low, blocks, ...), but for low and blocks.

    A list of one block is one cell, of a longer one every two blocks are a cell. In it the members that ask are compared
    with those that are told. The members of the least component, mostly the largest, never ask, so they are not compared
    with each other.
    """
    asks, columns = F.col("root") > F.col("low"), [c for c in lists.columns if c not in ("low", "blocks")]
    whole = lists.where("blocks = 1").select(
        F.col("key").alias("cell"), asks.alias("asks"), F.lit(True).alias("told"), *columns)
    long = lists.where("blocks > 1").withColumn("block", F.pmod(F.xxhash64("mark", F.lit(0)), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    told = F.transform(every, lambda b: F.struct(b.alias("row"), F.col("block").alias("column")))
    asking = F.transform(every, lambda b: F.struct(F.col("block").alias("row"), b.alias("column")))
    dealt = long.withColumn("at", F.explode(F.when(asks, F.array_union(told, asking)).otherwise(told)))
    return whole.union(dealt.select(
        F.xxhash64("key", "at.row", "at.column"), asks & (F.col("at.row") == F.col("block")),
        F.col("at.column") == F.col("block"), *columns)).repartition("cell").sortWithinPartitions("cell")


def _sieve(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs, as row numbers, of the whole cells in ``rows`` whose minima and sizes allow the least Jaccard."""
    cell = rows["cell"].to_numpy()
    root, size = np.array(rows["root"].to_pylist(), "S16"), rows["size"].to_numpy()
    most = rows["most"].to_numpy()
    minima = rows["minima"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS * ROWS)
    told = np.flatnonzero(rows["told"].to_numpy())
    asks = np.flatnonzero(rows["asks"].to_numpy())
    first, last = (np.searchsorted(cell[told], cell[asks], side) for side in ("left", "right"))
    ends = np.cumsum(last - first)
    for at in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        nr = np.arange(at, min(at + PAIRS, ends[-1]))
        one = np.searchsorted(ends, nr, "right")
        x, y = asks[one], told[last[one] - (ends[one] - nr)]
        # The greater root asks; sizes tell before minima are read.
        both, all_ = np.minimum(most[x], most[y]).astype(np.int64), size[x].astype(np.int64) + size[y]
        may = (root[y] < root[x]) & (both * 100 >= (all_ - both) * JACCARD_PERCENT)
        x, y = x[may], y[may]
        near = np.count_nonzero(minima[x] == minima[y], axis=1) >= LEAST_AGREED
        yield x[near], y[near]


def _taken(rows: pa.Table, columns: dict[str, tuple[str, np.ndarray]]) -> pa.RecordBatch:
    """A batch of named columns, each of them a column of ``rows`` at row numbers."""
    return pa.RecordBatch.from_arrays(
        [rows[column].combine_chunks().take(pa.array(at, pa.int64())) for column, at in columns.values()], list(columns))


def _met_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The members that stand in a pair of the sieve, once a cell."""
    met = np.zeros(len(rows), bool)
    for x, y in _sieve(rows):
        met[x] = met[y] = True
    at = np.flatnonzero(met)
    yield _taken(rows, {"key": ("key", at), "mark": ("mark", at)})


def _pairs_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The pairs of the sieve."""
    for x, y in _sieve(rows):
        yield _taken(rows, {"x": ("mark", x), "y": ("mark", y)})


def _links_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Of the pairs of the sieve that reach the least Jaccard those that connect their cell's components."""
    sets = rows["shingles"].combine_chunks().flatten().to_numpy().view(np.uint64)
    size = rows["size"].to_numpy().astype(np.int64)
    ends = np.cumsum(size)
    set_of = lambda i: sets[ends[i] - size[i]:ends[i]]
    _, cell = np.unique(rows["cell"].to_numpy(), return_inverse=True)
    roots, root = np.unique(np.array(rows["root"].to_pylist(), "S16"), return_inverse=True)
    _, home = np.unique(cell * len(roots) + root, return_inverse=True)
    a, b = [], []
    for x, y in _sieve(rows):
        for part in np.split(np.arange(len(x)), np.flatnonzero(x[1:] != x[:-1]) + 1) if len(x) else []:
            one, others = x[part[0]], y[part]
            others = others[home[others] != home[one]]
            if not len(others):
                continue
            mine, theirs = set_of(one), np.concatenate([set_of(i) for i in others])
            found = np.searchsorted(mine, theirs)
            same = mine[np.minimum(found, len(mine) - 1)] == theirs
            both = np.bincount(np.repeat(np.arange(len(others)), size[others]), same, len(others)).astype(np.int64)
            for other in others[both * 100 >= (size[one] + size[others] - both) * JACCARD_PERCENT]:
                if home[other] != home[one]:
                    home[home == home[other]] = home[one]
                    a.append(one)
                    b.append(other)
    yield _taken(rows, {"x": ("mark", a), "y": ("mark", b)})


def _by_cells(made: Callable[[pa.Table], Iterator[pa.RecordBatch]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What whole cells make, of a partition that is sorted by cell; holds one cell across batches."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        if not len(rows):
            continue
        cell = rows["cell"].to_numpy()
        cut = int(np.searchsorted(cell, cell[-1]))
        yield from made(rows.slice(0, cut))
        rest = rows.slice(cut)
    if rest is not None:
        yield from made(rest)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _by_cells(_met_of, batches)


def _sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _by_cells(_pairs_of, batches)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _by_cells(_links_of, batches)


def cross_pairs(lists: DataFrame, nodes: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """(a, b): the members of a list that lie in different components and whose minima and sizes allow the least Jaccard.

    With a column ``most``, the pairs of a list are those that may reach it with no more in common than the most of either.

    With ``sets``, the shingles by mark, the pairs are verified in place and only links are returned that connect the
    components of a list as all its verified pairs do: fewer than the list has members, in each of its cells.
    """
    nodes = nodes if "most" in lists.columns else nodes.withColumn("most", F.col("size"))
    rows = lists.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n").join(nodes, "mark")
    if sets is None:
        return cells(rows).mapInArrow(_sifted, "x binary, y binary").select(*_ordered("x", "y")).distinct()
    met = cells(rows).mapInArrow(_met, "key long, mark binary")
    rows = stage(lists.drop("n").join(met, ["key", "mark"], "left_semi").join(nodes, "mark").drop("minima"), "near-met")
    blocks = rows.groupBy("key").agg(F.ceil(F.sum(1 + F.col("size") / WEIGHT) / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(blocks, "key").join(nodes.select("mark", "minima"), "mark").join(sets, "mark")
    return cells(rows).mapInArrow(_linked, "x binary, y binary").select(*_ordered("x", "y")).distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets, by mark, are near enough."""
    left, right = sets.toDF("a", "left"), sets.toDF("b", "right")
    both = F.size(F.array_intersect("left", "right"))
    near = both * 100 >= (F.size("left") + F.size("right") - both) * JACCARD_PERCENT
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "b")


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """(a, b): links that connect the texts whose fingerprints two or fewer differing bits connect.

    The texts of one fingerprint are linked to the least of them, which stands for the fingerprint.
    """
    owners = stage(nodes.groupBy("fp").agg(F.min("mark").alias("owner")), "near-fingerprints")
    copies = nodes.select("fp", "mark").join(owners, "fp").where("mark <> owner").select(*_ordered("mark", "owner"))
    left, right = owners.toDF("a", "x"), owners.toDF("b", "y")
    bits = simhash.links(owners.select("fp")).join(left, "a").join(right, "b").select(*_ordered("x", "y"))
    return copies.union(bits)


def near_links(nodes: DataFrame, sets: DataFrame, lists: DataFrame, bits: DataFrame | None = None) -> DataFrame:
    """(node, root) of the texts that have near copies.

    ``lists``: the shared lists of the bands; ``bits``: the links of the fingerprints, if they count.
    """
    links = verified(hub_pairs(lists), sets)
    links = stage(links if bits is None else links.union(bits).distinct(), "near-links")
    known = stage(labels(links), "near-labels")
    rooted = lists.join(known, lists.mark == known.node, "left").select("key", "mark", F.coalesce("root", "mark").alias("root"))
    left = open_lists(rooted, "near-open-lists")
    found, long = cross_pairs(left.where(F.col("n") <= LONG), nodes, sets), left.where(F.col("n") > LONG)
    if not long.isEmpty():
        found = found.union(cross_pairs(open_lists(part_lists(long, sets), "near-part-lists"), nodes, sets))
    # What is linked so far goes on as one link a node, and one between nodes that are linked but labelled apart.
    first, second = known.toDF("a", "x"), known.toDF("b", "y")
    apart = links.join(first, "a").join(second, "b").where("x <> y").select(*_ordered("x", "y"))
    return components(known.toDF("a", "b").union(found).union(apart))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fingerprints: bool = False) -> DataFrame:
    """One row per distinct text: mark (of the text), component (its smallest mark), keep (doc_id, mark)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), mark_of(text).alias("mark"),
                       _minima(text_of(text).cast("binary")).alias("minima"),
                       *([simhash.fingerprint(text).alias("fp")] if fingerprints else []))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark"))
    nodes = stage(rows.groupBy("mark").agg(first.alias("first"), F.first("minima").alias("minima"),
                                           *([F.first("fp").alias("fp")] if fingerprints else [])), "near-marks")
    lists = shared_lists(band_lists(nodes), "near-lists")
    wanted = lists.select("mark").distinct()
    texts = docs.select(mark_of(text).alias("mark"), text_of(text).cast("binary").alias("text")).join(
        wanted, "mark", "left_semi").dropDuplicates(["mark"])
    sets = stage(texts.select("mark", _shingles("text").alias("shingles")), "near-sets")
    listed = nodes.select("mark", "minima").join(sets.select("mark", F.size("shingles").alias("size")), "mark")
    roots = near_links(listed, sets, lists, fingerprint_links(nodes) if fingerprints else None)
    rooted = nodes.join(roots, nodes.mark == roots.node, "left").select(
        "mark", "first", F.coalesce("root", "mark").alias("component"))
    least = rooted.groupBy("component").agg(F.min("first").alias("keep"))
    return rooted.join(least, "component").select(
        "mark", "component", F.struct("keep.doc_id", "keep.mark").alias("keep"))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fingerprints: bool = False) -> DataFrame:
    """``docs`` with the document of the smallest id of every component, as it was."""
    stays = near_groups(docs, doc_id, text, fingerprints).select("keep.doc_id", "keep.mark").distinct()
    keys = unused(docs, "id_key", "mark")
    id_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    keepers = stage(stays.select(id_key("doc_id"), "mark").toDF(*keys), "near-keepers")
    rows = docs.withColumns({keys[0]: id_key(doc_id), keys[1]: mark_of(text)})
    return rows.join(keepers, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
