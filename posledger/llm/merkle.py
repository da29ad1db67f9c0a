"""Merkle dataset manifest with nested-interval labels.

Every document is a leaf; per tree (language) leaves are ranked by doc_id and every two consecutive nodes become one
until one is left, the subroot; subroots, ordered by tree, become the root the same way. A node carries the interval
``[low, high)`` of the leaf ranks it covers, so no node needs a pointer: an ancestor is a node whose interval contains
a leaf's rank, and the sibling of a node is what is left of its parent's interval without its own.

* Ranks come from one range exchange of the small leaf rows (no texts): a leaf's place in its partition plus the
  sizes of the partitions before it. No window over a tree, however many leaves it has.
* Nodes are folded in tiers of ``TIER`` levels: a block of 2 ** TIER members is one bounded group and gives the nodes
  of its levels; block tops are the members of the next tier, one thousandth as many.
* Ancestors are attached by containment: within a tier a leaf asks each level for the children of its ancestor
  there, by equality on (tree, level, bucket), the bucket being the interval's place on the parent's level. The child
  that contains the rank is the own ancestor; what is left of the parent's interval is the sibling.
* Higher tiers' siblings are attached once a block, from the root down, so a leaf moves at most ``TIER`` siblings.

Defined results: a null field is ``-``; null trees come first, then bytewise; leaves of equal doc_id are ordered by
their hash, null ids first; repeated rows are leaves of their own. Texts are hashed whole. An empty table gives no
rows. Other columns of the documents are ignored, whatever their names, unless they are named in ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.sources.tables import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TIER = 10
#: Name of the tree of the subroots; names of other trees start with = or are -.
TOP = ""
NODES = "tree string, level int, low long, high long, digest string"
PATH = "array<struct<level:int,left:boolean,digest:string>>"


def field(value: Column) -> Column:
    """``-`` for a null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def ranked(members: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``members`` (with ``tree``) and ``low``, the place within the own tree by ``order``, from 0."""
    place = F.monotonically_increasing_id()
    dealt = members.withColumn("_tie", place).repartitionByRange("tree", *order, "_tie")
    dealt = stage(dealt.sortWithinPartitions("tree", *order, "_tie").withColumns(
        {"_part": F.spark_partition_id(), "_place": place}).drop("_tie"), name)
    parts = dealt.groupBy("tree", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("tree").orderBy("_part")) - F.col("_n")
    starts = parts.select("tree", "_part", (before - F.col("_first")).alias("_shift"))
    return dealt.join(starts, ["tree", "_part"]).withColumn("low", F.col("_place") + F.col("_shift")).drop(
        "_part", "_place", "_shift")


def _fold(block: pa.Table) -> pa.Table:
    """The nodes of one block from its members up."""
    block = block.sort_by("low")
    tree, base, levels = (block.column(c)[0].as_py() for c in ("tree", "base", "levels"))
    nodes = list(zip(*(block.column(c).to_pylist() for c in ("low", "high", "digest"))))
    rows = [(tree, base, *node) for node in nodes]
    for level in range(base + 1, base + levels + 1):
        runs = [nodes[at:at + 2] for at in range(0, len(nodes), 2)]
        nodes = [(run[0][0], run[-1][1], hashlib.sha256("".join(n[2] for n in run).encode()).hexdigest()) for run in runs]
        rows += [(tree, level, *node) for node in nodes]
    types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], ("tree", "level", "low", "high", "digest"))


def _bucket(ranks: str, bits: str) -> Column:
    return F.expr(f"shiftright({ranks}, {bits})")


def tier_nodes(members: DataFrame, heights: DataFrame, base: int) -> DataFrame:
    """The nodes of the levels from ``base`` to ``base + TIER`` over members of level ``base``."""
    levels = F.least(F.col("height") - base, F.lit(TIER)).cast("int")
    rows = members.select("tree", "low", "high", "digest").join(heights, "tree").select(
        "tree", "low", "high", "digest", F.lit(base).alias("base"), levels.alias("levels"),
        _bucket("low", f"{base + TIER}").alias("block"))
    return stage(rows.groupBy("tree", "block").applyInArrow(_fold, NODES), "merkle-nodes")


def tier_paths(members: DataFrame, nodes: DataFrame, heights: DataFrame, base: int) -> DataFrame:
    """(tree, low, path) per member: the sibling (or none) on each level of the tier, upwards."""
    top = F.least(F.col("height"), F.lit(base + TIER)).cast("int") - 1
    asked = members.select("tree", "low").join(heights.where(F.col("height") > base), "tree").select(
        "tree", "low", F.explode(F.sequence(F.lit(base), top)).alias("level"))
    asked = asked.withColumn("parent", _bucket("low", "level + 1"))
    families = nodes.withColumn("parent", _bucket("low", "level + 1")).groupBy("tree", "level", "parent").agg(
        F.sort_array(F.collect_list(F.struct("low", "high", "digest"))).alias("family"))
    met = asked.join(families, ["tree", "level", "parent"])
    contains = lambda node: (node["low"] <= F.col("low")) & (F.col("low") < node["high"])
    sibling = F.get(F.filter("family", lambda node: ~contains(node)), F.lit(0))
    steps = met.select("tree", "low", "level", sibling.alias("sibling")).select("tree", "low", F.struct(
        "level", (F.col("sibling.low") < F.col("low")).alias("left"), F.col("sibling.digest").alias("digest")).alias("step"))
    return steps.groupBy("tree", "low").agg(F.sort_array(F.collect_list("step")).alias("path"))


def build(members: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Trees over ``members`` (tree, low, digest): their nodes, their tops (tree, top) and the path of every member.

    A node is (tree, level, low, high, digest); a path is an array of (level, left, digest), one for each level
    below the top, with nulls where a node has no sibling.
    """
    members = members.select("tree", "low", (F.col("low") + 1).alias("high"), "digest")
    sizes = members.groupBy("tree").agg((F.max("low") + 1).alias("n"))
    heights = stage(sizes.select("tree", F.ceil(F.log2("n")).cast("int").alias("height")), "merkle-heights")
    highest = heights.agg(F.max("height")).first()[0] or 0
    tiers, at = [], members
    for base in range(0, max(highest, 1), TIER):
        nodes = tier_nodes(at, heights.where((F.col("height") > base) | F.lit(base == 0)), base)
        tiers.append((base, at, nodes))
        at = nodes.where(F.col("level") == base + TIER).drop("level")
    paths = None
    for base, at, nodes in reversed(tiers):
        own = at.select("tree", "low").join(tier_paths(at, nodes, heights, base), ["tree", "low"], "left")
        path = F.coalesce("path", F.array().cast(PATH))
        if paths is not None:
            above = paths.select("tree", _bucket("low", f"{base + TIER}").alias("block"), F.col("path").alias("above"))
            own = own.withColumn("block", _bucket("low", f"{base + TIER}")).join(above, ["tree", "block"], "left")
            path = F.concat(path, F.coalesce("above", F.array().cast(PATH)))
        paths = own.select("tree", "low", path.alias("path"))
        paths = stage(paths, "merkle-paths") if base else paths
    nodes = tiers[0][2]
    for base, _, more in tiers[1:]:
        nodes = nodes.union(more.where(F.col("level") > base))
    tops = nodes.join(heights, "tree").where(F.col("level") == F.col("height")).select(
        "tree", F.col("digest").alias("top"))
    return nodes, tops, paths


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "lang", doc_id: str = "doc_id",
             keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, the columns of ``keep``, leaf, path, subroot, root.

    ``keep`` are expressions over the documents that travel with the leaves, say the leaf of another version.
    """
    keep = keep or {}
    name = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("-"))
    leaves = docs.select(name.alias("tree"), F.col(doc_id).alias("doc_id"), leaf_of([F.col(c) for c in fields]).alias("digest"),
                         F.struct(*[v.alias(k) for k, v in keep.items()], F.lit(1).alias("_one")).alias("_keep"))
    leaves = stage(ranked(leaves, ["doc_id", "digest"], "merkle-places"), "merkle-leaves")
    _, tops, paths = build(leaves)
    tops = stage(tops, "merkle-subroots")
    trees = ranked(tops.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest")), ["name"],
                   "merkle-trees")
    trees = stage(trees, "merkle-trees")
    _, root, upper = build(trees)
    ends = trees.join(upper, ["tree", "low"]).join(root, "tree").select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("top").alias("root"), F.col("path").alias("upper"))
    rows = leaves.join(paths, ["tree", "low"]).join(stage(ends, "merkle-ends"), "tree")
    return rows.select("doc_id", *[F.col(f"_keep.{k}") for k in keep], F.col("digest").alias("leaf"),
                       F.concat("path", "upper").alias("path"), "subroot", "root")


def proof_of(path: str | Column) -> Column:
    """The siblings of a path as one text, a node without sibling adding nothing."""
    return F.array_join(F.transform(path, lambda step: step["digest"]), "")


def folded(leaf: str | Column, path: str | Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf
    side = lambda step, left: F.when(step["left"] == left, step["digest"]).otherwise("")
    return F.aggregate(path, leaf, lambda at, step: F.sha2(F.concat(side(step, True), at, side(step, False)), 256))


def audited(docs: DataFrame) -> DataFrame:
    """The manifest's digests per document, each checked against a version in which every seventh is tampered with.

    Where 7 divides the CRC-32 of the decimal doc_id, the tampered version has one more in n_chars.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    other = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    rows = manifest(docs, keep={"claimed": F.when(hit, leaf_of(other))})
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_of("path"), 256).alias("proof_sha256"),
                       folded(F.coalesce("claimed", "leaf"), "path").alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
