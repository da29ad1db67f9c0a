"""SimHash near-duplicates: 64-bit fingerprints, linked at two or fewer differing bits.

The index has the eight bytes of a fingerprint by position. Two bits lie in two bytes at most, so linked
fingerprints share at least six bytes at their positions: that is the guaranteed minimum of the count
filter. A posting list of a single byte would hold 1/256 of the corpus, and tallying its pairs is quadratic,
so the tally is made by equality: a pair reaches a tally of six exactly when it meets under one of the 28
choices of six positions. The index has those 28 postings per *distinct* fingerprint (copies are folded
first), each keyed by the choice and the six bytes.

Fingerprints of one posting list differ in two bytes only, so a list never holds more than 65,536 of them,
whatever the corpus. Pairs that reach the tally are verified for two differing bits without emitting the pairs
of a list: within a list, fingerprints differ in two bits or fewer exactly if they have a common value at one
bit's distance, so each probes itself and its 16 neighbours, and those that meet are linked to the first.

Defined results: a null text counts as empty; a text without words has fingerprint zero, which links like any
other; fewer than three words make one shingle. Repeated rows share a fingerprint. Null ids are ignored by
``component_id`` unless a component has no other. Texts are processed whole, in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from posledger.llm.common import text_of, unused
from posledger.llm.components import components
from posledger.sources.tables import stage

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SLICE = 1 << 16
#: The two free byte positions of each of the 28 index keys; the other six are fixed.
FREE_BYTES = list(combinations(range(8), 2))


def _votes(shingles: list[bytes]) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduce(bits, axis=0, dtype=np.int64)


def fingerprint_of(text: bytes) -> int:
    """Unsigned fingerprint of UTF-8 bytes; bytes.lower and bytes.split know ASCII only, as wanted."""
    words = text.lower().split()
    n = max(len(words) - SHINGLE + 1, min(len(words), 1))
    votes = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        part = words[at:at + SLICE + SHINGLE - 1]
        grams = zip(*(part[i:] for i in range(SHINGLE))) if len(words) >= SHINGLE else [words]
        votes += _votes([b" ".join(g) for g in grams])
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


@arrow_udf(T.LongType())
def _fingerprint(texts: pa.Array) -> pa.Array:
    out = np.fromiter((fingerprint_of(t.as_py() or b"") for t in texts), np.uint64, len(texts))
    return pa.array(out.view(np.int64))


def fingerprint(text: str | Column) -> Column:
    """The fingerprint as a signed long."""
    return _fingerprint(text_of(text).cast("binary"))


def _mask(free: tuple[int, ...]) -> int:
    """Signed 64-bit mask of the fixed bytes."""
    fixed = ~sum(0xFF << 8 * b for b in free) & (1 << 64) - 1
    return fixed - (1 << 64) if fixed >> 63 else fixed


def postings(fingerprints: DataFrame) -> DataFrame:
    """(choice, shared, fp): the index rows of distinct fingerprints."""
    keys = [F.struct(F.lit(i).cast("byte").alias("choice"), F.col("fp").bitwiseAND(F.lit(_mask(free))).alias("shared"))
            for i, free in enumerate(FREE_BYTES)]
    return fingerprints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.choice", "k.shared", "fp")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n points reaches over the links a-b."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[open_], np.minimum(x, y)[open_])
        while (root[root] != root).any():
            root = root[root]


def _link_lists(lists: np.ndarray, choice: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within posting lists; ``lists`` numbers the list of each fingerprint, ascending."""
    flips = np.array([[0, *(1 << (8 * byte + bit) for byte in free for bit in range(8))] for free in FREE_BYTES],
                     np.uint64)
    probes = fp[:, None] ^ flips[choice]
    owner = np.repeat(np.arange(len(fp)), probes.shape[1])
    probes, home = probes.ravel(), lists[owner]
    order = np.lexsort((owner, probes, home))
    home, probes, owner = home[order], probes[order], owner[order]
    meet = (home[1:] == home[:-1]) & (probes[1:] == probes[:-1])
    a, b = owner[:-1][meet], owner[1:][meet]
    root = _roots(len(fp), a, b)
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the posting lists of a partition that is sorted by list; holds one list across batches."""
    rest = [np.empty(0, np.int8), np.empty(0, np.int64), np.empty(0, np.int64)]

    def linked(choice, shared, fp):
        new = np.r_[True, (choice[1:] != choice[:-1]) | (shared[1:] != shared[:-1])]
        lists = np.cumsum(new) - 1
        many = (np.bincount(lists) > 1)[lists]
        a, b = _link_lists(lists[many], choice[many], fp[many].view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        now = [np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, batch.columns)]
        if not len(now[0]):
            continue
        inside = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
        cut = int(np.argmax(inside))
        rest = [c[cut:] for c in now]
        if cut:
            yield linked(*(c[:cut] for c in now))
    if len(rest[0]):
        yield linked(*rest)


def links(fingerprints: DataFrame) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints that two or fewer differing bits connect.

    Per posting list one link leads each fingerprint to the first it reaches there, so a and b may differ in
    more bits where others lie between them; the components are those of all pairs.
    """
    index = postings(fingerprints).repartition("choice", "shared").sortWithinPartitions("choice", "shared", "fp")
    return index.mapInArrow(_links, "a long, b long").distinct()


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, mark (of the text), fp, component (its smallest fp), component_id, keep_mark."""
    rows = stage(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("mark"),
                             fingerprint(text).alias("fp")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark"))
    distinct = stage(rows.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("component"))
    least = rooted.groupBy("component").agg(F.min("first").alias("keep"))
    owners = stage(rooted.join(least, "component").select(
        "fp", "component", F.col("keep.doc_id").alias("component_id"), F.col("keep.mark").alias("keep_mark")),
        "fingerprint-components")
    return rows.join(owners, "fp").select("doc_id", "mark", "fp", "component", "component_id", "keep_mark")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of every component, as it was."""
    groups = near_groups(docs, doc_id, text)
    stays = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("mark") == F.col("keep_mark")))
    keys = unused(docs, "id_key", "mark", "fp_key")
    id_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    keepers = stage(stays.select(id_key("doc_id"), "mark").distinct().toDF(*keys[:2]), "near-keepers")
    rows = docs.withColumns({keys[0]: id_key(doc_id), keys[1]: F.xxhash64(text_of(text))})
    return rows.join(keepers, keys[:2], "left_semi").dropDuplicates(keys[:2]).select(*docs.columns)
