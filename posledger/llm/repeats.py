"""Removal of long passages that occur more than once: distributed prefix doubling over sampled positions.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts at two or more places of the input. Doubling
ranks all positions by their first 2, 4, 8, ... bytes, each round by the pair of ranks at an offset, until a rank is
unique or the length is past the threshold. A row of a rank and a position takes 24 bytes a byte of text, forty times
the input in each round, so the positions are sampled first, by content, and in each round only those go on whose
rank is neither unique nor settled:

* **Seeds.** Of the strings of ``SEED`` bytes in a window of ``LENGTH`` bytes the one of the least hash is the window's
  anchor, the leftmost if several are. Equal windows have their anchor at the same place, so windows with equal strings
  have equal anchors. Successive windows share an anchor; such a run is one row, about one in 70 bytes. Anchors are
  ranked by their seed; a run whose seed is unique in the input has no repeated window and drops out.
* **Settled runs.** Two runs with equal bytes from the first window to the last are past the threshold as a whole. Of
  equal runs only one goes on, and only if its seed has other runs as well.
* **Rounds.** What is open is divided by the distance of window and anchor into pieces of ``WIDTHS`` windows. All windows
  of a piece share a core, LENGTH - width + 1 bytes long, so the length that pieces are ranked by grows from SEED over 169
  and 193 to 200 bytes. A piece is ranked by the pair of its run's seed and its core; unique ones drop out, pieces that
  are equal as a whole are settled, one of each kind goes on. In the last round a piece is a window, unique or settled.

Ranks are names: equal strings have equal 64-bit hashes. A name only ever lets a piece go on; a window is settled by
128 bits of its whole (64 for runs within a seed). Groups are counted by aggregations that are combined before the
shuffle and looked up by equality joins, and repeats within a document are folded to one row before that. Nothing is
collected but the spans of a single document.

Defined results: a null text is empty; texts shorter than LENGTH lose nothing; texts are read whole, in slices that
overlap by a window. Rows that repeat an id and a text are documents of their own, so all their windows repeat. Extra
columns are ignored, whatever their names; an empty table gives no rows. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from posledger.llm.common import text_of
from posledger.sources.tables import stage

LENGTH = 200
SEED = 32
#: Windows of a piece in each round; the last must be 1.
WIDTHS = (32, 8, 1)
#: Windows of a text that are looked at together.
SLICE = 1 << 17
#: Rows of an output batch.
OUT = 20_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _inverse(odd: int) -> np.uint64:
    return np.uint64(pow(odd, -1, 1 << 64))


_UP = np.cumprod(np.concatenate([[np.uint64(1)], np.full(SLICE + LENGTH, _ODD, np.uint64)]))
_DOWN = np.cumprod(np.concatenate([[np.uint64(1)], np.full(SLICE + LENGTH, _inverse(int(_ODD)), np.uint64)]))


def seeds_of(data: np.ndarray) -> np.ndarray:
    """A hash of the ``SEED`` bytes from each position: differences of a running polynomial, then mixed."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=sums[1:])
    out = (sums[SEED:] - sums[:-SEED]) * _DOWN[:len(data) - SEED + 1]
    for shift, factor in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):
        out ^= out >> np.uint64(shift)
        out *= np.uint64(factor)
    return out ^ (out >> np.uint64(31))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive values, by doubling."""
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    return np.minimum(values[:span - width], values[width - span:]) if width > span else values


def runs_of(text: bytes) -> tuple[np.ndarray, ...]:
    """Seed (signed), first window, last window and anchor of every run of windows with one anchor."""
    parts = []
    high = np.uint64(0xFFFFFFFF00000000)
    for at in range(0, len(text) - LENGTH + 1, SLICE):
        data = np.frombuffer(text, np.uint8)[at:at + SLICE + LENGTH - 1]
        seeds = seeds_of(data)
        marked = (seeds & high) | np.arange(len(seeds), dtype=np.uint64)
        anchor = (_least(marked, LENGTH - SEED + 1) & ~high).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(first[1:], len(anchor)) - 1
        anchor = anchor[first]
        parts.append((seeds[anchor].view(np.int64), first + at, last + at, anchor + at))
    return tuple(map(np.concatenate, zip(*parts))) if parts else (np.zeros(0, np.int64),) * 4


def placed(first, last, anchor):
    """A run as one number: first window, windows after it, distance of its anchor."""
    return first << 16 | (last - first) << 8 | (anchor - first)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<struct<start:long,stop:long>>":
             pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))}
    return pa.schema([(n, types[t]) for n, t in (c.strip().split(" ", 1) for c in ddl.split(", "))])


def _batched(rows: Iterator[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    schema, held = _arrow(ddl), []
    for row in rows:
        held.append(row)
        if len(held) == OUT:
            yield _out(held, schema)
            held.clear()
    yield _out(held, schema)


SEEDS = "seed long, n long"
RUNS = "id long, mark long, seed long, whole long, places array<long>"
CONTEXTS = "id long, mark long, place long, seed long, context binary"
PIECES = "id long, mark long, place long, near int, far int, core long, whole long, whole2 long"
RESULT = ("doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept_sha256 string, "
          "kept binary")


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [runs_of(t.as_py())[0] for t in batch.column(0)]
        seeds, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(seeds), pa.array(n)], schema=_arrow(SEEDS))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc_id, mark, value in zip(*(batch.column(i) for i in range(3))):
                text, own = value.as_py(), {}
                seeds, first, last, anchor = runs_of(text)
                hashed = (xxhash.xxh3_64_intdigest(text[a:b + LENGTH]) for a, b in zip(first.tolist(), last.tolist()))
                for seed, whole, place in zip(seeds.tolist(), hashed, placed(first, last, anchor).tolist()):
                    own.setdefault((seed, whole), []).append(place)
                doc_id, mark = doc_id.as_py(), mark.as_py()
                yield from ((doc_id, mark, seed, _signed(whole), places) for (seed, whole), places in own.items())
    return _batched(rows(), RUNS)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc_id, mark, text, asked in zip(*(c for c in batch.columns)):
                text, doc_id, mark = text.as_py(), doc_id.as_py(), mark.as_py()
                for run in asked.as_py():
                    first, more = run["place"] >> 16, run["place"] >> 8 & 255
                    yield doc_id, mark, run["place"], run["seed"], text[first:first + more + LENGTH]
    return _batched(rows(), CONTEXTS)


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """near and far: the least and greatest distance of a window of the piece from the anchor."""
    def rows():
        for batch in batches:
            for doc_id, mark, place, seed, text, near, far in zip(*(c.to_pylist() for c in batch.columns)):
                anchor = place & 255
                for nr in range(near // width, far // width + 1):
                    low, high = nr * width, nr * width + width - 1
                    core = text[max(anchor - low, 0):anchor - high + LENGTH]
                    low, high = max(low, near), min(high, far)
                    whole = xxhash.xxh3_128_intdigest(text[anchor - high:anchor - low + LENGTH], high)
                    yield (doc_id, mark, place, low, high, _signed(xxhash.xxh3_64_intdigest(core, (seed + nr) % (1 << 64))),
                           _signed(whole >> 64), _signed(whole % (1 << 64)))
    return _batched(rows(), PIECES)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((start, stop))
    return out


def _removed(batches: Iterator[pa.RecordBatch], with_kept: bool) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc_id, text, found in zip(*batch.columns):
                text, at, kept = text.as_py(), 0, []
                spans = merged([(s["start"], s["stop"]) for s in found.as_py() or ()])
                for start, stop in spans:
                    kept.append(text[at:start])
                    at = stop
                rest = b"".join([*kept, text[at:]])
                yield (doc_id.as_py(), len(text), len(text) - len(rest), [{"start": a, "stop": b} for a, b in spans],
                       hashlib.sha256(rest).hexdigest(), rest if with_kept else None)
    return _batched(rows(), RESULT)


def _settled(pieces: DataFrame, kinds: DataFrame, keys: list[str]) -> DataFrame:
    """The pieces of a kind that occurs more than once."""
    return pieces.join(kinds.where("n > 1").select(*keys), keys, "left_semi")


def _going_on(kinds: DataFrame, rank: str) -> DataFrame:
    """One piece of each kind whose rank has other kinds as well."""
    shared = kinds.groupBy(rank).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    return kinds.join(shared.select(rank), rank, "left_semi")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(id, mark, start, stop): the repeated windows of documents (id, mark, text), successive ones joined."""
    seeds = rows.select("text").mapInArrow(_seeds, SEEDS).groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1")
    seeds = stage(seeds.select("seed"), "repeat-seeds")
    runs = stage(rows.mapInArrow(_runs, RUNS).join(seeds, "seed", "left_semi").select(*_arrow(RUNS).names), "repeat-runs")
    keys = ["seed", "whole"]
    first = F.min(F.struct("id", "mark", F.element_at("places", 1).alias("place"))).alias("one")
    kinds = stage(runs.groupBy(*keys).agg(F.sum(F.size("places")).alias("n"), first), "repeat-run-kinds")
    start = F.shiftright("place", 16)
    more = F.shiftright("place", 8).bitwiseAND(255)
    anchor = F.col("place").bitwiseAND(255)
    spans = [_settled(runs, kinds, keys).select("id", "mark", F.explode("places").alias("place")).select(
        "id", "mark", start.alias("start"), (start + more + LENGTH).alias("stop"))]

    asked = _going_on(kinds, "seed").select("one.*", "seed").groupBy("id", "mark").agg(
        F.collect_list(F.struct("place", "seed")).alias("asked"))
    contexts = stage(rows.join(asked, ["id", "mark"]).select("id", "mark", "text", "asked").mapInArrow(_contexts, CONTEXTS),
                     "repeat-contexts")
    still = contexts.withColumns({"near": (anchor - more).cast("int"), "far": anchor.cast("int")})
    keys = ["core", "whole", "whole2"]
    columns = ["id", "mark", "place", "near", "far"]
    for nr, width in enumerate(WIDTHS):
        asked = still.select("id", "mark", "place", "seed", "context", "near", "far")
        pieces = stage(asked.mapInArrow(partial(_pieces, width=width), PIECES), "repeat-pieces")
        kinds = stage(pieces.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*columns)).alias("one")),
                      "repeat-kinds")
        spans.append(_settled(pieces, kinds, keys).select(
            "id", "mark", (start + anchor - F.col("far")).alias("start"), (start + anchor - F.col("near") + LENGTH).alias("stop")))
        if nr + 1 < len(WIDTHS):
            still = contexts.join(_going_on(kinds, "core").select("one.*"), ["id", "mark", "place"])
    out = spans[0]
    for more_spans in spans[1:]:
        out = out.union(more_spans)
    return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_kept: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, spans (the removed runs), kept_sha256 and, if asked, the kept bytes."""
    body = text_of(text).cast("binary")
    identity = F.coalesce(F.col(doc_id).cast("long"), F.lit(-1 << 63))
    rows = docs.select(identity.alias("id"), F.xxhash64(body).alias("mark"), body.alias("text"))
    spans = repeated_spans(rows).groupBy("id", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("found"))
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), identity.alias("id"), F.xxhash64(body).alias("mark"),
                        body.alias("text"))
    return whole.join(spans, ["id", "mark"], "left").select("doc_id", "text", "found").mapInArrow(
        partial(_removed, with_kept=with_kept), RESULT)
