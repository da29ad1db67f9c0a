"""Interaction of text filters: what each removes in every order, and what it would remove alone.

Every text is read once by a table-driven byte transducer. ``CLASS`` gives the class of each byte, ``NEXT`` the state
after it (between words or inside one) and ``EMIT`` what the step from one state to the next counts: a word's start, a
word's end, a capital, a code point, a symbol. UTF-8 needs no further states: continuation bytes are inside words and
start no code point. As the state after a byte depends on that byte alone, whole arrays are stepped at once. The spans
between a start and an end go into a hash table that compares contents on equal hashes, so its size is the number of
distinct words. A text gives five verdicts, kept as the bits of one mask.

Verdicts over other rows (a text that a smaller doc_id has) come from one aggregation on the text's SHA-256 and length,
combined before the shuffle and joined back by plain equality, so a text that many rows share needs no task of its own.
Rows with equal part, mask and labels are then counted, at most ``2 ** 5 * 4`` a part, and only those counts meet the
orders. Counts over orders are therefore exact and cost nothing a document.

Defined results: a null text counts as empty; words are case-sensitive; texts are read whole. A null doc_id is
neither smaller than another nor has one that is; rows that repeat a doc_id have no smaller one in each other. A label
counts if any label row of the doc_id has it. Extra columns are ignored, whatever their names. A null part is the
empty string. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from posledger.llm.common import text_of

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"

#: Classes of bytes.
SPACE, CAPITAL, SYMBOL, OTHER, CONTINUATION = range(5)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = SPACE
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[0x80:0xC0] = CONTINUATION
#: State after a byte of each class: 0 between words, 1 inside a word.
NEXT = np.array([0, 1, 1, 1, 1], np.uint8)
#: What the step from a state (row) by a class (column) emits.
START, END, POINT, CAP, SIGN = 1, 2, 4, 8, 16
EMIT = np.array([
    [POINT, START | POINT | CAP, START | POINT | SIGN, START | POINT, START],
    [END | POINT, POINT | CAP, POINT | SIGN, POINT, 0],
], np.uint8)
STEP = (EMIT.ravel()).astype(np.uint8)

NAMES = ("words", "distinct_words", "capitals", "points", "symbols")


def transduce(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, distinct words, capitals, code points and symbols of UTF-8 bytes."""
    if not text:
        return 0, 0, 0, 0, 0
    classes = CLASS[np.frombuffer(text, np.uint8)]
    states = NEXT[classes]
    before = np.empty_like(states)
    before[0], before[1:] = 0, states[:-1]
    out = STEP[before * 5 + classes]
    starts = np.flatnonzero(out & START).tolist()
    ends = np.flatnonzero(out & END).tolist()
    if len(ends) < len(starts):
        ends.append(len(text))
    table = {text[a:b] for a, b in zip(starts, ends)}
    count = lambda bit: int(np.count_nonzero(out & bit))
    return len(starts), len(table), count(CAP), count(POINT), count(SIGN)


@arrow_udf(T.StructType([T.StructField(n, T.LongType()) for n in NAMES]))
def _counts(texts: pa.Array) -> pa.Array:
    rows = [transduce(t.as_py()) for t in texts]
    return pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(NAMES))], NAMES)


def counts(text: str | Column) -> Column:
    """Struct of the five counts of a text."""
    return _counts(text_of(text).cast("binary"))


def own_mask(c: str) -> Column:
    """Bits 0 to 3: the filters A to D that a text with counts ``c`` fails."""
    of = lambda name: F.col(f"{c}.{name}")
    fails = [of("words") < MIN_WORDS, 100 * of("distinct_words") < MIN_DISTINCT_PERCENT * of("words"),
             100 * of("capitals") > MAX_CAPITAL_PERCENT * of("points"), of("symbols") > 0]
    return sum((F.when(fail, 1 << nr).otherwise(0) for nr, fail in enumerate(fails)), F.lit(0))


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per document: doc_id, part, mask (bit i: fails filter i of ``FILTERS``)."""
    body = text_of(text).cast("binary")
    # The look-up needs no counts, so it is made of the digests alone and the counts travel with the rows.
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("length"), counts(text).alias("c"))
    rows = rows.select("doc_id", "part", "digest", "length", own_mask("c").alias("own"))
    keys = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("length"))
    first = keys.groupBy("digest", "length").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    mask = F.col("own") + F.when(again, 1 << 4).otherwise(0)
    return rows.join(first, ["digest", "length"], "left").select("doc_id", "part", mask.alias("mask"))


def _orders() -> Column:
    """Every order with its steps: filter_order, step, bit of the step's filter, bits of those before."""
    steps = []
    for order in map("".join, permutations(FILTERS)):
        seen = 0
        for nr, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            steps.append((order, nr, bit, seen))
            seen |= bit
    columns = zip(("filter_order", "step", "bit", "before"), zip(*steps))
    return F.arrays_zip(*[F.array(*map(F.lit, values)).alias(name) for name, values in columns])


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per part, order and step: what stays, goes, and would have gone, in all and by label; and Shapley sums."""
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(0))
    counted = verdicts(docs, doc_id, text, part).join(marked, "doc_id", "left").groupBy(
        "part", "mask", flag("good").alias("good"), flag("toxic").alias("toxic")).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.select("*", F.explode(_orders()).alias("o")).select("*", "o.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) > 0
    gone = F.col("mask").bitwiseAND(F.col("before")) > 0
    alone = F.col("mask") == F.col("bit")
    total = lambda when, value=F.col("n"): F.coalesce(F.sum(F.when(when, value)), F.lit(0)).cast("long")
    # A document that fails k filters is removed by each of them in one k-th of the orders.
    share = F.col("n") * F.lit(len(list(permutations(FILTERS)))) / F.bit_count("mask")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(alone).alias("unique_fails"), total(fails & ~gone & (F.col("good") == 1)).alias("good_lost"),
        total(fails & ~gone & (F.col("toxic") == 1)).alias("toxic_lost"), total(fails, share).alias("shapley"))
