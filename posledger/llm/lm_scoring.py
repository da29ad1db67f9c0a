"""Language-model scoring: an add-0.1 unigram base and a hidden Markov model whose states know every training word.

Training. Words fall into one of ``SYMBOLS`` hash symbols, the end token has its own, and Baum-Welch trains latent
states that emit symbols on all training tokens, in segments of ``SEGMENT`` that overlap by one token: a task adds up
expected counts, which meet in a grouped sum of fixed-point integers, so results do not depend on the order of
addition. Only that table of fixed size reaches the driver; it is the starting point and the back-off.

Words. A last expectation step over the trained states counts, for every distinct word, how much of it each state
emitted. These counts grow with the vocabulary, so they stay in Spark tables: tasks cut documents into blocks of about
``BLOCK_TOKENS`` tokens and number the distinct words of a block, a row (block, word, training count, state shares) per
word leaves the block, rows meet in a sum by word and go back to the blocks that hold the word. A state emits a word by
its smoothed count times the word's state shares, which lean on the shares of its symbol as far as the word is rare;
an unseen word has those of its symbol. No vocabulary is broadcast and no task holds more words than a block has.

Scoring runs the scaled forward recursion on these emissions over whole texts, never over segments.

Defined results: a null text is empty and consists of the end token. A null id counts as the empty text for the
training split, hence is held out. Without training tokens all counts are 0. Repeated rows score alike. A very long
text is a block of its own and is held by one task. Ties between words have no effect. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from posledger.llm.common import text_of
from posledger.sources.tables import stage

ADD = 0.1
STATES = 6
SYMBOLS = 4096
END_SYMBOL = SYMBOLS
ROUNDS = 4
SEGMENT = 256
#: Tokens of one forward-backward batch.
BATCH = 1 << 18
BLOCK_TOKENS = 2_500_000
#: Distinct symbol sequences that may seed a state (a bounded, hashed sample that only sets the starting point).
SEEDS = 64
FIXED_POINT = 1 << 16
#: A word's own state shares count as its training tokens do, those of its symbol as this many.
BACK_OFF = 2.0
#: State shares travel as one integer of so many bits a state; each gets a quarter step more, so none is zero.
SHARE_BITS, SHARE_FLOOR = 5, 0.25

ENCODED = ("word_row boolean, block long, doc_id long, held_out boolean, n_tokens long, ids binary, word binary, "
           "word_nr long, symbol int, train_count long, shares int")
ARROW = pa.schema([
    ("word_row", pa.bool_()), ("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
    ("n_tokens", pa.int64()), ("ids", pa.binary()), ("word", pa.binary()), ("word_nr", pa.int64()),
    ("symbol", pa.int32()), ("train_count", pa.int64()), ("shares", pa.int32())])
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")
SCORES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


class Model(NamedTuple):
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states


class Counts(NamedTuple):
    tokens: int
    words: int
    totals: np.ndarray  # states: smoothed counts of all words and of an unseen word of each symbol
    symbol_shares: np.ndarray  # symbols x states


class Segment(NamedTuple):
    """A stretch of a text. Unless it is the first one, its first token only leads in; ``words`` numbers its tokens."""

    symbols: np.ndarray
    first: bool = True
    words: np.ndarray | None = None


def held_out(doc_id: str | Column) -> Column:
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 10 == 0


# encoding -----------------------------------------------------------------------------------------------------

class _Numbers(dict):
    """Numbers words in the order they are first seen; the end token, the empty word, is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _packed(array: np.ndarray) -> bytes:
    """Compressed by byte place, as high bytes are mostly alike."""
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(array.view(np.uint8).reshape(-1, array.itemsize).T).tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(places.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _symbols(words: Iterable[bytes], n: int) -> np.ndarray:
    return (np.fromiter(map(zlib.crc32, words), np.uint32, n) % SYMBOLS).astype(np.uint16)


def _symbol_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column(0):
            words = text.as_py().lower().split()
            out.append(_packed(np.append(_symbols(words, len(words)), np.uint16(END_SYMBOL))))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["symbols"])


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("text"),
                       held_out(doc_id).alias("held_out"))


def training_symbols(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The symbol sequence of each training document."""
    return _rows(docs, doc_id, text).where("not held_out").select("text").mapInArrow(_symbol_task, "symbols binary")


def segments_of(symbols: np.ndarray, words: np.ndarray | None = None) -> Iterator[Segment]:
    for at in range(0, len(symbols), SEGMENT):
        part = slice(max(at - 1, 0), at + SEGMENT)
        yield Segment(symbols[part], at == 0, None if words is None else words[part])


def shares_packed(expected: np.ndarray) -> np.ndarray:
    """Rows of expected counts as one integer each, ``SHARE_BITS`` a state; 0 for a row without counts."""
    whole = expected.sum(1, keepdims=True)
    steps = np.rint(((1 << SHARE_BITS) - 1) * np.divide(expected, whole, out=np.zeros_like(expected), where=whole > 0))
    return (steps.astype(np.int64) << SHARE_BITS * np.arange(expected.shape[1])).sum(1).astype(np.int32)


def shares_unpacked(packed: np.ndarray, states: int) -> np.ndarray:
    steps = packed.astype(np.int64)[:, None] >> SHARE_BITS * np.arange(states) & (1 << SHARE_BITS) - 1
    steps = steps + SHARE_FLOOR
    return steps / steps.sum(1, keepdims=True)


def _encode(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    task, nr = TaskContext.get().partitionId(), 0
    numbers, docs, tokens = _Numbers({b"": 0}), [], 0
    k = len(model.start)

    def expected(symbols: np.ndarray) -> np.ndarray:
        out = np.zeros((len(symbols), k))
        for batch in batched(s for _, held, ids in docs if not held for s in segments_of(symbols[ids], ids)):
            expected_counts(model, batch, (np.zeros(k), np.zeros((k, k)), out))
        return out

    def flushed() -> list[pa.RecordBatch]:
        block = task << 32 | nr
        n = len(numbers)
        symbols = _symbols(numbers, n)
        symbols[0] = END_SYMBOL
        train = [ids for _, out, ids in docs if not out] or [np.empty(0, np.uint32)]
        counts = np.bincount(np.concatenate(train), minlength=n)
        rows = len(docs)
        texts = {"word_row": [False] * rows, "block": [block] * rows, "doc_id": [d[0] for d in docs],
                 "held_out": [d[1] for d in docs], "n_tokens": [len(d[2]) for d in docs],
                 "ids": [_packed(d[2]) for d in docs]}
        words = {"word_row": [True] * n, "block": [block] * n, "word": list(numbers), "word_nr": range(n),
                 "symbol": symbols, "train_count": counts, "shares": shares_packed(expected(symbols))}
        return [pa.RecordBatch.from_arrays(
            [pa.array(part[f.name], f.type) if f.name in part else pa.nulls(size, f.type) for f in ARROW], schema=ARROW)
            for part, size in ((texts, rows), (words, n))]

    for batch in batches:
        for doc_id, text, out in zip(*batch.columns):
            words = text.as_py().lower().split()
            ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            docs.append((doc_id.as_py(), out.as_py(), np.append(ids, 0).astype(np.uint32)))
            tokens += len(words) + 1
            if tokens >= BLOCK_TOKENS:
                yield from flushed()
                numbers, docs, tokens, nr = _Numbers({b"": 0}), [], 0, nr + 1
    if docs:
        yield from flushed()


def encode(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of documents (word numbers) and of the words of each block with their counts and state shares."""
    return _rows(docs, doc_id, text).mapInArrow(partial(_encode, model=model), ENCODED)


def _steps(packed: Column, states: int) -> list[Column]:
    mask = F.lit((1 << SHARE_BITS) - 1)
    return [F.shiftright(packed, SHARE_BITS * k).bitwiseAND(mask) for k in range(states)]


def _share(packed: Column, states: int) -> list[Column]:
    steps = [s + SHARE_FLOOR for s in _steps(packed, states)]
    return [s / sum(steps[1:], steps[0]) for s in steps]


def counted_words(encoded: DataFrame, states: int = STATES) -> DataFrame:
    """(home, word_nr, symbol, c, shares, first): each block's words with count and shares over all training tokens.

    One exchange by word: a word has one row per block that holds it, so no key grows beyond the number of blocks.
    """
    same = Window.partitionBy("word")
    steps = _steps(F.col("shares"), states)
    whole = F.greatest(sum(steps[1:], steps[0]), F.lit(1))
    parts = [F.sum((F.col("train_count") * s * FIXED_POINT / whole).cast("long")).over(same) for s in steps]
    counted = encoded.where("word_row").select(
        F.col("block").alias("home"), "word_nr", F.col("symbol").cast("short").alias("symbol"),
        F.sum("train_count").over(same).alias("c"), *[p.alias(f"part{k}") for k, p in enumerate(parts)],
        (F.col("block") == F.min("block").over(same)).alias("first"))
    top = (1 << SHARE_BITS) - 1
    packed = [F.shiftleft(F.round(F.col(f"part{k}") * top / (F.greatest("c", F.lit(1)) * FIXED_POINT)).cast("int"),
                          SHARE_BITS * k) for k in range(states)]
    return counted.select("home", "word_nr", "symbol", "c", sum(packed[1:], packed[0]).alias("shares"), "first")


def totals(words: DataFrame, model: Model) -> Counts:
    """Sums over the distinct training words; a row per symbol reaches the driver."""
    states = len(model.start)
    weight = (F.col("c") + ADD) / (F.col("c") + BACK_OFF)
    fixed = lambda x: F.sum((x * FIXED_POINT).cast("long"))
    by_symbol = words.where("first and c > 0").groupBy("symbol").agg(
        F.sum("c").alias("c"), F.count("*").alias("v"), fixed(weight * BACK_OFF).alias("back"),
        *[fixed(weight * F.col("c") * s).alias(f"own{k}") for k, s in enumerate(_share(F.col("shares"), states))]).collect()
    shares = symbol_shares(model)
    tokens = sum(r.c for r in by_symbol)
    unseen = np.ones(SYMBOLS + 1)
    unseen[END_SYMBOL] = tokens == 0
    sums = ADD * unseen @ shares
    for r in sorted(by_symbol):
        sums += (np.array([r[f"own{k}"] for k in range(states)]) + r.back * shares[r.symbol]) / FIXED_POINT
    return Counts(tokens, sum(r.v for r in by_symbol), sums, shares)


# hidden Markov model ------------------------------------------------------------------------------------------

def symbol_shares(model: Model) -> np.ndarray:
    """The share of each state among the tokens of a symbol, for states as frequent as they are in the long run."""
    joint = model.emit * long_run(model)
    return joint / joint.sum(1, keepdims=True)


def long_run(model: Model) -> np.ndarray:
    """The stationary distribution, by repeated squaring."""
    return np.linalg.matrix_power(model.move, 1 << 16).mean(0)


def starting_model(profiles: list[np.ndarray], base: np.ndarray, states: int = STATES) -> Model:
    """States that lean towards the documents that differ most, found farthest first."""
    roots = [np.sqrt(p / p.sum()) for p in profiles if p.sum()]
    picked = roots[:1]
    while len(picked) < min(states, len(roots)):
        picked.append(min(roots, key=lambda r: max(float(r @ p) for p in picked)))
    emit = np.array([0.5 * base + 0.5 * p * p for p in picked] + [base] * (states - len(picked)))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, np.ascontiguousarray(emit.T))


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact sequence likelihoods by the scaled forward recursion, all sequences in step."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lengths = np.array([len(sequences[i]) for i in order])
    offsets = np.cumsum(lengths) - lengths
    flat = np.concatenate([sequences[i] for i in order])
    logs = np.zeros(len(order))
    alpha = None
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    for t, n in enumerate(active):
        prior = model.start if alpha is None else alpha[:n] @ model.move
        alpha = prior * model.emit[flat[offsets[:n] + t]]
        scale = alpha.sum(1)
        logs[:n] += np.log10(scale)
        alpha /= scale[:, None]
    out = np.empty(len(order))
    out[order] = logs
    return out


def batched(segments: Iterable[Segment]) -> Iterator[list[Segment]]:
    """Segments in lists of about ``BATCH`` tokens."""
    waiting, tokens = [], 0
    for segment in segments:
        waiting.append(segment)
        tokens += len(segment.symbols)
        if tokens >= BATCH:
            yield waiting
            waiting, tokens = [], 0
    if waiting:
        yield waiting


def expected_counts(model: Model, segments: list[Segment], into: tuple[np.ndarray, ...]) -> None:
    """Forward-backward over segments; adds to (start, move, emit) counts, emissions by word where segments have them."""
    segments = sorted(segments, key=lambda s: -len(s.symbols))
    lengths = np.array([len(s.symbols) for s in segments])
    first = np.array([s.first for s in segments])
    offsets = np.cumsum(lengths) - lengths
    flat = np.concatenate([s.symbols for s in segments])
    labels = flat if segments[0].words is None else np.concatenate([s.words for s in segments])
    begin = np.where(first[:, None], model.start, long_run(model)).astype(np.float32)
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    emit = model.emit.astype(np.float32)
    move = model.move.astype(np.float32)
    seen, alphas, scales, at = [], [], [], []
    alpha = None
    for t, n in enumerate(active):
        where = offsets[:n] + t
        out = emit[flat[where]]
        alpha = (begin if alpha is None else alpha[:n] @ move) * out
        scale = alpha.sum(1, keepdims=True)
        alpha /= scale
        seen.append(out), alphas.append(alpha), scales.append(scale), at.append(where)
    start, moves, emits = into
    gammas = np.empty((len(flat), len(move)), np.float32)
    beta = np.ones((0, len(move)), np.float32)
    for t in range(len(active) - 1, -1, -1):
        if t + 1 < len(active):
            ahead = seen[t + 1] * beta / scales[t + 1]
            moves += (alphas[t][:len(ahead)].T @ ahead) * move
            beta = np.concatenate([ahead @ move.T, np.ones((active[t] - len(ahead), len(move)), np.float32)])
        else:
            beta = np.ones((active[t], len(move)), np.float32)
        gammas[at[t]] = alphas[t] * beta
    start += gammas[offsets[first]].sum(0)
    gammas[offsets[~first]] = 0
    for k in range(len(move)):
        emits[:, k] += np.bincount(labels, gammas[:, k], minlength=len(emits))


def _count_task(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Expected counts of a task as (place in the model's table, fixed-point count)."""
    k = len(model.start)
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros_like(model.emit)
    sequences = (_unpacked(data.as_py(), np.uint16) for batch in batches for data in batch.column(0))
    for batch in batched(s for symbols in sequences for s in segments_of(symbols)):
        expected_counts(model, batch, (start, move, emit))
    fixed = np.rint(np.concatenate([start, move.ravel(), emit.ravel()]) * FIXED_POINT).astype(np.int64)
    place = np.flatnonzero(fixed)
    yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(fixed[place])], ["place", "amount"])


def _tally_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SYMBOLS + 1, np.int64)
    for batch in batches:
        for data in batch.column(0):
            counts += np.bincount(_unpacked(data.as_py(), np.uint16), minlength=SYMBOLS + 1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(SYMBOLS + 1)), pa.array(counts)], ["place", "amount"])


def _summed(symbols: DataFrame, task, size: int) -> np.ndarray:
    """Tables of the tasks added up place by place."""
    rows = symbols.mapInArrow(task, "place long, amount long").groupBy("place").agg(
        F.sum("amount").alias("amount")).toPandas()
    out = np.zeros(size)
    out[rows["place"]] = rows["amount"]
    return out


def train(symbols: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all training documents."""
    tallied = _summed(symbols, _tally_task, SYMBOLS + 1)
    base = (tallied + ADD) / (tallied + ADD).sum()
    # Equal sequences have equal hashes and seed once.
    hashed = symbols.select("symbols", F.xxhash64("symbols").alias("h"))
    least = hashed.select("h").distinct().orderBy("h").limit(SEEDS)
    chosen = hashed.join(least, "h").groupBy("h").agg(F.max("symbols").alias("symbols")).orderBy("h").collect()
    profiles = [np.bincount(_unpacked(r.symbols, np.uint16), minlength=SYMBOLS + 1) for r in chosen]
    model = starting_model(profiles, base, states)
    for _ in range(rounds if tallied.any() else 0):
        flat = _summed(symbols, partial(_count_task, model=model), states + states * states + states * (SYMBOLS + 1))
        start, move, emit = np.split(flat / FIXED_POINT, [states, states + states * states])
        start, move = start + 1, move.reshape(states, states) + 1
        emit = emit.reshape(SYMBOLS + 1, states) + 100 * base[:, None]
        model = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    return model


# scoring ------------------------------------------------------------------------------------------------------

def word_emissions(c: np.ndarray, symbol: np.ndarray, packed: np.ndarray, counts: Counts) -> np.ndarray:
    """P(word | state), a row per word."""
    own = shares_unpacked(packed, len(counts.totals))
    mixed = (c[:, None] * own + BACK_OFF * counts.symbol_shares[symbol]) / (c + BACK_OFF)[:, None]
    return (c + ADD)[:, None] * mixed / counts.totals


def _score(docs: pa.Table, words: pa.Table, model: Model, counts: Counts) -> pa.Table:
    """Scores of a block's documents; ``words`` has the block's words with their counts over the whole corpus."""
    nr = words["word_nr"].to_numpy()
    c, symbol, packed = np.zeros(len(nr)), np.zeros(len(nr), np.int64), np.zeros(len(nr), np.int64)
    c[nr], symbol[nr], packed[nr] = (words[name].to_numpy() for name in ("c", "symbol", "shares"))
    base = np.log10((c + ADD) / (counts.tokens + ADD * (counts.words + 1)))
    by_word = model._replace(emit=word_emissions(c, symbol, packed, counts))
    sequences = [_unpacked(ids.as_py(), np.uint32) for ids in docs["ids"]]
    known = [int((c[ids] > 0).sum()) for ids in sequences]
    bases = [math.fsum(base[ids]) for ids in sequences]
    scores = log10_likelihoods(by_word, sequences) if sequences else []
    return pa.Table.from_arrays(
        [docs["doc_id"], docs["held_out"], docs["n_tokens"], pa.array(known, pa.int64()),
         pa.array([counts.tokens] * len(docs), pa.int64()), pa.array(bases, pa.float64()),
         pa.array(scores, pa.float64())], schema=SCORES_ARROW)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", states: int = STATES,
          rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; at most 6 states."""
    model = train(stage(training_symbols(docs, doc_id, text), "lm-symbols"), states, rounds)
    encoded = stage(encode(docs, model, doc_id, text), "lm-encoded")
    words = stage(counted_words(encoded, states), "lm-words")
    counts = totals(words, model)
    words = words.select("home", "word_nr", "symbol", "c", "shares")
    texts = encoded.where("not word_row").select("block", "doc_id", "held_out", "n_tokens", "ids")
    return texts.groupBy("block").cogroup(words.groupBy("home")).applyInArrow(
        lambda left, right: _score(left, right, model, counts), SCORES)
