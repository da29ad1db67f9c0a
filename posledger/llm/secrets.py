"""Secret scanning: fixed patterns, and probabilistic automata inferred from the credentials they find.

Base. ``assign`` (a keyword, a separator and a value of 6 or more characters), ``access`` (key ids) and ``hex`` (runs of
24 or more) are found leftmost and without overlap per kind. Their values are the labelled credentials.

Grammar inference. For each kind a prefix tree of its labelled values, written in character classes, is folded by
state merging: a state joins an earlier one if their stop and successor frequencies, and those of all states below,
differ by no more than the Hoeffding bound allows. The result is a probabilistic automaton of the format. One more
automaton is inferred from the other long tokens. Automata are fitted on a bounded sample, the ``SAMPLE`` values of
each kind with the smallest hash; everything else reads all texts.

Scoring. Every maximal run of credential characters of ``MIN_TOKEN`` or more that touches no base span is scored by all
automata. It is reported as ``format`` if a credential automaton accepts it, gives it at least the probability per
character of its ``QUANTILE`` of labelled values, and ``MARGIN`` nats more than the automaton of other tokens does.

Defined results: a null text is empty; no spans give an empty list. Positions are code points, ends exclusive.
Repeated rows are scanned alike. Without labelled values of a kind there is no automaton of it. Extra columns pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from posledger.llm.common import text_of

#: The kinds in their order and their patterns.
KINDS = ("assign", "access", "hex", "format")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_.=-]{16,}"
KEYWORDS = (b"passw", b"secret", b"token", b"api")
MIN_VALUE = 6
MIN_TOKEN = 16

SAMPLE = 500
ALPHA = 0.05
QUANTILE = 0.05
MARGIN = 10.0
OTHER = "other"

_assign, _access = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCESS)
_hex, _token = re.compile(HEX), re.compile(TOKEN)
_classes = [(re.compile(p), c) for p, c in
            ((r"[0-9]", "9"), (r"[a-f]", "a"), (r"[g-z]", "z"), (r"[A-F]", "A"), (r"[G-Z]", "Z"))]

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
VALUES = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())]))
VALUES_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))


class Automaton(NamedTuple):
    stop: list[float]  # log probability of stopping, by state; -inf if no value stopped there
    step: list[dict[str, tuple[float, int]]]  # class -> (log probability, next state)


class Format(NamedTuple):
    kind: str
    automaton: Automaton
    floor: float  # least log probability per character


def classes_of(value: str) -> str:
    """A value in character classes; punctuation stands for itself."""
    for pattern, symbol in _classes:
        value = pattern.sub(symbol, value)
    return value


# grammar inference --------------------------------------------------------------------------------------------

class _State:
    """stopped: values that end here; taken and next: by class, the values that go on and where to."""

    __slots__ = ("stopped", "taken", "next")

    def __init__(self):
        self.stopped, self.taken, self.next = 0, Counter(), {}

    def passed(self) -> int:
        return self.stopped + sum(self.taken.values())


def _prefix_tree(values: Counter) -> _State:
    root = _State()
    for value, times in sorted(values.items()):
        state = root
        for symbol in value:
            state.taken[symbol] += times
            state = state.next.setdefault(symbol, _State())
        state.stopped += times
    return root


def _compatible(a: _State, b: _State, alpha: float) -> bool:
    """Whether tree state b and all below it agree with state a, by Hoeffding's bound."""
    wide = math.sqrt(0.5 * math.log(2 / alpha))
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        n, m = a.passed(), b.passed()
        bound = wide * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        if abs(a.stopped / n - b.stopped / m) > bound:
            return False
        for symbol in a.taken.keys() | b.taken.keys():
            if abs(a.taken[symbol] / n - b.taken[symbol] / m) > bound:
                return False
            if symbol in a.next and symbol in b.next:
                stack.append((a.next[symbol], b.next[symbol]))
    return True


def _fold(a: _State, b: _State) -> None:
    """Add tree state b and all below it to a."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        a.stopped += b.stopped
        a.taken.update(b.taken)
        for symbol, below in b.next.items():
            if a.next.setdefault(symbol, below) is not below:
                stack.append((a.next[symbol], below))


def infer(values: Counter, alpha: float = ALPHA) -> Automaton:
    """Merge statistically compatible prefix-tree states, those nearest to the root first."""
    kept = {id(root): root for root in [_prefix_tree(values)]}
    while True:
        edge = next(((k, s) for k in kept.values() for s in sorted(k.next) if id(k.next[s]) not in kept), None)
        if edge is None:
            break
        parent, symbol = edge
        new = parent.next[symbol]
        same = next((k for k in kept.values() if _compatible(k, new, alpha)), None)
        if same is None:
            kept[id(new)] = new
        else:
            parent.next[symbol] = same
            _fold(same, new)
    place = {key: i for i, key in enumerate(kept)}
    log = lambda part, whole: math.log(part / whole) if part else -math.inf
    return Automaton(
        [log(k.stopped, k.passed()) for k in kept.values()],
        [{s: (log(k.taken[s], k.passed()), place[id(t)]) for s, t in k.next.items()} for k in kept.values()])


# scanning -----------------------------------------------------------------------------------------------------

def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the fixed patterns, by start and kind."""
    found, low = [], text.encode("utf-8", "surrogatepass").lower()
    if any(k in low for k in KEYWORDS):
        found += [(*m.span(), "assign", m[2]) for m in _assign.finditer(text) if len(m[2]) >= MIN_VALUE]
    # Runs of the other kinds lie within runs of credential characters.
    for run in _token.finditer(text):
        for kind, pattern in (("access", _access), ("hex", _hex)):
            found += [(*m.span(), kind, m[0]) for m in pattern.finditer(text, *run.span())]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


def other_tokens(text: str, base: list[tuple]) -> list[tuple[int, int, str]]:
    """Long runs of credential characters that touch no base span; both are in order, so one pass compares them."""
    out, at, reach = [], 0, 0
    for m in _token.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][0] < end:
            reach, at = max(reach, base[at][1]), at + 1
        if reach <= start:
            out.append((start, end, m[0]))
    return out


@arrow_udf(VALUES)
def _values(texts: pa.Array) -> pa.Array:
    out = []
    for t in texts:
        text = t.as_py()
        base = base_spans(text)
        out.append([{"kind": b[2], "value": b[3]} for b in base]
                   + [{"kind": OTHER, "value": value} for *_, value in other_tokens(text, base)])
    return pa.array(out, VALUES_ARROW)


def labelled_values(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> dict[str, Counter]:
    """The values of each kind with the smallest hashes, at most ``sample`` of a kind, in character classes."""
    values = docs.select(F.explode(_values(text_of(text))).alias("v")).select("v.kind", "v.value").distinct()
    order = [F.xxhash64("value"), "value"]
    # First the best of each of 64 parts of a kind, then the best of those, so no task ranks a whole kind.
    for keys in (["kind", F.pmod(F.xxhash64("value", F.lit("part")), F.lit(64))], ["kind"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        values = values.withColumn("nr", rank).where(F.col("nr") <= sample).drop("nr")
    out: dict[str, Counter] = {}
    for r in values.collect():
        out.setdefault(r.kind, Counter())[classes_of(r.value)] += 1
    return out


def fit(labelled: dict[str, Counter], alpha: float = ALPHA, quantile: float = QUANTILE) -> list[Format]:
    """An automaton for each kind that has values; its floor is a low quantile of its own values' likelihoods."""
    formats = []
    for kind in sorted(labelled):
        automaton = infer(labelled[kind], alpha)
        rates = sorted(_class_score(automaton, v) / len(v) for v in labelled[kind].elements())
        formats.append(Format(kind, automaton, rates[int(quantile * (len(rates) - 1))]))
    return formats


def _class_score(automaton: Automaton, classes: str) -> float:
    state, total = 0, 0.0
    for symbol in classes:
        found = automaton.step[state].get(symbol)
        if found is None:
            return -math.inf
        total, state = total + found[0], found[1]
    return total + automaton.stop[state]


def likely_secret(value: str, formats: list[Format], margin: float = MARGIN) -> bool:
    classes = classes_of(value)
    scores = {f.kind: _class_score(f.automaton, classes) for f in formats}
    other = scores.get(OTHER, -math.inf)
    return any(f.kind != OTHER and scores[f.kind] >= f.floor * len(classes) and scores[f.kind] > other + margin
               for f in formats)


def spans(text: Column, formats: list[Format], margin: float = MARGIN) -> Column:
    """All spans of a text by start, then kind."""

    @arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            content = t.as_py()
            base = base_spans(content)
            found = [b[:3] for b in base]
            found += [(start, end, "format") for start, end, value in other_tokens(content, base)
                      if likely_secret(value, formats, margin)]
            found.sort(key=lambda f: (f[0], KINDS.index(f[2])))
            out.append([{"kind": kind, "start": start, "end": end} for start, end, kind in found])
        return pa.array(out, SPANS_ARROW)

    return scan(text_of(text))


def find_secrets(docs: DataFrame, text: str = "text", output: str = "secrets", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with its spans in column ``output``, which takes the place of a column of that name."""
    formats = fit(labelled_values(docs, text, sample))
    rest = [c for c in docs.columns if c.lower() != output.lower()]
    return docs.select(*rest, spans(F.col(text), formats).alias(output))
