"""Line-first cleaning: rules judge lines, failing lines go, and a document that loses too much goes whole.

Every line that holds a word meets three rules:

* punctuation: it ends in a sentence mark (closing quotes and brackets may follow) unless it is a
  paragraph of ``long_line`` words or more, and symbols make up no more than a tenth of its characters;
* navigation: fewer than two stand-alone menu separators;
* boilerplate: no stock phrase of sites and licences in a line of at most ``stock_words`` words.

The document is rejected if the failing lines held more than ``max_loss`` of its word characters.

Defined results: a null text has no words, no lines and every count 0. Lines and windows are compared
exactly. Repeated rows are judged alike, each for itself; nothing moves between rows, so a hot source or
a very long text costs its own row only. Extra columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from posledger.llm.common import unused

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LONG_LINE = 40
STOCK_WORDS = 12
MAX_LOSS = 0.5

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SENTENCE_END = r"[.!?…:;。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$"
SEPARATOR = r"[\x20\x09][|»›•·][\x20\x09]"
STOCK_PHRASE = (
    r"all rights reserved|terms of (use|service)|privacy policy|cookie policy|use of cookies|accept cookies"
    r"|enable javascript|click here|sign up for|subscribe to our|skip to content|powered by")

FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("lost_chars", pa.int64()), ("base_failed", pa.bool_()),
    ("kept", pa.bool_()), ("clean_text", pa.string())]
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "lost_chars long, base_failed boolean, kept boolean, clean_text string")

_end, _separator, _stock = re.compile(SENTENCE_END), re.compile(SEPARATOR), re.compile(STOCK_PHRASE)
_symbol, _space = re.compile(f"[{re.escape(SYMBOLS)}]"), re.compile(f"[{SPACE}]")


def _length(piece: str) -> int:
    return len(piece) - sum(map(piece.count, SPACE))


def line_fails(line: str, words: int, chars: int) -> bool:
    """The rules for one line with that many words and word characters."""
    if words < LONG_LINE and not _end.search(line):
        return True
    if len(_symbol.findall(line)) * 10 > chars or len(_separator.findall(line)) >= 2:
        return True
    return words <= STOCK_WORDS and _stock.search(line.lower()) is not None


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    windows = [b" ".join(w) for w in zip(words, words[1:], words[2:])]
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, reach = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, reach)
            reach = at + 3
    return covered


def judge(text: str | None, max_loss: float = MAX_LOSS) -> tuple:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    total, symbols = _length(text), len(_symbol.findall(text))
    seen: set[str] = set()
    lines, kept_lines, lost = 0, [], 0
    for line in text.split("\n"):
        chars = _length(line)
        if not chars:
            continue
        lines += 1
        seen.add(line)
        if line_fails(line, len(line.encode("utf-8", "surrogatepass").split()), chars):
            lost += chars
        else:
            kept_lines.append(line)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    return (len(words), total, symbols, lines - len(seen), repeats, lost, failed,
            not failed and lost <= max_loss * total, "\n".join(kept_lines))


def quality(text: Column, max_loss: float = MAX_LOSS) -> Column:
    """A struct of the counts, the verdict and the text that the line rules leave."""

    @arrow_udf(SCHEMA)
    def report(texts: pa.Array) -> pa.Array:
        columns = zip(*(judge(t.as_py(), max_loss) for t in texts)) if len(texts) else [[] for _ in FIELDS]
        return pa.StructArray.from_arrays(
            [pa.array(values, kind) for values, (_, kind) in zip(columns, FIELDS)], [n for n, _ in FIELDS])

    return report(text)


def assess(docs: DataFrame, text: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """``docs`` with the report's columns added; a column of the same name gives way to the report's."""
    (box,) = unused(docs, "quality_report")
    names = {n for n, _ in FIELDS}
    rest = [c for c in docs.columns if c.lower() not in names]
    return docs.select(*rest, quality(F.col(text), max_loss).alias(box)).select(*rest, f"{box}.*")


def drop_rejected(docs: DataFrame, text: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """The documents that pass, as they were."""
    return docs.where(quality(F.col(text), max_loss)["kept"])
