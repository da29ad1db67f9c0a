"""Removal of repeated passages against every substring counted by hand."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from posledger.llm import repeats

SCHEMA = "doc_id long, text string, id int, mark int, spans string"


def expected(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p:p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA).repartition(3)
    got = repeats.remove_repeats(frame).collect()
    for r in got:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé日", k=rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            cut = rng.randint(0, 40)
            parts += [passage[cut:cut + rng.choice([190, 199, 200, 201, 230, 400])], prose(rng.randint(0, 20))]
        rows.append((i, rng.choice(["", " "]).join(parts)))
    base = prose(200).split()
    for i in range(100, 130):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(len(copy))] = word()
        rows.append((i, " ".join(copy)))
    rows += [(200, None), (201, ""), (202, "a" * 199), (203, "a" * 200), (204, "b" * 201), (205, "ab" * 300), (206, "ab" * 90 + "c"),
             (None, prose(60)), (None, prose(60)), (7, rows[7][1]), (7, "other " + rows[7][1]), (300, rows[9][1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_every_substring_counted(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == expected(rows)


def test_slices_of_long_texts(spark, monkeypatch):
    """Runs that a slice cuts differ from their copies elsewhere and must still be found."""
    monkeypatch.setattr(repeats, "SLICE", 700)
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefgh ", k=9000))
    rows = [(1, long), (2, "x" * 333 + long[1000:6000]), (3, long[2500:2699]), (4, long[2500:2700] + "z"), (5, "q" * 3000)]
    assert found(spark, rows) == expected(rows)


def test_one_long_repetitive_text(spark):
    rows = [(1, "a" * 300_000 + "b"), (2, "c" * 250)]
    a, b = found(spark, rows)
    assert a[1:4] == (300_001, 300_000, 1) and b[2:4] == (250, 1)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    shared = "".join(rng.choices("abcd", k=500)).encode()
    places = []
    for n in (0, 17, 230):
        text = bytes(rng.choices(b"abcd", k=n)) + shared + bytes(rng.choices(b"abcd", k=90))
        at = {}
        for first, last, anchor in zip(*(x.tolist() for x in repeats.runs_of(text)[1:])):
            at |= {p - n: anchor - n for p in range(first, last + 1)}
        places.append([at[p] for p in range(301)])
    assert places[0] == places[1] == places[2]
