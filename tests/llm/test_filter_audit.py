"""The filter audit against removal by hand in every order."""

from __future__ import annotations

import random
import re
from itertools import permutations

from posledger.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, part string, mask int, n int"
LABELS = "doc_id long, quality int, toxic int, part string"


def plain_counts(text):
    words = WORD.findall(text)
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


def failing(rows):
    out = []
    for doc_id, text, *_ in rows:
        n, distinct, capitals, points, symbols = plain_counts(text or "")
        again = doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, *_ in rows)
        tests = (n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * points, symbols > 0, again)
        out.append({f for f, bad in zip("ABCDE", tests) if bad})
    return out


def expected(rows, labels):
    out = {}
    fails = failing(rows)
    for part in {lang or "" for _, _, lang, *_ in rows}:
        inside = [(i, f) for (i, _, lang, *_), f in zip(rows, fails) if (lang or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        table = {}
        for order in permutations("ABCDE"):
            left = list(inside)
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(removed)
                having = lambda nr: sum(any(l[0] == i and i is not None and l[nr] == 1 for l in labels) for i, _ in removed)  # noqa: E731, B023
                table["".join(order), step] = [len(left), len(removed), sum(letter in f for _, f in inside) - len(removed),
                                               sum(f == {letter} for _, f in inside), having(1), having(2)]
        out |= {(part, *k): (*v, shapley[k[0][k[1] - 1]]) for k, v in table.items()}
    return out


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    marks = spark.createDataFrame(labels, LABELS)
    out = filter_audit.audit(docs, marks).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in out}
    assert len(found) == len(out)
    return found


def corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["été", "Œuvre", " x", "日本"]
    rows = []
    for i in range(60):
        n = rng.choice([0, 3, 199, 200, 260])
        body = rng.sample(words, n) if rng.random() < 0.6 else rng.choices(words[:40], k=n)
        text = rng.choice([" ", "\n", "\t\x0b"]).join(body)
        text += rng.choice(["", "", " A#", " X" * 40, "\r"])
        rows.append((i, text, rng.choice(["en", "de", None, ""]), "x", 1, 2))
    rows += [(100, rows[7][1], "en", "x", 1, 2), (None, rows[7][1], "en", "x", 1, 2), (None, None, None, None, None, None),
             (5, rows[5][1], "de", "x", 1, 2), (101, None, "zz", "x", 1, 2), (102, "Aé |" * 200_000, "zz", "x", 1, 2)]
    labels = [(i, rng.randint(0, 1), rng.choice([0, 1, None]), "p") for i in range(0, 60, 2)] + [(4, 1, 1, "p"), (None, 1, 1, "p")]
    return rows, labels


def test_every_order_against_removal_by_hand(spark):
    rows, labels = corpus()
    got = audited(spark, rows, labels)
    assert got == expected(rows, labels)
    assert len(got) == 4 * 600
    assert {"".join(sorted(f)) for f in failing(rows)} & {"ABCDE"[i] for i in range(5)}


def test_without_labels_and_without_documents(spark):
    rows, _ = corpus()
    assert audited(spark, rows[:9], []) == expected(rows[:9], [])
    assert audited(spark, [], []) == {}


def test_transducer_on_odd_bytes():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices(" \t\n\x0b\x0c\r\x00\x1f\x85  aAZz#|é日𝄞", k=rng.randint(0, 40)))
        assert filter_audit.transduce(text.encode()) == plain_counts(text), repr(text)


def test_equal_hashes_do_not_merge_words():
    assert filter_audit.transduce(b"a b a ab") == (4, 3, 0, 8, 0)
