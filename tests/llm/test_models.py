"""Language model, secrets and page extraction: brute force, hand-made cases and held-out accuracy."""

from __future__ import annotations

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from posledger.llm import dom, html_extraction, lm_scoring, secrets

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(FOLD)) if w] + [""]


# language model -----------------------------------------------------------------------------------------------

def two_tongues(n=300, seed=2):
    rng = random.Random(seed)
    tongues = [[f"{p}{i}" for i in range(40)] for p in ("alpha", "omega")]
    return [(i, " ".join(rng.choices(tongues[i % 2], k=rng.randint(1, 60)))) for i in range(n)]


def lm_docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, b"x") for i, t in rows], "doc_id long, text string, block int, terms binary")


def test_base_scores_match_brute_force_and_states_help(spark, monkeypatch):
    rows = two_tongues() + [(900, None), (901, ""), (902, "Alpha1 ALPHA1 unseen-Word ÉTÉ"), (3, "alpha1"), (None, "omega1"),
                            (903, "alpha1 omega2 " * 3000)]
    got = lm_scoring.score(lm_docs(spark, rows)).collect()
    train = Counter(w for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, t in rows:
        words = tokens(t)
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out = i is None or zlib.crc32(str(i).encode()) % 10 == 0
        want[(i, out, len(words), sum(train[w] > 0 for w in words), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 10
    # Small blocks and batches change nothing but the order of addition.
    plain = sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6)) for r in got)
    again = lm_scoring.score(lm_docs(spark, rows).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6)) for r in again) == plain


def small_model(states=2, symbols=4, seed=0):
    rng = np.random.default_rng(seed)
    norm = lambda a, axis: a / a.sum(axis, keepdims=True)
    return lm_scoring.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1),
                            norm(rng.random((symbols, states)), 0))


def path_probability(model, path, seen):
    p = model.start[path[0]] * model.emit[seen[0], path[0]]
    for t in range(1, len(seen)):
        p *= model.move[path[t - 1], path[t]] * model.emit[seen[t], path[t]]
    return p


def test_forward_recursion_sums_over_all_paths():
    model = small_model(3)
    sequences = [np.array(s) for s in ([0], [1, 2, 3, 0, 1], [3, 3], [2, 1, 0, 0, 2, 3])]
    got = lm_scoring.log10_likelihoods(model, sequences)
    for value, seen in zip(got, sequences):
        total = sum(path_probability(model, p, seen) for p in itertools.product(range(3), repeat=len(seen)))
        assert math.isclose(value, math.log10(total), rel_tol=1e-9)


def test_expected_counts_match_enumeration():
    model = small_model()
    segments = [np.array(s) for s in ([0, 1, 2], [3, 3, 1, 0], [2])]
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for seen in segments:
        paths = {p: path_probability(model, p, seen) for p in itertools.product(range(2), repeat=len(seen))}
        for p, w in paths.items():
            w /= sum(paths.values())
            start[p[0]] += w
            for t, s in enumerate(p):
                emit[seen[t], s] += w
                if t:
                    move[p[t - 1], s] += w
    got = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    lm_scoring.expected_counts(model, [lm_scoring.Segment(s) for s in segments], got)
    for a, b in zip(got, (start, move, emit)):
        assert np.allclose(a, b, atol=1e-4)


def test_segments_cover_each_token_and_each_step_once(monkeypatch):
    monkeypatch.setattr(lm_scoring, "SEGMENT", 3)
    symbols = np.array([0, 1, 2, 3, 1, 0, 2, 2], np.uint16)
    segments = list(lm_scoring.segments_of(symbols, np.arange(8)))
    assert [s.first for s in segments] == [True, False, False]
    assert sum(len(s.symbols) - 1 for s in segments) == len(symbols) - 1
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((8, 2))
    lm_scoring.expected_counts(small_model(), segments, (start, move, emit))
    assert math.isclose(start.sum(), 1, rel_tol=1e-5) and math.isclose(move.sum(), 7, rel_tol=1e-5)
    assert np.allclose(emit.sum(1), 1, atol=1e-5)


def test_emissions_of_all_words_sum_to_one(spark):
    """Every state's seen words and one unseen word of each symbol make a distribution; shares are the words' own."""
    rng, states = np.random.default_rng(3), 3
    model = small_model(states, lm_scoring.SYMBOLS + 1)
    end, n = lm_scoring.END_SYMBOL, 50
    symbol = np.append(rng.integers(0, 20, n), end)
    c = np.append(rng.integers(0, 9, n), 30)
    shares = lm_scoring.shares_packed(rng.random((n + 1, states)) ** 4)
    rows = [(7, i, int(symbol[i]), int(c[i]), int(shares[i]), True) for i in range(n + 1)]
    rows += [(8, i, *r[2:5], False) for i, r in enumerate(rows[::-1])]
    words = spark.createDataFrame(rows, "home long, word_nr long, symbol short, c long, shares int, first boolean")
    counts = lm_scoring.totals(words, model)
    assert counts.tokens == c.sum() and counts.words == (c > 0).sum()
    seen = c > 0
    emitted = lm_scoring.word_emissions(c[seen].astype(float), symbol[seen], shares[seen].astype(int), counts)
    none = np.zeros(end)
    unseen = lm_scoring.word_emissions(none, np.arange(end), none.astype(int), counts)
    assert np.allclose(emitted.sum(0) + unseen.sum(0), 1, atol=1e-4)


def test_words_of_one_symbol_keep_their_own_shares(spark):
    encoded = [(True, block, w, nr, 0, count, int(lm_scoring.shares_packed(np.array([share]))[0]))
               for block in (0, 1) for nr, (w, count, share) in enumerate(
                   [(b"a", 4, [3.0, 1.0]), (b"b", 2, [0.0, 2.0]), (b"c", 0, [0.0, 0.0])])]
    frame = spark.createDataFrame(
        encoded, "word_row boolean, block long, word binary, word_nr long, symbol int, train_count long, shares int")
    got = lm_scoring.counted_words(frame, 2).collect()
    assert {(r.word_nr, r.c) for r in got} == {(0, 8), (1, 4), (2, 0)} and sum(r["first"] for r in got) == 3
    for r in got:
        assert lm_scoring.shares_unpacked(np.array([r.shares]), 2)[0] == pytest.approx(
            [[0.75, 0.25], [0.01, 0.99], [0.5, 0.5]][r.word_nr], abs=0.02)


def test_blocks_are_cut_by_tokens(spark, monkeypatch):
    import pyarrow as pa

    class Context:
        @staticmethod
        def get():
            return Context()

        partitionId = staticmethod(lambda: 5)

    monkeypatch.setattr(lm_scoring, "TaskContext", Context)
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 6)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([b"A b a", b"c d e f g", b"a"]), pa.array([False, False, True])], ["i", "t", "h"])
    rows = [r for out in lm_scoring._encode(iter([batch]), small_model(symbols=lm_scoring.SYMBOLS + 1)) for r in out.to_pylist()]
    assert {r["block"] for r in rows} == {5 << 32, 5 << 32 | 1}
    words = Counter()
    for r in rows:
        if r["word_row"]:
            words[r["word"]] += r["train_count"]
    assert words == {b"": 2, b"a": 2, b"b": 1, b"c": 1, b"d": 1, b"e": 1, b"f": 1, b"g": 1}


def test_lm_without_rows_or_training(spark):
    assert lm_scoring.score(lm_docs(spark, [])).count() == 0
    (row,) = lm_scoring.score(lm_docs(spark, [(None, "a b")])).collect()
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0 and row.score <= 0


# secrets ------------------------------------------------------------------------------------------------------

def hexed(rng, n):
    return "".join(rng.choices("0123456789abcdef", k=n))


def secret_rows(seed=4):
    rng = random.Random(seed)
    upper = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=n))
    rows = [None, "", "token = abc", "TOKEN: 'abcdef' api-key apikey=\"x.y/z+1=\" Passwd   :   secret=abcdefg",
            "ſecret=abcdefg toKen=abcdefg", f"é𝒳 AKIA{upper(16)} AKIA{upper(15)} xAKIAab", "f" * 23 + " " + "0" * 24 + "g",
            f"secret:{hexed(rng, 40)}/{'A' * 30}", "a" * 50_000 + " password = " + "z" * 50_000]
    for _ in range(120):
        rows.append(f"some prose token = \"sk-{hexed(rng, 32)}\" and more prose, card {rng.randrange(10**15, 10**16)} here")
        rows.append(f"a plain line with a verylongordinaryword{rng.randrange(10)} and internationalization only")
    return list(enumerate(rows))


def slow_spans(text):
    text, out = text or "", []
    either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
    for m in re.finditer(either + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), 0, m.end())] * (len(m[2]) >= 6)
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], a, e) for a, k, e in sorted(out)]


def test_base_spans_match_brute_force(spark):
    rows = secret_rows()
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, Secrets string")
    out = secrets.find_secrets(frame).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"doc_id", "text", "secrets"}
    for r in out:
        found = [(s.kind, s.start, s.end) for s in r.secrets]
        assert [s for s in found if s[0] != "format"] == slow_spans(r.text), r.doc_id


def test_inferred_format_finds_unlabelled_credentials_and_no_prose(spark):
    rng = random.Random(8)
    bare = [f"key material sk-{hexed(rng, 32).upper().lower()[:31]}g is not hex" for _ in range(5)]
    planted = [f"we saw sk-{hexed(rng, 16)}{hexed(rng, 16)} in the log" for _ in range(20)]
    rows = secret_rows() + [(1000 + i, t.replace("token", "")) for i, t in enumerate(planted)]
    labelled = secrets.labelled_values(spark.createDataFrame(rows, "doc_id long, text string"))
    formats = secrets.fit(labelled)
    value = lambda t: re.search(r"sk-\S+", t)[0]
    assert sum(secrets.likely_secret(value(t), formats) for t in planted) >= 18
    assert not any(secrets.likely_secret(w, formats) for w in (
        "internationalization", "verylongordinaryword7", "4785380592391139", "http.example.org/a-long-path"))
    assert len(bare) == 5


def test_automata_merge_to_a_distribution():
    rng = random.Random(1)
    values = Counter(secrets.classes_of(hexed(rng, rng.randint(8, 40))) for _ in range(400))
    automaton = secrets.infer(values)
    assert len(automaton.stop) < sum(map(len, values)) / 20
    for stop, step in zip(automaton.stop, automaton.step):
        assert math.isclose(math.exp(stop) + sum(math.exp(p) for p, _ in step.values()), 1, rel_tol=1e-9)


def test_many_spans_of_one_text_take_one_pass():
    """A megabyte with twenty thousand labelled values and as many other tokens, in seconds."""
    rng = random.Random(4)
    parts = []
    for i in range(20_000):
        parts += [f"token={hexed(rng, 12)}", f"plain_token_number_{i}"]
    text = " ".join(parts)
    took = time.perf_counter()
    base = secrets.base_spans(text)
    others = secrets.other_tokens(text, base)
    assert time.perf_counter() - took < 5
    assert len(base) == 20_000 and [t for *_, t in others] == parts[1::2]
    touched = [m.span() for m in re.finditer(secrets.TOKEN, text[:30_000])
               if not any(m.start() < b[1] and b[0] < m.end() for b in base[:900])]
    assert [o[:2] for o in others if o[1] < 30_000][:len(touched) - 1] == touched[:-1]


def test_secrets_of_nothing(spark):
    assert secrets.find_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# page extraction ----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b</p>c", "a\nb\nc"), ("<p>a  \n b<br>c</p>", "a b c"),
    ("<p>x &amp; y &#233; &eacute &am", "x & y é é &am"), ("a<b>b</b>c<i class=x>d</i>", "abcd"),
    ("<script>var a='<p>no</p>';</script>yes<style>p{}</style>", "yes"), ("<!-- <p>no</p> -->yes<!-- cut", "yes"),
    ("1 < 2 <3 yes<", "1 < 2 <3 yes<"), ("x<p", "x"), ("x</artic", "x"), ("<ul><li>a<li>b</ul>c", "a\nb\nc"),
    ("<div><p>a<div>b</div></div>c", "a\nb\nc"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<!DOCTYPE html><title>t</title><a href='x>y'>link</a>", "link")])
def test_reader(source, text):
    page = dom.read(source)
    assert dom.joined(page, [True] * len(page.tags)) == text


def page_of(rng, article=True, extra=""):
    sentence = lambda: " ".join(rng.choices("lorem dolor sit amet magna velit".split(), k=rng.randint(6, 20))) + "."
    body = [" ".join(sentence() for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(4, 9))]
    menu = "".join(f"<li><a href='/{i}'>item {i}</a></li>" for i in range(6))
    tag = "article" if article else "div"
    html = (f"<html><head><title>t</title></head><body><nav><ul>{menu}</ul></nav><div class='ad'>Buy {sentence()}</div>"
            f"<{tag}><h1>Title here</h1>{''.join(f'<p>{b}</p>' for b in body)}{extra}</{tag}>"
            f"<footer>&copy; site</footer></body></html>")
    return html, "\n".join(["Title here", *body])


FURNITURE = ("<section class='comments'><p>Nice post!</p></section><aside>Side.</aside><form><p>Sign up</p></form>"
             "<div id='cookie-notice'>We use cookies.</div>")


def test_held_out_pages_are_extracted(spark):
    rng = random.Random(6)
    train = [(i, f"u{i}", page_of(rng)[0], "x") for i in range(120)] + [(None, None, None, "x"), (7, "u", "", "x")]
    frame = spark.createDataFrame(train, "page_id long, url string, html string, text string")
    trees = html_extraction.train(frame)
    held = [page_of(rng) for _ in range(30)] + [page_of(rng, extra=FURNITURE) for _ in range(30)]
    got = html_extraction.extract_pages([h for h, _ in held], trees)
    assert sum(g == t for g, (_, t) in zip(got, held)) >= 58
    plain = [page_of(rng, article=False) for _ in range(30)]
    got = html_extraction.extract_pages([h for h, _ in plain], trees)
    assert sum(g == t for g, (_, t) in zip(got, plain)) >= 24
    out = {r.page_id: r.text for r in html_extraction.extract(frame).collect()}
    assert out[None] == "" and out[7] == "" and len(out) == 121


def test_decoding_keeps_nothing_below_a_dropped_element():
    rng = np.random.default_rng(3)
    pages = [dom.read("<div><p>a</p><div><p>b</p><p>c</p></div></div><section><p>d</p></section>")]
    elements = html_extraction.elements_of(pages)
    n = len(elements.parent)
    for _ in range(200):
        chance = rng.random(n)
        kept = html_extraction.decode(elements, chance)
        p = np.clip(chance, 1e-6, 1 - 1e-6)
        score = lambda k: np.where(k, np.log(p), np.log(1 - p)).sum()
        legal = [np.array(k) for k in itertools.product([False, True], repeat=n)
                 if all(k[elements.parent[i]] or not k[i] for i in range(1, n))]
        assert all(kept[elements.parent[i]] or not kept[i] for i in range(1, n))
        assert math.isclose(score(kept), max(map(score, legal)), rel_tol=1e-9)


def test_rare_labelled_pages_still_train(spark):
    """Labels on few pages among many without: the sample is taken from the labelled ones."""
    rows = [(i, f"u{i}", f"<html><body><div>page {i}</div></body></html>") for i in range(1500)]
    rows += [(5000 + i, f"v{i}", f"<body><nav><a>home</a><a>news</a></nav><article><h1>T{i}</h1><p>{'words of the article ' * 12}</p></article></body>")
             for i in range(3)]
    rows += [(6000 + i, "copy", rows[-1][2]) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_extraction.train(pages, sample=20) is not None


def test_pages_without_labels_or_rows(spark):
    schema = "page_id long, url string, html string"
    assert html_extraction.extract(spark.createDataFrame([], schema)).count() == 0
    frame = spark.createDataFrame([(1, "u", "<nav>menu</nav><p>text</p>")], schema)
    assert html_extraction.extract(frame).select(F.col("text")).first().text == "text"
