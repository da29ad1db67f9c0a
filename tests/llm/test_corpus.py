"""Quality rules, mixing and packing against brute force, and the pipeline as a whole."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from posledger.llm import mixing, packing, quality_rules
from posledger.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, source string, kept int, Block int"
PROSE = "The quick brown fox jumps over a lazy dog near the river bank. It then rests for a while under old trees. "


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 5, 6) for i, t, s in rows], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def varied(n):
    """Prose of n words, none of whose three-word windows repeats."""
    return " ".join(f"word{i}" for i in range(n)) + "."


# quality rules -----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("line, fails", [
    ("A plain sentence ends here.", False), ("He said \"stop.\"", False), ("Contact us today", True),
    ("Home | News | Sport | More.", True), ("All rights reserved.", True),
    ("Is it so? ***###$$$ &&&.", True), (" ".join(["word"] * 45), False),
    ("All rights reserved is a phrase that this long sentence of prose mentions among many other words.", False)])
def test_line_rules(line, fails):
    assert quality_rules.line_fails(line, len(line.split()), len("".join(line.split()))) is fails


def slow_counts(text):
    words, lines = words_of(text), [x for x in (text or "").split("\n") if words_of(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(inside))


def test_counts_match_brute_force(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\v\f", "a"), (4, varied(60), "a"), (5, "x y z x y z q", "a"),
            (6, "a\na\n\n \n \nb\x85c d", None), (7, "é # | ünï & 𝒳𝒴 <b>", "b"), (7, "é # | ünï & 𝒳𝒴 <b>", "b"),
            (8, "w w w w w w", "b"), (9, (varied(70) + "\n") * 2, "b"), (None, varied(55), "b")]
    out = quality_rules.assess(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_counts(r.text), r
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_documents_losing_too_much_go(spark):
    menu = "\n".join(f"Home{i} | About{i} | Shop{i} | Help{i}" for i in range(40))
    rows = [(1, varied(80), "a"), (2, menu, "a"), (3, varied(80) + "\n" + "Home | About | Shop", "a"),
            (4, varied(20) + "\n" + menu, "a")]
    frame = docs(spark, rows)
    kept = quality_rules.drop_rejected(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {1, 3}
    text = quality_rules.assess(frame).where("doc_id = 3").first().clean_text
    assert text == varied(80)


# mixing -------------------------------------------------------------------------------------------------------

def slow_targets(sizes):
    """Share by weight, cap at three times a source's size, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s: 3 * sizes[s] for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {**capped, **share}
        capped.update(over)


def mix_rows(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for s, n in [("hot", 900), ("b", 300), ("c", 40), ("é", 200), ("tiny", 3), (None, 60), ("empty", 2)]:
        for _ in range(n):
            k = 0 if s == "empty" else int(rng.integers(1, 400))
            rows.append((len(rows), "w " * k, s))
    return rows + [(5, "same same", "b")] * 7 + [(None, "null id", "c"), (None, None, "c")]


def test_targets_match_repeated_sharing(spark):
    rows = mix_rows()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words_of(t))
    got = mixing.mix(docs(spark, rows)).select("source", "source_size", "target").distinct().collect()
    want = slow_targets(dict(sizes))
    assert {r.source: r.source_size for r in got} == dict(sizes)
    for r in got:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12), r


@pytest.mark.parametrize("block", [4096, 16])
def test_sources_come_near_their_targets(spark, block):
    rows = mix_rows()
    frame = docs(spark, rows)
    out = mixing.mix(frame, block=block).collect()
    assert len(out) == len(rows)
    assert Counter(r.doc_id for r in out) == Counter(i for i, _, _ in rows)
    by = defaultdict(list)
    for r in out:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        by[r.source].append(r)
    for group in by.values():
        size, target = group[0].source_size, group[0].target
        ratio = target / size if size else 0
        assert all(math.floor(ratio) <= r.copies <= math.floor(ratio) + 1 for r in group)
        # The flight keeps both totals exact; only the landing of at most two documents rounds.
        assert abs(sum(r.taken for r in group) - target) <= max(r.size for r in group)
        assert abs(sum(r.copies for r in group) - ratio * len(group)) <= 2
    again = mixing.mix(frame.repartition(7), block=block).collect()
    key = lambda r: (str(r.doc_id), r.mark, r.copies)
    assert sorted(map(key, again)) == sorted(map(key, out))


def test_mixed_rows_repeat_documents(spark):
    rows = mix_rows()
    frame = docs(spark, rows)
    want = Counter()
    for r in mixing.mix(frame).collect():
        want[r.doc_id] += r.copies
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    assert Counter(r.doc_id for r in out.collect()) == +want


def test_mix_of_nothing(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mixed(docs(spark, [(1, None, None), (2, "", "a")])).count() == 0


# packing ------------------------------------------------------------------------------------------------------

def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


whole = tokenizer()


def test_pieces_are_binary():
    for n in (1, 2, 3, 4095, 4096, 4097, 12345):
        cut = list(packing.pieces(n))
        assert sum(length for _, length in cut) == n and all(length & (length - 1) == 0 for _, length in cut)
        assert [s for s, _ in cut] == [sum(x for _, x in cut[:i]) for i in range(len(cut))]
        assert len(cut) == n // 4096 + (n % 4096).bit_count()


def test_packed_ids_round_trip(spark):
    texts = [None, "", " ", "Hello, World's  end", "Don't 12 34 x y é ́z <|endoftext|> a<|endoftext|>b",
             "ΣΑΣ ΟΔΟΣ İstanbul ﬁ", "日本語 テキスト 🙂🙂", "x" * 5000, "lorem ipsum dolor " * 4000, "\x00\x1f\x85"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "null id")]
    out = packing.pack(docs(spark, [(i, t, "s") for i, t in rows]), tokenizer_path()).collect()
    assert len({r.sequence_id for r in out}) == len(out) and all(r.offset == 0 for r in out)
    encode = tokenizer()
    got, want = defaultdict(list), Counter()
    for r in sorted(out, key=lambda r: r.start):
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert r.sequence_id >> 57 == r.length.bit_length() - 1
        got[r.doc_id].append(r)
    for i, t in rows:
        want[i] += 1
    for i, t in rows:
        ids = encode.encode(t or "", add_special_tokens=False).ids + [2]
        pieces = got[i]
        assert sum(r.length for r in pieces) == len(ids) * want[i]
        assert all(r.doc_tokens == len(ids) and r.ids == ids[r.start:r.start + r.length] for r in pieces)


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    memo = packing.WordIds(tokenizer_path())
    text = "a b c d e f a b c a"
    ids = np.frombuffer(memo.encode(text.encode()), "<u4").tolist()
    assert ids == tokenizer().encode(text, add_special_tokens=False).ids and len(memo) <= 3 and len(memo.old) <= 3


@given(st.text(st.one_of(st.sampled_from("aeéÉßσΣ' .,!<|>\u0301\u0338\u00a0\u2026İ"), st.characters(codec="utf-8")), max_size=40))
@settings(max_examples=1500, deadline=None)
def test_words_encode_as_the_whole_text_does(text):
    ids = np.frombuffer(packing.word_ids(tokenizer_path()).encode(text.encode()), "<u4").tolist()
    assert ids == whole.encode(text, add_special_tokens=False).ids


def test_pack_nothing(spark):
    assert packing.pack(docs(spark, []), tokenizer_path()).count() == 0


# pipeline -----------------------------------------------------------------------------------------------------

def test_pipeline_stages_keep_the_columns_of_documents(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, f"Document {i} says this. " + varied(60 + i), f"s{i % 4}") for i in range(40)]
    rows += [(100 + i, rows[i][1].upper(), "s1") for i in range(5)] + [(200, "too short.", "s2"), (201, None, None)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    frame, counts = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns, name
        counts.append(out.count())
        frame = out
    assert counts[0] == 45 and counts[1] == 40
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id"} <= set(packed.columns) and packed.count() > 0
