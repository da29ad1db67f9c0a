"""Near-duplicates of the pipeline against brute force over all pairs."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import pytest

from posledger.llm import minhash

SCHEMA = "doc_id long, text string, keep string, MARK int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def near(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def kept_ids(rows):
    """The smallest id of every component, by comparing all pairs."""
    sets, group = [(i, shingles(t)) for i, t in rows], {i: i for i, _ in rows}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if near(a, b):
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    return {find(i) for i in group}


def texts(seed=11):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    out = [None, "", " \n", "One", "one", "a b c d", "A b  c d", "été Été"]
    for _ in range(60):
        base = rng.choices(vocab, k=rng.randint(40, 300))
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(1, max(1, len(copy) // 35))):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(" ".join(copy))
    return list(enumerate(out))


def test_near_stage_finds_what_all_pairs_find(spark):
    rows = texts()
    out = corpus_pipeline.near_stage(spark, docs(spark, rows), "")
    assert out.columns == ["doc_id", "text", "keep", "MARK"]
    assert {r.doc_id for r in out.collect()} == kept_ids(rows)
    assert len(kept_ids(rows)) < len(rows) - 40


def test_chained_members_of_one_list_are_not_lost(spark):
    """Of a list only neighbours are compared at first; members that differ from theirs are still compared."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for n in range(40):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(100)] = f"x{n}"
        rows.append((n, " ".join(copy)))
    assert {r.doc_id for r in minhash.drop_near_copies(docs(spark, rows)).collect()} == kept_ids(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A b c d e f"), (None, "other words"), (9, "a b c d e f")]
    kept = Counter((r.doc_id, r.text) for r in minhash.drop_near_copies(docs(spark, rows)).collect())
    assert kept == Counter([(5, "a b c d e f"), (None, "other words")])


@pytest.mark.parametrize("operator", [minhash.near_groups, minhash.drop_near_copies])
def test_empty_table(spark, operator):
    assert operator(docs(spark, [])).count() == 0


def spread(n, seed=5):
    """A text and n - 1 copies with one to six words of 150 changed, so pairs lie between 0.5 and 0.95."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for nr in range(n):
        copy = list(base)
        for at in rng.sample(range(150), 1 + nr % 6):
            copy[at] = f"x{rng.randrange(40)}"
        rows.append((nr, " ".join(copy)))
    return rows


def test_one_large_group_between_far_and_near(spark, monkeypatch):
    """Lists longer than LONG are dealt out; the links that all pairs have must still be found."""
    rows = spread(360)
    monkeypatch.setattr(minhash, "LONG", 6)
    groups = {r.keep.doc_id: 0 for r in minhash.near_groups(docs(spark, rows)).collect()}
    wanted = kept_ids(rows)
    missed = set(groups) - wanted
    print(f"recall of links: {1 - len(missed) / (len(rows) - len(wanted)):.4f}")
    assert wanted <= set(groups)
    assert len(missed) <= 0.05 * (len(rows) - len(wanted))
    assert 5 < len(wanted) < 300


@pytest.mark.parametrize("seed", [5, 6])
def test_lists_of_any_length_lose_no_pair(spark, monkeypatch, seed):
    """What all pairs at a Jaccard of 0.8 connect is connected, though nearly all lists are longer than LONG."""
    rows = spread(240, seed)
    monkeypatch.setattr(minhash, "LONG", 2)
    assert {r.doc_id for r in minhash.drop_near_copies(docs(spark, rows)).collect()} == kept_ids(rows)


def test_near_texts_of_long_lists_meet_with_no_more_in_common_than_told(spark):
    rows = spread(80)
    sets = [set(minhash.shingles_of(t.encode()).tolist()) for _, t in rows]
    mark = lambda i: i.to_bytes(16)
    shingles_ = spark.createDataFrame([(mark(i), minhash.shingles_of(t.encode()).view("int64").tolist()) for i, t in rows],
                                      "mark binary, shingles array<long>")
    lists = spark.createDataFrame([(key, mark(i), mark(0)) for key in (-5, 7) for i, _ in rows], "key long, mark binary, root binary")
    met, got = {}, minhash.part_lists(lists, shingles_).collect()
    for r in got:
        met.setdefault(r.key, []).append((int.from_bytes(r.mark), r.most))
    told = {(i, j) for members in met.values() for i, m in members for j, n in members if min(m, n) >= len(sets[i] & sets[j])}
    wanted = [(i, j) for j in range(len(rows)) for i in range(j) if near(sets[i], sets[j])]
    assert wanted and told.issuperset(wanted)
    assert len(got) == len({(r.key, r.mark) for r in got}) < sum(map(len, sets)) / 2


def test_near_stage_links_fingerprints_beyond_the_jaccard(spark):
    """A few new words at the end of a long repeated text leave its fingerprint, but not its set of shingles, as it was."""
    base = " ".join([f"w{i}" for i in range(11)] * 200)
    rows = [(3, base), (7, base + " " + " ".join(f"x{i}" for i in range(10))), (8, "some other text of seven plain words")]
    assert not near(shingles(rows[0][1]), shingles(rows[1][1]))
    assert sorted(r.doc_id for r in corpus_pipeline.near_stage(spark, docs(spark, rows), "").collect()) == [3, 8]


@pytest.mark.parametrize("block", [1024, 16])
def test_only_pairs_that_may_be_near_become_rows(spark, monkeypatch, block):
    """Members of a list that are far apart give no rows, whether the list is compared whole or in blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    sets = [minhash.shingles_of(t.encode()) for _, t in spread(70)] + [minhash.shingles_of(b"some other text of seven words")]
    minima = [minhash.minima_of(s) for s in sets]
    mark = lambda i: i.to_bytes(16)
    nodes = spark.createDataFrame([(mark(i), m.tolist(), len(s)) for i, (m, s) in enumerate(zip(minima, sets))],
                                  "mark binary, minima array<int>, size int")
    root = [0 if i % 3 else i for i in range(len(sets))]
    lists = spark.createDataFrame([(key, mark(i), mark(root[i]), len(sets), mark(0)) for key in (-5, 7) for i in range(len(sets))],
                                  "key long, mark binary, root binary, n long, low binary")
    wanted = {(i, j) for j in range(len(sets)) for i in range(j) if root[i] != root[j] and (minima[i] == minima[j]).sum() >= minhash.LEAST_AGREED
              and min(len(sets[i]), len(sets[j])) * 100 >= max(len(sets[i]), len(sets[j])) * minhash.JACCARD_PERCENT}
    got = [(int.from_bytes(r.a), int.from_bytes(r.b)) for r in minhash.cross_pairs(lists, nodes).collect()]
    assert sorted(got) == sorted(wanted)
    assert 0 < len(wanted) < len(sets) * (len(sets) - 1) / 4


@pytest.mark.parametrize("block, weight", [(1024, 1024), (16, 1024), (1024, 1)])
def test_lists_of_many_near_pairs_give_links_only(spark, monkeypatch, block, weight):
    """A list gives fewer rows than members, and its members are connected as by all pairs at a Jaccard of 0.8.

    That holds for lists compared whole and for blocks by members and by shingles.
    """
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "WEIGHT", weight)
    rows = [*spread(90), (90, ""), (91, " \n"), (92, "some other text of seven words")]
    sets = [minhash.shingles_of(t.encode()) for _, t in rows]
    minima = [minhash.minima_of(s) for s in sets]
    mark = lambda i: i.to_bytes(16)
    root = [i if i % 4 else 0 for i in range(len(rows))]
    nodes = spark.createDataFrame([(mark(i), m.tolist(), len(s)) for i, (m, s) in enumerate(zip(minima, sets))],
                                  "mark binary, minima array<int>, size int")
    shingles_ = spark.createDataFrame([(mark(i), s.view("int64").tolist()) for i, s in enumerate(sets)],
                                      "mark binary, shingles array<long>")
    lists = spark.createDataFrame([(key, mark(i), mark(root[i]), len(sets), mark(0)) for key in (-5, 7) for i in range(len(sets))],
                                  "key long, mark binary, root binary, n long, low binary")

    def connected(pairs):
        group = list(root)
        for i, j in pairs:
            x, y = group[i], group[j]
            group = [min(x, y) if g in (x, y) else g for g in group]
        return group

    exact = [shingles(t) for _, t in rows]
    wanted = [(i, j) for j in range(len(rows)) for i in range(j) if root[i] != root[j] and near(exact[i], exact[j])]
    got = minhash.cross_pairs(lists, nodes, shingles_)
    links = [(int.from_bytes(r.a), int.from_bytes(r.b)) for r in got.collect()]
    assert set(links) <= set(wanted)
    assert connected(links) == connected(wanted) != root
    if block == weight:
        assert len(links) < len(rows) < len(wanted)
