"""SimHash and exact dedup against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash

from posledger.llm import exact_dedup, simhash

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, digest string, MARK int"


def docs(spark, rows):
    """(doc_id, text) rows with extra columns whose names clash with helper columns."""
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(FOLD)) if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """[(doc_id, fp)] -> doc_id -> smallest reachable id, by comparing all pairs."""
    group = {i: i for i, _ in fps}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in fps:
        for j, b in fps:
            if i < j and (a ^ b).bit_count() <= 2:
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    return {i: find(i) for i in group}


def texts(seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(300)]
    out = [None, "", " \n\t", "One", "one", "ONE two", "été Été", "a b c", "A b  c"]
    for _ in range(25):
        base = rng.choices(vocab, k=rng.randint(3, 400))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(" ".join(copy))
    return list(enumerate(out))


def test_fingerprints_and_components_match_brute_force(spark):
    rows = texts()
    got = {r.doc_id: r for r in simhash.near_groups(docs(spark, rows)).collect()}
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == dict(fps)
    want = brute_components(fps)
    assert {i: r.component_id for i, r in got.items()} == want
    assert max(Counter(want.values()).values()) > 1


def test_links_connect_what_all_pairs_connect(spark):
    rng, fps = random.Random(5), set()
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(12):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3])))
            fps.add(at - (1 << 64) if at >> 63 else at)
    fps |= {0, 1, 3, 7, 15, -1, -2}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    from posledger.llm.components import components

    roots = {r.node: r.root for r in components(simhash.links(frame)).collect()}
    ids = {f: n for n, f in enumerate(sorted(fps))}
    want = brute_components([(ids[f], f & (1 << 64) - 1) for f in fps])
    got = {ids[f]: ids[roots.get(f, f)] for f in fps}
    assert got == want


def test_posting_list_at_its_bound_stays_linear():
    import numpy as np

    low = np.arange(65536, dtype=np.uint64)
    choice = np.full(len(low), simhash.FREE_BYTES.index((0, 1)), np.int8)
    a, b = simhash._link_lists(np.zeros(len(low), np.int64), choice, low)
    assert len(a) == 65535 and set(b.tolist()) == {0}


def test_long_texts_are_hashed_in_slices(monkeypatch):
    text = " ".join(f"w{i % 91}" for i in range(500))
    whole = simhash.fingerprint_of(text.encode())
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint_of(text.encode()) == whole == slow_fingerprint(text)


def test_one_document_of_each_component_stays(spark):
    rows = [*texts(), (900, "a b c"), (900, "a b c"), (2, "a b c"), (None, "zz yy xx ww")]
    frame = docs(spark, rows)
    kept = simhash.drop_near_copies(frame)
    assert kept.columns == frame.columns
    fps = Counter(slow_fingerprint(r.text) for r in kept.collect())
    all_fps = {slow_fingerprint(t) for _, t in rows}
    want = brute_components(list(enumerate(sorted(all_fps))))
    component = {f: want[n] for n, f in enumerate(sorted(all_fps))}
    assert Counter(component[f] for f in fps.elements()) == Counter(set(component.values()))
    assert kept.where("doc_id is null").count() == 1


@pytest.mark.parametrize("operator", [simhash.near_groups, simhash.drop_near_copies, exact_dedup.copy_groups,
                                      exact_dedup.drop_copies])
def test_empty_table(spark, operator):
    assert operator(docs(spark, [])).count() == 0


def exact_rows():
    rng = random.Random(9)
    rows = [(1, None), (2, ""), (3, "Été"), (4, "été"), (5, "éTÉ"), (None, "only null id"), (None, "with id"),
            (6, "With ID"), (7, "same"), (7, "same"), (7, "SAME"), (8, "x" * 300_000), (9, "X" * 300_000)]
    rows += [(100 + i, rng.choice(["Hot copy", "hot COPY", f"t{i % 17}"])) for i in range(400)]
    return rows


def test_copy_groups_match_brute_force(spark):
    rows = exact_rows()
    got = exact_dedup.copy_groups(docs(spark, rows).repartition(5), salts=3).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(FOLD)].append(i)
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = 1
        for i in sorted(ids, key=lambda i: (i is not None, i), reverse=True):
            want[(i, keep, len(ids), i == keep and stays == 1, digest)] += 1
            stays -= i == keep
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in got) == want


def test_weak_digest_never_merges_different_texts(spark):
    from pyspark.sql import functions as F

    rows = exact_rows()
    frame = docs(spark, rows)
    got = exact_dedup.copy_groups(frame, digest=lambda c: F.length(c).cast("string"))
    strong = exact_dedup.copy_groups(frame)
    pick = ("doc_id", "keep_id", "group_size", "kept")
    assert Counter(map(tuple, got.select(*pick).collect())) == Counter(map(tuple, strong.select(*pick).collect()))


def test_drop_copies_keeps_whole_rows(spark):
    rows = exact_rows()
    kept = exact_dedup.drop_copies(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "digest", "MARK"]
    out = kept.collect()
    assert Counter((r.text or "").translate(FOLD) for r in out) == Counter(
        {(t or "").translate(FOLD) for _, t in rows})
    best = {}
    for i, t in rows:
        key = (t or "").translate(FOLD)
        best[key] = max((x for x in (best.get(key), i) if x is not None), default=None)
    assert all(r.doc_id == best[(r.text or "").translate(FOLD)] for r in out)


def test_exact_dedup_runs_no_python(spark):
    plan = exact_dedup.copy_groups(docs(spark, exact_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
