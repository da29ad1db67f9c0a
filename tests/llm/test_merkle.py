"""The Merkle manifest against a plain construction of the trees."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from posledger.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TREE string, low int, digest string, _keep int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def climb(digests):
    """All levels of one tree."""
    levels = [digests]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([sha("".join(at[i:i + 2])) for i in range(0, len(at), 2)])
    return levels


def way(levels, at):
    """(left, digest) or None of every level below the top."""
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append((other < at, level[other]) if other < len(level) else None)
        at >>= 1
    return out


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    built = {name: climb([leaf(r) for r in trees[name]]) for name in names}
    top = climb([built[name][-1][0] for name in names])
    out = []
    for nr, name in enumerate(names):
        for at, r in enumerate(trees[name]):
            path = way(built[name], at) + way(top, nr)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            n_chars = r["n_chars"] + 1 if hit and r["n_chars"] is not None else r["n_chars"]
            digest = leaf(r | {"n_chars": n_chars})
            for step in path:
                digest = sha(digest if step is None else step[1] + digest if step[0] else digest + step[1])
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r), built[name][-1][0], root, sha("".join(s[1] for s in path if s)), digest, digest == root))
    return sorted(out, key=repr)


def rows_of(n, langs, seed=3):
    rng = random.Random(seed)
    texts = ["", None, "a", "été", "long " * 40_000]
    return [dict(doc_id=i * 3 + 1, text=rng.choice(texts), lang=rng.choice(langs), source=rng.choice([None, "web", ""]),
                 n_chars=rng.choice([None, 0, 5]), TREE="t", low=1, digest="d", _keep=0) for i in range(n)]


def audited(spark, rows):
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(3)
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in merkle.audited(frame).collect()), key=repr)


@pytest.mark.parametrize("tier", [10, 2])
def test_digests_proofs_and_tampering(spark, monkeypatch, tier):
    """Trees of several heights, one over several tiers, nulls, long texts and clashing names."""
    monkeypatch.setattr(merkle, "TIER", tier)
    rows = rows_of(70, [None, "", "en", "en", "en", "Zz", "é"]) + rows_of(1, ["lone"], 9)
    rows += [rows[0], rows[0], rows[5] | {"doc_id": None}, rows[6] | {"doc_id": None}, rows[7] | {"text": "other"}]
    got = audited(spark, rows)
    assert got == expected(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_one_tree_and_one_leaf(spark):
    for n in (1, 2, 3):
        rows = rows_of(n, ["en"])
        assert audited(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_intervals_cover_and_divide(spark):
    """On every level the intervals cover the ranks once; a node's interval is that of its children."""
    frame = spark.range(37).selectExpr("'t' AS tree", "id AS low", "sha2(string(id), 256) AS digest")
    nodes, tops, _ = merkle.build(frame)
    rows = nodes.collect()
    for level in range(7):
        spans = sorted((r.low, r.high) for r in rows if r.level == level)
        assert spans == [(lo, min(lo + 2 ** level, 37)) for lo in range(0, 37, 2 ** level)]
    assert tops.first().top == climb([sha(str(i)) for i in range(37)])[-1][0]
