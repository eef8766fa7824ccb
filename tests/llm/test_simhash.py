"""SimHash: fingerprints, bit-sliced comparison and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from riskloom.llm import queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def _components(rows, radius=4):
    """id -> least id reachable, by comparing every two fingerprints."""
    fps = np.array([f for _, f in rows], np.uint64)
    part = list(range(len(rows)))

    def root(k):
        while part[k] != k:
            part[k] = part[part[k]]
            k = part[k]
        return k

    for k in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[:k] ^ fps[k]) <= radius):
            part[root(k)] = root(int(j))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [least.get(root(k)) for k in range(len(rows))]


def _check(docs, **more):
    rows = [(r.doc_id, _fingerprint(r.text)) for r in docs.collect()]
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs, **more).collect())
    assert got == sorted((str(i), f"{f:016x}", str(c)) for (i, f), c in zip(rows, _components(rows)))


def _texts(seed=3, n=120):
    rng = random.Random(seed)
    vocabulary = [f"W{k}é" for k in range(300)]
    rows = []
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 5, 40, 200]))
        rows.append((1000 + 10 * k, " ".join(words)))
        for c in range(rng.choice([0, 0, 1, 4])):
            other = list(words)
            if len(other) > 30:
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            rows.append((1001 + 10 * k + c, rng.choice([" ", "\t", " \n "]).join(other)))
    return rows


CASES = [(1, None), (2, ""), (3, " \t\n\v\f\r"), (4, "a"), (4, "a"), (5, "A"), (6, "a b c"), (None, "a b c"), (None, "all by itself here, no id"),
         (7, "x" * 200_000), (8, "word " * 70_000), (9, "one\x1ctwo three four five six"), (10, "Nul\x00 inside of words goes")]


def test_equals_brute_force(docs_of):
    _check(docs_of(CASES + _texts()))


def test_pieces_of_large_buckets(docs_of):
    """Buckets of more than 8 are compared piece by piece, with the same result."""
    _check(docs_of(_texts(5, 80) + [(k, "one text that is there many times over, word by word " + "and so on " * 30 + f"end{k % 40}") for k in range(300)]), holds=8)


def test_extra_columns_and_empty(docs_of):
    docs = docs_of(CASES)
    more = docs.selectExpr("*", "1 AS fp", "2 AS id", "'x' AS fingerprint", "3 AS component_id", "4 AS node")
    key = lambda d: sorted(map(str, simhash.near_duplicates(d).collect()))
    assert key(more) == key(docs) and simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 3, np.uint64)
    fps = base[rng.integers(0, 3, 700)]
    for _ in range(radius + 2):
        fps = np.where(rng.random(700) < 0.6, fps ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64)), fps)
    fps = rng.permutation(np.unique(fps))
    groups = np.minimum([0, 1, 70, 134, 134, 700], len(fps))
    a, b = simhash.links(fps, groups[:-1], groups[1:], groups[:-1], groups[1:], radius)
    place = {f: k for k, f in enumerate(fps.tolist())}
    label = simhash._forest(len(fps), *(np.array([place[f] for f in side.tolist()], int) for side in (a, b)))
    want = [lo + c for lo, hi in zip(groups, groups[1:]) for c in _components(list(enumerate(fps[lo:hi])), radius)]
    assert label.tolist() == want


def test_tables_meet_every_link():
    """However the table count grows, two fingerprints in reach share a key."""
    rng = random.Random(1)
    for n in (10, 1 << 24, 1 << 33, 1 << 38):
        tables = simhash.masks(n)
        for _ in range(300):
            x = rng.getrandbits(64)
            y = x
            for k in rng.sample(range(64), 4):
                y ^= 1 << k
            assert any(x & m == y & m for m in tables)
        assert n >> min(m.bit_count() for m in tables) <= simhash.HOLDS


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, _fingerprint(r.text)) for r in docs.collect()]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.queries()["op11_simhash"](spark, sf).collect())
    assert got == sorted((i, f"{f:016x}", c) for (i, f), c in zip(rows, _components(rows)))
