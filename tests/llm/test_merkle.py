"""Merkle manifest against a plain recomputation, and its midstates against hashlib."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from riskloom.llm import merkle, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(r, text):
    return H(*[_field(r[c]) for c in ("doc_id", "source", "lang", "n_chars")], _field(text))


def _up(nodes):
    """Levels of a group, the nodes first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k:k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def _way(levels, place):
    """(left, right) siblings for each level on the way up."""
    for level in levels[:-1]:
        run = level[place // 16 * 16:place // 16 * 16 + 16]
        yield run[:place % 16], run[place % 16 + 1:]
        place //= 16


def _wanted(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r, _leaf(r, r["text"])))
    trees = {}
    for s, members in groups.items():
        members.sort(key=lambda m: (m[0]["doc_id"] is not None, m[0]["doc_id"] or 0, m[1]))
        trees[s] = _up([leaf for _, leaf in members])
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    top = _up([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for place, (r, leaf) in enumerate(groups[s]):
            key = "" if r["doc_id"] is None else str(r["doc_id"])
            text = r["text"]
            if zlib.crc32(key.encode()) % 5 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            now, proof = _leaf(r, text), ""
            for left, right in [*_way(trees[s], place), *_way(top, at)]:
                now, proof = H(*left, now, *right), proof + "".join(left + right)
            out.append((str(r["doc_id"]), leaf, trees[s][-1][0], top[-1][0], H(proof), now, now == top[-1][0]))
    return sorted(out)


def _got(df):
    cols = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((str(r.doc_id), *[r[c] for c in cols]) for r in df.collect())


def _run(as_tables, spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    return _got(queries.queries()["op12_merkle_manifest"](spark, as_tables(documents=docs)))


def _rows(n, sources, seed=1):
    rng = random.Random(seed)
    return [(rng.randrange(10 ** 6), rng.choice([None, "", "Éa B c", "Plain words", "x" * rng.randrange(60)]), rng.choice([None, "", "en"]),
             rng.choice(sources), rng.choice([None, 3, -5])) for _ in range(n)]


CASES = [(1, None, None, None, None), (1, None, None, None, None), (None, "A", "en", None, 1), (None, "B", "en", None, 1), (5, "A", "en", "lone", 1),
         (6, "Z" * 300_000, "e", "long", 9), (7, "", "", "", 0), (8, "\x00Nul", "-", "-", -1), (9, "a", "b", "+", 2), (9, "c", "b", "+", 2)]


@pytest.mark.parametrize("rows", [
    CASES, _rows(700, ["hot", "hot", "hot", "b", None, "é", "z"]), _rows(60, [f"s{k}" for k in range(40)]), _rows(300, ["one"]), _rows(1, ["one"]),
    [(k, "same", "l", "s", 1) for k in range(16)] + [(k, "same", "l", "t", 1) for k in range(17)]], ids=["cases", "hot", "sources", "one", "single", "edges"])
def test_equals_plain_recomputation(spark, as_tables, rows):
    want = _wanted([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])
    got = _run(as_tables, spark, rows)
    assert got == want
    tampered = [r for r in got if not r[6]]
    assert all(zlib.crc32((r[0] if r[0] != "None" else "").encode()) % 5 == 0 for r in tampered)


def test_empty_and_extra_columns(spark, as_tables, tmp_path):
    docs = spark.createDataFrame(CASES, DOCS)
    assert merkle.manifest(docs.limit(0)).count() == 0
    more = docs.selectExpr("*", "1 AS grp", "2 AS id", "3 AS leaf", "4 AS place", "5 AS size", "6 AS digest")
    key = lambda d: sorted(map(str, merkle.manifest(d).collect()))
    assert key(more) == key(docs)
    assert all(r.verified for r in merkle.manifest(docs).collect())


def test_states_are_those_of_hashlib():
    """A kept state resumes to what hashlib's own copied state gives, for every slot."""
    rng = random.Random(4)
    kids = [b"".join(rng.randbytes(32) for _ in range(n)) for n in range(1, 17)]
    digests, states = merkle.parents_of(kids)
    for kid, digest, kept in zip(kids, digests, states):
        parts = [kid[k:k + 32] for k in range(0, len(kid), 32)]
        assert digest.tobytes() == hashlib.sha256(kid.hex().encode()).digest() and len(kept) == len(kid)
        running = hashlib.sha256()
        for slot, part in enumerate(parts):
            copied, new = running.copy(), rng.randbytes(32)
            copied.update((new + kid[32 * slot + 32:]).hex().encode())
            got = merkle.resume([kept[32 * slot:32 * slot + 32]], merkle.words_of(new), [kid[32 * slot + 32:]], np.array([len(parts)]))
            assert merkle.bytes_of(got)[0].tobytes() == copied.digest()
            running.update(part.hex().encode())


def test_equals_oracle(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    rel = con.execute(queries.oracle_sql()["op12_merkle_manifest"])
    names = [d[0] for d in rel.description]
    want = sorted(str(sorted(zip(names, r))) for r in rel.fetchall())
    out = queries.queries()["op12_merkle_manifest"](spark, sf)
    assert sorted(str(sorted(r.asDict().items())) for r in out.collect()) == want
