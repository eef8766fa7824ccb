"""Conversation repair against all repairs of small conversations, a plain recomputation and SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from riskloom.llm import queries, structure_repair as sr

SCHEMA = "conv_id long, turn long, role string, text string"
INITIALS = ["s", "u", "a", ""]


def _valid(rows, audit):
    """The cost of an audit, None if it repairs nothing."""
    roles, cost, k, at = list(sr.emitted_roles(audit)), 0, 0, 0
    if roles == ["s"]:
        return None
    for letter in audit:
        if letter != "I":
            initial, fault = rows[k]
            k += 1
            if letter == "D":
                cost += 3
                continue
            if fault in (sr.BLANK, sr.DUPLICATE):
                return None
            cost += (fault == sr.CUT) + 2 * (letter == "R")
        else:
            cost += 2
        if at >= len(roles) or (letter == "K" and initial != roles[at]) or (letter != "K" and roles[at] == "s"):
            return None
        at += 1
    return cost if k == len(rows) else None


def _brute(rows):
    found = []
    for letters in itertools.product("KRD", repeat=len(rows)):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "I" * gaps[0] + "".join(x + "I" * g for x, g in zip(letters, gaps[1:]))
            cost = _valid(rows, audit)
            if cost is not None:
                found.append((cost, audit))
    return min(found)


def test_cheapest_is_the_least_of_all_repairs():
    rng = random.Random(2)
    for n in range(5):
        every = list(itertools.product(itertools.product(INITIALS, range(4)), repeat=n))
        for rows in every if n < 2 else rng.sample(every, 150 if n < 4 else 25):
            assert sr.cheapest(rows) == _brute(rows), rows


def test_long_conversation():
    rng = random.Random(3)
    rows = [(rng.choice(INITIALS[:3]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(2000)]
    cost, audit = sr.cheapest(rows)
    assert _valid(rows, audit) == cost
    assert sr.cheapest([("u", 0), ("a", 0)] * 1500) == (0, "K" * 3000)


def _wanted(conversations):
    """Plain recomputation: damage, faults and the audit applied to the rows."""
    sp = lambda v: " " if v is None else v
    groups = {}
    for conv, turn, role, text in conversations:
        rows = groups.setdefault(conv, [])
        kind, role, text = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20, sp(role), sp(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in rows:
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append(1 if not words else 2 if (role, text) in seen else 0 if words[-1] in ".!?" else 3)
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        initials = [r[:1] for _, r, _ in rows]
        cost, audit = sr.cheapest(list(zip(initials, faults)))
        assert _valid(list(zip(initials, faults)), audit) == cost
        emitted, k, said = sr.emitted_roles(audit), 0, []
        for letter in audit:
            if letter != "I":
                _, role, text = rows[k]
                k += 1
            if letter != "D":
                x = next(emitted)
                said.append(f"{role if letter == 'K' else sr.NAMES[x]}:{'' if letter == 'I' else text}")
        out.append((str(conv), max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in (1, 2, 3)],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
CASES = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 3, None, "x!"), (2, None, "assistant", None), (2, None, "user", " \t\n"), (2, 9, "tool", "a?  "),
         (None, 0, "system", "Be good."), (None, 1, "user", "é"), (None, None, "", "No initial."), (3, 10 ** 12, "user", "Long. " * 60_000),
         (3, -5, "assistant", "Early! "), (4, 1, "usher", "Not.\x1c"), (4, 2, "Assistant", "No.")]


def _random(n, seed=6):
    rng = random.Random(seed)
    return [(k // 7, rng.choice([k % 7, k % 7, k % 3, None]), rng.choice(["user", "assistant", "system", "tool", None]),
             rng.choice(["Yes.", "No", "", " ", "Why? ", "Because it is.\n", None, "Go!"])) for k in range(n)]


def _report(spark, rows, as_tables):
    out = queries.queries()["op13_structure_repair"](spark, as_tables(conversations=spark.createDataFrame(rows, SCHEMA)))
    return sorted((str(r.conv_id), *[r[c] for c in COLUMNS]) for r in out.collect())


@pytest.mark.parametrize("rows", [CASES, _random(900)], ids=["cases", "random"])
def test_equals_plain_recomputation(spark, as_tables, rows):
    assert _report(spark, rows, as_tables) == _wanted(rows)


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    more = df.selectExpr("*", "1 AS digest", "2 AS kind", "3 AS fault", "4 AS __copy", "5 AS audit")
    key = lambda d: sorted(map(str, sr.repaired_report(d, sr.damaged(d)).collect()))
    assert key(more) == key(df) and key(df.limit(0)) == []


def test_all_rows_dropped(spark, as_tables):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert _report(spark, [(gone, 0, "user", "Hi.")], as_tables) == [(str(gone), 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("random_rows", [False, True])
def test_equals_oracle(spark, as_tables, random_rows):
    sf = as_tables(conversations=spark.createDataFrame(CASES[:9] + _random(300), SCHEMA)) if random_rows else "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet{'/*.parquet' if random_rows else ''}')")
    rel = con.execute(queries.oracle_sql()["op13_structure_repair"])
    names = [d[0] for d in rel.description]
    want = sorted(str(sorted(zip(names, r))) for r in rel.fetchall())
    out = queries.queries()["op13_structure_repair"](spark, sf)
    assert sorted(str(sorted(r.asDict().items())) for r in out.collect()) == want
