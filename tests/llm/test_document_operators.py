"""Fingerprints, toxicity, mixing, joins, personal data, languages, copies and the pipeline against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import uuid
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import (components, exact_dedup, fingerprints, language_id, ngram_join, pii, queries, source_mix,
                          toxicity)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- exact dedup -----------------------------------------------------------------------------------------------------

def _dedup_wanted(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    low = lambda i: -1 << 62 if i is None else i
    return sorted((str(i), str(k := max(groups[t or ""], key=low)), len(groups[t or ""]), i == k, hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t in rows)


DUPES = ([(k, "hot") for k in range(100, 400)] + [(k, f"text {k % 7}") for k in range(20)] +
         [(500, None), (501, ""), (502, " "), (503, "Hot"), (503, "Hot"), (504, "x" * 100_000), (505, "x" * 100_000), (None, "hot"), (None, "lone")])


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda text: F.length(text).cast("string")])
def test_dedup_equals_brute_force(docs_of, digest):
    """Also with a digest that different texts share: every stage compares the whole text."""
    out = exact_dedup.duplicate_report(docs_of(DUPES), digest=digest).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in out) == _dedup_wanted(DUPES)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda text: F.length(text).cast("string")])
def test_dedup_keeps_one_whole_row(docs_of, digest):
    df = docs_of(DUPES).withColumns({"digest": F.lit("mine"), "n": F.col("doc_id") + 1, "winner": F.lit(0)})
    out = exact_dedup.deduplicate(df, digest=digest)
    assert out.columns == df.columns
    rows = out.collect()
    keeps = {w[4]: w[1] for w in _dedup_wanted(DUPES)}
    assert sorted((r.text or "", str(r.doc_id)) for r in rows) == sorted(
        (t, keeps[hashlib.sha256(t.encode()).hexdigest()]) for t in {t or "" for _, t in DUPES})
    assert all(r.digest == "mine" and r.n == (None if r.doc_id is None else r.doc_id + 1) for r in rows)


def test_dedup_empty(docs_of):
    empty = docs_of(DUPES).limit(0)
    assert exact_dedup.duplicate_report(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


# --- source mix ------------------------------------------------------------------------------------------------------

def _targets(sizes):
    """Water filling by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
    for _ in range(1000):
        room = [s for s in names if target[s] < 2 * sizes[s] - 1e-9]
        if left < 1e-9 or not room:
            break
        share, total = left, sum(weight[s] for s in room)
        left = 0
        for s in room:
            target[s] += share * weight[s] / total
            if target[s] > 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
    return target


MIXED = [(k, "w " * (k * 7 % 40 + 1), None, f"s{k % 5}") for k in range(400)] + [(900 + k, "a b c", None, None) for k in range(9)] + [
    (950, None, None, "s1"), (951, "", None, "empty"), (7, "a b c d e f g", None, "s2"), (7, "a b c d e f g", None, "s2"), (960, "x " * 5000, None, "s3")]


def test_mix_targets_and_takes(docs_of):
    rows = source_mix.plan_mix(docs_of(MIXED)).collect()
    assert len(rows) == len(MIXED)
    sizes = collections.Counter()
    for _, t, _, s in MIXED:
        sizes[s] += len(WORD.findall(t or ""))
    want, taken = _targets(sizes), collections.Counter()
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert taken[s] <= want[s] + 1e-6 and taken[s] >= want[s] - 30, s
    again = source_mix.plan_mix(docs_of(MIXED).repartition(7)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.nth)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert {key(r): r.taken for r in rows if r.doc_id != 7} == {key(r): r.taken for r in again if r.doc_id != 7}


def test_mix_rows(docs_of):
    df = docs_of(MIXED).withColumns({"copies": F.lit("c"), "nth": F.lit("n"), "size": F.lit("z")})
    plan = source_mix.plan_mix(df).collect()
    out = source_mix.mix(df)
    assert out.columns == df.columns
    got = collections.Counter((r.doc_id, r.text, r.source, r.copies) for r in out.collect())
    want = collections.Counter()
    for r in plan:
        want[r.doc_id, r.source, r.size] += r.copies
    have = collections.Counter()
    for (i, t, s, c), n in got.items():
        assert c == "c"
        have[i, s, len(WORD.findall(t or ""))] += n
    assert +have == +want


def test_mix_uses_probabilities(docs_of):
    """Over many ids, a half-taken source keeps about half of its documents whatever their size."""
    rows = source_mix.plan_mix(docs_of([(k, "w " * (1 + k % 3), None, "only") for k in range(3000)])).collect()
    for size in (1, 2, 3):
        share = np.mean([r.copies for r in rows if r.size == size])
        assert abs(share - 1.5) < 0.06


def test_mix_fills_until_nothing_fits(docs_of):
    """Heavy-tailed sizes: filling goes on until no document left is as small as the words left, round after round."""
    rng = random.Random(11)
    rows = [(k, "w " * int(1.4 ** rng.randrange(1, 24)), None, f"s{k % 4}") for k in range(240)]
    plan = source_mix.plan_mix(docs_of(rows)).collect()
    for s in {r.source for r in plan}:
        mine = [r for r in plan if r.source == s]
        left = mine[0].target - sum(r.taken for r in mine)
        whole = int(mine[0].target // mine[0].source_size)
        open_ones = [r.size for r in mine if r.copies == whole and r.size]
        assert left >= 0 and (whole == 2 or all(size > left for size in open_ones)), s


def test_mix_rounds_do_not_pile_up(docs_of, monkeypatch):
    take, plans = source_mix._take, []

    def seen(pool, left):
        plans.append(pool._jdf.queryExecution().optimizedPlan().toString())
        return take(pool, left)
    monkeypatch.setattr(source_mix, "_take", seen)
    source_mix.plan_mix(docs_of([(k, "w " * (1 + k * k % 97), None, "ab"[k % 2]) for k in range(400)])).collect()
    assert len(plans) > 1 and not any("Join" in p for p in plans)        # each round starts from a table


def test_mix_empty_and_wordless(docs_of):
    assert source_mix.plan_mix(docs_of([(1, "a")]).limit(0)).count() == 0
    assert source_mix.mix(docs_of([(1, "a")]).limit(0)).count() == 0
    assert [r.taken for r in source_mix.plan_mix(docs_of([(1, None, None, "s"), (2, " ", None, None)])).collect()] == [0, 0]


@pytest.mark.parametrize("name", ["op4_source_mix", "op10_exact_dedup"])
def test_equals_oracle(spark, name):
    sf = "/root/testdata/sf0.01"
    out = queries.queries()[name](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(queries.oracle_sql()[name]).to_arrow_table().to_pylist()
    key = lambda r: tuple(sorted((k, str(v)) for k, v in r.items()))
    assert sorted(key(r.asDict()) for r in out.collect()) == sorted(map(key, want))


# --- n-gram Jaccard join ---------------------------------------------------------------------------------------------

def _grams(text, n=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def _joined(rows, n=4, percent=85):
    sets = [(i, _grams(t, n)) for i, t in rows]
    lead = {i: i for i, _ in rows}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(i), find(j)))
                lead[q] = p
    return sorted((i, len(x), find(i)) for i, x in sets)


def _near_copies(seed=4):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(4000)]
    common = " ".join(rng.choice(vocab) for _ in range(40))
    rows, n = [], 0
    for group in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice((5, 30, 120, 300)))]
        for _ in range(rng.choice((1, 2, 5, 25))):
            words = list(base)
            for _ in range(rng.randrange(0, max(1, len(words) // 25) + 1)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((n, " ".join(words) + (" " + common if group % 3 == 0 else "")))
            n += 1
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one TWO"), (1005, "one two three"), (1006, "é É a b"), (1007, "É é a b"),
             (1008, "a b c d"), (1009, "A b\tc\nd "), (1010, "a b c d a b c d a b c d")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("holds", [4096, 3])
def test_join_equals_brute_force(docs_of, monkeypatch, holds):
    """Also with frequent tokens split over salts, and with leader rounds forced."""
    monkeypatch.setattr(ngram_join, "SALT_HOLDS", holds)
    if holds == 3:
        monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", 0)
        monkeypatch.setattr(ngram_join, "ROUNDS", 2)
    rows = _near_copies()
    df = docs_of(rows).withColumns({"node": F.lit(1), "cls": F.lit(2), "component_id": F.lit(3)}).repartition(5)
    out = ngram_join.linked_components(df).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == _joined(rows)


def test_join_filters_lose_no_link():
    """Every linking pair shares a prefix token under each order."""
    rng = random.Random(9)
    levels = np.random.default_rng(9).integers(0, 4, ngram_join.SLOTS).astype(np.uint16)
    for _ in range(300):
        n = rng.randrange(1, 120)
        x = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))
        y = np.unique(np.concatenate((x[rng.randrange(0, max(1, n // 6)):], np.array([rng.getrandbits(64) for _ in range(rng.randrange(0, 8))], np.uint64))))
        common = len(np.intersect1d(x, y))
        if 100 * common >= 85 * (len(x) + len(y) - common):
            for k in range(ngram_join.ORDERS):
                assert set(x[ngram_join.prefix(x, levels, k)]) & set(y[ngram_join.prefix(y, levels, k)])


def test_join_repeated_null_and_empty(docs_of):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (None, "q r s t u"), (8, "q r s t u"), (None, "z z z z z y"), (9, "x")]
    out = ngram_join.linked_components(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in out) == [
        ("3", "3"), ("5", "3"), ("5", "3"), ("8", "8"), ("9", "9"), ("None", "3"), ("None", "8"), ("None", "None")]
    assert sorted(str(r.doc_id) for r in ngram_join.keep_one(docs_of(rows)).collect()) == ["3", "8", "9", "None", "None", "None"]
    assert ngram_join.linked_components(docs_of(rows).limit(0)).count() == 0


def test_keep_one_goes_by_row(docs_of):
    """Rows that share the id of a copy, but not its text, stay."""
    text = " ".join(f"w{k}" for k in range(200))
    near, other = text.replace("w150", "x"), " ".join(f"z{k}" for k in range(50))
    rows = [(3, text), (5, near), (5, other), (6, text), (7, None), (None, near)]
    docs = docs_of(rows).withColumns({"id": F.lit(1), "cls": F.lit(2), "doc": F.lit("d"), "n_shingles": F.lit(3)})
    out = ngram_join.keep_one(docs, words=5, percent=80)
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect() if r.text) == sorted([("3", text), ("5", other), ("None", near)])


def test_linked_by_other_words_and_percent(docs_of):
    """The rule is an argument: 5 words and 80 % link what 4 words and 95 % do not."""
    text = [f"w{k}" for k in range(200)]
    rows = [(1, " ".join(text)), (2, " ".join(text[:100] + ["x"] + text[101:]))]
    part = lambda **rule: [r.component_id for r in sorted(ngram_join.linked_components(docs_of(rows), **rule).collect())]
    assert part(words=5, percent=80) == [1, 1] and part(words=4, percent=97) == [1, 2]


@pytest.mark.parametrize("hot", [components.HOT, 0])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(components, "HOT", hot)
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(40)]
    out = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = collections.defaultdict(set)
    for a, b in links:
        near[a].add(b), near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y), todo.append(y)
        assert out.get(start, start) == min(seen)


def _work_of(spark, call):
    """(jobs, tasks) that ``call`` runs on 200 shuffle partitions that Spark does not coalesce."""
    conf = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    group, tracker = uuid.uuid4().hex, spark.sparkContext.statusTracker()
    for k, v in conf.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup(group, "")
    try:
        call()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.set(k, v)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    stages = [tracker.getStageInfo(s) for s in {s for j in jobs for s in j.stageIds}]
    return len(jobs), sum(s.numCompletedTasks for s in stages if s)


def test_star_steps_of_few_links_run_few_tasks(spark):
    """Before, each of the rounds ran two stages of all 200 partitions, for 40 links."""
    links = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    assert _work_of(spark, lambda: components.components(links).count())[1] < 1200


def test_workers_drop_what_other_operators_kept():
    """Before, a worker held the encoder and its caches through all stages that came after it."""
    from riskloom.llm import byte_bpe, common
    byte_bpe._encoders["k"] = common.KEPT.setdefault("other", {})["k"] = object()
    common.release_memory("byte_bpe")
    assert byte_bpe._encoders and not common.KEPT["other"]
    common.release_memory()
    assert not byte_bpe._encoders


def test_sketch_comes_in_one_job(spark, docs_of):
    """Before, each partition of the counts was a job of its own; the counts are those of all shingles."""
    docs, found = docs_of(["a b c d e", "a b c d", None]).repartition(3), []
    assert _work_of(spark, lambda: found.append(ngram_join.sketch(docs)))[0] <= 4
    assert found[0].sum() == 3 and sorted(found[0][found[0] > 0].tolist()) == [1, 2]


# --- fingerprints ----------------------------------------------------------------------------------------------------

def test_sampling_estimates_generalised_jaccard():
    sampler = fingerprints.Sampler(4096)
    rng = random.Random(6)
    for _ in range(5):
        a = [f"t{rng.randrange(60)}" for _ in range(150)]
        b = a[:rng.randrange(30, 150)] + [f"u{rng.randrange(60)}" for _ in range(60)]
        x, y = (collections.Counter({w: n * len(w) for w, n in collections.Counter(t).items()}) for t in (a, b))
        want = sum((x & y).values()) / sum((x | y).values())
        f = fingerprints.digits(sampler.fingerprints([" ".join(a).encode(), " ".join(b).encode()]))
        assert abs(fingerprints.likeness(f[:1], f[1:])[0] - want) < 4 * math.sqrt(want * (1 - want) / 4096) + 0.01


def test_fingerprint_depends_on_words_only():
    sampler = fingerprints.Sampler()
    a, b, c, d, e = fingerprints.digits(sampler.fingerprints([b"x y z y", b" y\tz y\nx", b"", b" \n", b"x"]))
    assert (a == b).all() and (c == 0).all() and (d == 0).all() and (e > 0).all()
    blocks = fingerprints.Sampler()
    text = " ".join(f"w{k}" for k in range(5000)).encode()
    whole = blocks.fingerprints([text])
    old, fingerprints.BLOCK = fingerprints.BLOCK, 100
    try:
        assert (fingerprints.Sampler().fingerprints([text]) == whole).all()
    finally:
        fingerprints.BLOCK = old


def test_fingerprint_query(spark, docs_of, as_tables):
    rng = random.Random(8)
    rows = [(k * 3, "".join(rng.choice("ab é日 \n") for _ in range(rng.randrange(0, 60)))) for k in range(120)]
    rows += [(30, None), (1000, None), (1001, ""), (2000, "é" * 3000), (6, "tie a"), (6, "tie b")]
    rows = list(dict.fromkeys((i, t) for i, t in rows))
    df = docs_of(rows).withColumns({"part": F.lit("p"), "guest": F.lit("g")}).repartition(6)
    out = fingerprints.op1_weighted_fingerprints(spark, as_tables(documents=df)).collect()
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, follow = t or "", order[(k + 1) % len(order)][1] or ""
        edit = t[:len(t) - len(t) // 3] + follow[:len(t) // 3]
        want.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 4 * fingerprints.SAMPLES for r in out)
    by_text = {}
    for i, t in order:
        by_text.setdefault(t or "", set()).update(r.fingerprint for r in out if r.doc_id == i and r.n_chars == len(t or ""))
    assert len(by_text[""]) == 1


def test_fingerprint_small_tables(spark, docs_of, as_tables):
    one = fingerprints.op1_weighted_fingerprints(spark, as_tables(documents=docs_of([(4, "abc def")]))).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    none = fingerprints.compare_with_edit(docs_of([(4, "abc def")]).limit(0))
    assert none.count() == 0
    assert fingerprints.fingerprint(docs_of([(1, "a"), (2, "a"), (3, None)])).select("fingerprint").distinct().count() == 2


def test_fingerprint_tells_edits_from_neighbours(real):
    rows = fingerprints.compare_with_edit(real).toPandas()
    long = rows[rows.n_chars >= 200]
    assert (long.near_edited > 0.3).mean() > 0.99 and (long.near_next < 0.3).mean() > 0.97


# --- toxicity --------------------------------------------------------------------------------------------------------

def _toxic_corpus(n=1600, seed=3):
    rng = random.Random(seed)
    words = [f"v{k}" for k in range(800)]
    bad = ["scum", "idiot", "trash", "moron"]
    docs, labels = [], []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        toxic = k % 8 == 0
        if toxic:
            for _ in range(max(1, len(text) // 20)):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        docs.append((k, " ".join(text)))
        if k % 3:
            labels.append((k, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark, docs_of, as_tables):
    docs, labels = _toxic_corpus()
    docs += [(9000, None), (9001, ""), (9002, "scum " * 3000), (3, docs[3][1]), (None, "idiot")]
    labels += [(1, 1, None), (None, 1, 1), (4, 0, 0)]
    sf = as_tables(documents=docs_of(docs), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = toxicity.op2_toxicity(spark, sf).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 9000]
    truth = np.array([r.doc_id % 8 == 0 for r in held])
    score = np.array([r.score for r in held])
    assert (score[truth][:, None] > score[~truth][None, :]).mean() > 0.85
    assert score[truth].mean() > 2 * score[~truth].mean()
    by_id = {r.doc_id: r.score for r in out}
    assert by_id[9000] == by_id[9001] and by_id[9002] > 0.5
    again = {r.doc_id: r.score for r in toxicity.op2_toxicity(spark, sf).collect()}
    assert again == by_id


def test_toxicity_learns_from_its_split_only(spark, docs_of):
    docs, labels = _toxic_corpus(600)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    learn = toxicity.crc_mod("doc_id", 4) != 2
    a, b = (toxicity.train(docs_of(docs), spark.createDataFrame(x, "doc_id long, quality int, toxic int"), learn) for x in (labels, flipped))
    assert a["order"] == b["order"] and a["curve"] == b["curve"] and a["quality"] == b["quality"]
    assert all((x == y).all() for x, y in zip(a["arrays"], b["arrays"]))


def test_toxicity_without_classes(spark, docs_of):
    docs = docs_of([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels, want in ((none, 0.0), (spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int"), 1.0)):
        model = toxicity.train(docs, labels, F.lit(True))
        assert [r.score for r in toxicity.score(docs, model).collect()] == [want, want]
        assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_of_a_phrase_of_common_words(spark, docs_of):
    """The words of the phrase are as common in ordinary texts; only the pair is toxic."""
    rng = random.Random(5)
    words = [f"v{k}" for k in range(60)]

    def text(phrase):
        out = [rng.choice(words) for _ in range(30)]
        for a, b in (("go", "rot"), ("rot", "well"), ("well", "go")) if not phrase else (("go", "well"),) * 3:
            at = rng.randrange(len(out))
            out[at:at] = [a, b, rng.choice(words)]
        return " ".join(out)

    docs = [(k, text(k % 4 == 0)) for k in range(1200)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(1200)], "doc_id long, toxic int")
    model = toxicity.train(docs_of(docs), labels, F.lit(True))
    probe = docs_of([(1, "v1 go well v2"), (2, "v1 well go v2"), (3, "v1 go v2 well v3")])
    got = {r.doc_id: r.evidence for r in toxicity.evidence(probe, model).collect()}
    assert got[1] > max(got[2], got[3]) + 0.1


def test_toxicity_of_an_expression_does_not_fade_with_the_corpus(spark, docs_of):
    rng = random.Random(6)
    words = [f"v{k}" for k in range(200)]

    def value(n):
        rows = [(k, " ".join(rng.choice(words) for _ in range(20)) + (" slurx" if k % 8 == 0 and k < 128 else ""), k % 8 == 0) for k in range(n)]
        values = toxicity.fit_models(spark.createDataFrame(rows, "doc_id long, text string, toxic boolean"))
        model = toxicity.one_model(values, 4, ["v0"])
        return {r.doc_id: r.evidence for r in toxicity.evidence(docs_of([(1, "slurx"), (2, "never")]), model).collect()}

    small, large = value(1600), value(16000)
    assert small[1] > small[2] + 0.2 and large[1] > large[2] + 0.2
    assert abs((large[1] - large[2]) - (small[1] - small[2])) < 0.5


def _plain_kneser_ney(rows, n, prior):
    """(log ratio by n-gram, by context, P by class and n-gram) from counts in dictionaries."""
    def grams(text):
        fold = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in text.encode())
        return {(b"\0" * n + fold)[i + 1:i + 1 + n] for i in range(len(fold))}

    counts = {True: collections.Counter(), False: collections.Counter()}
    for text, toxic in rows:
        counts[toxic].update(grams(text or ""))

    def discount(c):
        n1, n2 = (sum(v == k for v in c.values()) for k in (1, 2))
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.75

    def after(c, h):
        return [v for g, v in c.items() if g[:-1] == h]

    def shorter(c):
        levels = [c]
        while len(next(iter(levels[-1]))) > 1:
            levels.append(collections.Counter(g[1:] for g in levels[-1]))
        return {n - j: x for j, x in enumerate(levels)}

    both = shorter(counts[True] + counts[False])
    own = {k: shorter(c) for k, c in counts.items()}

    def left(h, toxic):
        c = own[toxic][len(h) + 1]
        seen = after(c, h)
        return (prior + discount(c) * len(seen)) / (sum(seen) + prior)

    def chance(g, toxic):
        c = own[toxic][len(g)]
        if len(g) > 1:
            lower = chance(g[1:], toxic)
        else:
            s = both[1]
            lower = (max(s[g] - discount(s), 0) + discount(s) * len(s) / 256) / sum(s.values())
        return max(c[g] - discount(c), 0) / (sum(after(c, g[:-1])) + prior) + left(g[:-1], toxic) * lower

    return grams, both[n], chance, left


def test_toxicity_equals_plain_kneser_ney(spark, docs_of, monkeypatch):
    rows = [("You idiot, you", True), ("a idiom of you", False), ("", True), (None, False), ("Ünique aaaa", False),
            ("you scum scum", True), ("the sum of a", False), ("a", False), ("you, a sum", False)]
    df = spark.createDataFrame(rows, "text string, toxic boolean")
    values = toxicity.fit_models(df, (2, 3), (4.0, 32.0))
    probe = [(1, "An idiot of SUM!"), (2, ""), (3, None), (4, "zzzz"), (5, "a"), (5, "a"), (6, "you " * 600_000), (None, "scum")]
    for n in (2, 3):
        for column, prior in (("v0", 4.0), ("v1", 32.0)):
            grams, seen, chance, left = _plain_kneser_ney(rows, n, prior)
            for toxic in (True, False):                  # a distribution over all bytes after a context
                for h in list({g[:-1] for g in seen})[:3]:
                    assert abs(sum(chance(h + bytes([x]), toxic) for x in range(256)) - 1) < 1e-9
            found = {r.key: r[column] / toxicity.UNIT for r in values.where(f"n = {n}").collect()}
            for g in seen:
                assert abs(found[int.from_bytes(g, "big") | n << toxicity.LENGTH] - math.log(chance(g, True) / chance(g, False))) < 1e-5
                rest = found[int.from_bytes(g[:-1], "big") | n << toxicity.LENGTH | toxicity.CONTEXT]
                assert abs(rest - math.log(left(g[:-1], True) / left(g[:-1], False))) < 1e-5
        model = toxicity.one_model(values, n, ["v0"])
        shipped = sorted(toxicity.evidence(docs_of(probe), model).select("doc_id", "evidence", "n_bytes").collect(), key=str)
        assert {r.doc_id: r.n_bytes for r in shipped}[6] == 2_400_000
        monkeypatch.setattr(toxicity, "SHIPPED", 0)      # a table of values too large for the tasks
        joined = toxicity.one_model(values, n, ["v0"])
        assert "arrays" not in joined
        assert sorted(toxicity.evidence(docs_of(probe), joined).select("doc_id", "evidence", "n_bytes").collect(), key=str) == shipped
        monkeypatch.undo()
        chance = _plain_kneser_ney(rows, n, 4.0)[2]
        fold = b"\0" * (n - 1) + b"an idiot of sum "
        want = sum(math.log(chance(fold[i:i + n], True) / chance(fold[i:i + n], False)) for i in range(16)) / 16
        assert abs({r.doc_id: r.evidence for r in shipped}[1] - want) < 1e-5


def test_toxicity_counts_combine_over_a_task(spark, monkeypatch):
    """Long texts in pieces, several texts: each n-gram counts once a text."""
    rows = [("ab cd " * 400_000, True), ("ab", False), ("cd " * 10, True)]
    found = {(r.n, r.code): (r.t, r.o) for r in toxicity.gram_counts(spark.createDataFrame(rows, "text string, toxic boolean").coalesce(1), (2,)).collect()}
    key = lambda x: (2, int.from_bytes(x, "big"))
    assert found[key(b"ab")] == (1, 1) and found[key(b"cd")] == (2, 0) and found[key(b" a")] == (1, 0) and found[key(b"\0c")] == (1, 0)


def test_toxicity_empty_documents_with_labels(spark, as_tables, docs_of):
    sf = as_tables(documents=docs_of([]), labels=spark.createDataFrame([(1, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int"))
    assert toxicity.op2_toxicity(spark, sf).collect() == []


# --- personal data ---------------------------------------------------------------------------------------------------

def _base_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
    found = {"email": re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text),
             "ip": (m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))),
             "card": (m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
             "phone": (m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15)}
    return {k: [m.span() for m in ms] for k, ms in found.items()}


PRIVATE = ["", "no data", "mail a.b@c.de now", "a@b.c@d.e x@y.z_q@r.st", "a@b..c a@.b.c @x.y a@b", "1.2.3.4 1.2.3.4.5.6.7.8.9 256.1.1.1 0001.2.3.255",
           "4111 1111 1111 1111", "4111-1111-1111-1111x4111111111111111", "4111  1111 1111 1111", "4111111111111112", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
           "+1 (415) 555-2671 and +49.30.123456-", "+1((((((((", "+12 3456789012345678", "\U0001f600é 1.2.3.4 \U0001f600 z@z.zz", "12.34.56.78@host.com",
           "call 415-555-2671 or (415) 555 2671", "joe (at) site (dot) com, 10[.]0[.]0[.]1", "xy@z.com", "+1 (269) 555-3296 4524000000000000",
           "4111\ue0001111\ue0001111\ue0001111", "a\ue000b@c.de\ue000f", "4111 1111\ue0011111 1111 4111 1111-1111 1111\ue000",
           " ".join("4" + "1" * 15), "-".join("4" + "1" * 15), "pay 4 1-1 1 1 1-1 1 1 1 1-1 1 1 1 1 now"]


def test_pii_base_spans_equal_brute_force(docs_of):
    rng = random.Random(7)
    texts = PRIVATE + ["".join(rng.choice("0123456789 .-+()@ab,é\U0001f600") for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    texts += ["".join(rng.choice(("4111 1111-1111 1111", "1.2.3.4", "a@b.cd", "+12345678", " ", ".", "x")) for _ in range(30)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(5000, None), (5001, PRIVATE[2]), (5001, PRIVATE[2]), (None, PRIVATE[2])]
    df = docs_of(rows).withColumns({"mark": F.lit(1), "base": F.lit(2), "kind": F.lit(3)})
    out = pii.personal_data(df).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    for i, t in rows:
        got = collections.defaultdict(list)
        for s in by_id[i].base:
            got[pii.KINDS[s.no - 1]].append((s.start, s.end))
        assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in _base_spans(t or "").items() if v}, (i, t)
        spans = sorted((s.start, s.end) for s in by_id[i].added)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        for s in by_id[i].added:
            assert all(s.end <= a or b <= s.start for v in _base_spans(t or "").values() for a, b in v)


@pytest.mark.parametrize("text", ["1" * 60_000, "1 " * 40_000, "1." * 40_000, "a." * 40_000, "a@" + "b." * 40_000, "+1" + "(" * 60_000, "x@y.zz " * 15_000,
                                  "a(at)b(dot)c " * 4000, "1.2.3.4 " * 10_000])
def test_pii_long_runs(docs_of, text):
    out = pii.personal_data(docs_of([(1, text)])).collect()[0]
    assert len(out.base) == sum(map(len, _base_spans(text).values()))


def test_pii_adds_what_labelers_support(docs_of):
    rows = [(k, f"please call +1 (415) 555-{2000 + k} today") for k in range(200)]
    rows += [(1000 + k, f"please call (415) 555-{3000 + k} today") for k in range(40)] + [(2000 + k, f"version 2.{k} build 12345{k:03}9871 x") for k in range(40)]
    out = {r.doc_id: r for r in pii.personal_data(docs_of(rows)).collect()}
    assert all(len(out[k].base) == 1 and not out[k].added for k in range(200))
    assert np.mean([len(out[1000 + k].added) == 1 for k in range(40)]) > 0.9
    assert np.mean([len(out[2000 + k].added) == 0 for k in range(40)]) > 0.9


def test_pii_query_and_empty(spark, docs_of, as_tables):
    rows = list(enumerate(PRIVATE)) + [(99, None)]
    out = pii.op8_pii(spark, as_tables(documents=docs_of(rows)))
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    for r in out.collect():
        base = _base_spans(dict(rows)[r.doc_id] or "")
        text = ",".join(f"{k}:{a}:{b}" for k, v in base.items() for a, b in v)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(v) for v in base.values()]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
    assert pii.personal_data(docs_of([(1, "a")]).limit(0)).count() == 0
    assert [list(r.base) for r in pii.personal_data(docs_of([(1, "a"), (2, None)])).collect()] == [[], []]


def test_reliabilities_follow_agreement():
    patterns = [("phone", "1,1,1,1", 500), ("phone", "-1,-1,-1,-1", 500), ("phone", "1,1,0,1", 50), ("phone", "-1,1,0,-1", 50)]
    likely = pii.reliabilities(patterns)
    assert likely["phone", "1,1,1,1"] > 0.9 > 0.5 > 0.1 > likely["phone", "-1,-1,-1,-1"]
    assert likely["phone", "1,1,0,1"] > 0.5 > likely["phone", "-1,1,0,-1"]


# --- language ID -----------------------------------------------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    out = language_id.op9_language_id(spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(truth, on="doc_id")
    assert len(out) == len(truth) and ((both.score >= 0) & (both.score <= 1)).all()
    assert (both.lang_pred == both.lang)[both.held_out].mean() > 0.97
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out))


def test_language_cases(spark, docs_of):
    rows = [(k, "the cat and the dog" if k % 2 else "der hund und die katze", "en" if k % 2 else "de") for k in range(40)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "1234 !?", None), (103, "日本", None), (104, "the cat", None), (104, "the cat", None), (None, "und die katze", None)]
    docs = docs_of(rows).withColumns({"score": F.lit("mine"), "n": F.lit(1)})
    model = language_id.learn(docs)
    out = language_id.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "lang_pred", "score"]
    got = {r.doc_id: r for r in out.collect()}
    assert [got[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert got[103].lang_pred in ("de", "en") and got[104].lang_pred == "en" and got[None].lang_pred == "de"
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {100, 101, 102}
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))          # nothing to learn: what has a letter stays
    assert {r.doc_id for r in language_id.keep_identified(unlabelled).collect()} == {r[0] for r in rows} - {100, 101, 102}
    assert language_id.learn(docs.limit(0)) is None and language_id.predict(docs.limit(0), model).count() == 0
    single = language_id.learn(docs.where("lang = 'en'"))
    assert {r.lang_pred for r in language_id.predict(docs.where("doc_id = 1"), single).collect()} == {"en"}


def test_language_weights_equal_kernel_form():
    """The folded weight matrix scores as kernels against landmarks do."""
    texts = [f"the cat {k} and a dog" for k in range(20)] + [f"der hund {k} und eine katze" for k in range(20)]
    import pyarrow as pa
    raw, off = language_id.buffers(pa.array(texts))
    present = language_id.presence(raw, off, 0, len(texts))
    for k, t in enumerate(texts):
        folded = bytes(language_id._FOLD[list(t.encode())])
        grams = {folded[i:i + n] for n in range(1, 5) for i in range(len(folded) - n + 1)}
        assert present[k].sum() <= len(grams) and present[k].sum() >= 0.98 * len(grams)
    model = language_id.fit(present, ["en"] * 20 + ["de"] * 20)
    scores = present @ model["weights"]
    assert model["languages"] == ["de", "en"] and (scores.argmax(1) == [1] * 20 + [0] * 20).all()


def test_long_text_is_marked_in_pieces(monkeypatch):
    import pyarrow as pa
    raw, off = language_id.buffers(pa.array(["the quick brown fox " * 300, "x"]))
    whole = language_id.presence(raw, off, 0, 2)
    monkeypatch.setattr(language_id, "_SPAN", 64)
    assert (language_id.presence(raw, off, 0, 2) == whole).all()


# --- pipeline --------------------------------------------------------------------------------------------------------

def test_pipeline_equals_its_stages_by_brute_force(spark, real):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    keep = [i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")]
    last = {}
    for i in sorted(keep):
        last[rows[i].text] = i
    keep = sorted(last.values())
    keep = [i for i, _, lead in _joined([(i, rows[i].text) for i in keep], corpus_pipeline.WORDS, corpus_pipeline.PERCENT) if i == lead]
    sizes = collections.Counter()
    for i in keep:
        sizes[rows[i].source] += len(WORD.findall(rows[i].text))
    want, taken = _targets(sizes), collections.Counter()
    for r in out:
        assert r.doc_id in keep and r.round_trip and r.n_tokens * 4 == len(r.ids)
        taken[r.source] += len(WORD.findall(rows[r.doc_id].text))
    copies = collections.Counter(r.doc_id for r in out)
    assert max(copies.values()) <= 2
    for s, t in want.items():
        most = max(len(WORD.findall(rows[i].text)) for i in keep if rows[i].source == s)
        assert t - most <= taken[s] <= t + 1e-6


def test_pipeline_stages_keep_columns(spark, docs_of):
    import corpus_pipeline
    docs = docs_of([(k, f"the cat {k} sat on the mat and the dog {k * 7}", "en", f"s{k % 3}") for k in range(40)] + [(50, None, "en", None), (51, "", None, "s1")])
    for stage in (s for _, s in corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, None)
        assert out.columns == docs.columns and 0 < out.count() <= 2 * 42
        assert stage(spark, docs.limit(0), None).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), None).count() == 0
