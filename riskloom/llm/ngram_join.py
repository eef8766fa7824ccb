"""N-gram Jaccard join by multiple-global-order filtering.

A document's set holds its distinct shingles of WORDS words (A-Z lowered); with
fewer words, the whole sequence as one.  Two documents link when
100 * |A & B| >= PERCENT * |A | B|.  Such documents share, under any order of
all tokens, a token of their prefixes: the first n - ceil(PERCENT * n / 100) + 1
tokens of a set of n.  Several orders are used, each rare tokens first by a
count sketch of all documents - the first by the count itself, the others by
its logarithm in coarse steps - and then by a hash of its own.  Candidates share a prefix token under the first order; the other
orders' prefixes are intersected before the pair is verified on its full sets.
Before the sets travel at all, their histograms by leading hash bits must allow
the overlap (an upper bound, so no link is lost).

No token's documents are paired with each other wholesale:

* documents with equal sets are one class, combined in each task first, and a
  token counts only where classes of comparable size share it;
* a token's classes are first paired with leaders only (a token that the sketch
  shows to be frequent is split over salts, whose leaders are paired in turn);
  pairs that pass join classes to components;
* only pairs across components can matter from then on.  Rounds with new
  leaders go on while many such pairs remain, then all of them are tested, for
  the few tokens of many classes in blocks, so no link is lost.

This is done twice: first with an upper bound of the overlap, from histograms
of the sets, which need no texts; then, inside the components so found, with
the sets of the classes in them, the only ones whose texts are read again.

What the driver sees: the sketch (SLOTS counts) and numbers of rows.

Cases: a null or empty text, or one of white space, has an empty set and is
linked with nothing, not even its like; rows repeating an id are separate rows
of one document; a null id takes part, but names no component unless nothing
else does (then component_id is null); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import narrowed, on_workers, release_memory, shuffle_partitions, staged, table, with_computed
from riskloom.llm.components import HOT, components
from riskloom.llm.textops import LOWER, buffers, mix64, row_words, stretches

WORDS, PERCENT = 4, 85
#: Slots of the count sketch and number of token orders.
SLOTS, ORDERS = 1 << 22, 3
#: Classes of a token that one salt holds, roughly.
SALT_HOLDS = 4096
#: Leader rounds go on while the pairs across components are more than this many for each class of a token.
PAIRS_PER_ROW, ROUNDS = 4, 3
#: Tokens of more classes are compared in blocks of about as many.
HOLDS = 128
#: Pairs of histograms, and rows with a text or histograms, that weigh as much as a plain row.
LIGHT, HEAVY = 64, 16
_BLOCK = 4096
_SEEDS = mix64(np.arange(1, ORDERS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def shingles(raw: np.ndarray, off: np.ndarray, lo: int, hi: int, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of rows lo..hi."""
    h, _, per_row = row_words(raw, off, lo, hi, LOWER)
    n = len(h)
    rolled = h.copy()
    for k in range(1, words):
        rolled = mix64(rolled[:max(0, n - k)]) + h[k:]
    rolled = mix64(rolled)
    out, at = [], 0
    for count in per_row.tolist():
        if count >= words:
            out.append(np.unique(rolled[at:at + count - words + 1]))
        elif count:
            x = np.uint64(count)
            x = np.array([x], np.uint64)
            for k in range(at, at + count):
                x = mix64(x) + h[k:k + 1]
            out.append(mix64(x))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out


def _sets(column: pa.Array, words: int = WORDS):
    """(row, set) of a batch's texts, and a slice of rows at a time."""
    raw, off = buffers(column)
    for lo, hi in stretches(off):
        yield lo, shingles(raw, off, lo, hi, words)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _class(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, n_shingles, cls, bins) for each document: a 64-bit hash of its set and the set's histogram."""
    on_workers(docs.sparkSession)

    def run(batches):
        release_memory()
        for batch in batches:
            n, cls, bins = [], [], []
            for _, sets in _sets(batch.column(1), words):
                n += [len(s) for s in sets]
                cls += [_class(s) for s in sets]
                bins += [histogram(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(bins, pa.binary())],
                names=["id", "n_shingles", "cls", "bins"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, cls long, bins binary")


def sketch(docs: DataFrame, text_col: str = "text", words: int = WORDS) -> np.ndarray:
    """Count of each token slot: each task adds up its documents, blocks of slots are added up across tasks."""
    on_workers(docs.sparkSession)

    def count(batches):
        release_memory()
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, sets in _sets(batch.column(0), words):
                if any(len(s) for s in sets):
                    total += np.bincount(_slot(np.concatenate(sets)), minlength=SLOTS)
        for at in range(0, SLOTS, 64 * _BLOCK):
            part = total[at:at + 64 * _BLOCK].reshape(-1, _BLOCK)
            used = np.flatnonzero(part.any(axis=1))
            data = [part[k].astype("<u2" if part[k].max() < 1 << 16 else "<u4").tobytes() for k in used]
            yield pa.RecordBatch.from_arrays([pa.array(used + at // _BLOCK, pa.int32()), pa.array(data, pa.binary())], names=["block", "counts"])

    def add(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[block] = found.get(block, 0) + np.frombuffer(data, f"<u{len(data) // _BLOCK}").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()),
                                          pa.array([np.minimum(v, 0xFFFFFFFF).astype("<u4").tobytes() for v in found.values()], pa.binary())],
                                         names=["block", "counts"])

    parts = docs.select(text_col).mapInArrow(count, "block int, counts binary")
    parts = parts.repartition(min(shuffle_partitions(docs.sparkSession), SLOTS // _BLOCK), "block").mapInArrow(add, "block int, counts binary")
    out = np.zeros(SLOTS, np.uint32)
    for row in parts.collect():                          # SLOTS counts of 4 bytes in all, in one job
        out[row["block"] * _BLOCK:(row["block"] + 1) * _BLOCK] = np.frombuffer(row["counts"], "<u4")
    return out


def order_counts(counts: np.ndarray) -> np.ndarray:
    """What the orders need of the sketch: counts up to 65535, two bytes a slot."""
    return np.minimum(counts, 65535).astype(np.uint16)


def salts_of(counts: np.ndarray) -> np.ndarray:
    """Salts for the tokens of a slot, by what its count is above the common load."""
    common = np.uint32(2 * int(counts.mean()))
    over = (np.maximum(counts, common) - common) // np.uint32(SALT_HOLDS)
    return (1 + np.minimum(over, 65534)).astype(np.uint16)


def _ranks(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    level = levels[_slot(tokens)]
    if order:
        level = np.round(4 * np.log2(level + 1.0))
    return (level.astype(np.uint64) << np.uint64(48)) | (mix64(tokens ^ _SEEDS[order]) >> np.uint64(16))


def prefix(tokens: np.ndarray, levels: np.ndarray, order: int, percent: int = PERCENT) -> np.ndarray:
    """Places in ``tokens`` of the set's prefix under one of the orders."""
    n = len(tokens)
    p = n + (-percent * n // 100) + 1
    if not n:
        return np.zeros(0, np.int64)
    return np.argpartition(_ranks(tokens, levels, order), p - 1)[:p] if p < n else np.arange(n)


def postings(docs: DataFrame, levels, salts, text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(token, salts, salt, node, n): the first order's prefix tokens of each set that a task meets first."""
    on_workers(docs.sparkSession)
    names = ["token", "salts", "salt", "node", "n"]

    def run(batches):
        release_memory()
        seen: set[int] = set()
        level, salt = levels.value, salts.value
        for batch in batches:
            for _, sets in _sets(batch.column(0), words):
                out: list[list] = [[] for _ in names]
                for s in sets:
                    if not len(s) or (cls := _class(s)) in seen:
                        continue
                    seen.add(cls)
                    first = s[prefix(s, level, 0, percent)]
                    split = salt[_slot(first)].astype(np.int64)
                    for column, x in zip(out, (first.view(np.int64), split, cls % split, np.full(len(first), cls),
                                               np.full(len(first), len(s)))):
                        column.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=names)

    return docs.select(text_col).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def histogram(tokens: np.ndarray) -> bytes:
    """Tokens counted by the leading bits of their hash, a bin for one or two; a byte a bin."""
    bits = min(16, max(5, int(len(tokens)).bit_length() - 1))
    bins = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(bins, 255).astype(np.uint8).tobytes()


def most_common(a: bytes, b: bytes) -> int | None:
    """An upper bound of the tokens two sets share, from their histograms; None if a bin is full."""
    x, y = (np.frombuffer(h, np.uint8).astype(np.int64) for h in (a, b))
    if (x == 255).any() or (y == 255).any():
        return None
    n = min(len(x), len(y))
    return int(np.minimum(x.reshape(n, -1).sum(1), y.reshape(n, -1).sum(1)).sum())


def full_sets(texts: DataFrame, levels, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(text) -> (node, tokens, others): the sorted set, and the places in it of the other orders' prefixes."""
    on_workers(texts.sparkSession)

    def run(batches):
        release_memory()
        for batch in batches:
            for _, sets in _sets(batch.column(0), words):
                others = [np.concatenate([prefix(s, levels.value, k, percent) for k in range(1, ORDERS)]).astype(np.uint32).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array([_class(s) for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(others, pa.binary())],
                                                 names=["node", "tokens", "others"])

    return texts.mapInArrow(run, "node long, tokens binary, others binary")


def may_link(n: int, bins: bytes, m: int, others: bytes, percent: int = PERCENT) -> bool:
    common = most_common(bins, others)
    return common is None or 100 * common >= percent * (n + m - common)


def similar(a: tuple[bytes, bytes], b: tuple[bytes, bytes], percent: int = PERCENT) -> bool:
    """Whether two sets link: filters of the other orders first, then the full sets."""
    x, y = np.frombuffer(a[0], np.uint64), np.frombuffer(b[0], np.uint64)
    p, q = np.frombuffer(a[1], np.uint32).reshape(ORDERS - 1, -1), np.frombuffer(b[1], np.uint32).reshape(ORDERS - 1, -1)
    for k in range(ORDERS - 1):
        if not len(np.intersect1d(x[p[k]], y[q[k]], assume_unique=True)):
            return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _filtered(pairs: DataFrame, sets: DataFrame, columns: list[str], test) -> DataFrame:
    """The pairs (a, b) for which ``test`` holds of both sets' ``columns``."""
    pairs = staged(pairs, "pairs")
    total = pairs.count()
    involved = staged(narrowed(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), 2 * total), "involved")
    sets = sets.join(involved, "node", "left_semi")

    def side(name):
        return sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def run(batches):
        release_memory()
        for batch in batches:
            a, b, *rest = (c.to_pylist() for c in batch.columns)
            keep = [test(r[:len(columns)], r[len(columns):]) for r in zip(*rest)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(c, keep) if k], pa.int64()) for c in (a, b)], names=["a", "b"])

    both = narrowed(narrowed(pairs.join(side("a"), "a"), total).join(side("b"), "b"), total)
    return both.select("a", "b", *[f"{c}_{s}" for s in "ab" for c in columns]).mapInArrow(run, "a long, b long")


def possible(pairs: DataFrame, bins: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose histograms allow a link."""
    return _filtered(pairs, bins, ["n", "bins"], lambda x, y: may_link(*x, *y, percent))


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that link."""
    return _filtered(pairs, sets, ["tokens", "others"], lambda x, y: similar(x, y, percent))


def _fits(percent: int) -> Column:
    return 100 * F.least("n", "m") >= percent * F.greatest("n", "m")


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b, of rows (a, n, b, m) whose sizes allow a link; some repeat."""
    return (rows.where((F.col("a") != F.col("b")) & _fits(percent))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _led(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Each row of (keys, node, n) beside the node of its group that comes first by ``order``."""
    first = F.min_by(F.struct("node", "n"), F.col(order)).over(Window.partitionBy(*keys))
    return rows.withColumn("lead", first)


def star_pairs(posts: DataFrame, total: int, percent: int) -> DataFrame:
    """First round: every class with the leader of its token and salt, those leaders with the token's."""
    posts = narrowed(_led(posts.withColumn("place", F.xxhash64("node")), ["token", "salt"], "place"), total)
    inner = posts.select(F.col("node").alias("a"), "n", F.col("lead.node").alias("b"), F.col("lead.n").alias("m"))
    leads = posts.where("node = lead.node and salts > 1").drop("lead")
    outer = narrowed(_led(leads, ["token"], "place"), total).select(F.col("node").alias("a"), "n", F.col("lead.node").alias("b"), F.col("lead.n").alias("m"))
    return narrowed(_pairs(inner.unionByName(outer), percent).distinct(), total)


def _open(posts: DataFrame, total: int, parts: DataFrame) -> DataFrame:
    """(token, node, n, part, main, all): postings of tokens that hold several
    components, with the token's most frequent one and its number of postings.
    Tokens of one salt hold a bounded number of classes, so windows do; the
    frequent ones are counted first and joined."""
    rows = narrowed(posts.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node")), total)
    of_token, of_part = Window.partitionBy("token"), Window.partitionBy("token", "part")
    few = rows.where("salts = 1").repartition("token").withColumn("k", F.count(F.lit(1)).over(of_part))
    few = few.withColumns({"main": F.max(F.struct("k", "part")).over(of_token)["part"], "all": F.count(F.lit(1)).over(of_token)}).where("k < all")
    many = rows.where("salts > 1")
    per = narrowed(many.groupBy("token", "part").agg(F.count(F.lit(1)).alias("k")), total)
    main = per.groupBy("token").agg(F.max_by("part", F.struct("k", "part")).alias("main"), F.count(F.lit(1)).alias("several"),
                                    F.sum("k").alias("all")).where("several > 1").drop("several")
    main = narrowed(main, total)
    columns = ["token", "salts", "node", "n", "part", "main", "all"]
    return narrowed(few.select(columns), total).unionByName(narrowed(many.join(main, "token").select(columns), total))


def _leader_pairs(still: DataFrame, total: int, turn: int, percent: int) -> DataFrame:
    """Classes outside their token's main component, with a member of it picked anew for each round."""
    pick = (still.where("part = main").groupBy("token")
            .agg(F.min_by(F.struct("node", "n"), F.xxhash64("node", F.lit(turn))).alias("lead")))
    met = narrowed(still.where("part <> main").join(pick, "token"), total)
    return narrowed(_pairs(met.select(F.col("node").alias("a"), "n", F.col("lead.node").alias("b"), F.col("lead.n").alias("m")), percent).distinct(), total)


def _all_pairs(still: DataFrame, most: int, percent: int) -> DataFrame:
    """Every pair (``most`` at most) of a token's classes in different components: one of them is outside the main one."""
    out = still.where("part <> main").select("token", F.col("node").alias("a"), "n", F.col("part").alias("own"))
    rest = still.select("token", F.col("node").alias("b"), F.col("n").alias("m"), "part", (F.col("part") == F.col("main")).alias("in_main"))
    met = out.join(rest, "token").where((F.col("own") != F.col("part")) & (F.col("in_main") | (F.col("a") < F.col("b"))) & _fits(percent))
    return narrowed(_pairs(met, percent), most)


def _block_pairs(still: DataFrame, total: int, most: int, bins: DataFrame, percent: int) -> DataFrame:
    """The same for tokens of many classes: classes outside the main component
    against all, a block of about HOLDS by a block; only pairs whose histograms
    allow a link leave the task."""
    rows = narrowed(still.join(bins.select("node", "bins"), "node"), HEAVY * total).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.ceil(F.col("all") / HOLDS)))
    one = F.collect_list(F.struct("node", "n", "part", F.col("part") == F.col("main"), "bins"))
    rest = narrowed(rows.groupBy("token", F.col("block").alias("to")).agg(one.alias("rest")), HEAVY * total)
    out = narrowed(rows.where("part <> main").groupBy("token", "block").agg(one.alias("out")), HEAVY * total)

    def unpack(items):
        node, n, part, main, packed = ([tuple(i.values())[k] for i in items] for k in range(5))
        return np.array(node), np.array(n), np.array(part), np.array(main, bool), [np.frombuffer(h, np.uint8) for h in packed]

    def folded(hists, width):
        return np.stack([h.astype(np.int32).reshape(width, -1).sum(1) for h in hists])

    def run(batches):
        release_memory()
        for batch in batches:
            for x, y in zip(*(batch.column(k) for k in (0, 1))):
                (a, n, own, _, g), (b, m, part, main, h) = unpack(x.as_py()), unpack(y.as_py())
                width = min(len(i) for i in g + h)
                full_a, full_b = (np.array([(i == 255).any() for i in k]) for k in (g, h))
                left, right = folded(g, width), folded(h, width)
                found = [[], []]
                for k in range(len(a)):
                    most = np.minimum(right, left[k]).sum(1)
                    ok = (100 * most >= percent * (n[k] + m - most)) | full_a[k] | full_b
                    ok &= (own[k] != part) & (main | (a[k] < b)) & (100 * np.minimum(n[k], m) >= percent * np.maximum(n[k], m))
                    found[0].append(np.minimum(a[k], b[ok]))
                    found[1].append(np.maximum(a[k], b[ok]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(f)) for f in found], names=["a", "b"])

    return narrowed(out.join(rest, "token").select("out", "rest"), most // LIGHT).mapInArrow(run, "a long, b long")


def _merged(parts: DataFrame, links: DataFrame, turn: int) -> DataFrame:
    """(node, part) after more links: components of both, or of the components where these have many nodes."""
    links = staged(links, "found")
    known, fresh = parts.count(), links.count()
    if known <= HOT:
        own = parts.select(F.col("node").alias("a"), F.col("part").alias("b"))
        return components(links.unionByName(own), known + fresh).withColumnRenamed("component", "part") if fresh else parts

    def named(col):
        return parts.select(F.col("node").alias(col), F.col("part").alias(f"part_{col}"))
    up = links.join(named("a"), "a", "left").join(named("b"), "b", "left").select(
        F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"))
    found = components(up).select(F.col("node").alias("part"), F.col("component").alias("least"))
    moved = parts.join(found, "part", "left").select("node", F.coalesce("least", "part").alias("part"))
    fresh = found.select(F.col("part").alias("node"), F.col("least").alias("part")).join(parts, "node", "left_anti")
    return staged(moved.unionByName(fresh), f"parts-{turn}")


def settled(posts: DataFrame, bins: DataFrame, test, percent: int = PERCENT) -> DataFrame:
    """(node, part) of the classes that pairs which pass ``test`` connect, but for each component's smallest."""
    parts = posts.sparkSession.createDataFrame([], "node long, part long")
    total = posts.count()
    parts = _merged(parts, test(star_pairs(posts, total, percent)), 0)
    joined = parts.count()
    still = posts
    for turn in range(1, ROUNDS + 2):
        # a token whose classes are joined stays so: what was open before is all that can be open now
        still = staged(_open(still.select("token", "salts", "node", "n"), total, parts), f"open-{turn}")
        outside = F.col("part") != F.col("main")
        size = still.agg(F.count(F.lit(1)).alias("rows"), F.sum(outside.cast("long") * F.col("all")).alias("pairs"),
                         F.approx_count_distinct(F.when(outside, F.col("node"))).alias("nodes")).first()
        if not size["rows"]:
            break
        total = size["rows"]
        # leaders are worth a round as long as the round before joined a tenth of the classes left
        last = size["pairs"] <= PAIRS_PER_ROW * size["rows"] or turn > ROUNDS or 10 * joined < size["nodes"]
        if last:
            few, many = still.where(F.col("all") <= HOLDS), still.where(F.col("all") > HOLDS)
            pairs = _all_pairs(few, size["pairs"], percent)
            if many.limit(1).count():
                pairs = pairs.unionByName(_block_pairs(many, total, size["pairs"], bins, percent))
            pairs = narrowed(pairs.distinct(), size["pairs"])
        else:
            pairs = _leader_pairs(still, total, turn, percent)
        before = parts.count()
        parts = _merged(parts, test(pairs), turn)
        joined = parts.count() - before
        if last:
            break
    return parts


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    return _linked(docs, id_col, text_col, words, percent).select(F.col("id").alias(id_col), "n_shingles", "component_id")


def _linked(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """id, cls (of the set), n_shingles, component_id."""
    rows, parts = _settled_parts(docs, id_col, text_col, words, percent)
    return _reported(rows, _named(rows, parts))


def _settled_parts(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The documents' classes (id, n_shingles, cls, bins), and (node, part) of the classes that links join."""
    spark = docs.sparkSession
    rows = staged(described(docs, id_col, text_col, words), "described")
    counts = sketch(docs, text_col, words)
    levels = spark.sparkContext.broadcast(order_counts(counts))
    salts = spark.sparkContext.broadcast(salts_of(counts))
    del counts

    # a token links nothing where no other class of comparable size has it
    posts = postings(docs, levels, salts, text_col, words, percent).withColumn("size", F.floor(F.log("n") * 1_000_000))
    # logarithms of sizes that can link, in millionths, are at most so far apart (with some slack for rounding)
    reach = int(1e6 * np.log(100 / percent)) + 10
    near = Window.partitionBy("token", "salt").orderBy("size").rangeBetween(-reach, reach)
    posts = posts.withColumn("least", F.min("node").over(near)).withColumn("most", F.max("node").over(near))
    posts = staged(posts.where("least < most or salts > 1").select("token", "salts", "salt", "node", "n").distinct(), "postings")
    total = posts.count()
    nodes = narrowed(posts.select("node").distinct(), total)
    bins = rows.join(nodes, rows["cls"] == nodes["node"], "left_semi").groupBy(F.col("cls").alias("node"))
    bins = staged(narrowed(bins.agg(F.max("n_shingles").alias("n"), F.max("bins").alias("bins")), total), "bins")
    maybe = settled(posts, bins, lambda pairs: possible(pairs, bins, percent), percent)

    # the classes that may link, each token once for every component it is in, and one text of each class
    most = 2 * maybe.count()
    whole = staged(narrowed(maybe.unionByName(maybe.select(F.col("part").alias("node"), "part")).distinct(), most), "maybe")
    posts = staged(narrowed(posts.join(whole, "node").withColumn("token", F.xxhash64("token", "part")).drop("part"), total), "postings-in")
    firsts = (rows.join(whole, rows["cls"] == whole["node"], "left_semi").groupBy("cls").agg(F.min("id").alias("id")).select("id").distinct())
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = narrowed(own.join(firsts.hint("shuffle_hash"), "id", "left_semi"), HEAVY * most).unionByName(own.where("id is null")).select("text")
    sets = staged(full_sets(texts, levels, words, percent), "full")
    levels.destroy()                                     # all that needs them is written
    salts.destroy()
    parts = settled(posts, bins, lambda pairs: verified(possible(pairs, bins, percent), sets, percent), percent)
    return rows, parts


def _named(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """(cls, count, component_id) of the classes."""
    classes = (rows.where("n_shingles > 0").groupBy("cls").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("count"))
               .join(parts.withColumnRenamed("node", "cls"), "cls", "left").withColumn("part", F.coalesce("part", "cls")))
    named = classes.groupBy("part").agg(F.min("first").alias("component_id"))
    return staged(classes.join(named, "part").select("cls", "count", "component_id"), "named")


def _reported(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Components back on the documents; the few classes with over a thousandth of all rows by broadcast."""
    big = F.col("count") * 1000 > rows.count()
    hot = F.broadcast(named.where(big).select("cls", "component_id"))      # fewer than 1000 rows
    full = rows.where("n_shingles > 0")
    warm = full.join(hot, "cls")
    cold = full.join(hot, "cls", "left_anti").join(named.where(~big).select("cls", "component_id"), "cls")
    empty = rows.where("n_shingles = 0").withColumn("component_id", F.col("id"))
    columns = ["id", "cls", "n_shingles", "component_id"]
    return cold.select(columns).unionByName(warm.select(columns)).unionByName(empty.select(columns))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows that name their component, and those without an id: one document
    of each group stays.  Rows go by id and set, so a row stays that shares only the id of one that goes."""
    found = _linked(docs, id_col, text_col, words, percent)
    gone = found.where(~F.col("component_id").eqNullSafe(F.col("id")) & F.col("id").isNotNull()).select("id", "cls").distinct()
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).cast("long").alias("id"),
                         F.col(text_col).alias("text"))

    def compute():
        return lambda part: [pa.array([_class(s) for _, sets in _sets(part.column(2), words) for s in sets], pa.int64())]

    # only texts whose id has a row that goes are looked at again
    ids = gone.select("id").distinct()
    maybe = with_computed(nested.join(ids.hint("shuffle_hash"), "id", "left_semi").select("doc", "id", "text"), [("cls", "long")], compute)
    kept = (maybe.join(gone, ["id", "cls"], "left_anti").select("doc")
            .unionByName(nested.join(ids.hint("shuffle_hash"), "id", "left_anti").select("doc")))
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def op5_ngram_jaccard(spark, sf_dir):
    return linked_components(table(spark, sf_dir, "documents"))
