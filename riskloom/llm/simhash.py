"""SimHash near-duplicates by bit-sliced comparison.

A document's fingerprint has bit k set if over half of its shingles' hashes
have it: words (A-Z lowered) in runs of WORDS, repeats included, joined by a
space and hashed by XXH64 with SEED; with fewer words, the whole sequence as
one.  Fingerprints link at RADIUS or fewer differing bits; a document's
component is named by the smallest id that links reach.

Fingerprints are compared, not documents: equal ones are one row first.

* *Tables.*  The 64 bits are cut into RADIUS + a blocks.  Two fingerprints that
  link agree in at least a of the blocks, so they meet in a bucket of one of
  the tables, one for each choice of a blocks.  The smallest a is taken whose
  buckets would hold at most HOLDS / 2 fingerprints were they spread evenly.
  No link is missed, at any size.
* *Buckets.*  A bucket's fingerprints are stored vertically: word k holds bit k
  of 64 of them.  A fingerprint is compared with 64 others at once: the planes
  that differ are counted by carry-save adders into four bit planes (ones,
  twos, fours, more).  After every 8 planes the words are dropped in which all
  64 exceed the radius.
* *Large buckets* (over HOLDS) are cut into pieces of about HOLDS by a hash;
  each pair of pieces is a row of its own, so no task gets a whole one.
* A task sends a forest of the links it found, never all pairs of a group.

Cases: a null or empty text, or one of white space, has fingerprint zero and is
linked like any other; rows repeating an id are separate rows of one document;
a null id takes part, but names no component unless nothing else does (then
component_id is null); an empty table gives an empty result; other columns
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import on_workers, shuffle_partitions, staged, table
from riskloom.llm.components import components
from riskloom.llm.textops import LOWER, buffers

WORDS, SEED, RADIUS, BITS = 4, 42, 4, 64
#: Fingerprints of a bucket that are compared in one piece.
HOLDS = 2048
#: Shingles hashed, and (fingerprint, word) pairs compared, at a time.
RUN, AT_ONCE = 1 << 16, 1 << 15
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints ----------------------------------------------------------------------------------------------------

def hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text with A-Z lowered, in runs."""
    from xxhash import xxh64_intdigest as digest
    found = text.split()                                 # bytes: on \x20 and \x09-\x0D
    if not found:
        return
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = ends - [len(w) for w in found]
    joined, n = b" ".join(found), max(1, len(found) - words + 1)
    starts, ends = starts[:n].tolist(), ends[min(words, len(found)) - 1:].tolist()
    for at in range(0, n, RUN):
        yield np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[at:at + RUN], ends[at:at + RUN])), np.uint64)


def simhash(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """Fingerprint of a text with A-Z lowered."""
    total, n = np.zeros(BITS, np.int64), 0
    for h in hashes(text, words, seed):
        total += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little") if n else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, fp) for each document; fp holds the 64 bits as a signed number."""
    on_workers(docs.sparkSession)

    def run(batches):
        for batch in batches:
            raw, off = buffers(batch.column(1))
            fps = np.array([simhash(LOWER[raw[off[k]:off[k + 1]]].tobytes(), words) for k in range(batch.num_rows)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


# --- bit-sliced comparison -------------------------------------------------------------------------------------------

def planes(fps: np.ndarray) -> np.ndarray:
    """(BITS, words): bit j of word w in plane k is bit k of fingerprint 64 w + j."""
    full = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    full[:len(fps)] = fps
    bits = np.unpackbits(full.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8").astype(np.uint64)


def _add(a, b, c):
    """Carry-save adder: (carry, sum) of three planes."""
    u = a ^ b
    return (a & b) | (u & c), u ^ c


def near(fps: np.ndarray, word: np.ndarray, query: np.ndarray, lanes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Lanes within ``radius`` (under 8) of a query.  Row r holds the fingerprint
    query[r] against the 64 of plane word word[r], of which lanes[r] count.
    Returns (rows, lane masks) of the rows in which any lane is left."""
    sliced = planes(fps)
    rows = np.flatnonzero(lanes)
    over = ~lanes[rows]
    ones, twos, fours = (np.zeros(len(rows), np.uint64) for _ in range(3))
    for k in range(0, BITS, 8):
        at, q = word[rows], query[rows]
        d = [sliced[k + j][at] ^ (np.uint64(0) - ((q >> np.uint64(k + j)) & np.uint64(1))) for j in range(8)]
        carry = []
        for half in (0, 4):
            two_a, ones = _add(ones, d[half], d[half + 1])
            two_b, ones = _add(ones, d[half + 2], d[half + 3])
            four, twos = _add(twos, two_a, two_b)
            carry.append(four)
        more, fours = _add(fours, *carry)
        over |= more
        past = over | _exceeds(ones, twos, fours, radius)
        left = past != _FULL
        if not left.all():                               # words without a lane in reach are dropped
            rows, ones, twos, fours, over, past = (x[left] for x in (rows, ones, twos, fours, over, past))
        if not len(rows):
            break
    return rows, ~past if len(rows) else np.zeros(0, np.uint64)


def _exceeds(ones, twos, fours, radius: int):
    """Lanes whose three-bit count is over ``radius``, by bitwise comparison from the highest digit."""
    above, equal = np.zeros_like(ones), np.full_like(ones, _FULL)
    for digit, plane in ((4, fours), (2, twos), (1, ones)):
        if radius & digit:
            equal = equal & plane
        else:
            above = above | (equal & plane)
            equal = equal & ~plane
    return above


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that links (a, b) reach, for 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        label = new


def links(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, until: np.ndarray,
          radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among ``fps``.  The fingerprints come in groups;
    those of group g, starts[g]..ends[g], are compared with the fingerprints
    other[g]..until[g], each pair once (the later one with the earlier ones)."""
    padded, place = [], []                               # groups begin at plane words of their own
    base = 0
    word_of = np.zeros(len(other), np.int64)
    for g in range(len(other)):
        size = int(until[g] - other[g])
        word_of[g] = base
        padded.append(fps[other[g]:until[g]])
        fill = -size % 64
        padded.append(np.zeros(fill, np.uint64))
        place.append(np.concatenate([np.arange(other[g], until[g]), np.zeros(fill, np.int64)]))
        base += (size + fill) // 64
    if not base:
        return fps[:0], fps[:0]
    padded, place = np.concatenate(padded), np.concatenate(place)
    # rows: every query beside every plane word of its group
    n_query, n_word = ends - starts, -(-(until - other) // 64)
    per = n_query * n_word
    group = np.repeat(np.arange(len(per)), per)
    k = np.arange(len(group)) - np.repeat(np.cumsum(per) - per, per)
    query, turn = starts[group] + k // n_word[group], k % n_word[group]
    first = other[group] + 64 * turn                     # the lane's fingerprints begin here
    many = np.clip(np.minimum(until[group], query) - first, 0, 64)
    lanes = np.where(many >= 64, _FULL, (np.uint64(1) << np.minimum(many, 63).astype(np.uint64)) - np.uint64(1))
    label = np.arange(len(fps))
    for at in range(0, len(group), AT_ONCE):
        cut = slice(at, at + AT_ONCE)
        rows, mask = near(padded, (word_of[group] + turn)[cut], fps[query[cut]], lanes[cut], radius)
        if not len(rows):
            continue
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(bits)
        row = rows[row] + at
        label = label[_forest(len(fps), label[query[row]], label[place[64 * (word_of[group[row]] + turn[row]) + lane]])[label]]
    member = np.flatnonzero(label != np.arange(len(fps)))
    return fps[member], fps[label[member]]


# --- tables, buckets, pieces -----------------------------------------------------------------------------------------

def masks(n: int, radius: int = RADIUS, holds: int = HOLDS) -> list[int]:
    """The bits of each table's key for ``n`` fingerprints."""
    agree = 1
    while agree < BITS - radius and n >> (BITS * agree // (radius + agree)) > holds // 2:
        agree += 1
    cuts = [BITS * k // (radius + agree) for k in range(radius + agree + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_LINKS = "a long, b long"


def _sent(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (a, b)], names=["a", "b"])


def _in_buckets(posts: DataFrame, radius: int) -> DataFrame:
    """Links within buckets of a bounded size: (table, key, fp) in order, many buckets at once."""
    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def compare(rows):
            t, key, fp = rows
            cut = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
            several = ends - starts > 1
            starts, ends = starts[several], ends[several]
            if len(starts):
                return _sent(*links(fp, starts, ends, starts, ends, radius))
            return _sent(fp[:0], fp[:0])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)))
            if sum(len(h[0]) for h in held) < AT_ONCE:
                continue
            rows = tuple(np.concatenate(c) for c in zip(*held))
            change = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            full = int(change[-1]) + 1 if len(change) else 0    # the last bucket may go on in the next batch
            held = [tuple(c[full:] for c in rows)]
            if full:
                yield compare(tuple(c[:full] for c in rows))
        if held:
            rows = tuple(np.concatenate(c) for c in zip(*held))
            if len(rows[0]):
                yield compare(rows)

    dealt = posts.repartition(shuffle_partitions(posts.sparkSession), "t", "key").sortWithinPartitions("t", "key")
    return dealt.select("t", "key", "fp").mapInArrow(run, _LINKS)


def _in_pieces(posts: DataFrame, radius: int) -> DataFrame:
    """Links within large buckets, (t, key, fp, pieces): every two pieces are a row, dealt by the pair."""
    piece = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    packed = posts.groupBy("t", "key", "pieces", piece.alias("piece")).agg(F.collect_list("fp").alias("fps"))
    beside = packed.withColumn("with", F.explode(F.sequence(F.lit(0), (F.col("pieces") - 1).cast("int"))))
    pairs = (beside.groupBy("t", "key", F.least("piece", "with").alias("lo"), F.greatest("piece", "with").alias("hi"))
             .agg(F.sort_array(F.collect_list(F.struct("piece", "fps"))).alias("both")))

    def run(batches):
        for batch in batches:
            for both in batch.column(0):
                parts = [np.array(p["fps"], np.int64).view(np.uint64) for p in both.as_py()]
                fps = np.concatenate(parts)
                n, first = len(fps), len(parts[0]) if len(parts) > 1 else 0
                yield _sent(*links(fps, np.array([first]), np.array([n]), np.array([0]), np.array([first or n]), radius))

    return pairs.select("both").mapInArrow(run, _LINKS)


def near_links(fps: DataFrame, radius: int = RADIUS, holds: int = HOLDS) -> DataFrame:
    """(fp), distinct -> (a, b): links that join the same fingerprints as all links do."""
    spark = fps.sparkSession
    on_workers(spark)
    tables = masks(fps.count(), radius, holds)
    keys = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(tables)])
    posts = fps.select("fp", F.inline(keys))
    large = posts.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > holds)
    large = staged(large.select("t", "key", F.ceil(F.col("n") / holds).alias("pieces")), "large-buckets")
    small = _in_buckets(posts.join(large, ["t", "key"], "left_anti"), radius)
    return small.unionByName(_in_pieces(posts.join(large, ["t", "key"]), radius)).distinct()


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Components back on the documents; the few fingerprints with over a thousandth of all rows by broadcast."""
    classes = (rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("count"))
               .join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("part", F.coalesce("component", "fp")))
    named = classes.groupBy("part").agg(F.min("first").alias("component_id"))
    named = staged(classes.join(named, "part").select("fp", "count", "component_id"), "named")
    big = F.col("count") * 1000 > rows.count()
    hot = F.broadcast(named.where(big).select("fp", "component_id"))       # fewer than 1000 rows
    cold = rows.join(hot, "fp", "left_anti").join(named.where(~big).select("fp", "component_id"), "fp")
    return cold.unionByName(rows.join(hot, "fp"))


def hexed(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS,
                    holds: int = HOLDS) -> DataFrame:
    """One row per document: id, fingerprint (hex), component_id."""
    rows = staged(fingerprints(docs, id_col, text_col, words), "simhash")
    found = components(near_links(rows.select("fp").distinct(), radius, holds))
    return _named(rows, found).select(F.col("id").alias(id_col), hexed(F.col("fp")).alias("fingerprint"), "component_id")


def op11_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
