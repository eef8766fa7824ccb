"""Merkle manifest of a dataset, folded from SHA-256 midstates.

Every row is a leaf: the SHA-256 of its columns, each ``-`` if null, else its
number of UTF-8 bytes, ``:`` and the value.  The leaves of a source, by rising
id, are hashed in runs of FAN, the hashes again, until one is left (the
subroot); the subroots, by source, make the root in the same way.  A digest
enters its parent as 64 hex digits, which is one block of SHA-256.  So the hash state before any child slot is 8 words: a
parent row keeps one copied state for each of its slots.  To fold a leaf that
was replaced, the state before its slot is resumed with the new digest and the
siblings right of it; those left of it are not hashed again.

The tree is a table for each level, keyed by group and place, so any two levels
meet in a join in which a key has at most FAN rows:

* places come from a range partitioning by (group, order): the place in the
  partition and the partitions' own counts, no window over a source;
* building goes up, level by level, each staged in the shared checkpoint folder;
* paths go down: a node adds its slot's state and its siblings to its parent's
  path, so a leaf's path is read once for the run of FAN leaves that share it.

What the driver sees: the length of the longest source, and the root.

Cases: a null in a column is ``-``, an empty text ``0:``; null ids come first,
rows of one id are ordered by their leaf, equal rows are equal leaves beside
each other; a null source is a source of its own, before all others; a source
of one row has its leaf as subroot, one source alone its subroot as root; an
empty table gives an empty result; other columns don't enter the leaf.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import on_workers, shuffle_partitions, staged, table

#: Children of a node.
FAN = 16
#: The columns of a leaf.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaf runs folded at once.
RUNS = 256
_MASK = (1 << 33) - 1


# --- SHA-256 over many messages at once, from any block on ---------------------------------------------------------------

def _fraction(n: int, root: int) -> int:
    """The first 32 bits of the fraction of the root-th root of n."""
    shifted, low, high = n << 32 * root, 0, n << 32
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid ** root <= shifted else (low, mid - 1)
    return low & 0xFFFFFFFF


_PRIMES = [n for n in range(2, 312) if all(n % k for k in range(2, n))]
_FIRST = np.array([_fraction(p, 2) for p in _PRIMES[:8]], np.uint32)
_ROUND = [np.uint32(_fraction(p, 3)) for p in _PRIMES]


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """One SHA-256 step: states (8, n) after the blocks (16, n), 32-bit words."""
    w = list(block)
    for k in range(16, 64):
        x, y = w[k - 15], w[k - 2]
        w.append(w[k - 16] + w[k - 7] + (_turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3)))
                 + (_turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10))))
    a, b, c, d, e, f, g, h = state
    for k in range(64):
        t = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (g ^ (e & (f ^ g))) + (w[k] + _ROUND[k])
        u = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


_HEX = np.frombuffer(b"".join(b"%02x" % k for k in range(256)), np.uint8).reshape(256, 2)


def words_of(digests: bytes | np.ndarray) -> np.ndarray:
    """Digests of 32 bytes each -> (8, n) words."""
    return np.frombuffer(digests, ">u4").reshape(-1, 8).T.astype(np.uint32)


def bytes_of(words: np.ndarray) -> np.ndarray:
    """(8, n) words -> (n, 32) bytes."""
    return np.ascontiguousarray(words.T.astype(">u4")).view(np.uint8).reshape(-1, 32)


def hex_block(words: np.ndarray) -> np.ndarray:
    """The block (16, n) that the hex digits of digests (8, n) make."""
    return np.ascontiguousarray(_HEX[bytes_of(words)].reshape(-1, 64)).view(">u4").T.astype(np.uint32)


def finished(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (8, n) of messages whose whole blocks, ``blocks`` of them each, led to the states."""
    last = np.zeros((16, state.shape[1]), np.uint32)
    last[0] = 1 << 31
    bits = blocks.astype(np.uint64) * np.uint64(512)
    last[14], last[15] = (bits >> np.uint64(32)).astype(np.uint32), bits.astype(np.uint32)
    return compress(state, last)


def absorb(state: np.ndarray, digests: Sequence[np.ndarray | None], n: int) -> np.ndarray:
    """States after the digests in turn; ``digests`` has (lanes, (8, lanes) words) for each turn."""
    for lanes, words in digests:
        if len(lanes) == n:
            state = compress(state, hex_block(words))
        elif len(lanes):
            state[:, lanes] = compress(state[:, lanes], hex_block(words))
    return state


def _padded(pieces: list[bytes], longest: int) -> np.ndarray:
    """Runs of digests -> (n, longest, 8) words, zeros behind the shorter ones."""
    return np.frombuffer(b"".join(p.ljust(32 * longest, b"\0") for p in pieces), ">u4").reshape(len(pieces), longest, 8)


def _sizes(pieces: list[bytes]) -> np.ndarray:
    return np.array([len(p) // 32 for p in pieces], np.int64)


def parents_of(kids: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Digests (n, 32) of nodes with these children, and the states before every slot (32 bytes each, in turn)."""
    n, size = len(kids), _sizes(kids)
    state, kept = np.repeat(_FIRST[:, None], n, 1), np.zeros((n, FAN, 32), np.uint8)
    words = _padded(kids, FAN)
    for k in range(FAN):
        lanes = np.flatnonzero(size > k)
        kept[lanes, k] = bytes_of(state[:, lanes])
        state = absorb(state, [(lanes, words[lanes, k].T.astype(np.uint32))], n)
    return bytes_of(finished(state, size)), [kept[i, :size[i]].tobytes() for i in range(n)]


def resume(states: list[bytes], new: np.ndarray, right: list[bytes], size: np.ndarray) -> np.ndarray:
    """Digests (8, n) of parents of ``size`` slots: the states before a slot, the new digests (8, n) in it, the siblings right of it."""
    n, more = len(states), _sizes(right)
    longest = int(more.max(initial=0))
    words = _padded(right, longest) if longest else None
    turns = [(np.arange(n), new)]
    for k in range(longest):
        lanes = np.flatnonzero(more > k)
        turns.append((lanes, words[lanes, k].T.astype(np.uint32)))
    return finished(absorb(words_of(b"".join(states)), turns, n), size)


# --- the tree --------------------------------------------------------------------------------------------------------

def field(c: Column) -> Column:
    """A column's part of a leaf."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf(**replaced: Column) -> Column:
    """The leaf's hash, hex; columns may be replaced."""
    return F.sha2(F.concat(*[field(replaced.get(c, F.col(c))) for c in FIELDS]), 256)


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with a column grp) and place, their number in grp by ``order`` from 0, and size, the rows of grp.

    The rows are dealt by ranges of (grp, order), so a range's rows are in
    turn; a partition's rows of a group begin where those of the partitions before end."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(shuffle_partitions(spark), "grp", *order).sortWithinPartitions("grp", *order)
    dealt = staged(dealt.withColumn("at", F.monotonically_increasing_id()), name)
    # one row for each partition and each group in it
    parts = dealt.groupBy("grp", F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("grp")
    before = F.sum("n").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("grp", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(of).alias("size"))
    found = dealt.withColumn("part", F.shiftright("at", 33)).join(parts, ["grp", "part"])
    return found.select(*rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("place"), "size")


def _level_up(nodes: DataFrame) -> DataFrame:
    """(grp, place, size, digest) -> the parents: grp, place, size, kids (their digests), digest, states."""
    kids = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda x: F.hex(x["digest"])), "")
    rows = (nodes.groupBy("grp", F.expr(f"place div {FAN}").alias("place"))
            .agg(F.expr(f"(max(size) + {FAN - 1}) div {FAN}").alias("size"), F.unhex(kids).alias("kids")))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 12):
                part = batch.slice(at, 1 << 12)
                digests, states = parents_of(part.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays(part.columns + [pa.array([d.tobytes() for d in digests], pa.binary()), pa.array(states, pa.binary())],
                                                 names=["grp", "place", "size", "kids", "digest", "states"])

    on_workers(nodes.sparkSession)
    return rows.mapInArrow(run, "grp string, place long, size long, kids binary, digest binary, states binary")


def build(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The levels above (grp, place, size, digest), each a table, up to one node a group."""
    longest = leaves.agg(F.max("size")).first()[0] or 0
    levels, now = [], leaves
    while longest > 1:
        now = staged(_level_up(now.where("size > 1").select("grp", "place", "size", "digest")), f"{name}-{len(levels) + 1}")
        levels.append(now)
        longest = -(-longest // FAN)
    return levels


def tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(grp, digest): each group's last node."""
    last = [x.where("size = 1").select("grp", "digest") for x in [leaves, *levels]]
    for more in last[1:]:
        last[0] = last[0].unionByName(more)
    return last[0]


_STEP = "struct<state:binary,left:binary,right:binary>"


def _step(place: Column) -> Column:
    """What a parent (kids, states) gives the child in a slot: the state before it and its siblings."""
    slot = (place % FAN).cast("int")
    here = 32 * slot
    return F.array(F.struct(F.substring(F.col("states"), here + 1, F.lit(32)).alias("state"), F.substring(F.col("kids"), F.lit(1), here).alias("left"),
                            F.substring(F.col("kids"), here + 33, F.lit(32 * FAN)).alias("right")))


def paths(levels: list[DataFrame], above: DataFrame, keep: Sequence[str] = ()) -> list[DataFrame]:
    """For each level its nodes (grp, place, kids, states, path, ...): the steps
    from a node's parent up; ``above`` (grp, path, ...) is what a group's last node has."""
    out: list[DataFrame] = []
    for level in reversed(levels):
        nodes = level.select("grp", "place", "size", "kids", "states")
        found = nodes.where("size = 1").join(above, "grp")
        if out:
            up = out[-1].select("grp", F.col("place").alias("up"), F.struct("kids", "states", "path", *keep).alias("parent"))
            below = nodes.where("size > 1").withColumn("up", F.expr(f"place div {FAN}")).join(up, ["grp", "up"])
            step = (below.withColumnsRenamed({"kids": "own_kids", "states": "own_states"})
                    .select("grp", "place", "size", "own_kids", "own_states", "parent.*"))
            step = step.select("grp", "place", "size", F.col("own_kids").alias("kids"), F.col("own_states").alias("states"),
                               F.concat(_step(F.col("place")), F.col("path")).alias("path"), *keep)
            found = found.select("grp", "place", "size", "kids", "states", "path", *keep).unionByName(step)
        out.append(found.select("grp", "place", "size", "kids", "states", "path", *keep))
    return out[::-1]


def _fold_runs(size: list[int], new: list[list[bytes]], kids: list, states: list, path: list[list[dict]]) -> tuple[np.ndarray, list[str]]:
    """For runs of leaves: the roots (n, 32) that the new digests lead to, and the
    hashes of all siblings on the way.  A run without kids is a source's only leaf."""
    import hashlib
    run = np.repeat(np.arange(len(size)), size)
    slot = np.concatenate([np.arange(s) for s in size])
    now = words_of(b"".join(b for r in new for b in r)).copy()
    full = np.flatnonzero(np.array([k is not None for k in kids])[run])
    if len(full):
        pick = [(run[k], slot[k]) for k in full.tolist()]
        now[:, full] = resume([states[r][32 * s:32 * s + 32] for r, s in pick], now[:, full], [kids[r][32 * s + 32:] for r, s in pick],
                              np.array([size[r] for r, _ in pick]))
    # leaves of a run that have led to the same digest go up as one
    key = np.concatenate([run[:, None].astype(">u8").view(np.uint8).reshape(-1, 8), bytes_of(now)], 1)
    _, first, of = np.unique(np.ascontiguousarray(key).view("V40").ravel(), return_index=True, return_inverse=True)
    at, now = run[first], now[:, first]
    for turn in range(max(map(len, path))):
        lanes = np.flatnonzero(np.array([len(p) > turn for p in path])[at])
        steps = [path[r][turn] for r in at[lanes].tolist()]
        wide = _sizes([s["left"] for s in steps]) + _sizes([s["right"] for s in steps]) + 1
        now[:, lanes] = resume([s["state"] for s in steps], now[:, lanes], [s["right"] for s in steps], wide)
    proofs = []
    for r, s in enumerate(size):
        up = b"".join(p["left"] + p["right"] for p in path[r]).hex().encode()
        for k in range(s):
            near = b"" if kids[r] is None else kids[r][:32 * k] + kids[r][32 * k + 32:]
            proofs.append(hashlib.sha256(near.hex().encode() + up).hexdigest())
    return bytes_of(now)[of], proofs


def folded(runs: DataFrame, root: str) -> DataFrame:
    """(leaves: array of (place, id, digest, new), kids, states, path, subroot) -> a row for each leaf."""
    on_workers(runs.sparkSession)
    schema = ("id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, RUNS):
                leaves, kids, states, path, top = (c.to_pylist() for c in batch.slice(at, RUNS).columns)
                flat = [x for r in leaves for x in r]
                roots, proofs = _fold_runs([len(r) for r in leaves], [[x["new"] for x in r] for r in leaves], kids, states, path)
                ends = [bytes(r).hex() for r in roots]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["id"] for x in flat], pa.int64()), pa.array([x["digest"].hex() for x in flat]),
                     pa.array([t.hex() for t, r in zip(top, leaves) for _ in r]), pa.array([root] * len(flat)), pa.array(proofs), pa.array(ends),
                     pa.array([e == root for e in ends])], names=names)

    return runs.select("leaves", "kids", "states", "path", "subroot").mapInArrow(run, schema)


def manifest(docs: DataFrame, replaced: Column | None = None, text: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, proof_sha256 (its
    siblings on the way up), folded_root and verified.  Where ``replaced`` is
    true, the fold starts with the leaf that has ``text`` for its text, elsewhere with the row's own."""
    replaced = F.lit(False) if replaced is None else replaced
    group = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit(""))       # null first, then by UTF-8 bytes
    own = F.unhex(leaf())
    new = own if text is None else F.when(replaced, F.unhex(leaf(text=text))).otherwise(own)
    leaves = staged(docs.select(group.alias("grp"), F.col(id_col).cast("long").alias("id"), own.alias("digest"), new.alias("new")), "leaves")
    leaves = staged(placed(leaves, ["id", "digest"], "leaves-dealt"), "leaves-placed")
    levels = build(leaves, "level")

    sources = tops(leaves, levels).select(F.lit("").alias("grp"), F.col("grp").alias("source"), "digest")
    sources = staged(placed(sources, ["source"], "sources-dealt"), "sources")
    upper = build(sources, "upper")
    last = tops(sources, upper).first()
    root = bytes(last["digest"]).hex() if last else ""
    none = F.array().cast(f"array<{_STEP}>")
    if upper:
        top = paths(upper, upper[-1].where("size = 1").select("grp", none.alias("path")))[0]
        parents = top.select(F.col("place").alias("up"), "kids", "states", "path")
        above = (sources.withColumn("up", F.expr(f"place div {FAN}")).join(parents, "up")
                 .select(F.col("source").alias("grp"), F.concat(_step(F.col("place")), F.col("path")).alias("path"), F.col("digest").alias("subroot")))
    else:
        above = sources.select(F.col("source").alias("grp"), none.alias("path"), F.col("digest").alias("subroot"))
    above = staged(above, "source-paths")

    run = F.expr(f"place div {FAN}")
    runs = (leaves.groupBy("grp", run.alias("run"))
            .agg(F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("place", "id", "digest", "new"))).alias("leaves")))
    lone = runs.where("size = 1").join(above, "grp").withColumns({"kids": F.lit(None).cast("binary"), "states": F.lit(None).cast("binary")})
    columns = ["leaves", "kids", "states", "path", "subroot"]
    out = lone.select(columns)
    if levels:
        first = paths(levels, above, ["subroot"])[0].withColumnRenamed("place", "run").drop("size")
        out = out.unionByName(runs.where("size > 1").join(first, ["grp", "run"]).select(columns))
    return folded(out, root).withColumnRenamed("id", id_col)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    return manifest(docs, tampered, F.translate("text", UPPER, LOWER))


#: crc32 of a string of single-byte characters, bit by bit.
def crc32_sql(text: str) -> str:
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"[4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: {step}), 4294967295)"


def _leaf_sql(text: str = "text") -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in [*FIELDS[:-1], text]]
    return f"sha256({' || '.join(parts)})"


#: Levels that the SQL has for a source and for the sources: 16 ** 6 rows of one source.
_LEVELS = (6, 4)


def _levels_sql(letter: str, n: int) -> str:
    return "".join(f"""
{letter}{k + 1} AS MATERIALIZED (SELECT grp, p // {FAN} AS p, max((n + {FAN - 1}) // {FAN}) AS n, list(h ORDER BY p) AS kids,
  sha256(array_to_string(list(h ORDER BY p), '')) AS h FROM {letter}{k} WHERE n > 1 GROUP BY grp, p // {FAN}),""" for k in range(n))


def _fold_sql(letter: str, tree: str, n: int) -> str:
    left, right = f"t.kids[1:(f.p % {FAN})]", f"t.kids[(f.p % {FAN}) + 2:]"
    return "".join(f"""
{letter}{k + 1} AS (SELECT f.rid, f.grp, f.p // {FAN} AS p, CASE WHEN f.n > 1 THEN sha256(array_to_string({left} || [f.cur] || {right}, '')) ELSE f.cur END AS cur,
  CASE WHEN f.n > 1 THEN f.proof || array_to_string({left} || {right}, '') ELSE f.proof END AS proof, (f.n + {FAN - 1}) // {FAN} AS n
  FROM {letter}{k} f LEFT JOIN {tree}{k + 1} t ON f.n > 1 AND t.grp = f.grp AND t.p = f.p // {FAN}),""" for k in range(n))


def _tops_sql(letter: str, n: int) -> str:
    return " UNION ALL ".join(f"SELECT grp, h FROM {letter}{k} WHERE n = 1" for k in range(n + 1))


OP12_SQL = f"""
WITH hashed AS (SELECT doc_id, coalesce('+' || source, '') AS grp, {_leaf_sql()} AS h,
  CASE WHEN {crc32_sql("coalesce(doc_id::VARCHAR, '')")} % 5 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf_sql()} END AS new FROM documents),
s0 AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS p,
  count(*) OVER (PARTITION BY grp) AS n FROM hashed),{_levels_sql("s", _LEVELS[0])}
subs AS MATERIALIZED ({_tops_sql("s", _LEVELS[0])}),
u0 AS MATERIALIZED (SELECT '' AS grp, grp AS src, h, row_number() OVER (ORDER BY grp) - 1 AS p, count(*) OVER () AS n FROM subs),{_levels_sql("u", _LEVELS[1])}
top AS ({_tops_sql("u", _LEVELS[1])}),
f0 AS (SELECT rid, grp, p, new AS cur, '' AS proof, n FROM s0),{_fold_sql("f", "s", _LEVELS[0])}
g0 AS (SELECT f.rid, u.grp, u.p, f.cur, f.proof, u.n FROM f{_LEVELS[0]} f JOIN u0 u ON u.src = f.grp),{_fold_sql("g", "u", _LEVELS[1])}
ends AS (SELECT * FROM g{_LEVELS[1]})
SELECT s.doc_id, s.h AS leaf, subs.h AS subroot, top.h AS root, sha256(e.proof) AS proof_sha256, e.cur AS folded_root, e.cur = top.h AS verified
FROM s0 s JOIN subs ON subs.grp = s.grp JOIN ends e ON e.rid = s.rid, top
"""
