"""Document fingerprints by consistent weighted sampling.

A text is a set of weighted terms: its words, each weighted by how often it
occurs times the length it has in bytes (a cheap stand-in for rarity, so that
function words don't make unrelated texts alike).  For term k and sample j,
with r and c drawn from Gamma(2, 1) and b from (0, 1), all fixed by (k, j):

    t = floor(ln weight / r + b),   y = exp(r (t - b)),   a = c / (y exp r)

The sample is the (k, t) of least a, and two texts agree in a sample with the
probability of their generalised Jaccard similarity, sum of minima over sum of
maxima.  ``a`` depends on (k, t) alone, so its bits stand for the pair.  The
draws are quantiles picked by bits of a hash of (k, j).  A fingerprint is
SAMPLES times four hexadecimal digits; likeness is the share of equal samples.

Cases: null and empty texts have no terms; their fingerprint is all zero
digits, equal to each other and (but for chance) unlike any other; rows that
repeat an id are separate rows, in the order of their texts; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import on_workers, shuffle_partitions, table, text_or_empty, with_computed
from riskloom.llm.textops import mix64, row_words, stretches

SAMPLES = 128
#: Rows of term samples that a worker keeps, terms of a stretch handled together, and sampled or compared at once.
CACHED, BLOCK, AT_ONCE = 1 << 16, 1 << 16, 1 << 13
_STEPS = 1 << 16
_EMPTY = np.float32(np.inf)


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution is 1 - (1 + x) exp(-x), by bisection."""
    goal = (np.arange(_STEPS) + 0.5) / _STEPS
    low, high = np.zeros(_STEPS), np.full(_STEPS, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < goal
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return (low + high) / 2


class Sampler:
    """ln a of terms, SAMPLES to a row; rows of common terms are kept."""

    def __init__(self, samples: int = SAMPLES):
        gamma = _gamma_quantiles()
        self.r, self.ln_c = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        self.seeds = mix64(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.samples = samples
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.rows = np.empty((CACHED, samples), np.float32)

    def draw(self, terms: np.ndarray, ln_weight: np.ndarray) -> np.ndarray:
        out = np.empty((len(terms), self.samples), np.float32)
        for lo in range(0, len(terms), AT_ONCE):
            bits = mix64(terms[lo:lo + AT_ONCE, None] ^ self.seeds[None, :])
            bits = bits.view(np.uint16).reshape(*bits.shape, 4)      # three draws of 16 bits
            r, ln_c = self.r.take(bits[..., 0]), self.ln_c.take(bits[..., 1])
            b = (bits[..., 2].astype(np.float32) + np.float32(0.5)) / np.float32(_STEPS)
            t = np.floor(ln_weight[lo:lo + AT_ONCE, None].astype(np.float32) / r + b)
            out[lo:lo + AT_ONCE] = ln_c - r * (t - b) - r
        return out

    def of(self, terms: np.ndarray, weight: np.ndarray, uses: np.ndarray) -> np.ndarray:
        """Rows for distinct (term, weight); ``uses`` says how many texts share each."""
        keys = mix64(terms + weight.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        out = np.empty((len(keys), self.samples), np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out[known] = self.rows[self.places[at[known]]]
        new = np.flatnonzero(~known)
        out[new] = self.draw(terms[new], np.log(weight[new]))
        keep = new[uses[new] > 1][:CACHED - len(self.keys)]
        if len(keep):
            places = np.arange(len(self.keys), len(self.keys) + len(keep))
            self.rows[places] = out[keep]
            self.keys, self.places = np.concatenate((self.keys, keys[keep])), np.concatenate((self.places, places))
            order = np.argsort(self.keys)
            self.keys, self.places = self.keys[order], self.places[order]
        return out

    def _distinct(self, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(samples of the distinct pairs of term and weight, place of each pair in them)."""
        pick = np.lexsort((weight, term))
        t, w = term[pick], weight[pick]
        lead = np.concatenate(([True], (t[1:] != t[:-1]) | (w[1:] != w[:-1])))
        place = np.empty(len(pick), np.int64)
        place[pick] = np.cumsum(lead) - 1
        uses = np.diff(np.append(np.flatnonzero(lead), len(lead)))
        return self.of(t[lead], w[lead], uses), place

    def fingerprints(self, texts: list[bytes]) -> np.ndarray:
        """(texts, SAMPLES) float32; infinity where a text has no terms."""
        off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        out = np.full((len(texts), self.samples), _EMPTY)
        for lo, hi in stretches(off):
            hashes, size, per_row = row_words(raw, off, lo, hi)
            if not len(hashes):
                continue
            row = np.repeat(np.arange(lo, hi), per_row)
            order = np.lexsort((hashes, row))
            row, term, size = row[order], hashes[order], size[order]
            first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (term[1:] != term[:-1]))))
            count = np.diff(np.append(first, len(row)))
            row, term, weight = row[first], term[first], count * size[first]
            for at in range(0, len(row), BLOCK):
                part = slice(at, at + BLOCK)
                samples, place = self._distinct(term[part], weight[part])
                starts = np.flatnonzero(np.concatenate(([True], row[part][1:] != row[part][:-1])))
                for a, b in zip(starts, np.append(starts[1:], len(place))):
                    for k in range(a, b, AT_ONCE):
                        own = out[row[at + a]]
                        np.minimum(own, samples.take(place[k:min(k + AT_ONCE, b)], axis=0).min(axis=0), out=own)
        return out


def digits(samples: np.ndarray) -> np.ndarray:
    """Samples as 16-bit numbers: (texts, SAMPLES) big-endian, 0 for no terms only."""
    bits = mix64(samples.view(np.uint32).astype(np.uint64))
    short = (bits >> np.uint64(48)).astype(np.uint32)
    return np.where(np.isinf(samples), 0, np.maximum(short, 1)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


_samplers: dict[int, Sampler] = {}


def sampler(samples: int = SAMPLES) -> Sampler:
    return _samplers.setdefault(samples, Sampler(samples))


def fingerprint(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``df`` with its texts' fingerprints."""
    column = df.columns.index(text_col)

    def compute():
        def step(part):
            texts = [t or b"" for t in part.column(column).cast(pa.binary()).to_pylist()]
            return [pa.array([r.tobytes().hex() for r in digits(sampler().fingerprints(texts))], pa.string())]
        return step

    return with_computed(df, [(out_col, "string")], compute)


def edited_text(text: str, following: str) -> str:
    """``text`` with its last third (code points, rounded down) replaced by as many of the next text's first."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, text) by falling doc_id in stretches: part, guest, doc_id, text.

    A part is a range of ids between approximate quantiles, so rows and their
    successors share a part; the row that follows a part's last one is added to
    it as a guest.  Only a row per part and the quantiles pass the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    parts = 4 * shuffle_partitions(spark)
    cuts = rows.where("doc_id is not null").approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.1 / parts)
    cuts = sorted({int(c) for c in cuts})
    if cuts:
        above = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c >= F.col("doc_id")))
        part = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(above)
    else:
        part = F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    heads = sorted((r["part"], r["top"]) for r in rows.groupBy(part.alias("part")).agg(F.max("doc_id").alias("top")).collect())
    if not heads:
        return rows.select(F.lit(0).alias("part"), F.lit(False).alias("guest"), "doc_id", "text")
    # the head of each part follows the last row of the part before it, the first head the last part's
    goes = {top: heads[k - 1][0] for k, (_, top) in enumerate(heads)}
    known = {k: v for k, v in goes.items() if k is not None}
    pairs = [x for k, v in known.items() for x in (F.lit(k).cast("long"), F.lit(v))]
    to = F.create_map(*pairs)[F.col("doc_id")] if pairs else F.lit(None).cast("int")
    if None in goes:
        to = F.when(F.col("doc_id").isNull(), goes[None]).otherwise(to)
    rows = rows.withColumn("part", part).withColumn("to", to)
    spread = F.explode(F.when(F.col("to").isNull(), F.array(F.struct(F.col("part"), F.lit(False).alias("guest"))))
                       .otherwise(F.array(F.struct(F.col("part"), F.lit(False).alias("guest")),
                                          F.struct(F.col("to").alias("part"), F.lit(True).alias("guest")))))
    rows = rows.select(spread.alias("at"), "doc_id", "text").select("at.part", "at.guest", "doc_id", "text")
    return (rows.repartition(shuffle_partitions(spark), "part")
            .sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "text"))


#: Documents fingerprinted together, and the characters they may hold before they are.
TOGETHER, CHARACTERS = 256, 1 << 21


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness, as the query returns them."""
    on_workers(docs.sparkSession)
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [f.split()[0] for f in schema.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        """rows: (doc_id, text, next text), in order; a next text may be the next row's own."""
        edits = [edited_text(text, following).encode() for _, text, following in rows]
        texts = [text.encode() for _, text, _ in rows]
        follow = [k + 1 if k + 1 < len(rows) and rows[k + 1][1] is rows[k][2] else -1 for k in range(len(rows))]
        alone = [k for k, f in enumerate(follow) if f < 0]
        n = len(rows)
        # a text beside its edit: they share most terms
        found = digits(sampler().fingerprints([t for pair in zip(texts, edits) for t in pair] + [rows[k][2].encode() for k in alone]))
        own, edited = found[:2 * n:2], found[1:2 * n:2]
        after = np.concatenate((own, found[2 * n:]))
        follow = np.array(follow)
        follow[alone] = n + np.arange(len(alone))
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edits]), pa.array([f.tobytes().hex() for f in own]),
            pa.array([f.tobytes().hex() for f in edited]), pa.array(likeness(own, edited)),
            pa.array(likeness(own, after[follow]))], names=names)

    def run(batches):
        held, size, last = [], 0, None        # last: (part, doc_id, text), whose next row hasn't come yet

        def pairs():
            nonlocal last
            for batch in batches:
                for part, guest, doc_id, text in zip(*(batch.column(k) for k in range(4))):
                    part, guest, text = part.as_py(), guest.as_py(), text.as_py()
                    if last is not None and last[0] == part:
                        yield last[1], last[2], text
                    last = None if guest else (part, doc_id.as_py(), text)

        for row in pairs():
            held.append(row)
            size += len(row[1])
            if len(held) >= TOGETHER or size >= CHARACTERS:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    return neighbours(docs).mapInArrow(run, schema)


def op1_weighted_fingerprints(spark, sf_dir):
    return compare_with_edit(table(spark, sf_dir, "documents"))
