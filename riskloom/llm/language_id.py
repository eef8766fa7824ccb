"""Language identification by a string kernel.

The kernel of two texts is the blended-spectrum presence kernel: the number of
distinct byte n-grams (n = 1..ORDER, folded into SLOTS slots) that both hold,
normalised by the geometric mean of their own numbers.  Kernel ridge regression
in Nystroem form, one class against the rest, is fitted on a bounded sample
with a part of it as landmarks:

    (K_nm' K_nm + n * RIDGE * K_mm) a = K_nm' Y

Scoring is linear in the presence vectors, so landmarks and coefficients fold
into one weight matrix and a batch of texts is scored by one matrix product.

The sample is PER_LANGUAGE rows of each language, those of smallest id hash
(documented bound of the fit; everything else covers all rows and whole texts).

Cases: a null text or one without a letter gets ``und`` and score 0, and so
does every text if there is nothing to learn from; a single learned language
is predicted with the score its regression gives; rows repeating an id are
separate rows; an empty table gives an empty result; other columns pass
through ``predict``, and columns named like its results are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm.common import crc_mod, on_workers, table, with_computed
from riskloom.llm.textops import buffers

ORDER, SLOTS = 4, 1 << 15
PER_LANGUAGE, LANDMARKS, RIDGE, SHARPNESS = 400, 320, 1e-4, 4.0
#: Rows scored by one matrix product.
BATCH = 128
UNKNOWN = "und"
#: Bytes as the kernel sees them: A-Z lowered, other ASCII than letters is a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(128)]
_SPREAD = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - SLOTS.bit_length() + 1)


def _mark(data: np.ndarray, off: np.ndarray, present: np.ndarray) -> None:
    """present[k, s] = 1 if row k (bytes off[k]..off[k+1] of data) holds an n-gram of slot s."""
    data = _FOLD[data].astype(np.uint32)
    for n in range(1, ORDER + 1):
        if len(data) < n:
            break
        code = data[:len(data) - n + 1].copy()
        for k in range(1, n):
            code <<= np.uint32(8)
            code |= data[k:len(data) - n + 1 + k]
        slots = ((code + np.uint32(n)) * _SPREAD) >> _SHIFT
        for row in range(len(off) - 1):
            present[row, slots[off[row]:max(off[row], off[row + 1] - n + 1)]] = 1


#: Bytes of one text marked at a time.
_SPAN = 1 << 20


def presence(raw: np.ndarray, off: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """0/1 matrix (rows, SLOTS) of rows lo..hi."""
    out = np.zeros((hi - lo, SLOTS), np.float32)
    if off[hi] - off[lo] <= 2 * _SPAN:
        _mark(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], out)
    else:
        for row in range(lo, hi):
            for at in range(int(off[row]), int(off[row + 1]), _SPAN):
                piece = raw[at:min(at + _SPAN + ORDER - 1, int(off[row + 1]))]
                _mark(piece, np.array([0, len(piece)]), out[row - lo:row - lo + 1])
    return out


def has_letter(data: np.ndarray) -> bool:
    folded = _FOLD[data]
    if ((folded >= 97) & (folded <= 122)).any():
        return True
    return bool((data > 127).any()) and any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def fit(present: np.ndarray, labels: list[str]) -> dict:
    """Model from a 0/1 presence matrix (bytes will do) and its languages:
    languages in code point order, weights (SLOTS, languages)."""
    languages = sorted(set(labels))
    y = np.array([[1.0 if label == lang else -1.0 for lang in languages] for label in labels])
    each = max(1, LANDMARKS // len(languages))
    chosen = np.concatenate([np.flatnonzero(y[:, k] > 0)[:each] for k in range(len(languages))])

    def unit(rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(np.float32)
        rows /= np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1.0))
        return rows

    marks = unit(present[chosen])
    k_nm = np.concatenate([unit(present[k:k + BATCH]) @ marks.T for k in range(0, len(present), BATCH)]).astype(np.float64)
    k_mm = k_nm[chosen]
    a = k_nm.T @ k_nm + len(labels) * RIDGE * k_mm
    a[np.diag_indices_from(a)] += 1e-8 * max(1.0, np.trace(a) / len(a))
    return {"languages": languages, "weights": (marks.T @ np.linalg.solve(a, k_nm.T @ y)).astype(np.float32)}


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict | None:
    """Fit on a bounded sample of ``rows`` with a language; None if there is none."""
    spark = rows.sparkSession
    on_workers(spark)
    rows = rows.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                                           F.col(lang_col).alias("lang"))
    place = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    few = rows.select("id", "lang").withColumn("n", F.row_number().over(place)).where(F.col("n") <= PER_LANGUAGE)
    few = few.select("id", "lang").distinct()         # at most PER_LANGUAGE rows a language
    hit = rows["id"].eqNullSafe(few["id"]) & (rows["lang"] == few["lang"])
    picked = rows.join(F.broadcast(few), hit, "left_semi")
    again = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", F.xxhash64("text"))
    picked = picked.withColumn("n", F.row_number().over(again)).where(F.col("n") <= PER_LANGUAGE).select("lang", "n", "text")

    def packed(batches):
        for batch in batches:
            raw, off = buffers(batch.column(2))
            bits = [np.packbits(presence(raw, off, k, k + 1)[0].astype(bool)).tobytes() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())],
                                             names=["lang", "n", "bits"])

    found = picked.mapInArrow(packed, "lang string, n int, bits binary").orderBy("lang", "n").collect()
    if not found:
        return None
    present = np.unpackbits(np.frombuffer(b"".join(bytes(r["bits"]) for r in found), np.uint8)).reshape(len(found), -1)
    return fit(present, [r["lang"] for r in found])


def predict(df: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred (string) and score (double, 0 to 1)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    column = df.columns.index(text_col)

    def compute():
        model = shared.value

        def step(part):
            raw, off = buffers(part.column(column))
            pred, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            if model is not None:
                for lo in range(0, part.num_rows, BATCH):
                    hi = min(lo + BATCH, part.num_rows)
                    present = presence(raw, off, lo, hi)
                    out = (present @ model["weights"]) / np.sqrt(np.maximum(present.sum(1, keepdims=True), 1.0))
                    sure = np.exp(SHARPNESS * (out - out.max(1, keepdims=True)))
                    sure = sure.max(1) / sure.sum(1) if out.shape[1] > 1 else np.clip((out[:, 0] + 1) / 2, 0, 1)
                    best = out.argmax(1)
                    for k in range(hi - lo):
                        if has_letter(raw[off[lo + k]:off[lo + k + 1]]):
                            pred[lo + k], score[lo + k] = model["languages"][best[k]], float(sure[k])
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]

        return step

    return with_computed(df, [("lang_pred", "string"), ("score", "double")], compute)


#: Rows whose id's crc32 is 0 modulo this are held out of the learning.
HELD_OUT = 5


def learn(docs: DataFrame) -> dict | None:
    return train(docs.where(crc_mod("doc_id", HELD_OUT) != 0))


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return (predict(docs.select("doc_id", "text"), learn(docs)).drop("text")
            .select("doc_id", (crc_mod("doc_id", HELD_OUT) == 0).alias("held_out"), "lang_pred", "score"))


def keep_identified(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of ``least`` or
    more (``und`` goes), with the columns of ``docs``.  Where nothing can be learnt, the rows with a letter stay."""
    model = learn(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").alias("text"))
    found = predict(nested, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
