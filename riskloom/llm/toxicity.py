"""Toxicity by class-conditional Kneser-Ney models of the bytes of a text.

Each class (toxic, ordinary) has a model of a byte x after the n-1 bytes h
before it, from c(h, x), the number of the class's texts that hold the n-gram.
With discounts D of at most 1, from the counts of counts (n1 / (n1 + 2 n2)):

    P(x | h) = (max(c(h, x) - D, 0) + (K + D * types(h)) * P(x | h')) / (c(h) + K)

types(h) being the distinct bytes that the class has after h, and h' being h
without its first byte.  P(x | h') is the same of continuation counts (the
class's distinct bytes before a shorter n-gram), down to single bytes, which rest on the
Kneser-Ney counts of both classes together: what a class never showed is
judged by its shorter n-grams and, at last, by what both share.

A text's evidence is the log-likelihood ratio of the two models over all its
bytes, repeats counted, divided by their number.  A logistic curve in the
evidence (of short texts, drawn to the mean of all by LIGHT more bytes) is the
score.  n (ORDERS) and K (PRIORS) are those that best rank a fifth of the
learning rows after counting the other four; the curve is fitted on that fifth
too.  The rows held out take no part.

A-Z is lowered and other ASCII than letters and digits is one blank each; bytes
before a text's first are zero.  An n-gram is known by its bytes, not by a hash.
Counts and values are Spark tables that grow with the input, staged in the
shared checkpoint folder; each task combines what it counts.  The driver sees
counts of counts.  Scoring needs the values of one n: up to SHIPPED rows of
them go to the tasks, a larger table is joined to the texts' n-grams; values are
whole numbers of 1/UNIT, so both ways give the same evidence and reruns agree.
Counting covers every labelled row of its four fifths; choice and curve use at
most CALIBRATION rows of the fifth, those of smallest id hash.

Why bytes and not words: a text's word pairs are as large as the text, so joining
all of them to a model exceeds the disk allowed, while a table of byte n-grams
grows slowly; and rare words share evidence through their parts.

Cases: a null or empty text has evidence 0 and the score of the mean evidence; a
text counts as toxic if any of its label rows says so, null labels say nothing;
without rows of both classes every score is the share of toxic rows (0 if
there are none); without rows of both in the fifth, n and K are the first ones;
rows repeating an id are separate rows; an empty table gives an empty result;
other columns pass through ``score``, and columns named like its results are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import crc_mod, on_workers, release_memory, staged, table, with_computed
from riskloom.llm.textops import STRETCH, buffers, stretches

CALIBRATION = 20_000
#: Lengths of n-grams and weights of what a model rests on, to choose from; 5 bytes at most, an n-gram is packed with its row.
ORDERS = (3, 4, 5)
PRIORS = (1.0, 4.0, 16.0, 64.0)
#: Rows of a table of values that go to every task (16 bytes each and prior); a larger one is joined.
SHIPPED = 1 << 20
#: n-grams that a task holds before it sends them on.
HELD = 1 << 21
#: Values are summed in whole numbers of this part.
UNIT = 1 << 20
#: predicted = 1 from this score on.
THRESHOLD = 0.3
#: Bytes of mean evidence that a text is taken to hold besides its own.
LIGHT = 32
#: A key of a value: the bytes, above them the n-gram's length; CONTEXT marks the value of a context's rest.
LENGTH, CONTEXT = 48, 1 << 62
_ROW_BITS = 24
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(128)]


def grams(raw: np.ndarray, off: np.ndarray, lo: int, hi: int, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row from lo, n-gram) of every byte of rows lo..hi, the byte lowest; a long row comes in pieces."""
    for at in range(off[lo], max(off[hi], off[lo] + 1), STRETCH) if hi == lo + 1 else (off[lo],):
        end = min(at + STRETCH, off[hi]) if hi == lo + 1 else off[hi]
        begin = max(off[lo], at - order + 1)
        data = _FOLD[raw[begin:end]]
        row = np.repeat(np.arange(hi - lo), np.diff(off[lo:hi + 1].clip(begin, end)))
        code = np.zeros(len(data), np.uint64)
        for k in range(min(order, len(data))):
            code[k:] |= data[:len(data) - k].astype(np.uint64) << np.uint64(8 * k)
        place = np.minimum(np.arange(begin, end) - off[lo:hi][row], order - 1).astype(np.uint64)
        code &= (np.uint64(1) << (place + np.uint64(1)) * np.uint64(8)) - np.uint64(1)
        yield row[at - begin:], code[at - begin:]


def _text_counts(raw, off, lo, hi, order, toxic) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram, toxic texts, texts) of rows lo..hi."""
    each = [np.unique(code << np.uint64(_ROW_BITS) | row.astype(np.uint64)) for row, code in grams(raw, off, lo, hi, order)]
    each = each[0] if len(each) == 1 else np.unique(np.concatenate(each))
    code, row = each >> np.uint64(_ROW_BITS), (each & np.uint64((1 << _ROW_BITS) - 1)).astype(np.int64)
    return _combined(code, toxic[row].astype(np.int64), np.ones(len(code), np.int64))


def _combined(code, t, every):
    """Sums of t and every by code, ascending."""
    order = np.argsort(code, kind="stable")
    code, t, every = code[order], t[order], every[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    add = lambda x: np.add.reduceat(x, first) if len(first) else x
    return code[first], add(t), add(every)


def gram_counts(rows: DataFrame, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """(toxic, text) -> n, code, t, o: texts of each class (toxic, ordinary) that hold the n-gram of n bytes."""
    on_workers(rows.sparkSession)

    def run(batches):
        release_memory()
        held = {n: [] for n in orders}
        size = dict.fromkeys(orders, 0)                   # of the first part, which is combined

        def sent(n):
            code, t, every = held[n].pop()
            for at in range(0, len(code), 1 << 16):
                c, x, y = (a[at:at + (1 << 16)].astype(np.int64) for a in (code, t, every))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), n, np.int32)), pa.array(c), pa.array(x), pa.array(y - x)],
                                                 names=["n", "code", "t", "o"])

        def merge(n):
            held[n] = [_combined(*(np.concatenate(x) for x in zip(*held[n])))]
            size[n] = len(held[n][0][0])

        for batch in batches:
            toxic = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), bool)
            raw, off = buffers(batch.column(1))
            for lo, hi in stretches(off):
                for n in orders:
                    held[n].append(_text_counts(raw, off, lo, hi, n, toxic[lo:hi]))
                    if sum(len(x[0]) for x in held[n][1:]) > max(1 << 19, size[n]):
                        merge(n)
                        if size[n] > HELD:
                            yield from sent(n)
                            size[n] = 0
        for n in orders:
            if held[n]:
                merge(n)
                yield from sent(n)

    parts = rows.select(F.col("toxic").cast("boolean"), "text").mapInArrow(run, "n int, code long, t long, o long")
    return parts.groupBy("n", "code").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _discount(n1: int, n2: int) -> float:
    """n1 / (n1 + 2 n2); 0.75 where that is 0 or 1."""
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.75


def _by_order(values: dict[int, float]) -> Column:
    """The value of the row's n."""
    found = F.lit(0.0)
    for n, value in values.items():
        found = F.when(F.col("n") == n, F.lit(float(value))).otherwise(found)
    return found


def _last_bytes(less: int) -> Column:
    """The last n - less bytes of an n-gram."""
    return F.col("code").bitwiseAND(F.expr(f"shiftleft(1L, 8 * (n - {less})) - 1"))


def _kept(count: Column, discount: Column) -> Column:
    return F.greatest(count - discount, F.lit(0.0))


def continuations(counts: DataFrame, orders: tuple[int, ...]) -> list[DataFrame]:
    """[j] -> n, code, t, o, s of the last n - j bytes of the n-grams: texts of each class and of
    both for j = 0, then the distinct bytes before."""
    levels = [counts.select("n", "code", "t", "o", (F.col("t") + F.col("o")).alias("s"))]
    for j in range(1, max(orders)):
        longer = levels[-1].where(F.col("n") > j).withColumn("code", _last_bytes(j))
        levels.append(staged(longer.groupBy("n", "code").agg(
            F.count_if(F.col("t") > 0).alias("t"), F.count_if(F.col("o") > 0).alias("o"), F.count(F.lit(1)).alias("s")), "continuations"))
    return levels


def _discounts(levels: list[DataFrame]) -> list[dict[str, Column]]:
    """[j] -> the discounts of t, o and s by n."""
    marked = [x.withColumn("j", F.lit(j)) for j, x in enumerate(levels)]
    every = marked[0]
    for x in marked[1:]:
        every = every.unionByName(x)
    found = every.groupBy("j", "n").agg(*[F.count_if(F.col(k) == i).alias(f"{k}{i}") for k in "tos" for i in (1, 2)]).collect()
    return [{k: _by_order({r.n: _discount(r[f"{k}1"], r[f"{k}2"]) for r in found if r.j == j}) for k in "tos"} for j in range(len(levels))]


def fit_models(rows: DataFrame, orders: tuple[int, ...] = ORDERS, priors: tuple[float, ...] = PRIORS) -> DataFrame | None:
    """n, key, v0, v1, ...: for each n and each prior the log ratio of the models, in 1/UNIT, for the n-grams and
    shorter ones and, under CONTEXT, for the share that a context leaves to them; None if a class has no text."""
    counts = staged(gram_counts(rows, orders), "grams")
    whole = counts.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    if not whole["t"] or not whole["o"]:
        return None
    levels = continuations(counts, orders)
    below, values = None, None
    for j, discount in reversed(list(enumerate(_discounts(levels)))):
        h, length = F.shiftright("code", 8).alias("h"), F.shiftleft((F.col("n") - j).cast("long"), LENGTH)
        after = levels[j].groupBy("n", h).agg(*[f(F.col(k)).alias(name + k) for k in "tos" for name, f in (
            ("all_", F.sum), ("types_", lambda c: F.count_if(c > 0)))])
        left = {(k, i): (F.lit(prior) + discount[k] * F.col(f"types_{k}")) / (F.col(f"all_{k}") + prior) for i, prior in enumerate(priors) for k in "to"}
        seen = levels[j].withColumn("h", h).join(after, ["n", "h"])
        base = (_kept(F.col("s"), discount["s"]) + discount["s"] * F.col("types_s") / 256) / F.col("all_s")
        lower = {at: base for at in left}
        if below is not None:                            # single bytes have nothing below
            seen = seen.withColumn("low", _last_bytes(j + 1)).join(below.withColumnRenamed("code", "low"), ["n", "low"], "left")
            lower = {(k, i): F.coalesce(F.col(f"q{k}{i}"), base) for k, i in left}
        chance = {(k, i): _kept(F.col(k), discount[k]) / (F.col(f"all_{k}") + priors[i]) + left[k, i] * lower[k, i] for k, i in left}
        seen = seen.select("n", "code", *[c.alias(f"p{k}{i}") for (k, i), c in chance.items()])
        below = seen.select("n", "code", *[F.col(f"p{k}{i}").alias(f"q{k}{i}") for k, i in left])
        ratios = lambda t, o: [F.round(F.log(t(i) / o(i)) * UNIT).cast("long").alias(f"v{i}") for i in range(len(priors))]
        own = seen.select("n", (F.col("code") + length).alias("key"), *ratios(lambda i: F.col(f"pt{i}"), lambda i: F.col(f"po{i}")))
        rest = after.select("n", (F.col("h") + length + F.lit(CONTEXT)).alias("key"), *ratios(lambda i: left["t", i], lambda i: left["o", i]))
        both = own.unionByName(rest)
        values = both if values is None else values.unionByName(both)
    return staged(values, "values")


def one_model(values: DataFrame, order: int, columns: list[str]) -> dict:
    """The values of one order, ready for ``evidence``: as arrays if they are few."""
    rows = values.where(F.col("n") == order).select("key", *columns)
    model = {"order": order, "columns": columns, "rows": rows}
    if rows.limit(SHIPPED + 1).count() <= SHIPPED:
        found = rows.toArrow()
        key = found["key"].to_numpy()
        at = np.argsort(key)
        model["arrays"] = key[at], np.stack([found[c].to_numpy()[at] for c in columns])
    return model


def terms(rows: DataFrame, order: int) -> DataFrame:
    """(mark, text) -> mark, code, times: the n-grams of each text."""
    on_workers(rows.sparkSession)

    def run(batches):
        release_memory()
        for batch in batches:
            mark = batch.column(0).to_numpy(zero_copy_only=False)
            raw, off = buffers(batch.column(1))
            for lo, hi in stretches(off):
                for row, code in grams(raw, off, lo, hi, order):
                    each, times = np.unique(code | row.astype(np.uint64) << np.uint64(8 * order), return_counts=True)
                    row = (each >> np.uint64(8 * order)).astype(np.int64)
                    code = (each & np.uint64((1 << 8 * order) - 1)).astype(np.int64)
                    for at in range(0, len(each), 1 << 16):
                        some = slice(at, at + (1 << 16))
                        yield pa.RecordBatch.from_arrays([pa.array(mark[lo:hi][row[some]]), pa.array(code[some]), pa.array(times[some])],
                                                         names=["mark", "code", "times"])

    return rows.mapInArrow(run, "mark long, code long, times long")


def _looked_up(model: dict):
    """A function from a batch with the text first to the arrays of evidence and n_bytes."""
    order, (key, values) = model["order"], model["arrays"]

    def found(wanted):
        at = np.searchsorted(key, wanted)
        at[at == len(key)] = 0
        return at, key[at] == wanted

    def valued(code):
        """The values (a column each) of n-grams; of an unseen one, those of its context's rest and of its last bytes."""
        at, hit = found(code | order << LENGTH)
        out = np.where(hit, values[:, at], 0)
        miss = np.flatnonzero(~hit)
        for length in range(order, 0, -1):
            if not len(miss):
                break
            some = code[miss] & ((1 << 8 * length) - 1)
            if length < order:
                at, hit = found(some | length << LENGTH)
                out[:, miss] += np.where(hit, values[:, at], 0)
                miss, some = miss[~hit], some[~hit]
            at, hit = found(some >> 8 | length << LENGTH | CONTEXT)
            out[:, miss] += np.where(hit, values[:, at], 0)
        return out

    def step(column):
        raw, off = buffers(column)
        sums = np.zeros((len(values), len(column)), np.int64)
        for lo, hi in stretches(off):
            for row, code in grams(raw, off, lo, hi, order):
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                for k, value in enumerate(valued(code.view(np.int64))):
                    held = np.r_[0, np.cumsum(value)]
                    sums[k, lo:hi] += held[edge[1:]] - held[edge[:-1]]
        n = np.diff(off)
        return [pa.array(np.where(n > 0, s / UNIT / np.maximum(n, 1), 0.0)) for s in sums] + [pa.array(n)]

    return step


def evidence(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``df`` with n_bytes (long) and evidence (double), the log-likelihood ratio per byte; for a model of
    several columns, evidence_<column> for each."""
    names = ["evidence"] if len(model["columns"]) == 1 else [f"evidence_{c}" for c in model["columns"]]
    new = [(name, "double") for name in names] + [("n_bytes", "long")]
    if "arrays" in model:
        place = df.columns.index(text_col)
        light = {k: model[k] for k in ("order", "arrays")}

        def compute():
            step = _looked_up(light)
            return lambda batch: step(batch.column(place))

        return with_computed(df, new, compute)
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in dict(new)])
    # rows alike in every column share a mark, and their sums hold each of them
    marked = df.withColumn("__mark", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    once = marked.dropDuplicates(["__mark"]).select("__mark", text_col)
    each, total = terms(once, model["order"]), {c: F.lit(0) for c in model["columns"]}
    for length in range(1, model["order"] + 1):          # an unseen n-gram's value: its context's rest and its last bytes' value
        code = F.col("code").bitwiseAND((1 << 8 * length) - 1)
        for name, key in (("own", code + (length << LENGTH)), ("rest", F.shiftright(code, 8) + (length << LENGTH | CONTEXT))):
            some = model["rows"].where(F.shiftrightunsigned("key", LENGTH) == (length << LENGTH | (CONTEXT if name == "rest" else 0)) >> LENGTH)
            some = some.select(F.col("key").alias("__key"), *[F.col(c).alias(f"{name}{length}_{c}") for c in model["columns"]])
            each = each.withColumn("__key", key).join(some, "__key", "left").drop("__key")
        total = {c: F.coalesce(f"own{length}_{c}", F.coalesce(f"rest{length}_{c}", F.lit(0)) + total[c]) for c in total}
    sums = each.groupBy(F.col("mark").alias("__mark")).agg(
        F.sum("times").alias("__n"), *[F.sum(F.col("times") * total[c]).alias(f"__{c}") for c in model["columns"]])
    out = marked.join(sums, "__mark", "left")
    n = F.coalesce("__n", F.lit(0))
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[F.when(n > 0, F.col(f"__{c}") / UNIT / n).otherwise(0.0).alias(name) for c, name in zip(model["columns"], names)],
                      n.alias("n_bytes"))


def rank_quality(x: np.ndarray, y: np.ndarray) -> float:
    """Probability that a toxic row is above an ordinary one, ties half."""
    _, at, size = np.unique(x, return_inverse=True, return_counts=True)
    place = (np.cumsum(size) - (size - 1) / 2)[at]
    a, b = int(y.sum()), int((1 - y).sum())
    return (float(place[y == 1].sum()) - a * (a + 1) / 2) / (a * b)


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """(mean, a, b) of 1 / (1 + exp(-(a + b * (x - mean)))), b at least 0, by Newton steps with a light ridge."""
    mean, scale = float(x.mean()), float(x.std()) or 1.0
    z = np.stack([np.ones_like(x), (x - mean) / scale], 1)
    t = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ t, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (y - p) - 1e-3 * t)
        t += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return mean, float(t[0]), max(0.0, float(t[1])) / scale


def labelled(docs: DataFrame, labels: DataFrame, where: Column) -> DataFrame:
    """(doc_id, text, toxic) of the documents with a toxic label that meet ``where`` (on doc_id)."""
    marks = (labels.where(where & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # hashed on the small side's rows, so the texts are shuffled once and never sorted, at every size
    return docs.where(where).select("doc_id", "text").join(marks.hint("shuffle_hash"), "doc_id")


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> dict:
    """Model and curve from the rows that meet ``learn``: four fifths of them (by a hash of the id)
    are counted; order, prior and curve come from the others."""
    mine = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    values = fit_models(labelled(docs, labels, learn & (mine != 0)))
    if values is None:
        rate = labels.where(learn).agg(F.avg("toxic")).first()[0] or 0.0
        return {"rate": float(rate)}
    marks = labels.where(learn & (mine == 0) & F.col("toxic").isNotNull())
    few = marks.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION)
    rows = labelled(docs.join(F.broadcast(few), "doc_id", "left_semi"), labels, learn & (mine == 0))
    rows = staged(rows.select(F.xxhash64("doc_id", "text").alias("place"), "toxic", "text"), "calibration")
    columns = [f"v{i}" for i in range(len(PRIORS))]
    best = None
    for order in ORDERS:
        seen = evidence(rows, one_model(values, order, columns)).drop("text").orderBy("place").limit(CALIBRATION).toArrow()
        y, n = seen["toxic"].to_numpy().astype(np.float64), seen["n_bytes"].to_numpy()
        for c in columns:
            x = seen[f"evidence_{c}"].to_numpy()
            mean = float(x.mean()) if len(y) else 0.0
            x = (x - mean) * n / (n + LIGHT)
            quality = rank_quality(x, y) if 0 < y.sum() < len(y) else 0.0
            if best is None or quality > best[0]:
                best = quality, order, c, (mean, *(fit_curve(x, y) if len(y) else (0.0, 0.0, 1.0)))
    quality, order, column, curve = best
    return one_model(values, order, [column]) | {"curve": curve, "quality": quality, "prior": PRIORS[columns.index(column)]}


def score(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``df`` with score (0 to 1) and predicted (0 or 1)."""
    if "rate" in model:
        scored = df.withColumn("score", F.lit(model["rate"]))
    else:
        mean, middle, a, b = model["curve"]
        scored = evidence(df, model, text_col)
        n = F.col("n_bytes")
        x = (F.col("evidence") - mean) * n / (n + LIGHT)
        scored = scored.withColumn("score", 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * (x - middle)))))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod("doc_id", 4) == 2
    model = train(docs, labels, ~held_out)
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
