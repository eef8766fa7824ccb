"""Mixing sources to target weights by Pareto order sampling (DataFrame
operations only).

Every source gets a target number of words.  A source's documents are first
copied whole ``floor(target / words)`` times; what is left of the target is
drawn by Pareto order sampling: document i with inclusion probability p_i gets
the ranking variable (u_i / (1 - u_i)) / (p_i / (1 - p_i)) with u_i from the
MD5 of its id, and documents are taken in rising order up to the words that
are left.  The sample's fixed size is counted in words, so a last document
that would pass the target stays out; further rounds give the words still
missing, by the same order, to documents that fit into them, until none does.

Scale: the order statistic is found through a histogram of the ranking
variable (``BINS`` bins a source); only the documents of the bin with the cut
are sorted, so a source with a third of all rows is never one sort.

Cases: null and empty texts have size 0 and are never missing; a null source
is a source of its own, last in the order; rows repeating an id are separate
documents with the same rank; sources without words get target 0; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import staged, table, text_or_empty

#: Mixing weights by a source's place in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: All targets together, as a share of all words.
TOTAL_SHARE = 1.5
#: No target is above this many times its source's words.
MOST_COPIES = 2
BINS = 4096
#: Parts of a source that meet its row of words left.
SALTS = 16
WORD = r"[^\x20\x09-\x0D]+"


def uniform(id_col: str, seed: str = "mix") -> Column:
    """A number in (0, 1) from the id alone: 48 bits of an MD5, centred."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(2 ** 48)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = TOTAL_SHARE, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: stratum (its place), source_size, target.

    The windows run over one row per source.  In rising order of the level at
    which a source is full (most * size / weight), a source is full if the
    common level of what remains reaches its own; the others share the rest
    by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("stratum") % len(weights) + 1).cast("int"))
    per = per.withColumn("stratum", place).withColumn("weight", weight)
    per = per.withColumn("cap", (F.col("source_size") * most).cast("double"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "stratum")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * share
    per = per.withColumn("level", (total - before) / rest)
    per = per.withColumn("full", F.col("cap") / F.col("weight") <= F.col("level"))
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * common)
    return per.select("source", "stratum", "source_size", target.alias("target"))


def pareto_rank(u: Column, p: Column) -> Column:
    return (u / (1 - u)) * ((1 - p) / p)


def _take(pool: DataFrame, left: DataFrame) -> DataFrame:
    """Ids of rows of ``pool`` (row, stratum, size, rank) taken in rising rank
    while the stratum's words in ``left`` (stratum, words) last."""
    bins = F.floor(F.col("rank") / (1 + F.col("rank")) * BINS)
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pool = pool.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(left, ["stratum", "salt"])
    pool = pool.where("size <= words").withColumn("bin", bins)
    hist = pool.groupBy("stratum", "bin").agg(F.sum("size").alias("in_bin"), F.max("words").alias("words"))
    upto = F.sum("in_bin").over(Window.partitionBy("stratum").orderBy("bin"))
    hist = hist.withColumn("upto", upto)
    hist = hist.select("stratum", "bin", "upto", (F.col("upto") - F.col("in_bin")).alias("before"))
    near = pool.join(hist, ["stratum", "bin"]).where("before <= words")
    whole = near.where("upto <= words").select("row")
    order = Window.partitionBy("stratum", "bin").orderBy("rank", "row").rowsBetween(Window.unboundedPreceding, 0)
    part = (near.where("upto > words").withColumn("sum", F.col("before") + F.sum("size").over(order))
            .where("sum <= words").select("row"))
    return whole.unionByName(part)


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str, *more: str) -> DataFrame:
    size = F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")
    return df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), *more)


def plan_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, source, size, nth, source_size, target, copies,
    taken; nth numbers documents that agree in id, size and source."""
    sizes = staged(_sized(df, id_col, text_col, source_col), "sizes")
    targets = staged(source_targets(sizes), "targets")
    rows = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("whole", F.floor(ratio)).withColumn("p", ratio - F.floor(ratio))
    same = Window.partitionBy("id", "size", "source").orderBy(F.lit(0))
    rows = rows.withColumn("nth", F.row_number().over(same)).withColumn("row", F.struct("id", "size", "nth", "stratum"))
    rows = staged(rows.withColumn("rank", F.when(F.col("p") > 0, pareto_rank(uniform("id"), F.col("p")))), "ranked")
    pool = rows.where("rank is not null and size > 0").select("row", "stratum", "size", "rank")
    rest = F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")
    left = targets.where("source_size > 0").select("stratum", F.floor(rest).alias("words"))
    taken = more = staged(_take(pool, left), "taken")
    while not more.isEmpty():
        used = more.groupBy(F.col("row.stratum").alias("stratum")).agg(F.sum("row.size").alias("used"))
        # a source that took nothing has nothing left that fits
        left = staged(left.join(used, "stratum").select("stratum", (F.col("words") - F.col("used")).alias("words")).where("words > 0"), "left")
        # written each round, without what no longer fits: a round's plan holds no earlier one
        open_ = left.select("stratum", F.col("words").alias("most"))
        pool = staged(pool.join(more, "row", "left_anti").join(open_, "stratum").where("size <= most").drop("most"), "pool")
        more = staged(_take(pool, left), "taken")
        taken = taken.unionByName(more)
    rows = rows.join(taken.withColumn("extra", F.lit(1)), "row", "left")
    copies = (F.col("whole") + F.coalesce(F.col("extra"), F.lit(0))).cast("int")
    return rows.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "nth", "source_size", "target",
                       copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed table: the input's rows and columns, each row as often as the mix takes it."""
    plan = (plan_mix(df, id_col, text_col, source_col).where("copies > 0")
            .select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), "size", "nth", "copies"))
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))
    keyed = _sized(keyed.select("doc", F.col(f"doc.`{id_col}`").alias("i"), F.col(f"doc.`{text_col}`").alias("t"),
                                F.col(f"doc.`{source_col}`").alias("s")), "i", "t", "s", "doc")
    same = Window.partitionBy("id", "size", "source").orderBy(F.col(f"doc.`{text_col}`"))
    keyed = keyed.withColumn("nth", F.row_number().over(same))
    hit = ((keyed["nth"] == plan["nth"]) & (keyed["size"] == plan["size"]) & keyed["id"].eqNullSafe(plan["id"])
           & keyed["source"].eqNullSafe(plan["source"]))
    return (keyed.join(plan, hit).select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select(*[F.col(f"doc.`{c}`").alias(c) for c in df.columns]))


def op4_source_mix(spark, sf_dir):
    return plan_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: Each source's documents one by one, in rising rank: a document is drawn if it fits into what is left.
OP4_SQL = r"""
WITH RECURSIVE sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS stratum
  FROM sized GROUP BY source),
weighted AS (SELECT *, (2 * source_size)::DOUBLE AS cap,
  CASE stratum % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM per),
level AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
     - coalesce(sum(cap) OVER (ORDER BY cap / weight, stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, stratum ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
targets AS MATERIALIZED (SELECT source, stratum, source_size,
  CASE WHEN cap / weight <= level THEN cap
       ELSE weight * max(CASE WHEN cap / weight > level THEN level END) OVER () END AS target FROM level),
joined AS (SELECT s.doc_id, s.source, s.size, t.stratum, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS ratio,
    (('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u,
    row_number() OVER (PARTITION BY s.doc_id, s.size, s.source) AS nth, row_number() OVER () AS row_id
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS MATERIALIZED (SELECT *, ratio - floor(ratio) AS p,
    CASE WHEN ratio > floor(ratio) THEN (u / (1 - u)) * ((1 - (ratio - floor(ratio))) / (ratio - floor(ratio))) END AS rank FROM joined),
queue AS MATERIALIZED (SELECT row_id, stratum, size, row_number() OVER (PARTITION BY stratum ORDER BY rank, doc_id, size, nth) AS k
  FROM ranked WHERE size > 0 AND p > 0),
walk AS (SELECT stratum, 0::BIGINT AS k, floor(target - floor(target / source_size) * source_size)::BIGINT AS words, NULL::BIGINT AS row_id, false AS fits
  FROM targets WHERE source_size > 0
  UNION ALL SELECT w.stratum, q.k, CASE WHEN q.size <= w.words THEN w.words - q.size ELSE w.words END, q.row_id, q.size <= w.words
  FROM walk w JOIN queue q ON q.stratum = w.stratum AND q.k = w.k + 1),
extra AS (SELECT row_id FROM walk WHERE fits)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (floor(ratio) + CASE WHEN row_id IN (SELECT row_id FROM extra) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
"""
