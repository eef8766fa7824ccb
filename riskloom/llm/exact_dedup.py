"""Exact deduplication by skew-safe combining (DataFrame operations only).

Equal texts (null counts as the empty text, nothing is normalised) form a
group; the row with the largest id stays.  The combining has three stages and
every one of them compares the whole text next to its SHA-256 digest:

1. each map task merges its own copies (partial aggregation on
   digest, salt, text);
2. digests that hold over 1/1000 of all rows ("hot": under 1000 of them by
   construction, so the list is broadcast) are merged per salt, the rest
   directly;
3. the salt winners of a hot digest are merged globally.

Cases: null ids sort below all others; rows repeating both id and text count
as one document (``duplicate_report`` flags them alike, ``deduplicate`` keeps
one of them); an empty table gives an empty result; other columns, whatever
their names, pass through ``deduplicate`` untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import staged, table

#: A digest is hot when it holds more than one in HOT_PARTS rows.
HOT_PARTS = 1000
#: Salts over which the copies of a hot digest are spread.
SALTS = 64


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def _keyed(df: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col]).alias("row"),
                     F.col(id_col).alias("id"), F.col(text_col).isNull().alias("was_null"),
                     text.alias("text"), digest(text).alias("digest"))


def _hot(ids: DataFrame) -> DataFrame:
    """Digests of more than 1/HOT_PARTS of the rows: fewer than HOT_PARTS rows."""
    total = ids.count()
    return (ids.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) & (F.col("n") * HOT_PARTS > total)).select("digest"))


def _combine(rows: DataFrame, hot: DataFrame, winner: Column, order: Column) -> DataFrame:
    """One row per distinct text: digest, text, winner (the ``winner`` value of
    the row with the largest ``order``), n (rows of the group)."""
    few = F.broadcast(hot)
    rows = rows.select("digest", "text", winner.alias("winner"), order.alias("place"))

    def merged(df: DataFrame, keys: list[str], n: Column) -> DataFrame:
        return df.groupBy(*keys).agg(F.max_by("winner", "place").alias("winner"), F.max("place").alias("place"),
                                     F.sum(n).alias("n"))

    cold = merged(rows.join(few, "digest", "left_anti"), ["digest", "text"], F.lit(1))
    salted = rows.join(few, "digest", "left_semi").withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)))
    warm = merged(merged(salted, ["digest", "salt", "text"], F.lit(1)), ["digest", "text"], F.col("n"))
    return cold.unionByName(warm).select("digest", "text", "winner", F.col("n").cast("long").alias("n"))


def duplicate_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Group results return to the rows by digest, which stands for the text
    wherever the full comparison found one text for it; digests shared by
    different texts (none with SHA-256) are joined on the text as well.
    """
    rows = _keyed(df.select(id_col, text_col), id_col, text_col, digest)
    ids = staged(rows.select("id", "digest", sha256_hex(F.col("text")).alias("sha")), "digests")
    hot = _hot(ids)
    groups = _combine(rows, hot, F.col("id"), F.col("id"))
    groups = staged(groups.groupBy("digest").agg(F.max("winner").alias("keep"), F.max("n").alias("n"),
                                                 F.count(F.lit(1)).alias("texts"))
                    .where((F.col("n") > 1) | (F.col("texts") > 1)), "groups")
    plain, few = groups.where("texts = 1").drop("texts"), F.broadcast(hot)
    # the few hot digests meet their rows by broadcast, so no task gets all rows of one
    warm = ids.join(few, "digest", "left_semi").join(F.broadcast(plain.join(few, "digest", "left_semi")), "digest", "left")
    cold = ids.join(few, "digest", "left_anti").join(plain, "digest", "left")
    out = cold.unionByName(warm)
    clashing = groups.where("texts > 1").select("digest")
    if not clashing.isEmpty():
        out = out.join(clashing, "digest", "left_anti")
        own = rows.join(clashing, "digest", "left_semi").withColumn("sha", sha256_hex(F.col("text")))
        texts = own.groupBy("digest", "text").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
        out = out.unionByName(own.select("id", "digest", "sha", "text").join(texts, ["digest", "text"])
                              .select("id", "digest", "sha", "keep", "n"))
    keep = F.when(F.col("n") > 1, F.col("keep")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), keep.alias("keep_id"),
                      F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("group_size"),
                      F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """The rows that stay, one per distinct text, with all their columns."""
    rows = _keyed(df, id_col, text_col, digest)
    hot = staged(_hot(rows.select("digest")), "hot")
    hashed = [F.col(f"row.`{f.name}`") for f in df.schema if f.name != text_col and "map" not in f.dataType.simpleString()]
    order = F.struct(F.col("id"), F.col("was_null"), F.xxhash64(*hashed))
    kept = _combine(rows, hot, F.struct("row", "was_null"), order)
    text = F.when(~F.col("winner.was_null"), F.col("text"))
    return kept.select(*[text.alias(c) if c == text_col else F.col(f"winner.row.`{c}`").alias(c) for c in df.columns])


def op10_exact_dedup(spark, sf_dir):
    return duplicate_report(table(spark, sf_dir, "documents"))


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
