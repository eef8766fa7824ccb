"""Bitmap index of loaded keys.

A month of a table has one bit for each hash slot of a key, kept as bitmaps of
32,768 bits (``bitmap_construct_agg``), about ``BITS_PER_KEY`` bits for a key.  A
row whose bit is not set is certainly not loaded: it is inserted without
looking at the table.  Only rows whose bit is set ("maybe loaded") meet the table in an
exact anti join, and only the months that have such rows are read.

Bits are only ever added, so an index that knows more keys than the table is
still right, and one that is merged after an append never misses a key.  Rows
with a NULL in the key are never loaded (SQL equality) and need no bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap (fixed by ``bitmap_construct_agg``) and bits spent on a key: one in BITS_PER_KEY new rows is checked in vain.
BITMAP_BITS = 32768
BITS_PER_KEY = 16


def _slot(keys: Sequence[str], pages: Column) -> Column:
    """The key's bit among ``pages`` bitmaps, from 0."""
    return F.pmod(F.xxhash64(*keys), pages * BITMAP_BITS)


def _known(df: DataFrame, keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def _month(df: DataFrame, date_col: str, month_col: str) -> DataFrame:
    return df if month_col in df.columns else df.withColumn(month_col, F.date_format(date_col, "yyyy-MM"))


def build_key_index(loaded: DataFrame, keys: Sequence[str] = ("company_id", "data_date"), date_col: str = "data_date",
                    month_col: str = "data_month", bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """(month, pages, page, bitmap) of a table.  Two aggregations with map-side
    combining: rows a month, then bits; 4 KB a page leave each task, no keys."""
    rows = _month(loaded, date_col, month_col).where(_known(loaded, keys))
    # power-of-two pages by the month's rows; the join side is one row a month
    pages = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.count(F.lit(1)) * bits_per_key / F.lit(BITMAP_BITS))))).cast("long")
    sizes = rows.groupBy(month_col).agg(pages.alias("pages"))
    bits = rows.select(month_col, *keys).join(sizes, month_col).withColumn("slot", _slot(keys, F.col("pages")))
    return _paged(bits, month_col)


def _paged(bits: DataFrame, month_col: str) -> DataFrame:
    page = F.expr(f"slot div {BITMAP_BITS}").alias("page")
    return (bits.groupBy(month_col, "pages", page).agg(F.bitmap_construct_agg(F.expr(f"slot % {BITMAP_BITS}")).alias("bitmap")))


def merge_key_index(index: DataFrame, added: DataFrame, keys: Sequence[str] = ("company_id", "data_date"), date_col: str = "data_date",
                    month_col: str = "data_month", bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """The index with the keys of appended rows: months it knows keep their number of pages, others are new."""
    rows = _month(added, date_col, month_col).where(_known(added, keys))
    known = index.select(month_col, "pages").distinct()
    old = rows.select(month_col, *keys).join(known, month_col).withColumn("slot", _slot(keys, F.col("pages")))
    fresh = build_key_index(rows.join(known, month_col, "left_anti"), keys, date_col, month_col, bits_per_key)
    both = index.unionByName(_paged(old, month_col)).unionByName(fresh)
    return both.groupBy(month_col, "pages", "page").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def flag_maybe_loaded(incoming: DataFrame, index: DataFrame, keys: Sequence[str] = ("company_id", "data_date"), date_col: str = "data_date",
                      month_col: str = "data_month", flag: str = "maybe_loaded") -> DataFrame:
    """``incoming`` with whether the index has its bit; the loaded table is not read."""
    rows = _month(incoming, date_col, month_col)
    sized = rows.join(index.select(F.col(month_col).alias("_month"), "pages").distinct(), F.col(month_col) == F.col("_month"), "left")
    sized = sized.withColumn("_slot", _slot(keys, F.col("pages")))
    pages = index.select(F.col(month_col).alias("_m"), F.col("page").alias("_page"), "bitmap")
    hit = (F.col("_month") == F.col("_m")) & (F.expr(f"_slot div {BITMAP_BITS}") == F.col("_page"))
    byte = F.expr(f"cast(conv(hex(substring(bitmap, cast((_slot % {BITMAP_BITS}) div 8 as int) + 1, 1)), 16, 10) as int)")
    bit = F.expr("shiftright(_byte, cast(_slot % 8 as int)) & 1")
    found = sized.join(pages, hit, "left").withColumn("_byte", byte)
    return found.select(*incoming.columns, (F.coalesce(bit, F.lit(0)) == 1).alias(flag))


def anti_loaded_indexed(incoming: DataFrame, loaded: DataFrame, index: DataFrame, keys: Sequence[str] = ("company_id", "data_date"),
                        date_col: str = "data_date", month_col: str = "data_month") -> DataFrame:
    """``anti_not_loaded`` by the index: sure-new rows pass, the others are
    checked exactly against the months of ``loaded`` that hold one (a list
    bounded by the calendar; partition pruning where the table is kept by month)."""
    from riskloom.operators.mutate import staged
    flagged = staged(flag_maybe_loaded(incoming, index, keys, date_col, month_col), "key-index-probe")
    maybe = flagged.where("maybe_loaded").drop("maybe_loaded")
    months = [r[0] for r in maybe.select(F.date_format(date_col, "yyyy-MM")).distinct().collect()]
    sure = flagged.where("NOT maybe_loaded").drop("maybe_loaded")
    if not months:
        return sure
    table = _month(loaded, date_col, month_col).where(F.col(month_col).isin(months))
    return sure.unionByName(maybe.join(table.select(*keys).distinct(), list(keys), "left_anti").select(*sure.columns))
