"""Cell cleaning, sentinels, defaults and boolean parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.schemas import NULL_LIKE_TEXT


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Trim; the null-like words ``nan``, ``nat`` and the empty string (any
    case) become NULL."""
    t = F.trim(_c(c))
    return F.when(F.lower(t).isin(*NULL_LIKE_TEXT), F.lit(None).cast("string")).otherwise(t)


def nan_to_null(c) -> Column:
    """NaN is 'missing' in the source matrices; make it NULL so aggregates
    and comparisons skip it."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def clean_all(df: DataFrame) -> DataFrame:
    """Apply the cell rule to every column by type: text is cleaned, floating
    NaN becomes NULL, everything else passes unchanged."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out.append(clean_text(f.name).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(nan_to_null(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def fill_by_type(df: DataFrame, values: dict) -> DataFrame:
    """``coalesce(col, literal)`` per named column; unlike ``na.fill`` it
    also works when the literal's type differs from a numeric column (the
    column is cast to the literal's type first)."""
    out = []
    for f in df.schema.fields:
        if f.name in values:
            v = values[f.name]
            c = F.col(f.name)
            if isinstance(v, str) and not isinstance(f.dataType, T.StringType):
                c = c.cast("string")
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                c = nan_to_null(c)
            out.append(F.coalesce(c, F.lit(v)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def with_defaults(df: DataFrame, defaults: dict, schema: T.StructType | None = None) -> DataFrame:
    """Give absent or NULL columns their declared default."""
    out = []
    names = set(df.columns)
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    for name, v in defaults.items():
        lit = F.lit(v)
        if name in types:
            lit = lit.cast(types[name])
        if name in names:
            out.append((name, F.coalesce(F.col(name), lit)))
        else:
            out.append((name, lit))
    res = df
    for name, c in out:
        res = res.withColumn(name, c)
    return res


def parse_bool(c, dtype: T.DataType | None = None) -> Column:
    """Booleans as the reference accepts them: booleans as is; text ``Y``
    (any case) is TRUE; the integer 1 is TRUE; anything else, NULL
    included, is FALSE."""
    col = _c(c)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(col, F.lit(False))
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.coalesce(col == 1, F.lit(False))
    return F.coalesce(F.upper(col.cast("string")) == "Y", F.lit(False))


def rescale_id(c, factor: int = 1000, as_text: bool = True) -> Column:
    """Source ids scaled by ``factor`` (e.g. 7007 -> 7): integer division,
    truncating like the source; text on request."""
    col = _c(c)
    res = (col.cast("double") / factor).cast("bigint")
    return res.cast("string") if as_text else res


def normalize_record(df: DataFrame, date_cols_as_text: bool = True) -> DataFrame:
    """Record normalisation before a load: floating NaN -> NULL, integral
    doubles of id columns kept numeric, plain dates rendered ``yyyy-MM-dd``
    (timestamps kept), text cleaned."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        elif isinstance(f.dataType, T.DateType) and date_cols_as_text:
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.StringType):
            c = clean_text(c)
        out.append(c.alias(f.name))
    return df.select(*out)
