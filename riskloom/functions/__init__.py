"""Column-expression builders.  All return ``Column`` objects built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen."""

from riskloom.functions.clean import (  # noqa: F401
    clean_text, nan_to_null, clean_all, fill_by_type, with_defaults, parse_bool,
)
from riskloom.functions.dates import (  # noqa: F401
    date_from_parts, date_from_parts_coerce, date_from_yyyymmdd, last_trading_day, relative_date,
)
from riskloom.functions.rating import rating_grade  # noqa: F401
