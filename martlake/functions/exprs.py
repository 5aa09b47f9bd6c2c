"""Scalar Column expressions shared by the entity builders (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_if_null(c, dtype: str = "bigint") -> Column:
    """Null -> 0, then integer cast (a lenient cast: unparsable -> 0)."""
    return F.coalesce(F.expr(f"try_cast({c} as {dtype})") if isinstance(c, str) else c.try_cast(dtype),
                      F.lit(0).cast(dtype))


def zero_float_if_null(c) -> Column:
    """Null -> 0.0 as double."""
    return F.coalesce(col(c).try_cast("double"), F.lit(0.0))


def unknown_if_null(c, text: str = "Unknown") -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(text))


def nan_if_null(c) -> Column:
    """Text cast where null becomes the literal text 'nan' (seller image URL rule)."""
    return F.coalesce(col(c).cast("string"), F.lit("nan"))


def with_prefix(c, prefix: str, marker: str = "http") -> Column:
    """Keep a value that already starts with ``marker``; otherwise prepend ``prefix``."""
    c = col(c)
    return F.when(c.startswith(marker), c).otherwise(F.concat(F.lit(prefix), c))


def concat_id(*cols) -> Column:
    """Composite id as decimal text concatenation, read back as bigint.

    Not collision free ('1'||'23' = '12'||'3'); overflow gives null (quarantine)."""
    return F.concat(*[col(c).cast("string") for c in cols]).try_cast("bigint")


def epoch_to_text(c) -> Column:
    """Epoch seconds -> 'yyyy-MM-dd HH:mm:ss' (UTC)."""
    return F.date_format(F.timestamp_seconds(col(c)), TS_FORMAT)


EPOCH_UNITS = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}


def lenient_timestamp(c, numeric_unit: str | None = None) -> Column:
    """Free-form date text -> timestamp; unparsable -> null.

    With ``numeric_unit`` ('s', 'ms' or 'us') a value that is a whole number is
    read as an epoch in that unit instead (the unit is never guessed)."""
    c = col(c)
    parsed = F.try_to_timestamp(c.cast("string"))
    if numeric_unit is None:
        return parsed
    num = c.cast("string").try_cast("bigint")
    return F.when(num.isNotNull(), EPOCH_UNITS[numeric_unit](num)).otherwise(parsed)


def ts_text(c) -> Column:
    return F.date_format(col(c), TS_FORMAT)


def date_text(c) -> Column:
    return F.date_format(col(c), DATE_FORMAT)


def reference_time(as_of: str, tz_offset_hours: int) -> Column:
    """The run's wall-clock 'now' (an explicit parameter) plus a fixed offset."""
    return F.to_timestamp_ntz(F.lit(as_of)) + F.make_dt_interval(hours=F.lit(tz_offset_hours))


def minus_days(ts: Column, days: Column) -> Column:
    """ts - days (days may be fractional); null days -> null."""
    secs = (days.cast("double") * 86400.0).cast("decimal(18,6)")
    return ts - F.make_dt_interval(secs=secs)


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a lambda variable.

    Catalyst substitutes column aliases into every reference when it pushes a
    filter below a projection, so an expensive expression used several times
    (a regex chain, a JSON parse) would be recomputed per use; a lambda binding
    is evaluated once per row."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def select_where(df, columns: dict, keep) -> "DataFrame":
    """``select(columns)`` keeping rows where ``keep(row_struct)`` holds, with each
    computed column evaluated once per row.

    Written as ``inline(filter(array(struct(...)), keep))``: a Generate node, which
    Catalyst does not push filters below, so an expensive column that the
    predicate reads is not recomputed inside a pushed-down Filter."""
    s = F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()])
    return df.select(F.inline(F.filter(F.array(s), keep)))
