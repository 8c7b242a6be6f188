"""Column-level parsing and plausibility rules (pure JVM expressions).

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's rules.
# Plausible ranges (inclusive) per measure; outside becomes NULL.
TEMPERATURE_RANGE = (-80.0, 80.0)
HUMIDITY_RANGE = (0.0, 100.0)
RATING_RANGE = (1.0, 5.0)
# Rating words of a product card, in order One..Five -> 1..5.
RATING_WORDS = ("One", "Two", "Three", "Four", "Five")
# Text used for a missing url after the text cast.
NULL_URL_TOKEN = "nan"

# A number as plain text: optional sign, digits with optional fraction (or a
# bare fraction), optional exponent, optional surrounding blanks.  Infinity
# words are allowed, NaN is not (it means "missing").
_NUMBER_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_INF_RE = r"^\s*[+-]?(?i)(inf|infinity)\s*$"
# A timestamp text must at least start with a full calendar date.
_DATE_PREFIX_RE = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"

_NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Parse a value to DOUBLE; anything that is not a number becomes NULL.

    NaN is folded to NULL (a NaN left in place sorts above every number and
    poisons averages).  Text is accepted only in plain decimal or exponent
    form, so Spark-only spellings such as ``1.5d`` are rejected.
    """
    c = _col(c)
    if dtype is not None and isinstance(dtype, _NUMERIC_TYPES):
        d = c.cast("double")
        return F.when(~F.isnan(d), d)
    s = c.cast("string")
    ok = s.rlike(_NUMBER_RE) | s.rlike(_INF_RE)
    return F.when(ok, F.trim(s).try_cast("double"))


def to_utc_timestamp(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Parse a value to a UTC timestamp; bad or partial values become NULL.

    Naive text is taken as UTC (the session zone is UTC), text with an offset
    is converted.  Each value is parsed on its own, so one row's format never
    decides another's.  Timestamp columns pass through unchanged.
    """
    c = _col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp")
    s = c.cast("string")
    return F.when(s.rlike(_DATE_PREFIX_RE), F.trim(s).try_cast("timestamp"))


def in_range_or_null(c: str | Column, lo: float, hi: float) -> Column:
    """Keep a value inside the closed range [lo, hi]; outside becomes NULL."""
    c = _col(c)
    return F.when(c.between(lo, hi), c)


def non_negative_or_null(c: str | Column) -> Column:
    """Keep a value >= 0; a negative value becomes NULL."""
    c = _col(c)
    return F.when(c >= 0, c)


def trim_blanks(c: str | Column) -> Column:
    """Strip leading and trailing whitespace (space, tab, newline, ...)."""
    return F.regexp_replace(_col(c).cast("string"), r"^\s+|\s+$", "")


def normalize_url(c: str | Column, null_token: str | None = NULL_URL_TOKEN) -> Column:
    """Text-cast and trim a url; a missing url becomes ``null_token``.

    ``null_token=None`` keeps a missing url NULL instead of the parity token.
    """
    c = _col(c).cast("string")
    if null_token is not None:
        c = F.coalesce(c, F.lit(null_token))
    return trim_blanks(c)


def price_text_to_double(c: str | Column, lenient: bool = False) -> Column:
    """Card price text to a number: drop the pound sign, decimal comma to dot.

    Strict by default: any other stray character gives NULL.  ``lenient``
    strips every character that cannot be part of a number first.
    """
    s = F.trim(_col(c).cast("string"))
    s = F.replace(F.replace(s, F.lit("£"), F.lit("")), F.lit(","), F.lit("."))
    if lenient:
        s = F.regexp_replace(s, r"[^0-9.+\-eE]", "")
    return to_double(s)


def rating_word_to_int(c: str | Column) -> Column:
    """Rating word One..Five to 1..5; an unknown word gives NULL."""
    pairs = []
    for i, word in enumerate(RATING_WORDS, start=1):
        pairs += [F.lit(word), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), _col(c))


def fill_default(c: str | Column, default) -> Column:
    """A missing value becomes ``default``."""
    return F.coalesce(_col(c), F.lit(default))


def day_of(c: str | Column) -> Column:
    """Calendar day (UTC) of a timestamp."""
    return F.to_date(_col(c))


def hour_of(c: str | Column) -> Column:
    """Timestamp truncated to its hour."""
    return F.date_trunc("hour", _col(c))


def prefixed(prefix: str, c: str | Column) -> Column:
    """String prefix concatenation (``prefix || c``)."""
    return F.concat(F.lit(prefix), _col(c))


def ensure_columns(df, schema: T.StructType):
    """Add every column of ``schema`` missing from ``df`` as a typed NULL."""
    have = set(df.columns)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in have]
    return df.select("*", *missing) if missing else df
