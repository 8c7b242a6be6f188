"""Registry of named queries: a Spark builder and, where SQL can say the
same thing, an independent SQL oracle (DuckDB dialect) over the same tables.

Float results are rounded to 6 decimals on both sides; every limit, lag and
row_number has a total order, and no query reads a clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL text."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (the oracle rounds the same way), show
    UTC timestamps as zone-less wall-clock values, as SQL engines do, and
    dates as ISO text (the oracle writes ``CAST(d AS VARCHAR)``)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            # ISO text: converts the same way from every engine and client.
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import the modules that register queries."""
    from . import queries_core  # noqa: F401
    from . import queries_store  # noqa: F401
    from . import queries_io  # noqa: F401
    from . import queries_load  # noqa: F401
