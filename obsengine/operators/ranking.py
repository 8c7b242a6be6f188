"""Order-dependent operators that stay balanced when one key is huge.

``Window.partitionBy(key)`` sends every row of a key to one task; if one key
holds a third of the data, that task holds a third of the data.  The
operators here split the work by key size:

* a cheap partial-aggregate count finds the *hot* keys, those with more
  rows than ``spark.obsengine.hotGroupRows`` (default 1,000,000).  There are
  at most ``rows / hotGroupRows`` of them, so the list is small by
  construction and is broadcast;
* cold keys use ordinary per-key windows (each task holds at most one
  bounded group at a time);
* hot keys are range-partitioned on (key, order), which splits each of them
  over many contiguous buckets; work happens inside each (key, bucket) with
  ordinary windows, and buckets are stitched together through a small
  per-(key, bucket) table.

Keys must be non-NULL (callers filter or substitute first); order columns
sort ascending with NULLs last and should form a total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

BUCKET = "_bucket"
HOT_ROWS_CONF = "spark.obsengine.hotGroupRows"
DEFAULT_HOT_ROWS = 1_000_000
UNSET = object()  # "find the hot keys yourself" (None means: none are hot)


def _n_buckets(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_rows_limit(df: DataFrame, hot_rows: int | None = None) -> int:
    if hot_rows:
        return hot_rows
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))


def sort_cols(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def sort_key(order: Sequence[str]) -> Column:
    """A struct that compares like ``ORDER BY order ASC NULLS LAST``."""
    return F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, as a small DataFrame (None when
    there are none).  At most rows / hot_rows keys can qualify."""
    limit = hot_rows_limit(df, hot_rows)
    keys = list(keys)
    if not keys:
        return df.sparkSession.range(1) if df.count() > limit else None
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(*keys)
    found = big.collect()
    if not found:
        return None
    return df.sparkSession.createDataFrame(found, big.schema)


def _split(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    keys = list(keys)
    if not keys:
        return None, df
    h = F.broadcast(hot)  # bounded: at most rows / hotGroupRows keys
    return df.join(h, keys, "left_anti"), df.join(h, keys, "left_semi")


def _union(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def _hot(df, keys, hot, hot_rows):
    return hot_keys(df, keys, hot_rows) if hot is UNSET else hot


def join_back(rows: DataFrame, stats: DataFrame, keys: Sequence[str], hot=UNSET,
              hot_rows: int | None = None, how: str = "left") -> DataFrame:
    """Join per-key rows (one row per key: statistics, a dimension) to the
    many rows of each key (``how`` is 'left' or 'inner').

    Rows of hot keys are joined to their keys' rows broadcast (at most
    rows / hotGroupRows of them), so a hot key never lands in one shuffle
    partition; the other rows take an ordinary join.
    """
    keys = list(keys)
    hot = _hot(rows, keys, hot, hot_rows)
    if hot is None:
        return rows.join(stats, on=keys, how=how)
    cold, heat = _split(rows, keys, hot)
    hot_stats = stats.join(F.broadcast(hot), keys, "left_semi")
    return cold.join(stats, on=keys, how=how).unionByName(heat.join(F.broadcast(hot_stats), on=keys, how=how))


def range_buckets(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None = None
) -> DataFrame:
    """Range-partition on (keys, order) and tag each row with its bucket.

    Buckets are contiguous in (keys, order): every bucket of a key holds rows
    that all sort after the rows of the key's lower buckets.

    Range bounds come from sampling the input, and a shuffled input arrives
    in a different order each time it is computed, so two evaluations of the
    exchange may cut different bounds.  The operators below read the buckets
    twice (rows and per-bucket totals), so the tagged rows are written once
    as a reliable checkpoint under the cluster's checkpoint folder: every
    reader, and every retry after a lost executor, sees the same buckets.
    """
    parts = [F.col(k).asc() for k in keys] + sort_cols(order)
    tagged = df.repartitionByRange(_n_buckets(df, n), *parts).withColumn(
        BUCKET, F.spark_partition_id()
    )
    checkpoint_dir(df.sparkSession)
    return tagged.checkpoint(eager=True)


# ------------------------------------------------------------------ rank


def _rank_window(df, keys, order, rank_col, size_col):
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return df.select(
        "*",
        (F.row_number().over(by_key.orderBy(*sort_cols(order))) - 1).alias(rank_col),
        F.count(F.lit(1)).over(by_key).alias(size_col),
    )


def _rank_buckets(df, keys, order, rank_col, size_col, n):
    b = range_buckets(df, keys, order, n)
    local = Window.partitionBy(*keys, BUCKET).orderBy(*sort_cols(order))
    ranked = b.withColumn("_local", F.row_number().over(local) - 1)

    counts = b.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy()
    before = by_key.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        BUCKET,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(by_key).alias(size_col),
    )
    out = ranked.join(offsets, on=[*keys, BUCKET], how="inner")
    return out.withColumn(rank_col, F.col("_off") + F.col("_local")).drop("_off", "_local", BUCKET)


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank_col: str = "_rank",
    size_col: str = "_group_n",
    n: int | None = None,
    hot_rows: int | None = None,
    hot=UNSET,
) -> DataFrame:
    """Add the 0-based position of each row within its key group, and the
    group's size.  Equivalent to ``row_number() - 1`` and ``count(*)`` over
    ``PARTITION BY keys ORDER BY order``, without an oversized task.
    """
    keys = list(keys)
    hot = _hot(df, keys, hot, hot_rows)
    if hot is None:
        return _rank_window(df, keys, order, rank_col, size_col)
    cold, heat = _split(df, keys, hot)
    cold_ranked = None if cold is None else _rank_window(cold, keys, order, rank_col, size_col)
    return _union(cold_ranked, _rank_buckets(heat, keys, order, rank_col, size_col, n))


# ------------------------------------------------------------------- lag


def _lag_window(df, keys, order, cols, prefix):
    w = Window.partitionBy(*keys).orderBy(*sort_cols(order))
    return df.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in cols])


def _lag_buckets(df, keys, order, cols, prefix, n):
    b = range_buckets(df, keys, order, n)
    local = Window.partitionBy(*keys, BUCKET).orderBy(*sort_cols(order))
    lagged = b.select(
        "*",
        (F.row_number().over(local) == 1).alias("_first"),
        F.lead(F.lit(1)).over(local).isNull().alias("_is_last"),
        *[F.lag(c).over(local).alias("_lag_" + c) for c in cols],
    )
    # Last row of every (key, bucket) comes out of the same window pass; the
    # previous bucket's last row of the same key is the predecessor of the
    # bucket's first row.  That table has one row per non-empty bucket.
    last = lagged.where("_is_last").select(*keys, BUCKET, F.struct(*cols).alias("_last"))
    by_key = Window.partitionBy(*keys).orderBy(BUCKET)
    carry = last.select(*keys, BUCKET, F.lag("_last").over(by_key).alias("_carry"))
    out = lagged.join(carry, on=[*keys, BUCKET], how="left")
    return out.select(
        *df.columns,
        *[
            F.when(F.col("_first"), F.col("_carry." + c)).otherwise(F.col("_lag_" + c)).alias(prefix + c)
            for c in cols
        ],
    )


def previous_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "prev_",
    n: int | None = None,
    hot_rows: int | None = None,
    hot=UNSET,
) -> DataFrame:
    """Add ``prefix + c``: the value of ``c`` on the previous row of the same
    key group in ``order`` (NULL on a group's first row).  Same result as
    ``lag(c, 1) OVER (PARTITION BY keys ORDER BY order)``.
    """
    keys = list(keys)
    hot = _hot(df, keys, hot, hot_rows)
    if hot is None:
        return _lag_window(df, keys, order, cols, prefix)
    cold, heat = _split(df, keys, hot)
    return _union(_lag_window(cold, keys, order, cols, prefix), _lag_buckets(heat, keys, order, cols, prefix, n))


# ------------------------------------------------------------- quantiles


def _quantiles_agg(df, keys, value, probs, names):
    q = F.percentile(F.col(value), F.array(*[F.lit(float(p)) for p in probs]))
    return df.groupBy(*keys).agg(q.alias("_q")).select(
        *keys, *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)]
    )


def _quantiles_ranked(df, keys, value, probs, names, n):
    r = _rank_buckets(df, keys, [value], "_rank", "_group_n", n)
    conds, aggs = [], []
    for p, name in zip(probs, names):
        pos = (F.col("_group_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        conds += [F.col("_rank") == lo, F.col("_rank") == hi]
        aggs += [
            F.max(F.when(F.col("_rank") == lo, F.col(value))).alias(f"_{name}_lo"),
            F.max(F.when(F.col("_rank") == hi, F.col(value))).alias(f"_{name}_hi"),
            F.first(pos - lo).alias(f"_{name}_frac"),
            F.first(hi - pos).alias(f"_{name}_rest"),
        ]
    hit = conds[0]
    for c in conds[1:]:
        hit = hit | c
    picked = r.where(hit).groupBy(*keys).agg(*aggs)
    return picked.select(
        *keys,
        *[
            # the same interpolation as the percentile aggregate, so infinite values
            # and rounding don't depend on how many rows a key has
            F.when(F.col(f"_{nm}_lo") == F.col(f"_{nm}_hi"), F.col(f"_{nm}_lo"))
            .otherwise(F.col(f"_{nm}_rest") * F.col(f"_{nm}_lo") + F.col(f"_{nm}_frac") * F.col(f"_{nm}_hi"))
            .alias(nm)
            for nm in names
        ],
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    n: int | None = None,
    hot_rows: int | None = None,
    hot=UNSET,
) -> DataFrame:
    """Per-key quantiles with linear interpolation (NULL values skipped).

    Same definition as ``percentile`` / ``quantile_cont``: position
    ``(n - 1) * p``, interpolated between its floor and ceiling neighbours.
    Cold keys use the exact ``percentile`` aggregate (its per-group value
    map is bounded by the hot-key limit); hot keys are ranked over range
    buckets and only the rows at the needed ranks reach the final
    aggregate, so no task ever holds a whole hot group.
    """
    keys = list(keys)
    x = df.where(F.col(value).isNotNull()).select(*keys, value)
    hot = _hot(x, keys, hot, hot_rows)
    if hot is None:
        return _quantiles_agg(x, keys, value, probs, names)
    cold, heat = _split(x, keys, hot)
    cold_q = None if cold is None else _quantiles_agg(cold, keys, value, probs, names)
    return _union(cold_q, _quantiles_ranked(heat, keys, value, probs, names, n))


def dense_ids(
    df: DataFrame,
    order: Sequence[str],
    start: Column | int = 1,
    id_col: str = "id",
    n: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Number rows 0..n-1 in ``order`` and add ``start``: gap-free surrogate
    keys.  Up to the hot-row limit one window numbers them; beyond it only
    one count per range bucket goes through a single task."""
    r = rank_within(df, [], order, rank_col="_rank", size_col="_group_n", n=n, hot_rows=hot_rows)
    start = F.lit(start) if isinstance(start, int) else start
    return r.withColumn(id_col, (F.col("_rank") + start).cast("bigint")).drop("_rank", "_group_n")
