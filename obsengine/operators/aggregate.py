"""Grouped aggregates: daily statistics, group moments, quartiles.

All are plain ``groupBy().agg()`` with built-in functions, so Spark runs a
partial aggregate in every map task and shuffles one row per group per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import day_of
from .ranking import UNSET, exact_quantiles


def last_non_null(value: str, order: str):
    """Aggregate: ``value`` on the row with the greatest ``order`` among rows
    where ``value`` is present (NULL when no row has one)."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def daily_price(df: DataFrame) -> DataFrame:
    """Per (url, UTC day): min, mean, max, last present price, row count.

    Rows without url or day are left out (a pandas group-by drops missing
    keys); ``n_obs`` counts rows whose price is missing too.
    """
    x = df.select("url", day_of("scraped_at").alias("day"), "scraped_at", "price_gbp")
    x = x.where(F.col("url").isNotNull() & F.col("day").isNotNull())
    return x.groupBy("url", "day").agg(
        F.min("price_gbp").alias("min_price"),
        F.avg("price_gbp").alias("avg_price"),
        F.max("price_gbp").alias("max_price"),
        last_non_null("price_gbp", "scraped_at").alias("last_price"),
        F.count(F.lit(1)).alias("n_obs"),
    )


def daily_weather(df: DataFrame) -> DataFrame:
    """Per (city, UTC day): mean temperature, mean humidity, total
    precipitation (0 when every value is missing), mean wind, row count."""
    x = df.select(
        "city",
        day_of("time").alias("day"),
        "temperature_2m",
        "relative_humidity_2m",
        "precipitation",
        "wind_speed_10m",
    ).where(F.col("city").isNotNull() & F.col("day").isNotNull())
    return x.groupBy("city", "day").agg(
        F.avg("temperature_2m").alias("avg_temp"),
        F.avg("relative_humidity_2m").alias("avg_rh"),
        F.coalesce(F.sum("precipitation"), F.lit(0.0)).alias("total_precip"),
        F.avg("wind_speed_10m").alias("avg_wind"),
        F.count(F.lit(1)).alias("n_obs"),
    )


def group_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Per group: mean and population standard deviation of ``value``."""
    return df.where(_keys_present(by)).groupBy(*by).agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
    )


def group_quartiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    approx: bool = False,
    accuracy: int = 10000,
    hot=UNSET,
) -> DataFrame:
    """Per group: first and third quartile of ``value`` (linear
    interpolation, missing values skipped).

    Exact by default: the ``percentile`` aggregate for ordinary groups and
    ranks over range buckets for hot ones (``ranking.exact_quantiles``), so
    no task holds a whole hot group; ``approx=True`` uses the bounded-memory
    percentile sketch instead.
    """
    x = df.where(_keys_present(by))
    if approx:
        q = F.percentile_approx(value, [0.25, 0.75], accuracy)
        return x.groupBy(*by).agg(q.alias("_q")).select(
            *by, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3")
        )
    return exact_quantiles(x, by, value, [0.25, 0.75], ["q1", "q3"], hot=hot)


def _keys_present(by: Sequence[str]):
    cond = F.lit(True)
    for k in by:
        cond = cond & F.col(k).isNotNull()
    return cond
