"""Anomaly detection: price jumps by z-score, weather by z-score and IQR.

Group statistics are aggregates joined back to the rows (the join is
planned at run time: broadcast when the statistics turn out small, a
skew-split shuffle join otherwise), never whole-group windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import group_quartiles
from .ranking import UNSET, hot_keys, join_back, previous_within

# Fixed values that must equal the reference's rules.
Z_THRESHOLD = 3.0  # both alert kinds
IQR_FACTOR = 1.5  # precipitation fences: q1 - 1.5*iqr .. q3 + 1.5*iqr

# A population stddev this small relative to the mean is rounding noise of a
# constant series and counts as zero (deviation, documented in the README).
REL_ZERO_STD = 1e-12


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std; 0 when std is (numerically) zero, NULL when std is
    NULL (no values)."""
    tiny = std <= F.lit(REL_ZERO_STD) * F.greatest(F.lit(1.0), F.abs(mean))
    return F.when(std.isNull(), F.lit(None).cast("double")).when(tiny, F.lit(0.0)).otherwise(
        (x - mean) / std
    )


def zscore_by_group(df: DataFrame, by: list[str], value: str, out: str = "z", hot=UNSET) -> DataFrame:
    """Add ``out`` = z-score of ``value`` within its group (population
    stddev).  Rows with a NULL group key get NULL."""
    present = df.where(_present(by))
    stats = present.groupBy(*by).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    j = join_back(df, stats, by, hot=_hot_of(present, by, hot))
    z = zscore(F.col(value), F.col("_mean"), F.col("_std"))
    return j.withColumn(out, z).drop("_mean", "_std")


def price_delta(df: DataFrame, hot=UNSET) -> DataFrame:
    """Add ``price_prev`` (previous row's price for the same url in time
    order, missing times last) and ``delta`` = price - previous price."""
    x = df.where(F.col("url").isNotNull()).select("url", "scraped_at", "price_gbp")
    lagged = previous_within(x, ["url"], ["scraped_at", "price_gbp"], ["price_gbp"], prefix="_p_", hot=hot)
    return lagged.select(
        "url",
        "scraped_at",
        "price_gbp",
        F.col("_p_price_gbp").alias("price_prev"),
        (F.col("price_gbp") - F.col("_p_price_gbp")).alias("delta"),
    )


def price_anomalies(df: DataFrame, z_thresh: float = Z_THRESHOLD) -> DataFrame:
    """Price alerts: rows whose change from the previous price has
    |z| >= ``z_thresh`` within its url (and a change is present).

    Columns: url, scraped_at, price_gbp, price_prev, delta, delta_z.
    """
    hot = hot_keys(df.where(F.col("url").isNotNull()), ["url"])  # found once, used by both steps
    d = price_delta(df, hot=hot)
    z = zscore_by_group(d, ["url"], "delta", out="delta_z", hot=hot)
    # NaN (infinite prices in the group) compares as the largest number: no alert
    high = (F.abs("delta_z") >= F.lit(float(z_thresh))) & ~F.isnan("delta_z")
    return z.where(F.col("delta").isNotNull() & high).select(
        "url", "scraped_at", "price_gbp", "price_prev", "delta", "delta_z"
    )


def iqr_outlier(
    df: DataFrame,
    value: str,
    by: list[str],
    k: float = IQR_FACTOR,
    out: str = "outlier",
    approx: bool = False,
) -> DataFrame:
    """Add ``out``: true when ``value`` is outside [q1 - k*iqr, q3 + k*iqr] of
    its group.  A missing value is flagged (it is not inside the fences); a
    group with no values is flagged whole; a NULL group key gives NULL."""
    q = group_quartiles(df, by, value, approx=approx)
    j = join_back(df, q, by)
    iqr = F.col("q3") - F.col("q1")
    inside = F.col(value).between(F.col("q1") - k * iqr, F.col("q3") + k * iqr)
    flag = F.when(_present(by), ~F.coalesce(inside, F.lit(False)))
    return j.withColumn(out, flag).drop("q1", "q3")


def weather_anomalies(df: DataFrame, z_thresh: float = Z_THRESHOLD, approx: bool = False) -> DataFrame:
    """Weather alerts: |temperature z| >= ``z_thresh`` within the city, or
    precipitation outside the city's IQR fences.

    Columns: city, time, temperature_2m, temp_z, precipitation,
    precip_outlier, wind_speed_10m.

    The per-city profile (mean and stddev of temperature, quartiles of
    precipitation) is one aggregate when no city is hot; hot cities get
    their quartiles from the rank-based path instead.
    """
    x = df.select("city", "time", "temperature_2m", "precipitation", "wind_speed_10m")
    present = x.where(F.col("city").isNotNull())
    moments = [F.avg("temperature_2m").alias("_mean"), F.stddev_pop("temperature_2m").alias("_std")]
    hot = None if approx else hot_keys(present, ["city"])
    if approx or hot is None:
        quart = (
            F.percentile_approx("precipitation", [0.25, 0.75], 10000)
            if approx
            else F.percentile(F.col("precipitation"), F.array(F.lit(0.25), F.lit(0.75)))
        )
        prof = present.groupBy("city").agg(*moments, quart.alias("_q")).select(
            "city", "_mean", "_std", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3")
        )
    else:
        prof = present.groupBy("city").agg(*moments).join(
            group_quartiles(present, ["city"], "precipitation", hot=hot), "city", "left"
        )
    j = join_back(x, prof, ["city"], hot=hot if not approx else UNSET)
    iqr = F.col("q3") - F.col("q1")
    inside = F.col("precipitation").between(F.col("q1") - IQR_FACTOR * iqr, F.col("q3") + IQR_FACTOR * iqr)
    out = j.select(
        "city",
        "time",
        "temperature_2m",
        zscore(F.col("temperature_2m"), F.col("_mean"), F.col("_std")).alias("temp_z"),
        "precipitation",
        F.when(F.col("city").isNotNull(), ~F.coalesce(inside, F.lit(False))).alias("precip_outlier"),
        "wind_speed_10m",
    )
    high = (F.abs("temp_z") >= F.lit(float(z_thresh))) & ~F.isnan("temp_z")
    alert = high | (F.col("precip_outlier") == F.lit(True))
    return out.where(alert)


def _hot_of(df: DataFrame, by: list[str], hot):
    return hot_keys(df, by) if hot is UNSET else hot


def _present(by: list[str]) -> Column:
    cond = F.lit(True)
    for k in by:
        cond = cond & F.col(k).isNotNull()
    return cond
