"""JSON API payloads to rows.

Hourly forecast payloads are an object of parallel arrays
(``{"hourly": {"time": [...], "temperature_2m": [...], ...}}``); geocoding
payloads an array of result objects (``{"results": [{...}, ...]}``).  Both
are parsed with an explicit schema (``from_json``) and flattened with
built-in array functions; the network calls are not built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference: the hourly variables requested.
HOURLY_VARS = ("temperature_2m", "precipitation", "relative_humidity_2m", "wind_speed_10m")

HOURLY_SCHEMA = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in HOURLY_VARS]
            ),
        )
    ]
)

GEOCODE_SCHEMA = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("latitude", T.DoubleType()),
                        T.StructField("longitude", T.DoubleType()),
                        T.StructField("country", T.StringType()),
                    ]
                )
            ),
        )
    ]
)


def hourly_rows(payloads: DataFrame, city: str = "city", payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Explode hourly payloads into rows (city, time, four measures).

    An empty or absent ``hourly`` object gives no rows; a variable absent
    from the payload is a NULL column.  Present arrays of unequal length are
    not padded: such payloads go to the second output (city, payload,
    reason) instead.
    """
    p = payloads.select(city, payload, F.from_json(payload, HOURLY_SCHEMA).alias("_j"))
    h = F.col("_j.hourly")
    names = ("time", *HOURLY_VARS)
    # Present arrays must agree in length; an absent variable is a NULL column.
    n = F.greatest(*[F.coalesce(F.size(h[v]), F.lit(0)) for v in names])
    same = F.lit(True)
    for v in names:
        same = same & (h[v].isNull() | (F.size(h[v]) == n))
    ok = p.where(same).withColumn("_n", n)
    bad = p.where(~same).select(city, payload, F.lit("unequal array lengths").alias("reason"))
    filled = [
        F.coalesce(h[v], F.array_repeat(F.lit(None).cast(t), F.col("_n"))).alias(v)
        for v, t in zip(names, ("string",) + ("double",) * len(HOURLY_VARS))
    ]
    rows = ok.select(city, F.inline(F.arrays_zip(*filled)))
    return rows.select(city, *names), bad


def first_geocode(payloads: DataFrame, key: str = "query", payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """First result of each geocoding payload: (key, name, latitude,
    longitude, country) with a missing country as ''.  Payloads without a
    result go to the second output (key, reason)."""
    p = payloads.select(key, F.from_json(payload, GEOCODE_SCHEMA).alias("_j"))
    first = F.get(F.col("_j.results"), 0)
    found = p.where(first.isNotNull()).select(
        key,
        first["name"].alias("name"),
        first["latitude"].alias("latitude"),
        first["longitude"].alias("longitude"),
        F.coalesce(first["country"], F.lit("")).alias("country"),
    )
    missing = p.where(first.isNull()).select(key, F.lit("no result").alias("reason"))
    return found, missing
