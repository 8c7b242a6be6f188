"""Keyed mutation: the next version of a table from its current version and
a batch (insert-or-update by key, update by predicate, delete by join).

Plain parquet tables take no MERGE/UPDATE/DELETE, so every operator here is
a pure ``DataFrame -> DataFrame`` function; the caller writes the result as
the new table version.

Plan shape of ``upsert``: without surrogate ids, one full outer join of the
current rows with the deduplicated batch, each read once; the caller passes
only the days that the batch touches (``plans.daily_tables``).  With surrogate
ids the table is joined *left* to the batch (broadcast where it measures
small), and new keys are found by a semi join of the table's key columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import keep_last
from .ranking import dense_ids

B = "_b_"  # prefix of batch columns inside match expressions


def batch_col(name: str) -> Column:
    """Refer to the batch's value of ``name`` inside a ``match_sets`` expression."""
    return F.col(B + name)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    *,
    batch_order: Sequence[str] | None = None,
    match_sets: Mapping[str, Column] | None = None,
    insert_sets: Mapping[str, Column] | None = None,
    id_col: str | None = None,
    id_order: Sequence[str] | None = None,
) -> DataFrame:
    """Insert-or-update ``batch`` into ``target`` by ``keys``.

    * the batch keeps its last row per key in ``batch_order`` (several rows
      for one key: the last wins; without an order, the last by its values);
    * matched rows take ``update_cols`` from the batch (a NULL overwrites),
      plus ``match_sets`` (column -> expression over target columns and
      ``batch_col(..)``); every other column keeps the target's value;
    * new keys become rows from the batch's columns plus ``insert_sets``;
      columns the batch lacks are NULL;
    * with ``id_col``, new rows get gap-free ids after the current maximum,
      numbered in ``id_order`` (default: ``keys``).

    Keys are NOT NULL on both sides (primary-key semantics).
    """
    keys = list(keys)
    cols = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    match_sets = dict(match_sets or {})
    insert_sets = dict(insert_sets or {})

    # without an order the last by the rows' values is one row a key, too
    b = keep_last(batch, keys, list(batch_order or [c for c in batch.columns if c not in keys] or keys))

    def insert_value(c: str, prefix: str) -> Column:
        if c in insert_sets:
            return insert_sets[c]
        return F.col(prefix + c) if c in b.columns else F.lit(None)

    def matched_value(c: str) -> Column:
        if c in match_sets:
            return match_sets[c]
        if c in update_cols:
            return F.col(B + c)
        return F.col(c)

    bb = b.select(*[F.col(c).alias(B + c) for c in b.columns])
    cond = _and([F.col(k) == F.col(B + k) for k in keys])
    hit = F.col(B + keys[0]).isNotNull()
    if not id_col:
        # one join for both: rows of the table, and keys that only the batch has
        known = F.col(keys[0]).isNotNull()
        return target.join(bb, on=cond, how="full_outer").select(
            *[
                F.when(hit & known, matched_value(c)).when(hit, insert_value(c, B)).otherwise(F.col(c)).cast(types[c]).alias(c)
                for c in cols
            ]
        )

    joined = target.join(bb, on=cond, how="left")
    updated = joined.select(
        *[F.when(hit, matched_value(c)).otherwise(F.col(c)).cast(types[c]).alias(c) for c in cols]
    )
    present = target.select(*keys).join(b.select(*keys), on=keys, how="left_semi")
    new = b.join(present, on=keys, how="left_anti")
    start = _next_id(target, id_col)
    new = dense_ids(new, list(id_order or keys), start=start, id_col="_new_id")
    insert_sets.setdefault(id_col, F.col("_new_id"))
    inserted = new.select(*[insert_value(c, "").cast(types[c]).alias(c) for c in cols])
    return updated.unionByName(inserted)


def _next_id(target: DataFrame, id_col: str) -> int:
    """Current maximum id + 1 (one scalar aggregate; 1 for an empty table)."""
    row = target.agg(F.max(id_col).alias("m")).first()
    return int(row["m"]) + 1 if row and row["m"] is not None else 1


def lookup_key(
    rows: DataFrame, dim: DataFrame, on: Sequence[str] | str, key_col: str
) -> DataFrame:
    """Attach ``dim``'s surrogate key to ``rows`` by natural key; rows without
    a match are dropped (inner join).  The dimension has one row per key: it
    is broadcast when it measures small, and otherwise a hot key's rows are
    split by the adaptive skew join, so no hot-key count is paid here."""
    on = [on] if isinstance(on, str) else list(on)
    return rows.join(dim.select(*on, key_col), on=on, how="inner")


def lookup_single_key(
    rows: DataFrame, dim: DataFrame, on: Sequence[str] | str, key_col: str
) -> tuple[DataFrame, DataFrame]:
    """Like ``lookup_key`` but a natural key must match exactly one dim row.

    Returns (matched rows, rejected rows with a ``reason`` column: 'no match'
    or 'ambiguous').
    """
    j = single_key(rows, dim, on, key_col)
    ok = j.where(F.col("reason").isNull()).drop("reason")
    bad = j.where(F.col("reason").isNotNull()).select(*rows.columns, "reason")
    return ok, bad


def single_key(rows: DataFrame, dim: DataFrame, on: Sequence[str] | str, key_col: str) -> DataFrame:
    """All rows with the key of ``lookup_single_key`` and its ``reason``, which
    is NULL where the natural key matches exactly one dim row."""
    on = [on] if isinstance(on, str) else list(on)
    ids = dim.groupBy(*on).agg(F.count(F.lit(1)).alias("_m"), F.min(key_col).alias(key_col))
    reason = F.when(F.col("_m").isNull(), F.lit("no match")).when(F.col("_m") > 1, F.lit("ambiguous"))
    return rows.join(ids, on=on, how="left").withColumn("reason", reason).drop("_m")


def semi_filter(rows: DataFrame, members: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is in ``members`` (``key = ANY(list)``)."""
    return rows.join(members, on=on, how="left_semi")


def update_where(df: DataFrame, pred: Column, sets: Mapping[str, Column]) -> DataFrame:
    """``UPDATE df SET sets WHERE pred``: same rows, changed values where
    ``pred`` holds (a NULL predicate changes nothing)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    hit = F.coalesce(pred, F.lit(False))
    return df.select(
        *[
            (F.when(hit, sets[c]).otherwise(F.col(c)).cast(types[c]) if c in sets else F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def delete_using(df: DataFrame, doomed: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """``DELETE FROM df USING ...``: drop the rows whose key is in ``doomed``."""
    return df.join(doomed, on=on, how="left_anti")


def _and(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


# ------------------------------------------------------------ star schema

DIM_PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("first_seen_at", T.TimestampType()),
        T.StructField("last_seen_at", T.TimestampType()),
    ]
)
FACT_PRICE = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("price_gbp", T.DecimalType(10, 2)),
        T.StructField("availability", T.StringType()),
        T.StructField("rating_1to5", T.ShortType()),
    ]
)
DIM_CITY = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("latitude", T.DecimalType(8, 5)),
        T.StructField("longitude", T.DecimalType(8, 5)),
    ]
)
FACT_WEATHER = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("time_at", T.TimestampType()),
        T.StructField("temperature_2m", T.DecimalType(5, 2)),
        T.StructField("relative_humidity_2m", T.DecimalType(5, 2)),
        T.StructField("precipitation", T.DecimalType(6, 2)),
        T.StructField("wind_speed_10m", T.DecimalType(6, 2)),
    ]
)


def upsert_dim_product(target: DataFrame, batch: DataFrame, as_of, batch_order=None) -> DataFrame:
    """Product dimension by url: a known url gets the batch's name and
    source and ``last_seen_at = as_of`` (id and first_seen_at kept); a new url
    gets the next id and first_seen_at = last_seen_at = as_of."""
    ts = F.lit(as_of).cast(target.schema["last_seen_at"].dataType)
    return upsert(
        target,
        batch.select("url", "product_name", "source", *(batch_order or [])),
        ["url"],
        ["product_name", "source"],
        batch_order=batch_order,
        match_sets={"last_seen_at": ts},
        insert_sets={"first_seen_at": ts, "last_seen_at": ts},
        id_col="product_id",
        id_order=["url"],
    )


def conform_price_rows(batch: DataFrame) -> DataFrame:
    """Fact-bound price rows: negative prices dropped, rating outside [1, 5]
    NULL, rating as a small integer, price as NUMERIC(10,2)."""
    price = F.col("price_gbp").try_cast("double")
    rating = F.col("rating_1to5").try_cast("double")
    return batch.where(price.isNull() | (price >= 0)).withColumns(
        {
            "price_gbp": price.try_cast(T.DecimalType(10, 2)),
            "rating_1to5": F.when(rating.between(1, 5), rating).try_cast("smallint"),
        }
    )


def upsert_fact_price(target: DataFrame, dim: DataFrame, batch: DataFrame, batch_order) -> DataFrame:
    """Price fact by (product_id, scraped_at): batch urls are looked up in
    the dimension (unknown urls dropped), rows conformed, and price,
    availability and rating overwrite (a NULL overwrites too)."""
    rows = lookup_key(conform_price_rows(batch), dim, "url", "product_id")
    # Key columns are NOT NULL in the fact: a row without a time cannot land.
    rows = rows.where(F.col("scraped_at").isNotNull()).select(
        "product_id", "scraped_at", "price_gbp", "availability", "rating_1to5", *batch_order
    )
    return upsert(
        target,
        rows,
        ["product_id", "scraped_at"],
        ["price_gbp", "availability", "rating_1to5"],
        batch_order=batch_order,
    )


def upsert_dim_city(target: DataFrame, batch: DataFrame, batch_order=None) -> DataFrame:
    """City dimension by (city_name, country); a missing country is ''.
    Latitude and longitude overwrite (NULL too); new cities get the next id."""
    b = batch.withColumn("country", F.coalesce(F.col("country"), F.lit("")))
    return upsert(
        target,
        b,
        ["city_name", "country"],
        ["latitude", "longitude"],
        batch_order=batch_order,
        id_col="city_id",
        id_order=["city_name", "country"],
    )


#: The hourly measures and their types in the fact.
WEATHER_TYPES = {f.name: f.dataType.simpleString() for f in FACT_WEATHER.fields[2:]}
WEATHER_FACT_MEASURES = tuple(WEATHER_TYPES)


def upsert_fact_weather(target: DataFrame, batch: DataFrame, batch_order=None) -> DataFrame:
    """Hourly weather fact by (city_id, time_at): the four measures overwrite."""
    return upsert(
        target,
        batch.where(F.col("city_id").isNotNull() & F.col("time_at").isNotNull()),
        ["city_id", "time_at"],
        list(WEATHER_FACT_MEASURES),
        batch_order=batch_order,
    )
