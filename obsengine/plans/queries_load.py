"""Queries over CSV records, loads, day partitions and quarantine.

Their files and tables are written to the shared scratch folder from the
driver tables; the oracles say what must come out without any file.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import functions as F

from ..operators import upsert as U
from ..sources import csvrecords as CR
from ..sources import payloads as PL
from . import adapters as AD
from . import batch_job as BJ
from . import daily_tables as DT
from . import standins as SI
from . import tables as TB
from .queries_core import DAILY_PRICE_SQL, WEATHER_ANOMALY_SQL, with_
from .queries_io import _scratch, write_family_csvs
from .queries_store import LI_DESC
from .registry import query, rounded

# -------------------------------------------------------------- CSV records

# Names with quotes, commas, line breaks and texts that look missing.
NAME_SQL = """
nm AS (
  SELECT p_partkey,
         CASE p_size % 5
           WHEN 0 THEN 'The ' || p_size || '" pan, "' || p_name || '"'
           WHEN 1 THEN p_name || chr(10) || chr(10) || '"' || p_brand || '",' || chr(10)|| p_type
           WHEN 2 THEN '"' || p_name
           WHEN 3 THEN CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_name || ',' END
           ELSE p_name END AS product_name,
         p_type
  FROM part)"""


def _names(part):
    size, name = F.col("p_size").cast("string"), F.col("p_name")
    line = F.lit("\n")
    kind = F.col("p_size") % 5
    return part.select(
        "p_partkey",
        F.when(kind == 0, F.concat(F.lit("The "), size, F.lit('" pan, "'), name, F.lit('"')))
        .when(kind == 1, F.concat(name, line, line, F.lit('"'), F.col("p_brand"), F.lit('",'), line, F.col("p_type")))
        .when(kind == 2, F.concat(F.lit('"'), name))
        .when(kind == 3, F.when(F.col("p_partkey") % 2 == 0, F.lit("NA")).otherwise(F.concat(name, F.lit(","))))
        .otherwise(name)
        .alias("product_name"),
        "p_type",
    )


@query("csv_roundtrip", with_(NAME_SQL) + "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, product_name, p_type FROM nm")
def q_csv_roundtrip(spark, sf):
    path = posixpath.join(_scratch(spark, "csv-roundtrip"), "parts_1.csv")
    CR.write_records(_names(AD.table(spark, sf, "part")).repartition(4), path)
    return CR.read_records(spark, path, "parts_*.csv").drop("_file", "_path", "_pos")


@query(
    "file_order_dedup",
    f"""
SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(l_orderkey AS VARCHAR) AS order_no, l_returnflag AS flag
FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {LI_DESC}) AS rn FROM lineitem)
WHERE rn = 1""",
)
def q_file_order_dedup(spark, sf):
    """The last line of the files wins, whatever its values."""
    from ..operators.clean import keep_last

    path = posixpath.join(_scratch(spark, "file-order"), "lines_1.csv")
    lineitem = AD.table(spark, sf, "lineitem")
    _in_file_order(lineitem, lineitem.count()).select(
        F.col("l_partkey").alias("part"), F.col("l_orderkey").alias("order_no"), F.col("l_returnflag").alias("flag")
    ).write.option("header", "true").csv(path)
    rows = CR.read_records(spark, path, "lines_*.csv")
    return keep_last(rows, ["part"], ["_pos"]).select("part", "order_no", "flag")


# Rows of one written file: a task sorts so many, however large the table is.
FILE_ROWS = 500_000


def _in_file_order(lineitem, n_rows: int):
    """Rows whose order in the written files is the line-item order."""
    order = [F.col(c) for c in SI.LINEITEM_ORDER]
    files = max(4, -(-n_rows // FILE_ROWS))
    return lineitem.repartitionByRange(files, *order).sortWithinPartitions(*order)


# -------------------------------------------------------------------- loads

# One products file: a row a line item, names over two lines, some prices
# negative or no number, some times unknown.
LOAD_SQL = """
f AS (
  SELECT concat('https://shop.example/p/', CAST(l_partkey AS VARCHAR)) AS url,
         p_name || ' "' || l_returnflag || '",' || chr(10) || l_linestatus AS product_name, p_type AS source,
         CASE WHEN l_linenumber = 7 THEN 'n/k' WHEN l_returnflag = 'R' THEN '-' ELSE '' END
           || CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS price_gbp,
         l_linestatus AS availability,
         CASE WHEN l_orderkey % 50 = 0 THEN 'unknown'
              ELSE '2024-01-0' || CAST(l_linenumber AS VARCHAR) || 'T10:00:00Z' END AS scraped_at,
         l_linenumber AS line,
         l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem JOIN part ON l_partkey = p_partkey),
t AS (
  SELECT *, TRY_CAST(price_gbp AS DOUBLE) AS price,
         CASE WHEN scraped_at <> 'unknown'
              THEN CAST(replace(replace(scraped_at, 'T', ' '), 'Z', '') AS TIMESTAMP) END AS time
  FROM f)"""


def _products_file(spark, sf, folder: str) -> str:
    li, part = AD.table(spark, sf, "lineitem"), AD.table(spark, sf, "part")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    line = F.col("l_linenumber").cast("string")
    rows = _in_file_order(li.join(part, li.l_partkey == part.p_partkey), li.count()).select(
        F.col("p_type").alias("source"),
        F.concat("p_name", F.lit(' "'), "l_returnflag", F.lit('",\n'), "l_linestatus").alias("product_name"),
        F.when(F.col("l_linenumber") == 7, "n/k").when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), price)).otherwise(price).alias("price_gbp"),
        F.col("l_linestatus").alias("availability"),
        line.alias("rating_1to5"),
        SI.product_url("l_partkey").alias("url"),
        F.when(F.col("l_orderkey") % 50 == 0, "unknown").otherwise(F.concat(F.lit("2024-01-0"), line, F.lit("T10:00:00Z"))).alias("scraped_at"),
    )
    CR.write_records(rows, posixpath.join(folder, "products_2024-05-01.csv"))
    return folder


@query(
    "load_price_facts",
    with_(LOAD_SQL)
    + f"""
, id AS (SELECT url, row_number() OVER (ORDER BY url) AS product_id FROM (SELECT DISTINCT url FROM f))
SELECT product_id, time AS scraped_at, round(CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE), 6) AS price_gbp, availability,
       CAST(CASE WHEN line BETWEEN 1 AND 5 THEN line END AS SMALLINT) AS rating_1to5
FROM (SELECT *, row_number() OVER (PARTITION BY url, time ORDER BY {LI_DESC}) AS rn
      FROM t WHERE price >= 0 AND time IS NOT NULL)
JOIN id USING (url) WHERE rn = 1""",
)
def q_load_price_facts(spark, sf):
    """The facts of a load that is run twice: the second run changes nothing."""
    base = _scratch(spark, "load")
    raw = _products_file(spark, sf, posixpath.join(base, "raw"))
    for _ in range(2):
        BJ.load_warehouse(spark, raw, posixpath.join(base, "wh"), SI.AS_OF)
    return rounded(TB.read_current(spark, posixpath.join(base, "wh"), "fact_price", U.FACT_PRICE))


@query(
    "load_quarantine",
    with_(LOAD_SQL)
    + """
SELECT url, price_gbp, scraped_at,
       concat_ws('; ', CASE WHEN time IS NULL THEN 'time(scraped_at)' END,
                 CASE WHEN price IS NULL THEN 'number(price_gbp)' END,
                 CASE WHEN price < 0 THEN 'check(price_gbp >= 0)' END) AS reasons,
       'products_2024-05-01.csv' AS source_file
FROM t WHERE time IS NULL OR price IS NULL OR price < 0""",
)
def q_load_quarantine(spark, sf):
    base = _scratch(spark, "quarantine")
    wh = posixpath.join(base, "wh")
    BJ.load_warehouse(spark, _products_file(spark, sf, posixpath.join(base, "raw")), wh, SI.AS_OF)
    row = F.from_json("row", "url string, price_gbp string, scraped_at string").alias("r")
    bad = BJ.read_rejects(spark, wh, "fact_price").select(row, "reasons", "source_file")
    return bad.select("r.*", F.array_join("reasons", "; ").alias("reasons"), "source_file")


@query(
    "documents_nested",
    with_(LOAD_SQL)
    + f"""
, head AS (
  SELECT url, product_name, source FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY {LI_DESC}) AS rn FROM f)
  WHERE rn = 1)
SELECT url, head.product_name, head.source, count(*) OVER (PARTITION BY url) AS n_prices, time AS scraped_at,
       round(price, 6) AS price_gbp, availability, CAST(line AS INTEGER) AS rating_1to5
FROM t JOIN head USING (url)""",
)
def q_documents_nested(spark, sf):
    """The written documents, a row a price; the load was tried twice."""
    base = _scratch(spark, "documents")
    raw = _products_file(spark, sf, posixpath.join(base, "raw"))
    for _ in range(2):
        out = BJ.load_documents(spark, raw, posixpath.join(base, "docs"), SI.AS_OF, "2024-05-01")
    docs = spark.read.parquet(out["products"])
    n = docs.groupBy("url").agg(F.sum(F.size("prices")).alias("n_prices"))
    rows = docs.join(n, "url").select("url", "product_name", "source", "n_prices", F.inline("prices"))
    return rounded(rows.select("url", "product_name", "source", "n_prices", "scraped_at", "price_gbp", "availability", "rating_1to5"))


@query(
    "merge_touched_days",
    """
SELECT CAST(CAST(time_at AS DATE) AS VARCHAR) AS day, count(DISTINCT (city_id, time_at)) AS n_rows,
       bool_or(ts >= TIMESTAMP '2024-01-15') AS rewritten
FROM (SELECT c_nationkey AS city_id, date_trunc('hour', ts) AS time_at, ts FROM events JOIN customer ON user_id = c_custkey)
GROUP BY 1""",
)
def q_merge_touched_days(spark, sf):
    """Rows of each day after a load, and whether its files were rewritten."""
    base = _scratch(spark, "merge")
    keys = (["city_id", "time_at"], "time_at", list(U.WEATHER_FACT_MEASURES))
    DT.merge_days(SI.fact_weather(spark, sf), base, "fact", U.FACT_WEATHER, *keys)
    listing = posixpath.join(base, "listing")
    DT.day_files(spark, base, "fact").write.parquet(listing)
    DT.merge_days(SI.weather_batch(spark, sf), base, "fact", U.FACT_WEATHER, *keys, batch_order=["event_id"])
    before = spark.read.parquet(listing).select("path", "mtime").withColumn("old", F.lit(True))
    files = DT.day_files(spark, base, "fact").join(before, ["path", "mtime"], "left")
    files = files.groupBy("day").agg(F.max(F.col("old").isNull()).alias("rewritten"))
    rows = TB.read_days(spark, base, "fact", U.FACT_WEATHER).groupBy("day").agg(F.count("*").alias("n_rows"))
    return rounded(rows.join(files, "day").select("day", "n_rows", "rewritten"))


# ----------------------------------------------------------------- batch job


def _batch_csv(spark, sf, name: str):
    """An output of the batch job, read back as CSV cells."""
    base = _scratch(spark, "batch-cells")
    data, out = posixpath.join(base, "data"), posixpath.join(base, "out")
    write_family_csvs(spark, sf, data)
    BJ.run_batch(spark, data, out, ordinal=lambda raw: F.struct(F.col("ordinal").cast("long")))
    # part files of an output have one layout, but an empty part has no header
    return CR.read_records(spark, posixpath.join(out, name), "*").drop("_file", "_path", "_pos")


@query("batch_daily_cells", DAILY_PRICE_SQL)
def q_batch_daily_cells(spark, sf):
    cells = _batch_csv(spark, sf, "agg/daily_price_stats")
    numbers = [F.col(c).cast("double").alias(c) for c in ("min_price", "avg_price", "max_price", "last_price")]
    return rounded(cells.select("url", "day", *numbers, F.col("n_obs").cast("bigint").alias("n_obs")))


@query("batch_alert_cells", WEATHER_ANOMALY_SQL)
def q_batch_alert_cells(spark, sf):
    cells = _batch_csv(spark, sf, "alerts/weather_anomalies")
    numbers = [F.col(c).cast("double").alias(c) for c in ("temperature_2m", "temp_z", "precipitation", "wind_speed_10m")]
    return rounded(
        cells.select(
            "city", F.col("time").cast("timestamp").alias("time"), *numbers, F.col("precip_outlier").cast("boolean").alias("precip_outlier")
        ).select("city", "time", "temperature_2m", "temp_z", "precipitation", "precip_outlier", "wind_speed_10m")
    )


# ------------------------------------------------------------------ payloads


@query(
    "json_hourly_rejects",
    f"""
WITH r AS (
  SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // {AD.HOURS_PER_PAYLOAD} AS chunk
  FROM events)
SELECT concat('city_', CAST(user_id AS VARCHAR)) AS city, 'unequal array lengths' AS reason, count(*) AS n_times
FROM r WHERE (user_id + chunk) % 13 = 0 GROUP BY user_id, chunk""",
)
def q_json_hourly_rejects(spark, sf):
    """Payloads that can't be read, as a load would quarantine them."""
    _, bad = PL.hourly_rows(AD.hourly_payloads(AD.table(spark, sf, "events")))
    path = posixpath.join(_scratch(spark, "payload-rejects"), "payloads")
    bad.write.parquet(path)
    times = F.size(F.from_json("payload", PL.HOURLY_SCHEMA)["hourly"]["time"]).cast("bigint").alias("n_times")
    return spark.read.parquet(path).select("city", "reason", times)
