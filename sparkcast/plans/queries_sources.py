"""Queries of sources, landing, manifests, incremental loads and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.functions import columns as fn
from sparkcast.plans import feeds
from sparkcast.plans.feeds import KEYS, sql
from sparkcast.plans.register import query
from sparkcast.sources import scan, sinks, snapshots
from sparkcast.sources.scratch import scratch_path

_NAMES = "SELECT event_id, 'nwp_' || strftime(ts, '%Y%m%dT%H%M') || '_' || event_type AS name FROM events"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", F.concat(F.lit("nwp_"), F.date_format("ts", "yyyyMMdd'T'HHmm"), F.lit("_"), "event_type").alias("name"))


@query("SELECT o_orderkey, o_totalprice, 'orders' AS source_url, 'orders' AS resource_id FROM orders")
def csv_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table written as CSV and landed with its provenance (times and paths differ from run to run)."""
    path = scratch_path(spark, "csv")
    spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice").write.option("header", True).csv(path)
    return scan.land_csv(spark, path, "o_orderkey long, o_totalprice double", "orders").withColumn("source_url", F.lit("orders")).drop("fetched_at")


@query("SELECT o_custkey AS cust, o_orderkey AS id, o_totalprice AS price, CAST(NULL AS DOUBLE) AS bad FROM orders")
def json_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One columnar payload per customer, landed as typed rows; text that is no number becomes NULL."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    row = F.array(F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"), F.lit("n/a"), F.col("o_custkey").cast("string"))
    packed = o.groupBy("o_custkey").agg(F.collect_list(row).alias("data"))
    payload = packed.select(F.to_json(F.struct(F.array(*map(F.lit, ("id", "price", "bad", "cust"))).alias("meta"), "data")).alias("payload"))
    return scan.land_columnar_json(payload, "payload", {"cust": "bigint", "id": "bigint", "price": "double", "bad": "double"})


@query(f"""SELECT event_id, name, CAST(substr(name, 5, 4) AS INTEGER) AS year, CAST(substr(name, 9, 2) AS INTEGER) AS month, CAST(substr(name, 11, 2) AS INTEGER) AS day,
    CAST(substr(name, 14, 2) AS INTEGER) AS hour FROM ({_NAMES}) WHERE substr(name, 5, 4) = '2024' AND substr(name, 9, 2) = '01' AND substr(name, 14, 2) IN ('00', '06', '12')""")
def manifest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.select_manifest(_names(spark, sf_dir), [2024], [1], [0, 6, 12])


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return scan.latest_partition_only(o, "year")


@query("SELECT o_orderkey, 'feed/Archive_' || year(o_orderdate) + 5 || '.parquet' AS name FROM orders WHERE o_orderkey % 3 <> 0 AND year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders WHERE o_orderkey % 3 <> 0)")
def lean_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a feed: archives go before the latest ones, and only those of the newest year stay."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("feed/latest_"), F.year("o_orderdate") + 9)).otherwise(F.concat(F.lit("feed/archive_"), F.year("o_orderdate") + 5))
    files = o.select("o_orderkey", F.concat(name, F.lit(".parquet")).alias("name"))
    return scan.lean_files(files).withColumn("name", F.replace("name", F.lit("archive"), F.lit("Archive")))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
def incremental_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose order is not done yet."""
    done = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return scan.pending(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber"), done, ["l_orderkey"])


@query("SELECT event_type, unnest(generate_series(date_trunc('day', lo), hi, INTERVAL 6 HOUR)) AS init FROM (SELECT event_type, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY event_type)")
def init_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz").alias("lo"), F.max("ts").alias("hi"))
    return scan.init_schedule(b, "lo", "hi", 6).select("event_type", "init")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-05-01' AND o_orderdate < DATE '1998-08-01'")
def recent_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months up to July 1998 out of a layer by month; no other folder is read."""
    path = scratch_path(spark, "months")
    scan.write_layer(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate"), path, "o_orderdate")
    return scan.recent_layer(spark, path, F.lit("1998-07-15"), 3, "o_orderdate")


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders written by month and read again."""
    path = scratch_path(spark, "layer")
    scan.write_layer(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderdate"), path, "o_orderdate")
    return scan.read_layer(spark, path).select("o_orderkey", "o_totalprice", "o_orderdate")


@query("SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1997 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, o_orderdate FROM orders")
def overwrite_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months from 1997 on written anew, with other values; earlier ones stay."""
    path, o = scratch_path(spark, "recent"), spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderdate")
    snapshots.overwrite_months(o, path, "o_orderdate")
    snapshots.overwrite_months(o.where(F.year("o_orderdate") >= 1997).withColumn("o_totalprice", -F.col("o_totalprice")), path, "o_orderdate")
    snapshots.vacuum(spark, path, keep=1)
    return snapshots.read(spark, path).select("o_orderkey", "o_totalprice", "o_orderdate")


@query("SELECT event_id, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS good, CAST(NULL AS TIMESTAMP) AS bad FROM events")
def utc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"), F.when(F.col("event_id") % 2 == 0, "2024-02-30T00:00:00Z").otherwise(F.col("event_type")).alias("b"))
    return e.select("event_id", fn.parse_utc("t").cast("timestamp_ntz").alias("good"), fn.parse_utc("b").cast("timestamp_ntz").alias("bad"))


@query("SELECT event_id, date_trunc('minute', ts) AS at FROM events")
def date_time_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("d"), F.date_format("ts", "HH:mm").alias("t"))
    return e.select("event_id", fn.combine("d", "t").cast("timestamp_ntz").alias("at"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(value AS FLOAT) END AS value FROM events")
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as text, every third one no number."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.when(F.col("event_id") % 6 == 0, "n/a").when(F.col("event_id") % 3 == 0, "NaN").otherwise(F.col("value").cast("string"))
    return e.select("event_id", fn.numeric(text).alias("value"))


@query("SELECT DISTINCT p_name, trim(lower(regexp_replace(p_name, '[^0-9A-Za-z]+', '_', 'g')), '_') AS slug FROM (SELECT p_name || ' (' || p_type || ')!' AS p_name FROM part)")
def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")!")).alias("p_name")).distinct()
    return names.select("p_name", fn.slug("p_name").alias("slug"))


@query("SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY ALL")
def month_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.groupBy(F.date_trunc("month", "o_orderdate").alias("month")).agg(F.count("*").alias("n"))


@query("""SELECT l_suppkey, min(l_quantity) FILTER (WHERE l_returnflag = 'A') AS "A", min(l_quantity) FILTER (WHERE l_returnflag = 'N') AS "N", min(l_quantity) FILTER (WHERE l_returnflag = 'R') AS "R" FROM lineitem GROUP BY l_suppkey""")
def pivot_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per variable, its name parsed out of a group name."""
    long = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", F.concat(F.lit("grp/"), "l_returnflag", F.lit("/level0")).alias("g"), "l_quantity")
    return scan.pivot_variables(long, ["l_suppkey"], "g", "l_quantity", r"^grp/(\w+)/", ["A", "N", "R"])


@query(sql("SELECT region, ts, total FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY ts) AS k FROM spine) WHERE k <= 480 AND (k - 1) % 4 = 0", "spine"))
def first_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth of a region's first 480 slots."""
    from sparkcast.operators.grid import by_time

    s = feeds.spine(spark, sf_dir).withColumn("k", F.row_number().over(by_time(KEYS)))
    return s.where("k <= 480 and (k - 1) % 4 = 0").select("region", "ts", "total")


_RECORDS = ["q10", "q50", "q90", "base", "y"]


@query(sql(f"""SELECT region, '2024-01-20T00:00:00Z' AS generated_at, 24 AS horizon_h, 'seasonal' AS model, count(*) OVER (PARTITION BY region) AS n_points, (row_number() OVER w - 1) // 1000 + 1 AS piece,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp_utc, {", ".join(f"round_even({c}, 4) AS {c}" for c in _RECORDS)} FROM forecast WINDOW w AS (PARTITION BY region ORDER BY ts)""", "forecast"))
def forecast_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast document per region, in pieces of 1000 slots, written and read back: header and records."""
    header = {"generated_at": F.lit("2024-01-20T00:00:00Z"), "horizon_h": F.lit(24), "model": F.lit("seasonal")}
    d = _written(spark, sinks.to_forecast_json(feeds.forecast(spark, sf_dir), KEYS, _RECORDS, header, rows=1000))
    head = d.where("array = -1").select("region", F.from_json(F.concat("text", F.lit("}")), "generated_at string, horizon_h int, model string, n_points long").alias("h"))
    records = _values(d.where("array = 0 and piece > 0"), "struct<timestamp_utc: string, " + ", ".join(f"{c}: double" for c in _RECORDS) + ">")
    return records.join(head, "region").select("region", "h.*", "piece", "v.*")


_SHOWN = {"actual": "y", "q50": "q50", "cap": "capacity * 10"}


@query(sql(f"""SELECT region, strftime(min(ts) OVER (PARTITION BY region), '%Y-%m-%dT%H:%M:%SZ') AS start, 30 AS step_min, count(*) OVER (PARTITION BY region) AS n, row_number() OVER w - 1 AS place,
    {", ".join(f"round_even({v}, 0)::BIGINT AS {c}" for c, v in _SHOWN.items())} FROM forecast WINDOW w AS (PARTITION BY region ORDER BY ts)""", "forecast"))
def history_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columnar history per region in display units, in pieces of 1000 slots, written and read back: header and columns."""
    columns = {"actual": fn.display_int(F.col("y")), "q50": fn.display_int(F.col("q50")), "cap": fn.display_int(F.col("capacity"), 10.0)}
    d = _written(spark, sinks.to_columnar_json(feeds.forecast(spark, sf_dir), KEYS, columns, rows=1000))
    head = d.where("array = -1").select("region", F.from_json(F.concat("text", F.lit("}")), "start string, step_min int, n long").alias("h"))
    values = _values(d.where(f"array between 0 and {len(columns) - 1} and piece > 0"), "bigint")
    places = values.groupBy("region", ((F.col("piece") - 1) * 1000 + F.col("k")).alias("place"))
    wide = places.agg(*(F.max(F.when(F.col("array") == k, F.col("v"))).alias(c) for k, c in enumerate(columns)))
    return wide.join(head, "region").select("region", "h.*", "place", *columns)


def _written(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    path = scratch_path(spark, "pieces")
    pieces.write.parquet(path)
    return spark.read.parquet(path)


def _values(pieces: DataFrame, kind: str) -> DataFrame:
    """The values of pieces of arrays, each with its place in the piece."""
    values = F.from_json(F.concat(F.lit("["), F.regexp_replace("text", r"[,\]]$", ""), F.lit("]")), f"array<{kind}>")
    return pieces.select("region", "array", "piece", F.posexplode(values).alias("k", "v"))


@query(sql("SELECT region, ts, round_even(y * 10 - 273.15, 0)::BIGINT AS y10, round_even(q50, 4) AS q50 FROM forecast", "forecast"))
def display_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.forecast(spark, sf_dir).select("region", "ts", fn.display_int(F.col("y"), 10.0, -273.15).alias("y10"), F.bround("q50", 4).alias("q50"))
