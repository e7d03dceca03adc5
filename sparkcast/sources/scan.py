"""Scans with column pruning, landing of CSV and JSON, file manifests, partitioned layers and incremental loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table with a projection, which reaches the files."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def land_csv(spark: SparkSession, path: str, schema: T.StructType | str, resource: str, max_records: int | None = None) -> DataFrame:
    """A CSV file with its provenance: fetched_at, source_url and resource_id."""
    df = spark.read.csv(path, header=True, schema=schema)
    df = df.select("*", F.current_timestamp().alias("fetched_at"), F.col("_metadata.file_path").alias("source_url"), F.lit(resource).alias("resource_id"))
    return df if max_records is None else df.limit(max_records)


def land_columnar_json(df: DataFrame, payload: str, columns: dict[str, str]) -> DataFrame:
    """Rows of payloads {"meta": [names], "data": [[...], ...]}: fields are found by name and cast; bad ones are NULL."""
    parsed = df.select(F.from_json(payload, "struct<meta:array<string>,data:array<array<string>>>").alias("p"))
    rows = parsed.select("p.meta", F.explode("p.data").alias("row"))
    return rows.select(*(F.get("row", (F.array_position("meta", name) - 1).cast("int")).try_cast(kind).alias(name) for name, kind in columns.items()))


def manifest(files: DataFrame, name: str = "name") -> DataFrame:
    """Year, month, day and hour parsed out of file names of the form ...YYYYMMDDTHHMM...; NULL where there is none."""
    part = lambda k: F.nullif(F.regexp_extract(name, r"(\d{4})(\d{2})(\d{2})T(\d{2})\d{2}", k), F.lit("")).cast("int")
    return files.withColumns({"year": part(1), "month": part(2), "day": part(3), "hour": part(4)})


def select_manifest(files: DataFrame, years: list[int], months: list[int], hours: list[int], name: str = "name") -> DataFrame:
    return manifest(files, name).where(F.col("year").isin(years) & F.col("month").isin(months) & F.col("hour").isin(hours))


def latest_partition_only(df: DataFrame, partition: str) -> DataFrame:
    """The rows of the newest value of a partition column."""
    newest = df.agg(F.max(partition).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(partition) == F.col("_newest")).drop("_newest")  # one row


def lean_files(files: DataFrame, name: str = "name", lean: bool = True) -> DataFrame:
    """The files to load: archives if there are any, else whatever is there; with `lean` only those of the newest archive
    year, where one is known. Both questions are one aggregate."""
    archive = F.lower(name).contains("archive")
    year = F.nullif(F.regexp_extract(name, r"archive_(20\d{2})", 1), F.lit("")).cast("int")
    known = files.withColumns({"_archive": archive, "_year": year})
    facts = known.agg(F.max("_archive").alias("_some"), F.max(F.when(F.col("_archive"), F.col("_year"))).alias("_newest"))
    out = known.join(F.broadcast(facts), F.lit(True)).where(F.col("_archive") | ~F.col("_some"))  # one row
    if lean:
        out = out.where(F.col("_newest").isNull() | (F.col("_year") == F.col("_newest")))
    return out.drop("_archive", "_year", "_some", "_newest")


def recent_months(df: DataFrame, now: Column, n: int, ts: str = "ts") -> DataFrame:
    """The present month and the n - 1 before it."""
    return df.where((F.col(ts) >= F.add_months(F.trunc(now.cast("date"), "month"), -(n - 1))) & (F.col(ts) < F.add_months(F.trunc(now.cast("date"), "month"), 1)))


def pending(wanted: DataFrame, state: DataFrame, by: list[str], force: bool = False) -> DataFrame:
    """Items that are not in the state yet or have changed; all of them if forced."""
    return wanted if force else wanted.join(state, by, "left_anti")


def init_schedule(df: DataFrame, start: str, end: str, hours: int) -> DataFrame:
    """A row for every init time from start to end."""
    return df.withColumn("init", F.explode(F.sequence(start, end, F.expr(f"INTERVAL '{hours}' HOUR"))))


def _by_month(df: DataFrame, ts: str) -> DataFrame:
    """df with p_year and p_month, dealt by them; a month of many rows is split over several tasks by its size."""
    parts = df.withColumns({"p_year": F.year(ts), "p_month": F.month(ts)})
    return parts.hint("rebalance", F.col("p_year"), F.col("p_month")).sortWithinPartitions("p_year", "p_month", ts)


def write_layer(df: DataFrame, path: str, ts: str = "ts", max_records: int = 4_000_000, mode: str = "overwrite") -> None:
    """Partitions by p_year and p_month (features may be called month), sorted by time, files of bounded length."""
    _by_month(df, ts).write.mode(mode).option("maxRecordsPerFile", max_records).option("compression", "snappy").partitionBy("p_year", "p_month").parquet(path)


def month_number(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def read_layer(spark: SparkSession, path: str, first: Column | None = None, last: Column | None = None, months: list[int] | None = None) -> DataFrame:
    """A layer, or only its folders from the month of `first` to that of `last`, or those of the given month numbers."""
    df, own = spark.read.parquet(path), F.col("p_year") * 12 + F.col("p_month")
    if first is not None:
        df = df.where(own >= month_number(first))
    if last is not None:
        df = df.where(own <= month_number(last))
    if months is not None:
        df = df.where(own.isin(months) if months else F.lit(False))
    return df.drop("p_year", "p_month")


def recent_layer(spark: SparkSession, path: str, now: Column, n: int, ts: str = "ts") -> DataFrame:
    """The present month and the n - 1 before it, out of a layer of which no other month is read."""
    first = F.add_months(F.trunc(now.cast("date"), "month"), -(n - 1))
    return recent_months(read_layer(spark, path, first, now.cast("date")), now, n, ts)


def pivot_variables(long: DataFrame, by: list[str], name: str, value: str, pattern: str, known: list[str]) -> DataFrame:
    """One column per known variable, whose name is parsed out of a group name; the smallest value if there are several."""
    df = long.withColumn("_v", F.regexp_extract(name, pattern, 1))
    return df.groupBy(*by).pivot("_v", known).agg(F.min(value))


def table_name(stem: str, horizon: int) -> str:
    """Each horizon (in half-hours) has its own table."""
    return f"{stem}_{horizon // 2}h"


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
