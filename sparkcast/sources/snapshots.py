"""Layers as snapshots: parts that never change, and a manifest for each version that names the parts it is made of.

A layer is a folder with part=N/p_year=Y/p_month=M/*.parquet and _manifest/VERSION.json. A writer adds a part and then commits
a manifest by a rename, so a job that dies on its way leaves the last version as it was. A reader opens one version and keeps
seeing it whatever is written meanwhile. A manifest says which months of a part count, so months are replaced without touching
others; and small parts of new rows may lie over older ones (`append_batch`): the freshest row of a key is picked when they are
read, and `compact` merges them once a month has many. A layer has one writer at a time. `vacuum` deletes what no kept version
names.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.operators.grid import dedup_latest
from sparkcast.operators.quality import check

MAX_RECORDS = 4_000_000


@dataclass(frozen=True)
class Part:
    """A part's number, the months of it that count, and the streaming batch that it holds, if any."""

    number: int
    months: tuple[int, ...]
    batch: int | None = None


@dataclass(frozen=True)
class Snapshot:
    """A version of a layer; `batch` is the last streaming batch that has been taken in."""

    version: int = 0
    parts: tuple[Part, ...] = ()
    batch: int = -1
    schema: str | None = None

    def without(self, months: Iterable[int]) -> tuple[Part, ...]:
        gone = set(months)
        left = (replace(p, months=tuple(m for m in p.months if m not in gone)) for p in self.parts)
        return tuple(p for p in left if p.months)

    def holders(self, months: Iterable[int] | None = None) -> dict[int, list[int]]:
        """The numbers of the parts that hold each month."""
        wanted, out = None if months is None else set(months), {}
        for p in self.parts:
            for m in p.months:
                if wanted is None or m in wanted:
                    out.setdefault(m, []).append(p.number)
        return out


class _Folder:
    """Names and small files of a folder in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.fs = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def names(self, name: str = "") -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(name))] if self.fs.exists(self.at(name)) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """The whole file or none: it is written under another name first. Raises if it is there."""
        aside = self.at(f"{name}.new")
        stream = self.fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.at(name)) or not self.fs.rename(aside, self.at(name)):
            raise FileExistsError(f"{self.path}/{name} is there: another job has written to this layer")

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def month_of(ts: Column) -> Column:
    """A month's number; rows without a time are in month 0."""
    return F.coalesce(F.year(ts) * 12 + F.month(ts) - 1, F.lit(0))


def _versions(folder: _Folder) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in folder.names("_manifest") if n.endswith(".json"))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The last version of a layer, or the given one; an empty snapshot where there is no layer."""
    folder = _Folder(spark, path)
    versions = _versions(folder)
    if version is None and not versions:
        return Snapshot()
    raw = json.loads(folder.text(f"_manifest/{version or versions[-1]:010d}.json"))
    return Snapshot(raw["version"], tuple(Part(p["number"], tuple(p["months"]), p["batch"]) for p in raw["parts"]), raw["batch"], raw["schema"])


def _commit(spark: SparkSession, path: str, new: Snapshot) -> Snapshot:
    _Folder(spark, path).put(f"_manifest/{new.version:010d}.json", json.dumps(asdict(new)))
    return new


def _add(df: DataFrame, path: str, ts: str, batch: int | None = None) -> Part:
    """Writes df as a part that no version names yet; a large month is split over several tasks by its size."""
    folder = _Folder(df.sparkSession, path)
    number = 1 + max((int(n[5:]) for n in folder.names() if n.startswith("part=")), default=0)
    rows = df.withColumns({"p_year": F.floor(month_of(F.col(ts)) / 12).cast("int"), "p_month": (month_of(F.col(ts)) % 12 + 1).cast("int")})
    rows = rows.hint("rebalance", F.col("p_year"), F.col("p_month")).sortWithinPartitions("p_year", "p_month", ts)
    rows.write.option("maxRecordsPerFile", MAX_RECORDS).partitionBy("p_year", "p_month").parquet(f"{path}/part={number}")
    value = lambda name: int(name.partition("=")[2])
    months = [12 * value(y) + value(m) - 1 for y in folder.names(f"part={number}") if "=" in y for m in folder.names(f"part={number}/{y}") if "=" in m]
    return Part(number, tuple(sorted(months)), batch)


def _same_columns(at: Snapshot, df: DataFrame) -> None:
    if at.schema is not None and [(f.name, f.dataType) for f in T.StructType.fromJson(json.loads(at.schema))] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError("the rows don't have the layer's columns")


def read(spark: SparkSession, path: str, at: Snapshot | None = None, months: Iterable[int] | None = None, keys: list[str] | None = None, stamp: str | None = None) -> DataFrame:
    """A version of a layer, the last one by default, or only some months of it; other folders are not touched.

    With keys, which hold the time, one row of each is given: the one with the newest stamp, a NULL stamp counting as newest,
    and of these the one written last. Months that lie in a single part need no such choice.
    """
    at = at or snapshot(spark, path)
    if at.schema is None:
        raise FileNotFoundError(f"no layer at {path}")
    schema = T.StructType.fromJson(json.loads(at.schema))
    full = T.StructType([*schema.fields, T.StructField("part", T.IntegerType()), T.StructField("p_year", T.IntegerType()), T.StructField("p_month", T.IntegerType())])

    def rows(holders: dict[int, list[int]]) -> DataFrame:
        folders = [f"{path}/part={n}/p_year={m // 12}/p_month={m % 12 + 1}" for m, parts in holders.items() for n in parts]
        return spark.read.schema(full).option("basePath", path).parquet(*folders) if folders else spark.createDataFrame([], full)

    holders = at.holders(months)
    over = {m: parts for m, parts in holders.items() if len(parts) > 1 and keys is not None}
    plain = rows({m: parts for m, parts in holders.items() if m not in over}).select(*schema.names)
    if not over:
        return plain
    order = [F.col(stamp).isNull().alias("none"), F.col(stamp).alias("stamp")] if stamp else []
    merged = rows(over).select(*schema.names, F.struct(*order, "part").alias("_at"))
    return plain.union(dedup_latest(merged, keys, "_at").select(*schema.names))


def read_batch(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The rows of one streaming batch, as long as no compaction has merged them."""
    at = snapshot(spark, path)
    return read(spark, path, replace(at, parts=tuple(p for p in at.parts if p.batch == number)))


def publish(df: DataFrame, path: str, rules: dict[str, Column], unique: list[str], warn: set[str] = frozenset(), ts: str = "ts") -> dict[str, int]:
    """Writes a built table as a new part, validates what was written, and makes it the layer's whole content.

    A violated hard rule raises, and so does a job that fails: the last version stays as it was, and is what readers see.
    """
    spark, at = df.sparkSession, snapshot(df.sparkSession, path)
    part = _add(df, path, ts)
    new = Snapshot(at.version + 1, (part,), at.batch, df.schema.json())
    found = check(read(spark, path, new), rules, unique, warn)
    _commit(spark, path, new)
    return found


def overwrite_months(df: DataFrame, path: str, ts: str = "ts") -> Snapshot:
    """Replaces the months that df touches, which df must hold whole; the others stay as they are. Makes the layer if there is
    none."""
    at = snapshot(df.sparkSession, path)
    _same_columns(at, df)
    part = _add(df, path, ts)
    return _commit(df.sparkSession, path, Snapshot(at.version + 1, (*at.without(part.months), part), at.batch, at.schema or df.schema.json()))


def append_batch(df: DataFrame, path: str, number: int, ts: str = "ts") -> Snapshot:
    """Lays the rows of a streaming batch over the layer; a batch that has been taken in already is not written again. What is
    written is the batch, however large its months are."""
    at = snapshot(df.sparkSession, path)
    if number <= at.batch:
        return at
    _same_columns(at, df)
    part = _add(df, path, ts, number)
    return _commit(df.sparkSession, path, Snapshot(at.version + 1, (*at.parts, part) if part.months else at.parts, number, at.schema or df.schema.json()))


def compact(spark: SparkSession, path: str, keys: list[str], stamp: str | None = None, ts: str = "ts", most: int = 4) -> Snapshot:
    """Merges the months that lie in more than `most` parts, each into a new part. Rows don't change, for readers."""
    at = snapshot(spark, path)
    many = [m for m, parts in at.holders().items() if len(parts) > most]
    if not many:
        return at
    part = _add(read(spark, path, at, many, keys, stamp), path, ts)
    return _commit(spark, path, Snapshot(at.version + 1, (*at.without(many), part), at.batch, at.schema))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Deletes versions but the last `keep`, and parts that none of these names, such as those of failed jobs. Returns the
    parts deleted."""
    folder = _Folder(spark, path)
    versions = _versions(folder)
    named = {p.number for v in versions[-keep:] for p in snapshot(spark, path, v).parts}
    gone = sorted(n for n in (int(x[5:]) for x in folder.names() if x.startswith("part=")) if n not in named)
    for v in versions[:-keep]:
        folder.remove(f"_manifest/{v:010d}.json")
    for n in gone:
        folder.remove(f"part={n}")
    return gone
