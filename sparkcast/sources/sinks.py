"""JSON sinks of published forecasts and histories, in pieces.

A document may hold any number of slots, so it is never a row: it is a run of pieces of at most `rows` slots each, in the order
of (array, piece), whose texts one after the other are the document. Pieces are cut by counted places, which come from a
running count in two levels, so one long series uses many tasks and no row grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.operators.prefix import Running, running

#: Slots in a piece, some 2 MB of records.
PIECE_ROWS = 20_000
#: Folder of a key that is NULL or empty.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def _utc(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX")


def _json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def _pieces(df: DataFrame, by: list[str], ts: str, header: dict[str, Column], arrays: dict[str, Column], rows: int) -> DataFrame:
    """(by, array, piece, n, text): array -1 is the header, then come the arrays, each opened by a piece 0, and a last brace.
    `header` may use the aggregates of a series."""
    own = [f"_a{k}" for k in range(len(arrays))]
    # keys in a struct, which is never NULL itself
    flat = df.select(F.struct(*by).alias("_by"), F.col(ts).alias("_ts"), *(v.alias(a) for a, v in zip(own, arrays.values(), strict=True)))
    placed = running(flat, ["_by"], {"_at": Running("count"), "_of": Running("count", whole=True)}, ts="_ts")
    piece = (F.floor((F.col("_at") - 1) / rows) + 1).alias("_piece")
    cut = placed.groupBy("_by", piece, "_of").agg(F.array_sort(F.collect_list(F.struct("_at", *own))).alias("_r"))  # `rows` at most
    end = F.when(F.col("_piece") * rows >= F.col("_of"), "]").otherwise(",")
    inner = lambda a: F.regexp_extract(_json(F.transform("_r", lambda x: x[a])), r"(?s)^\[(.*)\]$", 1)
    texts = F.inline(F.array(*(F.struct(F.lit(k).alias("array"), F.col("_piece").alias("piece"), F.size("_r").alias("n"), F.concat(inner(a), end).alias("text")) for k, a in enumerate(own))))
    head = df.groupBy(*by).agg(_json(F.struct(*(v.alias(k) for k, v in header.items()))).alias("_head"))
    fixed = [(-1, F.regexp_extract("_head", r"(?s)^(.*)\}$", 1)), *((k, F.lit(f',"{name}":[')) for k, name in enumerate(arrays)), (len(arrays), F.lit("}"))]
    opened = head.select(*by, F.inline(F.array(*(F.struct(F.lit(k).alias("array"), F.lit(0).cast("long").alias("piece"), F.lit(0).alias("n"), t.alias("text")) for k, t in fixed))))
    return opened.union(cut.select("_by.*", texts))


def to_forecast_json(df: DataFrame, by: list[str], columns: list[str], header: dict[str, Column], name: str = "forecast", ts: str = "ts", rows: int = PIECE_ROWS) -> DataFrame:
    """A document per key, in pieces (by, array, piece, n, text): the header, n_points, and the records in time order, numbers
    rounded half-even to 4 places. n is the number of records in a piece. Header columns are constants.

    NULL values are written as null, rows without a time come first, a NULL key is a key; an empty table has no documents.
    """
    record = F.struct(_utc(F.col(ts)).alias("timestamp_utc"), *(F.bround(F.col(c).cast("double"), 4).alias(c) for c in columns))
    return _pieces(df, by, ts, {**header, "n_points": F.count("*")}, {name: record}, rows)


def to_columnar_json(df: DataFrame, by: list[str], columns: dict[str, Column], step: int = 30, ts: str = "ts", rows: int = PIECE_ROWS) -> DataFrame:
    """A document per key, in pieces (by, array, piece, n, text): start, step_min, n, and one array per column in time order,
    with NULL as null. Edge cases as in to_forecast_json."""
    return _pieces(df, by, ts, {"start": _utc(F.min(ts)), "step_min": F.lit(step), "n": F.count("*")}, columns, rows)


def write_documents(pieces: DataFrame, by: list[str], path: str) -> None:
    """Writes pieces as text, a folder per key. The files of a folder in the order of their names, one after the other, are the
    key's document; line breaks lie between pieces only. Keys are dealt by ranges of pieces, so a long document is written by
    many tasks."""
    # names that are never NULL: otherwise Spark would sort anew, by the folders alone
    named = pieces.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit(NO_KEY)) for k in by})
    order = [*by, "array", "piece"]
    named.repartitionByRange(*order).sortWithinPartitions(*order).select(*by, "text").write.partitionBy(*by).text(path)
