"""The latest of some points at or before each row of a log, without moving the log's rows where the points are few enough to be sent to them."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stored

#: Points of 16 bytes that are sent to every worker at most.
MOST = 4_000_000
#: Points that an expression holds at most.
FEW = 16


def latest_at(log: DataFrame, points: DataFrame, keys: list[str], order: str, value: str, name: str, rows: int = 1_000_000, most: int = MOST) -> DataFrame:
    """Adds to each row of the log the `value` (a whole number) of the last point of the same keys at or before its place, or null.

    points(keys, order, value) are stored and counted. A few are conditions of one expression. Up to `most` of them are sent to the workers as sorted arrays, in which each batch of rows looks its
    places up by halving: only keys and places go to Python, and nothing of the log is shuffled. Beyond that log and points are
    shuffled together into buckets of places, filled in each, with the last point of the buckets before as the carry.
    """
    points = stored(points.select(*keys, F.col(order).cast("bigint").alias(order), F.col(value).cast("bigint").alias("__value")))
    count = points.count()
    if count <= min(FEW, most):
        return log.withColumn(name, _one_of(points, keys, order))
    if count <= most:
        return _looked_up(log, points, keys, order, name)
    marks = points.withColumn("__point", F.struct(F.col("__value").alias("value"))).drop("__value")
    both = log.withColumn("__log", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    found = filled(both, keys, order, "__point", rows, ties=[F.col("__log").isNotNull()])
    return found.where("__log").withColumn(name, F.col("__filled")["value"]).drop("__log", "__point", "__filled")


def _one_of(points: DataFrame, keys: list[str], order: str) -> Column:
    found = F.when(F.lit(False), F.lit(None).cast("bigint"))
    for row in sorted(points.collect(), key=lambda r: r[order], reverse=True):  # counted
        same = [F.col(k).eqNullSafe(F.lit(row[k]).cast(points.schema[k].dataType)) for k in keys]
        found = found.when(reduce(lambda a, b: a & b, same, F.col(order) >= row[order]), F.lit(row["__value"]).cast("bigint"))
    return found


def _looked_up(log: DataFrame, points: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    found = points.toArrow()  # counted
    index: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    code, names = _coded([found[k].combine_chunks() for k in keys], found.num_rows)
    at, value = found[order].to_numpy(), found["__value"].to_numpy()
    by = np.lexsort((at, code))
    for run in np.split(by, np.flatnonzero(np.diff(code[by])) + 1) if len(by) else ():
        index[names[code[run[0]]]] = (at[run], value[run])
    shared = log.sparkSession.sparkContext.broadcast(index)

    def run(place: pa.Array, *own: pa.Array) -> pa.Array:
        place = place.to_numpy(zero_copy_only=False)
        code, names = _coded(list(own), len(place))
        out, known = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        for c in np.unique(code).tolist():
            if names[c] in shared.value:
                rows = np.flatnonzero(code == c)
                at, value = shared.value[names[c]]
                k = np.searchsorted(at, place[rows], side="right") - 1
                out[rows], known[rows] = value[np.maximum(k, 0)], k >= 0
        return pa.array(out, pa.int64(), mask=~known)

    return log.withColumn(name, F.arrow_udf(run, "bigint")(F.col(order).cast("bigint"), *keys))


def _coded(columns: list[pa.Array], n: int) -> tuple[np.ndarray, dict[int, tuple]]:
    """A number for each row's keys, and the keys of each number."""
    code, parts = np.zeros(n, np.int64), []
    for column in columns:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        coded = column.dictionary_encode(null_encoding="encode")
        values = coded.dictionary.to_pylist()
        code = code * max(1, len(values)) + coded.indices.to_numpy()
        parts.append(values)
    names = {}
    for c in np.unique(code).tolist():
        rest, key = c, []
        for values in reversed(parts):
            rest, k = divmod(rest, max(1, len(values)))
            key.append(values[k])
        names[c] = tuple(reversed(key))
    return code, names


def all_filled(log: DataFrame, keys: list[str], order: str, marks: dict[str, Column], last: DataFrame, rows: int) -> DataFrame:
    """Adds for each name the last non-null mark at or before each row, all of them by one shuffle into buckets of `rows` places, without Python. last: of `last_marks`, the same marks and rows."""
    held = log.withColumn("__bucket", F.floor(F.col(order) / rows))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__bucket").alias("__of"), *(F.last(name, ignorenulls=True).over(before).alias(f"__carry_{name}") for name in marks))
    on = F.col("__bucket") == F.col("__of")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    held = held.withColumns({name: F.last(mark, ignorenulls=True).over(inside) for name, mark in marks.items()})
    joined = held.join(broadcast_if_small(stored(carry)), on, "left")
    return joined.withColumns({name: F.coalesce(name, f"__carry_{name}") for name in marks}).drop("__bucket", "__of", *(f"__carry_{name}" for name in marks), *(f"__{k}" for k in keys))


def last_marks(log: DataFrame, keys: list[str], order: str, marks: dict[str, Column], rows: int) -> DataFrame:
    """The last of each mark in each bucket of `rows` places, and as `__count` how many rows of the bucket have a mark: one row a bucket, stored."""
    some = reduce(lambda a, b: a | b, (mark.isNotNull() for mark in marks.values()))
    last = (F.max_by(mark, F.when(mark.isNotNull(), F.col(order))).alias(name) for name, mark in marks.items())
    return stored(log.groupBy(*keys, F.floor(F.col(order) / rows).alias("__bucket")).agg(*last, F.count(F.when(some, 1)).alias("__count")))


def hot(log: DataFrame, keys: list[str], rows: int) -> bool:
    """Whether a key has more than so many rows. An aggregate with map-side combine over the keys alone."""
    return not log.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > rows).isEmpty()


def filled(log: DataFrame, keys: list[str], order: str, mark: str, rows: int, ties: list = (), upto: int = 0) -> DataFrame:
    """Adds __filled: the last non-null `mark` at or before each row, in buckets of places. upto -1: before the row, without its own.

    One window over all rows of a key would be one task. Each bucket is filled by itself, and the last mark of the buckets before comes in from a table
    of one row a bucket. That table is what runs in order, `rows` times smaller than the log.
    """
    held = log.withColumn("__bucket", F.floor(F.col(order) / rows))
    inside = F.last(mark, ignorenulls=True).over(Window.partitionBy(*keys, "__bucket").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, upto))
    last = held.groupBy(*keys, "__bucket").agg(F.max_by(mark, F.when(F.col(mark).isNotNull(), F.struct(order))).alias("__last"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__bucket").alias("__of"), F.last("__last", ignorenulls=True).over(before).alias("__carry")).where("__carry is not null")
    on = F.col("__bucket") == F.col("__of")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    joined = held.withColumn("__inside", inside).join(carry, on, "left")
    return joined.withColumn("__filled", F.coalesce("__inside", "__carry")).drop("__bucket", "__of", "__inside", "__carry", *(f"__{k}" for k in keys))
