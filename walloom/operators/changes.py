"""Filters on changes, and the versions of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stored
from . import asof

DATA = ("insert", "update", "delete", "truncate")


def data_changes(messages: DataFrame, column: str = "type") -> DataFrame:
    return messages.where(F.col(column).isin(*DATA))


def published(changes: DataFrame, operations: list[str], tables: DataFrame | None = None, column: str = "op") -> DataFrame:
    """Changes of a publication: its operations and, where given, its tables(schema, table), a list that is measured before it is broadcast."""
    kept = changes.where(F.col(column).isin(operations))
    return kept.join(broadcast_if_small(stored(tables)), ["schema", "table"], "left_semi") if tables is not None else kept


def logical_messages(messages: DataFrame, prefix: str | None = None, transactional: bool | None = None) -> DataFrame:
    kept = messages.where(F.col("type") == "message")
    kept = kept.where(F.col("prefix") == prefix) if prefix is not None else kept
    return kept.where(F.col("transactional") == transactional) if transactional is not None else kept


def acknowledgeable(messages: DataFrame) -> DataFrame:
    """Messages after which a consumer may confirm: commits, and aborts that carry a position."""
    return messages.where(F.col("type").isin("commit", "stream_commit") | F.col("abort_lsn").isNotNull())


def from_position(changes: DataFrame, start: int, column: str = "commit_lsn") -> DataFrame:
    """Whole transactions that commit at or after a position; 0 is the oldest."""
    return changes.where(F.col(column) >= start)


def toasted(changes: DataFrame, flags: list[str]) -> DataFrame:
    return changes.where(F.exists(F.array(*flags), lambda x: x))


def previous_versions(changes: DataFrame, keys: list[str], columns: list[str], order: str, prefix: str = "old_", rows: int = 1_000_000) -> DataFrame:
    """Each change with the row before it, for logs that carry no old row; null for a row's first version.

    A window over each key; where a key has more than `rows` changes, over buckets of that many positions, with the last row of the buckets before as the carry.
    """
    held = changes.withColumn("__row", F.struct(*columns))
    if asof.hot(changes, keys, rows):
        held = asof.filled(held, keys, order, "__row", rows, upto=-1).withColumnRenamed("__filled", "__old")
    else:
        held = held.withColumn("__old", F.lag("__row").over(Window.partitionBy(*keys).orderBy(order)))
    return held.select("*", *(F.col("__old")[c].alias(prefix + c) for c in columns)).drop("__old", "__row")


def filled(changes: DataFrame, keys: list[str], columns: dict[str, str], order: str, rows: int = 1_000_000) -> DataFrame:
    """Unchanged large values replaced by the last known value of the row. columns: value column -> flag of the marker.

    A null that was written wins over older values: values are wrapped before the fill. Keys with more than `rows` changes are filled as in `previous_versions`.
    """
    many = asof.hot(changes, keys, rows)
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    for column, flag in columns.items():
        known = F.when(~F.col(flag), F.struct(F.col(column).alias("v")))
        if many:
            changes = asof.filled(changes.withColumn("__known", known), keys, order, "__known", rows).withColumn(column, F.col("__filled")["v"]).drop("__known", "__filled")
        else:
            changes = changes.withColumn(column, F.last(known, ignorenulls=True).over(window)["v"])
    return changes


def without_redundant(changes: DataFrame, columns: list[str], prefix: str = "old_") -> DataFrame:
    """Drops updates whose new row equals the old one, nulls counting as equal."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(prefix + c))
    return changes.where(~((F.col("op") == "update") & same))


def changed_columns(columns: list[str], prefix: str = "old_") -> Column:
    """Names of the columns that differ between the old and the new row."""
    return F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(prefix + c)), F.lit(c)) for c in columns)))


def changed_keys(changes: DataFrame, keys: list[str]) -> DataFrame:
    """What a cache has to drop."""
    return changes.select(*keys).distinct()


def as_json(changes: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """Key and value for a broker or another store."""
    return changes.select(F.to_json(F.struct(*key)).alias("key"), F.to_json(F.struct(*value)).alias("value"))


def any_of(rows: DataFrame, column: str, values: list) -> DataFrame:
    return rows.where(F.col(column).isin(values))


def none_of(rows: DataFrame, column: str, values: list) -> DataFrame:
    return rows.where(~F.col(column).isin(values))
