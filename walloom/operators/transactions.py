"""From a log to committed transactions: carried state, pairs of begin and commit, streamed outcomes, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..session import broadcast_if_small, stored
from . import asof


def carry_forward(log: DataFrame, marker: Column, name: str, slot: str = "slot", order: str = "seq", rows: int = 1_000_000, most: int = asof.MOST) -> DataFrame:
    """Adds the last non-null `marker` at or before each row, by position in its slot.

    Rows with a marker are taken out as (slot, position, marker), without those that repeat the one before them in their bucket of `rows` positions; up to
    `most` of them are sent to the rows, so that the log itself stays where it is. Markers that aren't whole numbers, and more of them than that, are filled in
    by buckets of positions, which shuffles the log.
    """
    kind = log.select(marker.alias("m")).schema["m"].dataType
    if not isinstance(kind, IntegralType):
        held = log.withColumn("__marker", F.when(marker.isNotNull(), F.struct(marker.alias("value"))))
        return asof.filled(held, [slot], order, "__marker", rows).withColumn(name, F.col("__filled")["value"]).drop("__marker", "__filled")
    marks = log.select(slot, order, marker.alias("__mark")).where("__mark is not null")
    before = F.lag("__mark").over(Window.partitionBy(slot, F.floor(F.col(order) / rows)).orderBy(order))
    marks = marks.withColumn("__before", before).where("__before is null or __before <> __mark")
    found = asof.latest_at(log, marks, [slot], order, "__mark", name, rows, most)
    return found.withColumn(name, F.col(name).cast(kind))


def pair_begin_commit(begins: DataFrame, commits: DataFrame, slot: str = "slot") -> DataFrame:
    """Attempts that a commit closes: begins(slot, tx, lsn, ...) with commits(slot, tx, commit_lsn, ...) of the same attempt and
    position. Attempts without a commit fall out."""
    return begins.join(commits, (begins[slot] == commits[slot]) & (begins["tx"] == commits["tx"]) & (begins["lsn"] == commits["commit_lsn"])).drop(commits[slot]).drop(commits["tx"])


def enrich(changes: DataFrame, transactions: DataFrame, keys: list[str]) -> DataFrame:
    """Every change with its transaction's position, id and time."""
    return changes.join(transactions, keys)


def committed_streamed(changes: DataFrame, commits: DataFrame, keys: list[str]) -> DataFrame:
    """Streamed changes whose commit has arrived."""
    return changes.join(commits.select(*keys).distinct(), keys, "left_semi")


def pending_streamed(changes: DataFrame, outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """Streamed changes with neither commit nor abort so far."""
    return changes.join(outcomes.select(*keys).distinct(), keys, "left_anti")


def without_aborted(changes: DataFrame, aborts: DataFrame, xid: str = "xid", subxid: str = "subxid") -> DataFrame:
    """Drops changes of aborted transactions, and of aborted subtransactions only those.

    aborts(xid, subxid): the whole transaction where both are equal.
    """
    whole = aborts.where(F.col(xid) == F.col(subxid)).select(xid).distinct()
    part = aborts.where(F.col(xid) != F.col(subxid)).select(xid, subxid).distinct()
    return changes.join(whole, xid, "left_anti").join(part, [xid, subxid], "left_anti")


def batches(changes: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """One row a transaction with its changes as a list in order. For consumers of small transactions; `positions` keeps
    one row a change and has no such bound."""
    return changes.groupBy(*keys).agg(F.count("*").alias("n_changes"), F.array_sort(F.collect_list(F.struct(order, *columns))).alias("batch"))


def positions(changes: DataFrame, keys: list[str], order: str | Column, name: str = "n") -> DataFrame:
    """The number of each change in its transaction, from 1. A transaction is one task's work; `numbered` has no such bound."""
    return changes.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def numbered(changes: DataFrame, keys: list[str], end: str, place: str, ties: list[str] = (), rows: int = 1_000_000, name: str = "n") -> DataFrame:
    """The number (a long) of each change in its transaction, from 1, in ranges of (end, place): each partition follows the one before and is sorted so.

    end: one of the keys, the position at which the transaction ends, which is behind all its changes; ties order changes at one place. Counted back from their end, changes lie in steps of `rows` places; a transaction that spans more than one is
    spread over its steps. Each step is numbered by itself, and what the steps before hold is added. Only steps before the last are counted for that, so short transactions cost one filter. The one
    shuffle by range serves the numbers as well.
    """
    step = F.floor((F.col(place) - F.col(end)) / rows).cast("bigint")
    changes = changes.withColumn("__step", step)
    early = stored(changes.where("__step < -1").groupBy(*keys, "__step").agg(F.count("*").alias("__count")))
    early = early.unionByName(early.select(*keys, F.lit(-1).cast("bigint").alias("__step"), F.lit(0).cast("bigint").alias("__count")).distinct())
    before = F.sum("__count").over(Window.partitionBy(*keys).orderBy("__step").rowsBetween(Window.unboundedPreceding, -1))
    carried = stored(early.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__step").alias("__of"), before.alias("__before")).where("__before is not null"))
    on = F.col("__step") == F.col("__of")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    dealt = changes.join(broadcast_if_small(carried), on, "left").repartitionByRange(end, "__step")
    own = F.row_number().over(Window.partitionBy(*keys, "__step").orderBy(place, *ties))
    found = dealt.withColumn(name, own + F.coalesce("__before", F.lit(0).cast("bigint")))
    return found.drop("__step", "__of", "__before", *(f"__{k}" for k in keys)).sortWithinPartitions(end, name)


def deduplicated(changes: DataFrame, position: str, order: str, slot: str | None = None) -> DataFrame:
    """Of transactions that came again, the first copy: rows of the smallest attempt of each commit position.

    changes carry `attempt`, the position of the begin. An aggregate with map-side combine finds the first attempt.
    """
    keys = [*([slot] if slot else []), position]
    first = changes.groupBy(*keys).agg(F.min("attempt").alias("attempt"))
    return changes.join(first, [*keys, "attempt"], "left_semi")


def in_commit_order(changes: DataFrame, *order: str, partitions: int | None = None) -> DataFrame:
    """A total order by ranges: each partition is sorted and follows the one before."""
    dealt = changes.repartitionByRange(partitions, *order) if partitions else changes.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order)
