"""Positions: what is confirmed, how far a slot is behind, whether a replica has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stored
from . import asof


def confirmed(commits: DataFrame, slot: str = "slot") -> DataFrame:
    """The greatest confirmed position of each slot."""
    return commits.where("acknowledged").groupBy(slot).agg(F.max("tx_end_lsn").alias("confirmed_lsn"))


def confirmed_safe(commits: DataFrame, slot: str = "slot") -> DataFrame:
    """The greatest position of each slot before which nothing is unconfirmed."""
    gap = commits.groupBy(slot).agg(F.min(F.when(~F.col("acknowledged"), F.col("tx_end_lsn"))).alias("gap"))
    before = commits.join(gap, slot).where(F.col("gap").isNull() | (F.col("tx_end_lsn") < F.col("gap")))
    return before.groupBy(slot).agg(F.max("tx_end_lsn").alias("confirmed_lsn"))


def lag(commits: DataFrame, slot: str = "slot") -> DataFrame:
    """Bytes and seconds between the last commit and the last confirmed one."""
    done = F.col("acknowledged")
    return commits.groupBy(slot).agg(
        (F.max("tx_end_lsn") - F.max(F.when(done, F.col("tx_end_lsn")))).alias("lag_bytes"),
        (F.unix_micros(F.max("commit_timestamp").cast("timestamp")) - F.unix_micros(F.max(F.when(done, F.col("commit_timestamp"))).cast("timestamp"))).alias("lag_micros"),
    )


def behind(alive: DataFrame, commits: DataFrame, slot: str = "slot") -> DataFrame:
    """How far each slot's confirmed position is behind what its server says in keep-alives(slot, lsn, system_clock); all of it where nothing is confirmed."""
    said = alive.groupBy(slot).agg(F.max("lsn").alias("server_lsn"), F.max("system_clock").alias("server_clock"))
    return said.join(confirmed(commits, slot), slot, "left").select(slot, "server_lsn", "server_clock", (F.col("server_lsn") - F.coalesce("confirmed_lsn", F.lit(0))).alias("lag_bytes"))


def caught_up(commits: DataFrame, target: int) -> DataFrame:
    return commits.agg((F.max("tx_end_lsn") >= target).alias("caught_up"))


def validity(relations: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Versions of table descriptions with the position at which the next one takes over."""
    return relations.withColumn("valid_to", F.lead(order).over(Window.partitionBy(*keys).orderBy(order)))


def without_repeats(relations: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Versions that differ from the one before them: a server describes a table again in each session, mostly with nothing new."""
    said = F.struct(*(c for c in relations.columns if c not in (*keys, order)))
    before = F.lag(F.struct(said.alias("said"))).over(Window.partitionBy(*keys).orderBy(order))
    return relations.withColumn("__before", before).where(F.col("__before").isNull() | ~F.col("__before")["said"].eqNullSafe(said)).drop("__before")


def as_of(changes: DataFrame, relations: DataFrame, keys: list[str], order: str = "seq", most: int = asof.MOST) -> DataFrame:
    """Each change with the description of its table that is the latest before it; changes before their table's first one fall out.

    Versions that say nothing new are left out, and the others get a number. A change finds the number of its version by its position (see `asof.latest_at`), so that a table
    with very many versions costs no more than one with few, and then joins its version by that number. Descriptions are broadcast where
    they are counted and measured to be small; else that join shuffles.
    """
    versions = stored(without_repeats(relations, keys, order).withColumn("__version", F.monotonically_increasing_id()))
    numbered = asof.latest_at(changes, versions, keys, order, "__version", "__version", most=most)
    said = versions.drop(*keys, order)
    return numbered.join(broadcast_if_small(said), "__version").drop("__version")
