"""Applying changes to tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stored
from . import asof


def moved_keys(changes: DataFrame, key: str | list[str], old_key: str | list[str], columns: list[str]) -> DataFrame:
    """Updates that move a row to another key become a delete of the old key and an insert of the new one. columns of the
    delete are null. A key of several columns is a list, and so is the old one: it was sent if any of its columns isn't null."""
    key, old_key = ([k] if isinstance(k, str) else k for k in (key, old_key))
    sent, same = F.lit(False), F.lit(True)
    for k, old in zip(key, old_key, strict=True):
        sent, same = sent | F.col(old).isNotNull(), same & F.col(old).eqNullSafe(F.col(k))
    moved = (F.col("op") == "update") & sent & ~same
    keep = [c for c in changes.columns if c not in (*key, "op", *columns)]
    gone = F.struct(*(F.col(old).alias(k) for k, old in zip(key, old_key, strict=True)), F.lit("delete").alias("op"), F.lit(0).alias("part"), *(F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in columns))
    new = F.struct(*key, F.when(moved, F.lit("insert")).otherwise(F.col("op")).alias("op"), F.lit(1).alias("part"), *(F.col(c).alias(c) for c in columns))
    parts = F.explode(F.when(moved, F.array(gone, new)).otherwise(F.array(new)))
    return changes.select(*keep, parts.alias("__part")).select(*keep, "__part.*")


def with_moved_values(log: DataFrame, keys: list[str], old_keys: list[str], order: list[str], marked: dict[str, str], rows: int = 1_000_000) -> DataFrame:
    """A log as `moved_keys` gives it, in which a large value that a move didn't send is that which the row had under its old key, and isn't marked any more.

    That value may itself have come by a move that didn't send it, so each such move points to the last event of its old key: a value, or another move. Chains are
    resolved by pointer jumping, in as many rounds as their length has binary digits. Only events of keys from which such moves start are looked at,
    in buckets of the first column of `order` (a number), so that no key's history is one task. A value that the log doesn't hold stays marked.
    """
    flag = lambda c: F.coalesce(F.col(marked[c]), F.lit(False))
    sent, same = F.lit(False), F.lit(True)
    for k, old in zip(keys, old_keys, strict=True):
        sent, same = sent | F.col(old).isNotNull(), same & F.col(old).eqNullSafe(F.col(k))
    log = stored(log.withColumn("__id", F.monotonically_increasing_id()).withColumn("__moved", (F.col("op") == "insert") & sent & ~same))
    moves = log.where(F.col("__moved") & reduce(lambda a, b: a | b, (flag(c) for c in marked), F.lit(False)))
    open_ = moves.agg(*(F.coalesce(F.max(flag(c)), F.lit(False)).alias(f"m{k}") for k, c in enumerate(marked))).first()
    from_keys = broadcast_if_small(stored(moves.select(*(F.col(old).alias(k) for k, old in zip(keys, old_keys, strict=True))).distinct())) if any(open_) else None
    for c in (c for c, some in zip(marked, open_, strict=True) if some):
        event = F.when(F.col("__moved") & flag(c), F.struct(F.lit(None).cast(log.schema[c].dataType).alias("v"), F.col("__id").alias("of"))).when((F.col("op") != "delete") & ~flag(c), F.struct(F.col(c).alias("v"), F.lit(None).cast("bigint").alias("of")))
        events = log.join(from_keys, keys, "left_semi").select(*keys, *order, F.lit(None).cast("bigint").alias("__asks"), event.alias("__event"))
        asks = moves.where(flag(c)).select(*(F.col(old).alias(k) for k, old in zip(keys, old_keys, strict=True)), *order, F.col("__id").alias("__asks"), F.lit(None).cast(events.schema["__event"].dataType).alias("__event"))
        found = asof.filled(events.union(asks), keys, order[0], "__event", rows, ties=[F.col(o) for o in order[1:]]).where("__asks is not null")
        found = stored(found.select(F.col("__asks").alias("__ask"), F.col("__filled").isNotNull().alias("known"), F.col("__filled")["v"].alias("v"), F.col("__filled")["of"].alias("of")))
        while not found.where("of is not null").isEmpty():
            to = found.select(F.col("__ask").alias("__to"), F.col("known").alias("known_"), F.col("v").alias("v_"), F.col("of").alias("of_"))
            hop = lambda x: F.when(F.col("of").isNull(), F.col(x)).otherwise(F.col(f"{x}_")).alias(x)
            found = stored(found.join(to, F.col("of") == F.col("__to"), "left").select("__ask", hop("known"), hop("v"), hop("of")))
        log = log.join(broadcast_if_small(found.where("known").select("__ask", F.struct("v").alias("__had"))), F.col("__id") == F.col("__ask"), "left")
        had = F.col("__had").isNotNull()
        log = log.withColumn(c, F.when(had, F.col("__had")["v"]).otherwise(F.col(c))).withColumn(marked[c], flag(c) & ~had).drop("__ask", "__had")
    return log.drop("__id", "__moved")


def latest_state(changes: DataFrame, keys: list[str], columns: list[str], order: list[str], marked: dict[str, str] | None = None) -> DataFrame:
    """The rows that a table holds after all changes.

    One aggregate with map-side combine (no window), so a key that every transaction updates costs one row a task. A column's
    value is that of the last change that isn't a delete and doesn't mark it unchanged (marked: column -> flag);
    nulls that were written win over older values. Changes before the row's last insert don't count.
    """
    marked = marked or {}
    position = F.struct(*order)
    at = lambda c: F.when((F.col("op") != "delete") & (~F.coalesce(F.col(marked[c]), F.lit(False)) if c in marked else F.lit(True)), position)
    state = changes.groupBy(*keys).agg(
        F.max_by("op", position).alias("__op"),
        *(F.max_by(F.struct(F.col(c).alias("v")), at(c)).alias(c) for c in columns),
    )
    return state.where(F.col("__op") != "delete").select(*keys, *(F.col(c)["v"].alias(c) for c in columns))


def after_truncate(changes: DataFrame, truncates: DataFrame, table: str = "table", order: str | list[str] = "seq") -> DataFrame:
    """Changes that no later truncate of their table wipes out; truncates has a row for each target table."""
    at = F.struct(*([order] if isinstance(order, str) else order))
    last = truncates.groupBy(table).agg(F.max(at).alias("__last"))
    kept = changes.join(F.broadcast(last), table, "left")  # one row a table
    return kept.where(F.col("__last").isNull() | (at > F.col("__last"))).drop("__last")


def net_rows(changes: DataFrame, columns: list[str], sign: Column) -> DataFrame:
    """Rows of a table without key: inserts count up, deletes of an equal row count down, and the rest is laid out again."""
    net = changes.groupBy(*columns).agg(F.sum(sign).alias("__n")).where("__n > 0")
    return net.select(*columns, F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("copy"))


def merge(base: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], order: list[str], marked: dict[str, str] | None = None, old_keys: list[str] | None = None) -> DataFrame:
    """A base table with changes applied: the base's rows are the oldest inserts of one aggregate over both.

    order columns and marks that the base lacks are null there; nulls come first, and what isn't marked counts. old_keys: the keys that rows of
    `moved_keys` moved from, under which values that weren't sent are looked up.
    """
    snapshot = base.select(*keys, *columns, F.lit("insert").alias("op"))
    both = snapshot.unionByName(changes.select(*keys, *columns, "op", *order, *(marked or {}).values(), *(old_keys or [])), allowMissingColumns=True)
    if old_keys and marked:
        both = with_moved_values(both, keys, old_keys, order, marked)
    return latest_state(both, keys, columns, order, marked)


def quoted(value: Column) -> Column:
    """A SQL literal: text in quotes, the rest as it is shown, null as NULL."""
    return F.coalesce(F.concat(F.lit("'"), F.replace(value.cast("string"), F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def statements(changes: DataFrame, table: str, keys: list[str], columns: list[str], literal: dict[str, Column]) -> Column:
    """The SQL statement of each change; literal: the rendered value of each column."""
    every = [*keys, *columns]
    insert = F.concat(F.lit(f"INSERT INTO {table} ({', '.join(every)}) VALUES ("), F.concat_ws(", ", *(literal[c] for c in every)), F.lit(")"))
    where = F.concat_ws(" AND ", *(F.concat(F.lit(f"{k} = "), literal[k]) for k in keys))
    update = F.concat(F.lit(f"UPDATE {table} SET "), F.concat_ws(", ", *(F.concat(F.lit(f"{c} = "), literal[c]) for c in columns)), F.lit(" WHERE "), where)
    delete = F.concat(F.lit(f"DELETE FROM {table} WHERE "), where)
    return F.when(F.col("op") == "insert", insert).when(F.col("op") == "update", update).when(F.col("op") == "delete", delete)


def truncate_statement(tables: Column, cascade: Column, restart: Column) -> Column:
    """The statement of a truncate of some tables (an array of names with their schemas)."""
    option = lambda flag, text: F.when(F.coalesce(flag, F.lit(False)), F.lit(text)).otherwise(F.lit(""))
    return F.concat(F.lit("TRUNCATE TABLE "), F.array_join(tables, ", "), option(restart, " RESTART IDENTITY"), option(cascade, " CASCADE"))


def statement_batches(changes: DataFrame, keys: list[str], n: str = "n", statement: str = "statement", most: int = 1000) -> DataFrame:
    """(keys, part, n_statements, batch): the statements of each transaction in their order as one text, in parts of `most` statements, so that
    no transaction has to fit one row. n: the number of a change in its transaction, from 1."""
    part = F.floor((F.col(n) - 1) / most).alias("part")
    each = changes.select(*keys, part, F.struct(n, statement).alias("__s"))
    found = each.groupBy(*keys, "part").agg(F.count("*").alias("n_statements"), F.array_sort(F.collect_list("__s")).alias("__all"))
    return found.select(*keys, "part", "n_statements", F.array_join(F.transform("__all", lambda s: F.concat(s[statement], F.lit(";"))), "\n").alias("batch"))
