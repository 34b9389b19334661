"""spark-submit replicate.py FRAMES TABLE KEY,... COLUMN:TYPE,... OUT: the rows of one table after all committed changes.

COLUMN:TYPE lists the table's columns in order, with the built-in types of their values.
"""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walloom.functions import layouts, usertypes
from walloom.jobs import common
from walloom.operators import apply, catalog, rows


def decoders(kinds: dict[str, str]) -> dict:
    """Decoders of the layouts among a table's types."""
    return {kind: layouts.decoder(kind) for kind in kinds.values() if kind in layouts.OIDS or kind.endswith("]")}


def built_in(kinds: dict[str, str], graph: usertypes.TypeGraph) -> tuple[dict[str, str], dict]:
    """A table's types with those of the database's own by what they are read as, and decoders for composites and arrays of them, which become JSON."""
    out, own = {}, {}
    for column, kind in kinds.items():
        oid = None if kind in usertypes.NAMES.values() else graph.named(kind)
        read = graph.read(oid, usertypes.LAST) if oid is not None else None
        if read in (usertypes.RECORD, usertypes.RECORDS):
            own[kind] = lambda d, oid=oid: usertypes.texts(graph, oid)(d, F.col("seq"))
        out[column] = usertypes.NAMES.get(read, kind) if oid is not None and kind not in own else kind
    return out, own


#: The order in which changes apply; a row that moves is a delete (part 0) and an insert (part 1).
ORDER = ["commit_seq", "seq", "part"]


def keyed(changes: DataFrame, keys: list[str], kinds: dict[str, str], registry: dict | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Described changes of one table as typed rows with their key, in ORDER, and the columns' marks of large values that weren't sent."""
    known = {**decoders(kinds), **{kind: layouts.decoder(kind, {kind: one}) if isinstance(one, layouts.Type) else one for kind, one in (registry or {}).items()}}
    # of an old row nothing but its key is used, so nothing else of it is decoded
    value = [F.struct(*rows.typed(F.col(f"{c}_tuple"), kinds, known, only)).alias(c) for c, only in (("new", None), ("old", keys))]
    log = changes.select(F.col("type").alias("op"), "commit_seq", "seq", "old_kind", *value, rows.unchanged(F.col("new_tuple"), F.col("attributes")).alias("unchanged"))
    values = [c for c in kinds if c not in keys]
    key = [F.coalesce(F.col("new")[k], F.col("old")[k]).alias(k) for k in keys]
    # an old key (K) names the columns of the replica identity only, an old row (O) all of them
    held = lambda k: F.when(F.col("old_kind") == "O", F.col("old")[k]).otherwise(F.coalesce(F.col("old")[k], F.col("new")[k]))
    before = [F.when((F.col("op") == "update") & F.col("old_kind").isNotNull(), held(k)).alias(f"old_{k}") for k in keys]
    flags = [F.coalesce(F.array_contains("unchanged", c), F.lit(False)).alias(f"{c}_unchanged") for c in values]
    log = log.select("op", "commit_seq", "seq", *key, *before, *(F.col("new")[c].alias(c) for c in values), *flags)
    return apply.moved_keys(log, keys, [f"old_{k}" for k in keys], values), {c: f"{c}_unchanged" for c in values}


def of_table(changes: DataFrame, table: str) -> DataFrame:
    """Changes of one table, named with its schema."""
    return changes.withColumn("table", F.concat_ws(".", "namespace", "name")).where(F.col("table") == table)


def after_truncates(changes: DataFrame) -> DataFrame:
    return apply.after_truncate(changes, changes.where("type = 'truncate'"), "table", ["commit_seq", "seq"])


def may_move(found: DataFrame, keys: list[str], kinds: dict[str, str]) -> bool:
    """Whether an update among the messages sends an old key whose bytes differ from the new one's, and leaves a large value out. Where none does, no row has a value to take along. Of other tables
    and of transactions that didn't commit they count too: that costs time only."""
    part = lambda c, k: F.get(F.col(f"{c}_tuple"), F.lit(k))
    # in an old key (K) a null is a column outside the replica identity
    other = [~part("old", k).eqNullSafe(part("new", k)) & ((F.col("old_kind") == "O") | part("old", k)["data"].isNotNull()) for k, c in enumerate(kinds) if c in keys]
    sent = found.where((F.col("type") == "update") & F.col("old_kind").isNotNull())
    if sent.isEmpty():  # reads two narrow columns; tuples only where there is something to compare
        return False
    return not sent.where(F.array_contains("new_tuple.kind", "u") & reduce(lambda a, b: a | b, other)).isEmpty()


def replicate(spark, path: str | DataFrame, table: str, keys: list[str], kinds: dict[str, str], registry: dict | None = None, types: DataFrame | None = None) -> DataFrame:
    """registry: type -> decoder of a column of bytes, or `layouts.Type`, added to those of the built-in types or in place of them. types: the database's own types, as
    `catalog.type_graph` takes them; kinds may name them. A moved row keeps its large values, whether they were sent or not."""
    graph = catalog.type_graph(types) if types is not None else None
    kinds, own = built_in(kinds, graph) if graph else (kinds, {})
    found = common.messages(spark, path)
    changes = after_truncates(of_table(common.described(found, common.committed(found), graph), table))
    log, marked = keyed(changes, keys, kinds, {**own, **(registry or {})})
    old_keys = [f"old_{k}" for k in keys]
    return apply.latest_state(apply.with_moved_values(log, keys, old_keys, ORDER, marked) if marked and may_move(found, keys, kinds) else log, keys, list(marked), ORDER, marked)


def main(frames: str, table: str, keys: str, kinds: str, out: str) -> None:
    spark = common.session("replicate")
    columns = dict(x.split(":") for x in kinds.split(","))
    replicate(spark, frames, table, keys.split(","), columns).write.mode("overwrite").parquet(out)


if __name__ == "__main__":
    main(*sys.argv[1:])
