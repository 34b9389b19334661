"""spark-submit deliver.py FRAMES OUT: every committed change as a row, in commit order, with its transaction's data.

One row a change with its number in the transaction, rather than one list a transaction, so a transaction of any size fits.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walloom.functions import layouts, usertypes
from walloom.jobs import common
from walloom.operators import catalog, rows, transactions
from walloom.sources import frames


#: What users add: by a type's id a decoder of a column of bytes to a column of text, of expressions only; or by its name a `layouts.Type`, as `replicate` takes it too.
Registry = dict[int | str, Callable[[Column], Column] | layouts.Type]


def _described(spark, path: str | DataFrame, graph: usertypes.TypeGraph | None) -> DataFrame:
    """Every committed change of a table with its description."""
    found = common.messages(spark, path)
    return common.described(found, common.committed(found).where("type <> 'message'"), graph)


def _unknown(registry: Registry | None, graph: usertypes.TypeGraph | None) -> Column:
    """The values of a described change that can't be read."""
    known = rows.known_oids({one.oid if isinstance(one, layouts.Type) else name: None for name, one in (registry or {}).items()}, graph)
    side = lambda c: F.transform(rows.unknown_values(F.col("attributes"), F.coalesce(f"{c}_tuple", F.array().cast(frames.TUPLE)), known), lambda v: F.struct(F.lit(c).alias("row"), v["column"].alias("column"), v["oid"].alias("oid"), v["data"].alias("data")))
    return F.concat(side("new"), side("old"))


def _delivered(changes: DataFrame, registry: Registry | None, graph: usertypes.TypeGraph | None, step: int = 1_000_000) -> DataFrame:
    """Described changes with their rows as maps, their number in their transaction, and `unknown`: their values that can't be read."""
    own = {name: t for name, t in (registry or {}).items() if isinstance(t, layouts.Type)}
    by_oid = {oid: one for oid, one in (registry or {}).items() if oid not in own}
    changes = transactions.numbered(changes, ["slot", "commit_seq", "tx"], "commit_seq", "seq", ["target"], step)
    each = lambda f: F.transform("attributes", lambda a: a[f])
    for c in ("new", "old"):
        changes = changes.withColumn(f"{c}_texts", layouts.shown(F.col(f"{c}_tuple"), each("type_oid"), each("sent_oid"), F.col("seq"), graph, own))
    decoders = {**rows.WIRE, **by_oid}
    new, old = (rows.row_map(F.col("attributes"), F.col(f"{c}_tuple"), decoders, failfast=False, texts=F.col(f"{c}_texts")) for c in ("new", "old"))
    return changes.select("slot", "seq", "commit_seq", "n", "commit_lsn", "tx_end_lsn", "commit_timestamp", "type", "namespace", "name", new.alias("new_row"), old.alias("old_row"), _unknown(registry, graph).alias("unknown"))


def deliver(spark, path: str | DataFrame, registry: Registry | None = None, types: DataFrame | None = None) -> DataFrame:
    """A truncate is a row for each of its tables, with neither a new row nor an old one. types: the database's own types, as `catalog.type_graph` takes them:
    enums come out as texts, domains as what they are over, composites as JSON. Values of types that have a decoder neither
    here nor in the registry fail, because a map would leave them out unseen; `split` sets them aside."""
    graph = catalog.type_graph(types) if types is not None else None
    every = _delivered(_described(spark, path, graph), registry, graph)
    first = F.element_at("unknown", 1)
    known = F.when(F.size("unknown") > 0, F.raise_error(F.concat(F.lit("no decoder for type "), first["oid"].cast("string"), F.lit(" of column "), first["column"])).cast("boolean")).otherwise(F.lit(True))
    return every.where(known).drop("unknown", "seq")


def split(spark, path: str | DataFrame, registry: Registry | None = None, types: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(what `deliver` gives for changes whose every value can be read; the values that can't: slot, seq, commit_seq, namespace, name, row, column, oid, data).

    Messages are decoded once for both. What is set aside takes neither numbers nor an order, nor the values that can be read, and what is kept is numbered and ordered by one shuffle, as in `deliver`. A change with such a value is
    left out as a whole and keeps its number in the transaction, so that a consumer sees that it is missing; once a decoder is there, the log is read again from the first position that was set aside.
    """
    graph = catalog.type_graph(types) if types is not None else None
    changes = _described(spark, path, graph)
    kept = _delivered(changes, registry, graph).where(F.size("unknown") == 0).drop("unknown", "seq")
    aside = changes.select("slot", "seq", "commit_seq", "namespace", "name", F.inline(_unknown(registry, graph)))
    return kept, aside


def main(landed: str, out: str) -> None:
    deliver(common.session("deliver"), landed).write.mode("overwrite").parquet(out)


if __name__ == "__main__":
    main(*sys.argv[1:])
