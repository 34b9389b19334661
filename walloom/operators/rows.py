"""Rows from tuples: names and values put together, keys, renames, targets of a truncate."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import layouts, usertypes, wire

#: Decoders that a user adds or replaces: type id -> column of bytes to column of text.
Registry = dict[int, Callable[[Column], Column]]
_SHOWN = ("bool", "int2", "int4", "int8", "oid", "xid", "text", "varchar", "bpchar", "name", "json", "jsonb", "date", "timestamp", "timestamptz", "uuid", "char")

#: Decoders of the other built-in types that expressions read; structs are shown as JSON, void and unknown are null.
WIRE: Registry = {
    **{wire.OID[kind]: lambda d, kind=kind: wire.decode_value(d, kind) for kind in ("regproc", "money", "time", "pg_lsn", "void", "unknown")},
    **{wire.OID[kind]: lambda d, kind=kind: F.to_json(wire.decode_value(d, kind)) for kind in ("interval", "timetz")},
}


def known_oids(registry: Registry | None = None, graph: usertypes.TypeGraph | None = None) -> list[int]:
    """Types whose values `shown`, `WIRE`, `layouts.shown`, a registry or a graph of user types can read."""
    return sorted({17, *(wire.OID[k] for k in _SHOWN), *WIRE, *layouts.OIDS.values(), *layouts.ARRAYS, *(registry or {}), *((usertypes.RECORDS,) if graph else ())})


def unknown_values(attributes: Column, values: Column, known: list[int]) -> Column:
    """The binary values of a tuple whose type can't be read: array<struct<column, oid, data>>, with the id that was sent."""

    def one(a: Column, v: Column) -> Column:
        sent = F.coalesce(a["sent_oid"], a["type_oid"])
        return F.when((v["kind"] == "b") & ~a["type_oid"].isin(known), F.struct(a["name"].alias("column"), sent.alias("oid"), v["data"].alias("data")))

    return F.coalesce(F.array_compact(F.zip_with(attributes, values, one)), F.array().cast("array<struct<column:string,oid:bigint,data:binary>>"))


def shown(value: Column, oid: Column, registry: Registry | None = None, failfast: bool = True) -> Column:
    """A tuple's value as text: text values as they are, binary ones by their type. A type without a decoder is an error, or null."""
    data = value["data"]
    unknown = F.raise_error(F.concat(F.lit("no decoder for type "), oid.cast("string"))).cast("string") if failfast else F.lit(None).cast("string")
    by_type = F.when(oid == 17, F.lower(F.hex(data)))
    for kind in _SHOWN:
        if wire.OID[kind] not in (registry or {}):
            by_type = by_type.when(oid == wire.OID[kind], wire.decode_value(data, kind).cast("string"))
    for number, one in (registry or {}).items():
        by_type = by_type.when(oid == number, one(data).cast("string"))
    return F.when(value["kind"] == "t", F.decode(data, "UTF-8")).when(value["kind"] == "b", by_type.otherwise(unknown))


def row_map(attributes: Column, values: Column, registry: Registry | None = None, failfast: bool = True, texts: Column | None = None) -> Column:
    """Attribute name -> value as text, nulls left out, as a handler of single messages sees a row. texts: of values that were shown
    before, as `layouts.shown` does for types that expressions can't read; a registry's decoder goes before them."""

    def pair(a: Column, v: Column, k: Column | None = None) -> Column:
        text = shown(v, a["type_oid"], registry, failfast)
        if texts is not None:
            text = F.when(F.get(texts, k).isNotNull() & ~a["type_oid"].isin(list(registry or {})), F.get(texts, k)).otherwise(text)
        return F.struct(a["name"].alias("key"), text.alias("value"))

    pairs = F.zip_with(attributes, values, lambda a, v: pair(a, v)) if texts is None else F.transform(values, lambda v, k: pair(F.get(attributes, k), v, k))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def typed(values: Column, kinds: dict[str, str], decoders: dict[str, Callable[[Column], Column]] | None = None, only: list[str] | None = None) -> list[Column]:
    """One column for each attribute, or for some only, nulls kept; kinds: attribute -> type, in the table's order. A numeric is its text in both formats."""
    out = []
    for k, (name, kind) in enumerate(kinds.items()):
        if only is not None and name not in only:
            continue
        value = F.get(values, F.lit(k))
        binary = (decoders or {}).get(kind, lambda d, kind=kind: wire.decode_value(d, kind))(F.when(value["kind"] == "b", value["data"]))
        sent = F.decode(value["data"], "UTF-8")
        text = sent if kind == "numeric" else wire.decode_text(sent, kind)
        if kind not in _TEXT:
            text = F.raise_error(F.lit(f"no decoder for the text format of {kind}"))
        out.append(F.when(value["kind"] == "b", binary).when(value["kind"] == "t", text.cast(_type_of(kind)) if _type_of(kind) else text).alias(name))
    return out


#: Types whose values in text format come out with the type that those in binary format have.
_TEXT = ("bool", "int2", "int4", "int8", "oid", "xid", "float4", "float8", "numeric", "money", "date", "timestamp", "timestamptz", "time", "timetz", "uuid", "pg_lsn", "void", "unknown", "text", "varchar", "bpchar", "name", "json", "jsonb", "char")


def _type_of(kind: str) -> str | None:
    return {"int4": "int", "int2": "smallint", "int8": "bigint", "bool": "boolean", "text": "string", "varchar": "string", "date": "date", "timestamp": "timestamp_ntz", "timestamptz": "timestamp"}.get(kind)


def unchanged(values: Column, attributes: Column) -> Column:
    """Names of the attributes whose large value wasn't sent because it didn't change."""
    pairs = F.zip_with(attributes, values, lambda a, v: F.when(v["kind"] == "u", a["name"]))
    return F.array_compact(pairs)


def key_names(attributes: Column) -> Column:
    return F.transform(F.filter(attributes, lambda a: a["is_key"]), lambda a: a["name"])


def key_values(row: Column, keys: Column) -> Column:
    return F.map_filter(row, lambda k, _: F.array_contains(keys, k))


def renamed(row: Column, rename: Callable[[Column], Column]) -> Column:
    """A row map with new names, for example with the table's in front."""
    return F.transform_keys(row, lambda k, _: rename(k))


def truncate_targets(truncates: DataFrame, relations: DataFrame, as_of: Callable[..., DataFrame]) -> DataFrame:
    """One row for each table that a truncate names: (slot, seq, position, namespace, name, options)."""
    each = truncates.select("slot", "seq", "truncate_cascade", "truncate_restart_identity", F.posexplode("oids").alias("position", "rel_oid"))
    return as_of(each, relations.select("slot", "seq", "rel_oid", "namespace", "name"), ["slot", "rel_oid"])


def delimited(columns: list[str], delimiter: str = ",") -> Column:
    """A row as a line of delimited text: a null is nothing, an empty text is quoted, and so is what holds the delimiter, a quote or a line's end."""
    special = "[" + re.escape(delimiter) + '"\\r\\n]'

    def field(c: str) -> Column:
        text = F.col(c).cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.isNull(), F.lit("")).when((text == "") | text.rlike(special), quoted).otherwise(text)

    return F.array_join(F.array(*(field(c) for c in columns)), delimiter)


def message_text(messages: DataFrame) -> DataFrame:
    return messages.where("type = 'message'").withColumn("text", F.decode("content", "UTF-8"))
