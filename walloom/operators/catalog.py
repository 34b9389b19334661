"""Command tags, error codes, and catalogs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.usertypes import LAST, TypeGraph, Version
from ..session import broadcast_if_small, stored

#: Commands whose tags carry a number of rows.
COUNTED = ("INSERT", "DELETE", "UPDATE", "MERGE", "SELECT", "MOVE", "FETCH", "COPY")
#: Fields of error and notice messages by their code.
FIELDS = {"S": "severity_localized", "V": "severity", "C": "error_code", "M": "message", "D": "detail", "H": "hint", "P": "position", "p": "internal_position", "q": "internal_query", "W": "where", "s": "schema", "t": "table", "c": "column", "d": "data_type", "n": "constraint", "F": "file", "L": "line", "R": "routine"}


def command_of(tag: Column) -> Column:
    """The command of a tag; a tag that carries no rows is a command itself."""
    first = F.regexp_extract(tag, f"^({'|'.join(COUNTED)})", 1)
    return F.when(first != "", first).otherwise(tag)


def rows_of(tag: Column) -> Column:
    """The rows of a tag: the third word of an insert's, the second of others."""
    words = F.split(tag, r"\s+")
    counted = F.when(tag.startswith("INSERT"), F.get(words, F.lit(2))).when(tag.rlike(f"^({'|'.join(COUNTED)})"), F.get(words, F.lit(1)))
    return counted.try_cast("bigint")


def rows_by_command(tags: DataFrame, column: str = "tag") -> DataFrame:
    return tags.groupBy(command_of(F.col(column)).alias("command")).agg(F.sum(rows_of(F.col(column))).alias("n_rows"))


def named_states(errors: DataFrame, states: DataFrame, code: str = "error_code") -> DataFrame:
    """Errors with the condition's name from a table states(error_code, condition), `unknown` where it has none."""
    return errors.join(broadcast_if_small(stored(states)), code, "left").withColumn("condition", F.coalesce("condition", F.lit("unknown")))


def states(spark: SparkSession, path: str) -> DataFrame:
    """(error_code, condition) from the list of codes that the server's source holds as text: lines of a code, a letter, a macro and, for most, the condition's
    name, whose words come out with hyphens. Comments, sections and codes without a name are left out; of a code with several names the first stays."""
    line = spark.read.text(path).select(F.trim("value").alias("value"), F.monotonically_increasing_id().alias("n"))
    part = lambda k: F.regexp_extract("value", r"^([0-9A-Z]{5})\s+[EWS]\s+\S+\s+([a-z_0-9]+)$", k)
    named = line.select("n", part(1).alias("error_code"), F.replace(part(2), F.lit("_"), F.lit("-")).alias("condition")).where("error_code <> ''")
    return named.groupBy("error_code").agg(F.min_by("condition", "n").alias("condition"))


def named_fields(fields: Column) -> Column:
    """A map of one-letter field codes with the fields' names."""
    names = F.create_map(*(F.lit(x) for pair in FIELDS.items() for x in pair))
    return F.transform_keys(fields, lambda k, _: F.coalesce(names[k], F.lit("unknown")))


#: Fields that hold numbers.
NUMBERS = ("position", "internal_position", "line")


def error_fields(fields: Column) -> list[Column]:
    """A column for each field of an error or notice, from a map of one-letter codes: texts, but for places and lines, which are whole numbers. What isn't sent is null."""
    return [(fields[code].try_cast("int") if name in NUMBERS else fields[code]).alias(name) for code, name in FIELDS.items()]


def type_graph(types: DataFrame, most: int = 200_000) -> TypeGraph:
    """A catalog's types(type_oid, kind, base_oid) as a graph; further columns: seq (the position from which a row holds; all of the log where it
    is left out), namespace, name, element_oid (of an array), fields array<struct<name, type_oid>> (of a composite).

    A catalog is as large as a schema, not as its data: beyond `most` rows it is taken for something else and refused.
    """
    long = lambda c, default=0: F.coalesce(F.col(c).cast("bigint"), F.lit(default)) if c in types.columns else F.lit(default)
    text = lambda c: F.col(c) if c in types.columns else F.lit(None).cast("string")
    fields = F.col("fields") if "fields" in types.columns else F.lit(None).cast("array<struct<name:string,type_oid:bigint>>")
    rows = types.select("type_oid", "kind", long("base_oid").alias("base"), long("element_oid").alias("element"), long("seq", -(2**62)).alias("seq"), F.concat_ws(".", text("namespace"), text("name")).alias("name"), fields.alias("fields")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a catalog of more than {most} types")
    out: dict[int, list[Version]] = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        out.setdefault(r["type_oid"], []).append(Version(r["seq"], r["kind"], r["name"], r["base"], r["element"], tuple((f["name"], f["type_oid"]) for f in r["fields"] or ())))
    return TypeGraph(out)


def base_types(types: DataFrame, attributes: DataFrame) -> DataFrame:
    """Each attribute with resolved_oid, its type resolved through domains to a base type, however long the chain; composites read as records and enums as text."""
    graph = type_graph(types)
    reads = [(oid, graph.read(oid, LAST)) for oid in graph.versions]
    known = attributes.sparkSession.createDataFrame(reads, "type_oid long, __read long")
    joined = attributes.join(F.broadcast(known), "type_oid", "left")  # a row a type, counted
    return joined.withColumn("resolved_oid", F.coalesce("__read", "type_oid")).drop("__read").select(*attributes.columns, "resolved_oid")


RESOLVED = "array<struct<name:string,type_oid:bigint,typmod:int,is_key:boolean,sent_oid:bigint>>"


def resolved(relations: DataFrame, graph: TypeGraph, order: str = "seq", keys: tuple[str, ...] = ("slot", "rel_oid")) -> DataFrame:
    """Table descriptions whose attributes name the built-in types as which they are read, with the ids that were sent as sent_oid.

    A type may change while its table's description stays: then the description comes again at that position. Descriptions are read a few at a
    time, where they lie.
    """
    spans = relations.withColumn("__to", F.lead(order).over(Window.partitionBy(*keys).orderBy(order)))

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                end = row.pop("__to")
                sent, seq = row["attributes"] or [], row[order]
                places = {seq}.union(*(graph.changes(a["type_oid"], seq, LAST if end is None else end) for a in sent))
                for at in sorted(places):
                    out.append({**row, order: at, "attributes": [{**a, "type_oid": graph.read(a["type_oid"], at), "sent_oid": a["type_oid"]} for a in sent]})
            yield pa.RecordBatch.from_pylist(out, schema=target)

    kinds = relations.withColumn("attributes", F.lit(None).cast(RESOLVED)).schema
    target = to_arrow_schema(kinds)
    return spans.mapInArrow(run, kinds)
