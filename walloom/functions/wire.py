"""Numbers, strings and values in the wire format: big-endian whole numbers, strings that end in a zero byte, and
values of the built-in types, as expressions both ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: microseconds from 1970-01-01 to 2000-01-01, from which the wire format counts.
EPOCH_MICROS = 946684800000000


def int_bytes(value: Column, width: int) -> Column:
    """A whole number as so many bytes, in two's complement."""
    digits = F.lpad(F.hex(value.cast("bigint")), 16, "0")
    return F.unhex(F.substring(digits, 17 - 2 * width, 2 * width))


def unsigned(data: Column, at, width: int) -> Column:
    """The number in `width` bytes (up to 7) from place `at`, counted from 1."""
    at = at if isinstance(at, Column) else F.lit(at)
    return F.conv(F.hex(F.substring(data, at, F.lit(width))), 16, 10).cast("bigint")


def signed(data: Column, at, width: int) -> Column:
    at = at if isinstance(at, Column) else F.lit(at)
    if width == 8:
        return F.conv(F.hex(F.substring(data, at, F.lit(8))), 16, -10).cast("bigint")
    plain = unsigned(data, at, width)
    return F.when(plain >= 1 << (8 * width - 1), plain - (1 << (8 * width))).otherwise(plain)


def cstring(text: Column) -> Column:
    return F.concat(F.encode(text, "UTF-8"), F.unhex(F.lit("00")))


def cstring_end(data: Column, at) -> Column:
    """The place of the zero byte at or after `at`. Latin-1 has one character for each byte, so places agree."""
    at = at if isinstance(at, Column) else F.lit(at)
    return F.call_function("locate", F.char(F.lit(0)), F.decode(data, "ISO-8859-1"), at)


def text_between(data: Column, at, end: Column) -> Column:
    at = at if isinstance(at, Column) else F.lit(at)
    return F.decode(F.substring(data, at, end - at), "UTF-8")


def micros_to_timestamp(micros: Column) -> Column:
    """Null where the sum leaves the range, as for infinite timestamps."""
    return F.timestamp_micros(F.try_add(micros, F.lit(EPOCH_MICROS)))


def timestamp_to_micros(value: Column) -> Column:
    return F.unix_micros(value.cast("timestamp")) - EPOCH_MICROS


#: Built-in type ids.
OID = {
    "bool": 16, "bytea": 17, "char": 18, "name": 19, "int8": 20, "int2": 21, "int4": 23, "regproc": 24, "text": 25, "oid": 26, "xid": 28,
    "json": 114, "float4": 700, "float8": 701, "unknown": 705, "money": 790, "bpchar": 1042, "varchar": 1043, "date": 1082, "time": 1083,
    "timestamp": 1114, "timestamptz": 1184, "interval": 1186, "timetz": 1266, "bit": 1560, "varbit": 1562, "numeric": 1700, "void": 2278,
    "record": 2249, "uuid": 2950, "pg_lsn": 3220, "jsonb": 3802,
}


def encode_value(value: Column, kind: str) -> Column:
    """A column's values in the binary format of a type; null stays null."""
    if kind in ("int2", "int4", "int8", "oid", "xid", "money", "time"):
        return int_bytes(value, {"int2": 2, "int8": 8, "money": 8, "time": 8}.get(kind, 4))
    if kind == "bool":
        return F.when(value, F.unhex(F.lit("01"))).when(~value, F.unhex(F.lit("00")))
    if kind in ("text", "varchar", "bpchar", "name", "json", "char"):
        return value.cast("string").cast("binary")
    if kind == "jsonb":
        return F.concat(F.unhex(F.lit("01")), value.cast("string").cast("binary"))
    if kind == "bytea":
        return value
    if kind == "date":
        return int_bytes(F.datediff(value, F.lit("2000-01-01").cast("date")), 4)
    if kind in ("timestamp", "timestamptz"):
        return int_bytes(timestamp_to_micros(value), 8)
    if kind == "uuid":
        return F.unhex(F.regexp_replace(value, "-", ""))
    if kind == "pg_lsn":
        return int_bytes(value, 8)
    if kind == "interval":
        return F.concat(int_bytes(value["micros"], 8), int_bytes(value["days"], 4), int_bytes(value["months"], 4))
    if kind == "timetz":
        return F.concat(int_bytes(value["micros"], 8), int_bytes(-value["offset_seconds"], 4))
    raise ValueError(f"no encoder for {kind}")


def decode_value(data: Column, kind: str) -> Column:
    """Values of a type from its binary format; null stays null."""
    if kind == "int8" or kind in ("money", "time", "pg_lsn"):
        return signed(data, 1, 8)
    if kind in ("int4", "int2"):
        return signed(data, 1, 4 if kind == "int4" else 2).cast("int" if kind == "int4" else "smallint")
    if kind in ("oid", "xid", "regproc"):
        return unsigned(data, 1, 4)
    if kind == "bool":
        return F.hex(data) != "00"
    if kind in ("text", "varchar", "bpchar", "name", "json", "char"):
        return F.decode(data, "UTF-8")
    if kind == "jsonb":
        return F.when(F.hex(F.substring(data, 1, 1)) == "01", F.decode(F.substring(data, F.lit(2), F.length(data) - 1), "UTF-8"))
    if kind == "bytea":
        return data
    if kind == "date":
        return F.date_add(F.lit("2000-01-01").cast("date"), signed(data, 1, 4).cast("int"))
    if kind == "timestamptz":
        return micros_to_timestamp(signed(data, 1, 8))
    if kind == "timestamp":
        return micros_to_timestamp(signed(data, 1, 8)).cast("timestamp_ntz")
    if kind == "uuid":
        return F.regexp_replace(F.lower(F.hex(data)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    if kind == "interval":
        return F.struct(signed(data, 13, 4).cast("int").alias("months"), signed(data, 9, 4).cast("int").alias("days"), signed(data, 1, 8).alias("micros"))
    if kind == "timetz":
        return F.struct(signed(data, 1, 8).alias("micros"), (-signed(data, 9, 4)).cast("int").alias("offset_seconds"))
    if kind in ("void", "unknown"):
        return F.lit(None).cast("string")
    raise ValueError(f"no decoder for {kind}")


def decode_text(text: Column, kind: str) -> Column:
    """Values of a type from its text format; null where the text is of another form."""
    if kind == "bool":
        return F.when(text == "t", F.lit(True)).when(text == "f", F.lit(False))
    if kind in ("int2", "int4", "int8", "oid", "xid"):
        return text.try_cast({"int2": "smallint", "int4": "int"}.get(kind, "bigint"))
    if kind in ("float4", "float8"):
        return text.try_cast("float" if kind == "float4" else "double")
    if kind == "numeric":
        return text.try_cast("decimal(38,10)")
    if kind == "money":
        return (F.regexp_replace(text, r"[^0-9.\-]", "").try_cast("decimal(38,2)") * 100).cast("bigint")
    if kind == "date":
        return text.try_cast("date")
    if kind == "timestamp":
        return text.try_cast("timestamp_ntz")
    if kind == "timestamptz":
        return F.try_to_timestamp(F.regexp_replace(text, r"([+-]\d\d)$", "$1:00"))
    if kind in ("time", "timetz"):
        part = lambda k: F.regexp_extract(text, r"^(\d\d):(\d\d):(\d\d)(?:\.(\d{1,6}))?", k)
        micros = (part(1).try_cast("bigint") * 3600 + part(2).try_cast("bigint") * 60 + part(3).try_cast("bigint")) * 1000000 + F.rpad(part(4), 6, "0").cast("bigint")
        if kind == "time":
            return micros
        zone = lambda k: F.regexp_extract(text, r"([+-])(\d\d)(?::?(\d\d))?(?::?(\d\d))?$", k)
        offset = F.coalesce(zone(2).try_cast("int"), F.lit(0)) * 3600 + F.coalesce(zone(3).try_cast("int"), F.lit(0)) * 60 + F.coalesce(zone(4).try_cast("int"), F.lit(0))
        return F.when(micros.isNotNull(), F.struct(micros.alias("micros"), (F.when(zone(1) == "-", -offset).otherwise(offset)).alias("offset_seconds")))
    if kind == "uuid":
        return F.lower(text)
    if kind == "pg_lsn":
        from .lsn import text_to_lsn

        return text_to_lsn(text)
    if kind in ("void", "unknown"):
        return F.lit(None).cast("string")
    return text
