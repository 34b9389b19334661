"""Types whose layout Spark's expressions can't read: one registry of their ids, Spark types, decoders and encoders, over whole columns; and, for
fields in records, decoders of single values."""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import columns, wire

_POINT = "struct<x:double,y:double>"
_RANGE = "struct<lower:{0},lower_inc:boolean,upper:{0},upper_inc:boolean,lower_inf:boolean,upper_inf:boolean,empty:boolean>"


def numeric_text(data: bytes) -> str | None:
    """Digits in base 10000 with a weight, a sign and a scale, as a plain decimal text; NaN and infinities as such."""
    n, weight, sign, scale = struct.unpack(">HhHH", data[:8])
    if sign >= 0xC000:
        return {0xC000: "NaN", 0xD000: "Infinity", 0xF000: "-Infinity"}.get(sign)
    digits = struct.unpack(f">{n}H", data[8 : 8 + 2 * n])
    whole = "".join(f"{digits[k] if k < n else 0:04d}" for k in range(weight + 1)).lstrip("0") or "0"
    rest = "".join(f"{digits[k] if 0 <= k < n else 0:04d}" for k in range(weight + 1, weight + 2 + scale // 4))[:scale].ljust(scale, "0")
    return ("-" if sign == 0x4000 else "") + whole + ("." + rest if scale else "")


def numeric_bytes(text: str) -> bytes:
    special = {"NaN": 0xC000, "Infinity": 0xD000, "-Infinity": 0xF000}
    if text in special:
        return struct.pack(">HhHH", 0, 0, special[text], 0)
    sign, text = (0x4000, text[1:]) if text.startswith("-") else (0, text)
    whole, _, rest = text.partition(".")
    scale = len(rest)
    whole, rest = whole.rjust(-(-len(whole) // 4) * 4, "0"), rest.ljust(-(-len(rest) // 4) * 4, "0")
    groups = [int((whole + rest)[k : k + 4]) for k in range(0, len(whole + rest), 4)]
    weight = len(whole) // 4 - 1
    while groups and groups[0] == 0:
        groups, weight = groups[1:], weight - 1
    while groups and groups[-1] == 0:
        groups = groups[:-1]
    return struct.pack(f">HhHH{len(groups)}H", len(groups), weight if groups else 0, sign, scale, *groups)


def _inet(data: bytes) -> dict:
    import ipaddress

    family, mask, _, n = data[:4]
    return {"address": str(ipaddress.ip_address(data[4 : 4 + n])), "type": "inet4" if family == 2 else "inet6", "netmask": mask}


def _points(data: bytes) -> list[dict]:
    flat = struct.unpack(f">{len(data) // 8}d", data)
    return [{"x": a, "y": b} for a, b in zip(flat[::2], flat[1::2], strict=True)]


def _path(data: bytes) -> dict:
    return {"open": data[0] == 0, "points": _points(data[5:])}


def _range(element: Callable[[bytes], object]):
    def decode(data: bytes) -> dict:
        flags, at, bounds = data[0], 1, [None, None]
        empty, infinite = bool(flags & 1), (bool(flags & 8), bool(flags & 16))
        for k in (0, 1):
            if not empty and not infinite[k]:
                n = int.from_bytes(data[at : at + 4], "big")
                bounds[k] = element(data[at + 4 : at + 4 + n])
                at += 4 + n
        return {"lower": bounds[0], "lower_inc": bool(flags & 2), "upper": bounds[1], "upper_inc": bool(flags & 4), "lower_inf": infinite[0] and not empty, "upper_inf": infinite[1] and not empty, "empty": empty}

    return decode


def _tsvector(data: bytes) -> list[dict]:
    out, at = [], 4
    for _ in range(int.from_bytes(data[:4], "big")):
        end = data.index(0, at)
        n = int.from_bytes(data[end + 1 : end + 3], "big")
        entries = struct.unpack(f">{n}H", data[end + 3 : end + 3 + 2 * n])
        out.append({"text": data[at:end].decode(), "entries": [{"position": e & 0x3FFF, "weight": "DCBA"[e >> 14]} for e in entries]})
        at = end + 3 + 2 * n
    return out


def _record(data: bytes) -> list[dict]:
    out, at = [], 4
    for k in range(int.from_bytes(data[:4], "big")):
        oid, n = struct.unpack(">Ii", data[at : at + 8])
        at += 8
        out.append({"pos": k, "oid": oid, "value": None if n < 0 else data[at : at + n].hex()})
        at += max(n, 0)
    return out


def array_elements(data: bytes) -> list[bytes | None] | None:
    """Elements of a one-dimensional array; None for more dimensions."""
    dims = int.from_bytes(data[:4], "big")
    if dims == 0:
        return []
    if dims > 1:
        return None
    out, at = [], 20
    for _ in range(int.from_bytes(data[12:16], "big")):
        n = struct.unpack(">i", data[at : at + 4])[0]
        out.append(None if n < 0 else data[at + 4 : at + 4 + n])
        at += 4 + max(n, 0)
    return out


def array_bytes(elements: list, oid: int) -> bytes:
    body = b"".join(struct.pack(">i", -1) if e is None else struct.pack(">i", len(e)) + e for e in elements)
    if not len(elements):
        return struct.pack(">iiI", 0, 0, oid)
    return struct.pack(">iiIii", 1, int(any(e is None for e in elements)), oid, len(elements), 1) + body


_INT = lambda data: int.from_bytes(data, "big", signed=True)
#: type -> (Spark type, decoder of one value's bytes), for fields in records
LAYOUTS: dict[str, tuple[str, Callable]] = {
    "numeric": ("string", numeric_text),
    "inet": ("struct<address:string,type:string,netmask:int>", _inet),
    "point": (_POINT, lambda d: _points(d)[0]),
    "lseg": (f"array<{_POINT}>", _points),
    "box": (f"array<{_POINT}>", _points),
    "path": (f"struct<open:boolean,points:array<{_POINT}>>", _path),
    "polygon": (f"array<{_POINT}>", lambda d: _points(d[4:])),
    "line": ("struct<a:double,b:double,c:double>", lambda d: dict(zip("abc", struct.unpack(">3d", d), strict=True))),
    "circle": ("struct<x:double,y:double,r:double>", lambda d: dict(zip("xyr", struct.unpack(">3d", d), strict=True))),
    "int4range": (_RANGE.format("bigint"), _range(_INT)),
    "int8range": (_RANGE.format("bigint"), _range(_INT)),
    "numrange": (_RANGE.format("string"), _range(numeric_text)),
    "daterange": (_RANGE.format("bigint"), _range(_INT)),
    "tsrange": (_RANGE.format("bigint"), _range(_INT)),
    "tstzrange": (_RANGE.format("bigint"), _range(_INT)),
    "tsvector": ("array<struct<text:string,entries:array<struct<position:int,weight:string>>>>", _tsvector),
    "record": ("array<struct<pos:int,oid:bigint,value:string>>", _record),
}


#: Type ids of the layouts, and of arrays with their elements' type.
OIDS = {
    "float4": 700, "float8": 701, "numeric": 1700, "inet": 869, "cidr": 650, "point": 600, "lseg": 601, "path": 602, "box": 603, "polygon": 604, "line": 628,
    "circle": 718, "int4range": 3904, "numrange": 3906, "tsrange": 3908, "tstzrange": 3910, "daterange": 3912, "int8range": 3926, "tsvector": 3614, "record": 2249,
    "bit": 1560, "varbit": 1562,
}
ARRAYS = {
    1000: "bool", 1001: "bytea", 1002: "char", 1003: "name", 1005: "int2", 1007: "int4", 1009: "text", 1014: "bpchar", 1015: "varchar", 1016: "int8", 1017: "point", 1018: "lseg", 1019: "path", 1020: "box",
    1021: "float4", 1022: "float8", 1027: "polygon", 1028: "oid", 1041: "inet", 1115: "timestamp", 1182: "date", 1183: "time", 1185: "timestamptz", 1231: "numeric", 199: "json", 2951: "uuid", 3221: "pg_lsn", 3807: "jsonb",
    651: "cidr", 719: "circle", 629: "line", 1561: "bit", 1563: "varbit", 3905: "int4range", 3907: "numrange", 3909: "tsrange", 3911: "tstzrange", 3913: "daterange", 3927: "int8range",
}


@dataclass(frozen=True)
class Type:
    """A type of values: its id, the Spark type of its columns, and what reads and writes a whole column of them. A user's own types are given as more of these."""

    oid: int
    spark: str
    decode: columns.Decode
    encode: Callable[[pa.Array], pa.Array] | None = None


def _each(one: Callable[[bytes], object], kind: pa.DataType) -> columns.Decode:
    """Layouts that hold parts of different kinds, value by value."""
    return lambda b: pa.array([None if d is None else one(d) for d in b.binary().to_pylist()], kind)


_INET = "struct<address:string,type:string,netmask:int>"
_TSVECTOR = pa.list_(pa.struct([("text", pa.string()), ("entries", pa.list_(pa.struct([("position", pa.int32()), ("weight", pa.string())])))]))
_RECORD = pa.list_(pa.struct([("pos", pa.int32()), ("oid", pa.int64()), ("value", pa.string())]))


def _tsvector_bytes(values: pa.Array) -> pa.Array:
    def one(words: list[dict] | None) -> bytes | None:
        if words is None:
            return None
        entry = lambda w: b"".join(struct.pack(">H", "DCBA".index(e["weight"]) << 14 | e["position"]) for e in w["entries"])
        return struct.pack(">i", len(words)) + b"".join(w["text"].encode() + b"\0" + struct.pack(">H", len(w["entries"])) + entry(w) for w in words)

    return pa.array([one(v) for v in values.to_pylist()], pa.binary())


def _record_bytes(values: pa.Array) -> pa.Array:
    def one(parts: list[dict] | None) -> bytes | None:
        if parts is None:
            return None
        field = lambda p: struct.pack(">Ii", p["oid"], -1) if p["value"] is None else struct.pack(">Ii", p["oid"], len(p["value"]) // 2) + bytes.fromhex(p["value"])
        return struct.pack(">i", len(parts)) + b"".join(map(field, parts))

    return pa.array([one(v) for v in values.to_pylist()], pa.binary())


def _bit_bytes(values: pa.Array) -> pa.Array:
    one = lambda t: None if t is None else struct.pack(">i", len(t)) + (int(t.ljust(-(-len(t) // 8) * 8, "0"), 2).to_bytes(-(-len(t) // 8), "big") if t else b"")
    return pa.array([one(t) for t in values.to_pylist()], pa.binary())


def _types() -> dict[str, Type]:
    whole = {"int2": (2, pa.int16(), "smallint"), "int4": (4, pa.int32(), "int"), "int8": (8, pa.int64(), "bigint"), "money": (8, pa.int64(), "bigint"), "time": (8, pa.int64(), "bigint"), "pg_lsn": (8, pa.int64(), "bigint")}
    out = {kind: Type(wire.OID[kind], spark, columns.whole(w, arrow), columns.whole_bytes(w)) for kind, (w, arrow, spark) in whole.items()}
    out |= {kind: Type(wire.OID[kind], "bigint", columns.whole(4, pa.int64(), signed=False), columns.whole_bytes(4)) for kind in ("oid", "xid")}
    out |= {kind: Type(wire.OID[kind], "string", columns.text, columns.text_bytes) for kind in ("text", "varchar", "bpchar", "name", "json", "char")}
    days = lambda v: columns.whole_bytes(4)(pc.subtract(v.cast(pa.int32()).cast(pa.int64()), columns.EPOCH_DAYS))
    micros = lambda v: columns.whole_bytes(8)(pc.subtract(v.cast(pa.timestamp("us", v.type.tz)).cast(pa.int64()), wire.EPOCH_MICROS))
    out |= {
        "bool": Type(16, "boolean", columns.boolean, lambda v: columns.whole_bytes(1)(v.cast(pa.int8()))),
        "bytea": Type(17, "binary", columns.blob, lambda v: v.cast(pa.binary())),
        "jsonb": Type(3802, "string", columns.jsonb, lambda v: pc.binary_join_element_wise(pa.scalar(b"\x01"), columns.text_bytes(v), b"")),
        "uuid": Type(2950, "string", columns.uuid, lambda v: pa.array([None if x is None else uuid.UUID(x).bytes for x in v.to_pylist()], pa.binary())),
        "date": Type(1082, "date", columns.date, days),
        "timestamp": Type(1114, "timestamp_ntz", columns.moment(None), micros),
        "timestamptz": Type(1184, "timestamp", columns.moment("UTC"), micros),
        "float4": Type(700, "float", columns.real(4), columns.real_bytes(4)),
        "float8": Type(701, "double", columns.real(8), columns.real_bytes(8)),
        "numeric": Type(1700, "string", columns.numeric, columns.numeric_bytes),
        "inet": Type(869, _INET, columns.inet, columns.inet_bytes),
        "cidr": Type(650, _INET, columns.inet, columns.inet_bytes),
        "point": Type(600, _POINT, columns.fields(x=0, y=8), columns.fields_bytes("x", "y")),
        "line": Type(628, "struct<a:double,b:double,c:double>", columns.fields(a=0, b=8, c=16), columns.fields_bytes("a", "b", "c")),
        "circle": Type(718, "struct<x:double,y:double,r:double>", columns.fields(x=0, y=8, r=16), columns.fields_bytes("x", "y", "r")),
        "lseg": Type(601, f"array<{_POINT}>", columns.corners, columns.points_bytes("none")),
        "box": Type(603, f"array<{_POINT}>", columns.corners, columns.points_bytes("none")),
        "polygon": Type(604, f"array<{_POINT}>", columns.polygon, columns.points_bytes("number")),
        "path": Type(602, f"struct<open:boolean,points:array<{_POINT}>>", columns.path, columns.points_bytes("path")),
        "tsvector": Type(3614, LAYOUTS["tsvector"][0], _each(_tsvector, _TSVECTOR), _tsvector_bytes),
        "record": Type(2249, LAYOUTS["record"][0], _each(_record, _RECORD), _record_bytes),
        "bit": Type(1560, "string", columns.bits, _bit_bytes),
        "varbit": Type(1562, "string", columns.bits, _bit_bytes),
    }
    for kind, bound in {"int4range": "int4", "int8range": "int8", "daterange": "int4", "tsrange": "int8", "tstzrange": "int8"}.items():
        width = 4 if bound == "int4" else 8
        out[kind] = Type(OIDS[kind], _RANGE.format("bigint"), columns.range_of(columns.whole(width, pa.int64())), columns.range_bytes(columns.whole_bytes(width)))
    out["numrange"] = Type(OIDS["numrange"], _RANGE.format("string"), columns.range_of(columns.numeric), columns.range_bytes(columns.numeric_bytes))
    return out


TYPES = _types()
#: Types that `shown` reads; expressions read the others.
SHOWN = (*OIDS,)


def oid_of(kind: str, types: dict[str, Type] | None = None) -> int:
    """The id of a type by its name; `x[]`, of any depth, is an array of x."""
    known = {**TYPES, **(types or {})}
    element = kind.rstrip("[]")
    if element == kind:
        return known[kind].oid if kind in known else wire.OID[kind]
    found = [oid for oid, name in ARRAYS.items() if name == element]
    if not found:
        raise ValueError(f"no array type of {element}")
    return found[0]


#: The type in which a Spark column goes out where none is named.
_BY_SPARK = {"boolean": "bool", "smallint": "int2", "int": "int4", "bigint": "int8", "float": "float4", "double": "float8", "string": "text", "binary": "bytea", "date": "date", "timestamp": "timestamptz", "timestamp_ntz": "timestamp"}


def kind_of(spark_type: str) -> str:
    """The type in which a column of a Spark type goes out: the widest that holds it without loss."""
    if spark_type.startswith("decimal"):
        return "numeric"
    if spark_type.startswith("array<"):
        return kind_of(spark_type[6:-1]) + "[]"
    by_struct = {t.spark: kind for kind, t in TYPES.items() if t.spark.startswith("struct") and kind not in ("cidr", "int4range", "daterange", "tsrange", "tstzrange")}
    found = {**by_struct, **_BY_SPARK}.get(spark_type)
    if found is None:
        raise ValueError(f"no type for {spark_type}")
    return found


def decoder(kind: str, types: dict[str, Type] | None = None) -> Callable[[Column], Column]:
    """Column of bytes -> column of values. `x[]` are lists of x, `x[][]` lists of lists, and so on: an array of other dimensions fails; `x[*]` takes any, as
    struct<lengths, lower, elements>. `[]` alone gives the elements' bytes."""
    known = {**TYPES, **(types or {})}
    if kind.endswith("[*]"):
        element = known[kind[:-3]] if kind != "[*]" else known["bytea"]

        def parts(values: pa.Array) -> pa.Array:
            found = columns.Arrays(columns.Bytes.of(values))
            return found.parts(element.decode(found.elements))

        return F.arrow_udf(parts, f"struct<lengths:array<int>,lower:array<int>,elements:array<{element.spark}>>")
    name = kind.rstrip("[]")
    element, depth = known[name or "bytea"], (len(kind) - len(name)) // 2

    def run(values: pa.Array) -> pa.Array:
        b = columns.Bytes.of(values)
        if not depth:
            return element.decode(b)
        found = columns.Arrays(b)
        return found.nested(element.decode(found.elements), depth)

    return F.arrow_udf(run, "array<" * depth + element.spark + ">" * depth)


def encoder(kind: str, element_oid: int = 0, types: dict[str, Type] | None = None) -> Callable[[Column], Column]:
    """Column of values -> column of bytes; lists, lists of lists and so on for `x[]`, `x[][]`. element_oid: the id that arrays name for their elements,
    where it isn't that of the type."""
    known = {**TYPES, **(types or {})}
    name = kind.rstrip("[]")
    depth = (len(kind) - len(name)) // 2
    if (name or "bytea") not in known or known[name or "bytea"].encode is None:
        raise ValueError(f"no encoder for {kind}")
    element = known[name or "bytea"]
    oid = element_oid or element.oid

    def run(values: pa.Array) -> pa.Array:
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return columns.array_bytes(values, element.encode, oid, depth) if depth else element.encode(values)

    return F.arrow_udf(run, "binary")


# ---- texts of any type, and fields in records


def _bits(data: bytes) -> str:
    return "".join(f"{b:08b}" for b in data[4:])[: int.from_bytes(data[:4], "big")]


def _plain_float(oid: int, data: bytes):
    value = struct.unpack(">f" if oid == 700 else ">d", data)[0]
    return _plain(float(str(np.float32(value))) if oid == 700 else value)


def _plain(value):
    """A value as JSON can hold it."""
    if isinstance(value, float) and not np.isfinite(value):
        return str(value).replace("inf", "Infinity").replace("nan", "NaN")
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, bytes):
        return "\\x" + value.hex()
    return value.isoformat() if hasattr(value, "isoformat") else value


def as_json(value) -> str | None:
    return None if value is None else json.dumps(value, ensure_ascii=False)


def nest(flat: list, lengths: list[int]) -> list:
    """Elements of an array as lists in lists."""
    for n in reversed(lengths[1:]):
        flat = [flat[k : k + n] for k in range(0, len(flat), n)] if n else []
    return flat


def array_plain(data: bytes, one: Callable[[bytes], object]) -> list:
    """An array of any dimensions from its bytes."""
    dims = int.from_bytes(data[:4], "big")
    lengths = [int.from_bytes(data[12 + 8 * d : 16 + 8 * d], "big") for d in range(dims)]
    out, at = [], 12 + 8 * dims
    for _ in range(int(np.prod(lengths)) if dims else 0):
        n = struct.unpack(">i", data[at : at + 4])[0]
        out.append(None if n < 0 else one(data[at + 4 : at + 4 + n]))
        at += 4 + max(n, 0)
    return nest(out, lengths)


def scalar(oid: int) -> Callable[[bytes], object] | None:
    """The decoder of one value of a built-in type to what JSON can hold; None for a type that isn't known."""
    if oid in (700, 701):
        return lambda d: _plain_float(oid, d)
    if oid == 1700:
        return numeric_text
    if oid == 16:
        return lambda d: d != b"\x00"
    if oid in ARRAYS:
        element = scalar(TYPES[ARRAYS[oid]].oid)
        return lambda d: array_plain(d, element)
    by_oid = {t.oid: t for t in TYPES.values()}
    if oid in by_oid:
        t = by_oid[oid]
        return lambda d: _plain(t.decode(columns.Bytes.of(pa.array([d], pa.binary()))).to_pylist()[0])
    return None


def joined(*parts: pa.Array | str) -> pa.Array:
    """Columns of texts and texts, one after the other."""
    return pc.binary_join_element_wise(*(pa.scalar(p, pa.string()) if isinstance(p, str) else p for p in parts), "")


def quoted(texts: pa.Array) -> pa.Array:
    """Texts as JSON strings, as `as_json` writes them; those that need escapes go one by one."""
    odd = pc.match_substring_regex(texts, r'["\\\x00-\x1f]').fill_null(False)
    out = joined('"', texts, '"')
    if pc.any(odd).as_py():
        out = pc.replace_with_mask(out, odd, pa.array([as_json(t) for t in texts.filter(odd).to_pylist()], pa.string()))
    return out.fill_null("null")


def list_texts(b: columns.Bytes, element: Callable[[columns.Bytes, np.ndarray], pa.Array], plain: Callable[[bytes, int], object]) -> pa.Array:
    """Arrays as JSON texts, from the texts of all their elements, which come with the number of their array. Those of more dimensions go value by value."""
    dims = b.number(0, 4)
    flat, deep = np.flatnonzero((dims == 0) | (dims == 1)), np.flatnonzero((dims != 0) & (dims != 1))
    found = columns.Arrays(b.part(flat))
    texts = element(found.elements, flat[np.repeat(np.arange(len(flat)), found.counts)]).fill_null("null")
    lists = columns._lists(found.counts, texts, np.ones(len(flat), bool))
    rest = [as_json(plain(bytes(b.flat[b.start[k] : b.start[k] + b.size[k]]), k)) for k in deep]
    return columns._scattered([(flat, joined("[", pc.binary_join(lists, ", "), "]")), (deep, pa.array(rest, pa.string()))], pa.string())


def json_texts(oid: int) -> columns.Decode | None:
    """`scalar` of a whole column without nulls, as JSON texts; None for a type that isn't known."""
    if oid in ARRAYS:
        element, one = json_texts(TYPES[ARRAYS[oid]].oid), scalar(oid)
        return lambda b: list_texts(b, lambda e, _: columns._scattered([(r := np.flatnonzero(e.valid), element(e.part(r))), (n := np.flatnonzero(~e.valid), pa.nulls(len(n), pa.string()))], pa.string()), lambda d, _: one(d))
    found = {t.oid: t for t in TYPES.values()}.get(oid)
    if found is None:
        return None
    if oid in (700, 701):
        return lambda b: pa.array([as_json(_plain_float(oid, d)) for d in b.binary().to_pylist()], pa.string())
    if oid == 16:
        return lambda b: pc.if_else(columns.boolean(b), "true", "false")
    if found.spark in ("smallint", "int", "bigint"):
        return lambda b: found.decode(b).cast(pa.string())
    if found.spark == "string":
        return lambda b: quoted(found.decode(b))
    return lambda b: pa.array([as_json(_plain(v)) or "null" for v in found.decode(b).to_pylist()], pa.string())


def _number_texts(width: int) -> columns.Decode:
    def run(b: columns.Bytes) -> pa.Array:
        flat = columns.real(width)(b).fill_null(0).to_numpy(zero_copy_only=False).astype(str)
        return pa.array(flat, pa.string(), mask=b.null())

    return run


def _whole_texts(t: Type, width: int) -> columns.Decode:
    """Whole numbers as texts; those of another width are left to expressions."""
    return lambda b: t.decode(b.slices(b.start, b.size, b.valid & (b.size == width))).cast(pa.string())


def _json_texts(t: Type) -> columns.Decode:
    return lambda b: pa.array([as_json(_plain(v)) for v in t.decode(b).to_pylist()], pa.string())


def _array_texts(t: Type) -> columns.Decode:
    def run(b: columns.Bytes) -> pa.Array:
        found = columns.Arrays(b)
        flat, ends = [_plain(v) for v in t.decode(found.elements).to_pylist()], np.cumsum(found.counts)
        row = lambda k: as_json(nest(flat[ends[k] - found.counts[k] : ends[k]], found.lengths[k, : found.dims[k]].tolist()))
        return pa.array([row(k) if found.valid[k] else None for k in range(len(b))], pa.string())

    return run


def _own_texts(t: Type) -> columns.Decode:
    """Texts of a user's own type: strings as they are, the rest as JSON."""
    return lambda b: pa.array([x if x is None or isinstance(x, str) else as_json(_plain(x)) for x in t.decode(b).to_pylist()], pa.string())


def _texts(own: dict[str, Type] | None = None) -> dict[int, columns.Decode]:
    out = {TYPES[kind].oid: _json_texts(TYPES[kind]) for kind in OIDS}
    out |= {TYPES[kind].oid: TYPES[kind].decode for kind in ("numeric", "bit", "varbit", "text", "varchar", "bpchar", "name", "json", "jsonb", "char")}
    out |= {TYPES[kind].oid: _whole_texts(TYPES[kind], width) for kind, width in (("int2", 2), ("int4", 4), ("int8", 8))}
    return out | {700: _number_texts(4), 701: _number_texts(8)} | {oid: _array_texts(TYPES[kind]) for oid, kind in ARRAYS.items()} | {t.oid: _own_texts(t) for t in (own or {}).values()}


def shown(values: Column, oids: Column, sent: Column | None = None, at: Column | None = None, graph=None, own: dict[str, Type] | None = None) -> Column:
    """Texts of a tuple's binary values, by their types, for texts, whole numbers and the types of this module (numbers as such, the rest as JSON); null for
    the other values. All values of one type in a batch are read together. sent, at, graph: the ids as they were sent, the change's position and the
    graph of user types, by which records and arrays of user types are read. own: types that a user adds, or puts in place of those of this module."""

    def run(tuples: pa.Array, types: pa.Array, *more: pa.Array) -> pa.Array:
        tuples, types, *more = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (tuples, types, *more))
        texts = _texts(own)
        valid = (pc.is_valid(tuples).to_numpy(zero_copy_only=False)) & (pc.is_valid(types).to_numpy(zero_copy_only=False))
        n, m = (np.where(valid, pc.list_value_length(x).fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64) for x in (tuples, types))
        row = np.repeat(np.arange(len(valid)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        flat = tuples.values.take(pa.array(tuples.offsets.to_numpy()[:-1][row] + place))
        has = place < m[row]
        ids = lambda x: np.where(has, x.values.fill_null(0).to_numpy(zero_copy_only=False)[np.where(has, x.offsets.to_numpy()[:-1][row] + place, 0)] if len(x.values) else 0, 0)
        oid = ids(types)
        binary = pc.equal(flat.field("kind"), "b").fill_null(False).to_numpy(zero_copy_only=False)
        data, parts, left = columns.Bytes.of(flat.field("data")), [], np.ones(len(row), bool)
        if graph is not None:
            was, position = ids(more[0]), more[1].to_numpy(zero_copy_only=False)[row] if len(row) else np.zeros(0)
            user = np.flatnonzero(binary & graph.composed(was, oid))
            left[user] = False
            for o in np.unique(was[user]).tolist():
                rows = user[was[user] == o]
                parts.append((rows, graph.json(o, data.part(rows), position[rows])))
        for o in np.unique(oid[binary & left]).tolist():
            if o in texts:
                rows = np.flatnonzero(binary & left & (oid == o))
                left[rows] = False
                parts.append((rows, texts[o](data.part(rows))))
        rest = np.flatnonzero(left)
        parts.append((rest, pa.nulls(len(rest), pa.string())))
        whole = columns._scattered(parts, pa.string())
        return columns._lists(n, whole, valid)

    more = [sent, at] if graph is not None else []
    return F.arrow_udf(run, "array<string>")(values, oids, *more)
