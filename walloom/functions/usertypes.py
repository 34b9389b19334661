"""The graph of a database's own types (enums, domains, composites, arrays of them) as it stood at each position of a log."""

from __future__ import annotations

import struct
from bisect import bisect_right
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import columns, layouts, wire

#: Ids of text, record and an array of records.
TEXT, RECORD, RECORDS = 25, 2249, 2287
LAST = 2**63 - 1
#: Fields of a composite at most.
MOST_FIELDS = 1664
ARRAY_OF = {layouts.TYPES[kind].oid: oid for oid, kind in layouts.ARRAYS.items()}
NAMES = {**{oid: kind for kind, oid in wire.OID.items()}, **{t.oid: kind for kind, t in layouts.TYPES.items()}, **{oid: f"{kind}[]" for oid, kind in layouts.ARRAYS.items()}}


@dataclass(frozen=True)
class Version:
    """kind: e an enum, d a domain over `base`, c a composite of `fields`, b another type (an array where `element` isn't 0)."""

    seq: int
    kind: str
    name: str
    base: int = 0
    element: int = 0
    fields: tuple[tuple[str, int], ...] = ()


@dataclass(frozen=True)
class TypeGraph:
    """Each type's versions by position. What isn't among them is a built-in type, or unknown."""

    versions: dict[int, list[Version]] = field(default_factory=dict)

    def at(self, oid: int, seq: int) -> Version | None:
        """The type as it stood at a position; null before its first version."""
        own = self.versions.get(oid, [])
        k = bisect_right(own, seq, key=lambda v: v.seq)
        return own[k - 1] if k else None

    def end(self, oid: int, seq: int) -> tuple[int, Version | None]:
        """What a domain is over in the end, however many domains lie between; a domain over itself fails."""
        seen = set()
        while (v := self.at(oid, seq)) is not None and v.kind == "d":
            if oid in seen:
                raise ValueError(f"type {oid} is a domain over itself")
            seen.add(oid)
            oid = v.base
        return oid, v

    def read(self, oid: int, seq: int) -> int:
        """The built-in type as which values are read: enums as text, composites as records, arrays by their elements."""
        oid, v = self.end(oid, seq)
        if v is None:
            return oid
        if v.kind == "e":
            return TEXT
        if v.kind == "c":
            return RECORD
        if v.element:
            element = self.read(v.element, seq)
            return RECORDS if element in (RECORD, RECORDS) else ARRAY_OF.get(element, oid)
        return oid

    def reached(self, oid: int) -> set[int]:
        """The type and all those that any of its versions is made of."""
        out, left = set(), [oid]
        while left:
            if (one := left.pop()) not in out:
                out.add(one)
                for v in self.versions.get(one, []):
                    left += [v.base, v.element, *(o for _, o in v.fields)]
        return out

    def changes(self, oid: int, low: int, high: int) -> set[int]:
        """Positions between two others at which the type, or one that it is made of, changes."""
        return {v.seq for one in self.reached(oid) for v in self.versions.get(one, []) if low < v.seq < high}

    def named(self, name: str) -> int | None:
        """The id of a type by its name, with or without its schema; of types that had the name, the latest."""
        found = [(own[-1].seq, oid) for oid, own in self.versions.items() if name in (own[-1].name, own[-1].name.rpartition(".")[2])]
        return max(found)[1] if found else None

    def composed(self, sent: np.ndarray, read: np.ndarray) -> np.ndarray:
        """Which values only the graph can read: records, and arrays of them, whose type is known."""
        return np.isin(read, (RECORD, RECORDS)) & np.isin(sent, list(self.versions))

    def plain(self, oid: int, data: bytes, seq: int):
        """A value as JSON can hold it, its fields and elements read by their own types: a composite by its fields' names, by their numbers where it
        has another number of fields than is known."""
        oid, v = self.end(oid, seq)
        if v is not None and v.kind == "e":
            return data.decode()
        if v is not None and v.kind == "c":
            return self._record(v, data, seq)
        if v is not None and v.element:
            return layouts.array_plain(data, lambda d: self.plain(v.element, d, seq))
        if oid == RECORD:
            return self._record(None, data, seq)
        one = _scalar(oid)
        if one is None:
            raise ValueError(f"no decoder for type {oid}")
        return one(data)

    def _record(self, v: Version | None, data: bytes, seq: int) -> dict:
        count, at, out = int.from_bytes(data[:4], "big"), 4, {}
        names = [n for n, _ in v.fields] if v is not None and len(v.fields) == count else [str(k + 1) for k in range(count)]
        for name in names:
            oid, n = struct.unpack(">Ii", data[at : at + 8])
            at += 8
            out[name] = None if n < 0 else self.plain(oid, data[at : at + n], seq)
            at += max(n, 0)
        return out

    def json(self, oid: int, b: columns.Bytes, at: np.ndarray, over: tuple[int, ...] = ()) -> pa.Array:
        """`plain` of a whole column, each value at its position, as JSON texts; null for nulls. Values of one version of a type are read together, field by field and all elements at once. over: the domains that
        led here."""
        own, parts = self.versions.get(oid, []), [(np.flatnonzero(~b.valid), pa.nulls(int((~b.valid).sum()), pa.string()))]
        which = np.searchsorted(np.array([v.seq for v in own], np.int64), at, side="right")
        for k in np.unique(which[b.valid]).tolist():
            rows = np.flatnonzero(b.valid & (which == k))
            parts.append((rows, self._version(oid, own[k - 1] if k else None, b.part(rows), at[rows], over)))
        return columns._scattered(parts, pa.string())

    def _version(self, oid: int, v: Version | None, b: columns.Bytes, at: np.ndarray, over: tuple[int, ...]) -> pa.Array:
        if v is not None and v.kind == "d":
            if oid in over:
                raise ValueError(f"type {oid} is a domain over itself")
            return self.json(v.base, b, at, (*over, oid))
        if v is not None and v.kind == "e":
            return layouts.quoted(columns.text(b))
        if oid == RECORD or (v is not None and v.kind == "c"):
            return self._records(v if v is not None and v.kind == "c" else None, b, at)
        if v is not None and v.element:
            return layouts.list_texts(b, lambda e, row: self.json(v.element, e, at[row]), lambda d, k: layouts.array_plain(d, lambda x: self.plain(v.element, x, int(at[k]))))
        one = _texts(oid)
        if one is None:
            raise ValueError(f"no decoder for type {oid}")
        return one(b)

    def _records(self, v: Version | None, b: columns.Bytes, at: np.ndarray) -> pa.Array:
        """Records of one version, those of as many fields together. What isn't as long as it says goes value by value."""
        count, parts = b.number(0, 4), []
        for n in np.unique(count).tolist():
            rows = np.flatnonzero(count == n)
            names = [name for name, _ in v.fields] if v is not None and len(v.fields) == n else [str(k + 1) for k in range(min(max(n, 0), MOST_FIELDS + 1))]
            own, place, odd = b.part(rows), b.start[rows] + 4, np.full(len(rows), not 0 < n <= MOST_FIELDS or len(set(names)) < n)
            end, texts = own.start + own.size, []
            for _ in range(0 if odd.all() else n):
                odd |= place + 8 > end
                head = columns.Bytes(own.flat, np.where(odd, 0, place), np.full(len(rows), 8), ~odd)
                oid, size = head.number(0, 4, False), head.number(4, 4)
                odd |= place + 8 + size > end
                has, text = ~odd & (size >= 0), []
                field = own.slices(place + 8, size, has)
                for o in np.unique(oid[has]).tolist():
                    some = np.flatnonzero(has & (oid == o))
                    text.append((some, self.json(o, field.part(some), at[rows[some]])))
                none = np.flatnonzero(~has)
                texts.append(columns._scattered([*text, (none, pa.array(["null"] * len(none), pa.string()))], pa.string()))
                place = place + 8 + np.maximum(size, 0)
            whole = layouts.joined(*(x for k, t in enumerate(texts) for x in (("{" if k == 0 else ", ") + layouts.as_json(names[k]) + ": ", t)), "}") if texts else pa.nulls(len(rows), pa.string())
            if odd.any():
                left = np.flatnonzero(odd)
                one = lambda k: layouts.as_json(self._record(v, bytes(own.flat[own.start[k] : own.start[k] + own.size[k]]), int(at[rows[k]])))
                whole = columns._scattered([(np.flatnonzero(~odd), whole.filter(pa.array(~odd))), (left, pa.array([one(k) for k in left], pa.string()))], pa.string())
            parts.append((rows, whole))
        return columns._scattered(parts, pa.string())


_scalar, _texts = lru_cache(None)(layouts.scalar), lru_cache(None)(layouts.json_texts)


def texts(graph: TypeGraph, oid: int):
    """Column of bytes and column of positions -> values of a user type as JSON."""

    def run(values: pa.Array, at: pa.Array) -> pa.Array:
        return graph.json(oid, columns.Bytes.of(values), at.to_numpy(zero_copy_only=False))

    return F.arrow_udf(run, "string")


def record_bytes(fields: list[tuple[int, Column]]) -> Column:
    """A composite's bytes from (type id, bytes or null) of its fields."""
    parts = [F.concat(wire.int_bytes(F.lit(oid), 4), F.coalesce(F.concat(wire.int_bytes(F.length(data), 4), data), wire.int_bytes(F.lit(-1), 4))) for oid, data in fields]
    return F.concat(wire.int_bytes(F.lit(len(fields)), 4), *parts)
