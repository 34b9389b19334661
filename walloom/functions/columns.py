"""Whole columns of binary values, read and written with numpy over their bytes: nothing here calls Python once a value, but for IPv6 addresses."""

from __future__ import annotations

import ipaddress
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .wire import EPOCH_MICROS

Decode = Callable[["Bytes"], pa.Array]
#: Days from 1970-01-01 to 2000-01-01.
EPOCH_DAYS = 10957
#: Values of which a matrix of digits is made together; those of like width go together.
ROWS = 1 << 14
POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])


class Bytes:
    """Values as places in one buffer: value k is flat[start[k] : start[k] + size[k]], or null."""

    def __init__(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray, valid: np.ndarray):
        self.flat, self.start, self.size, self.valid = flat, start, size, valid

    @classmethod
    def of(cls, values: pa.Array | pa.ChunkedArray) -> Bytes:
        values = (values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values).cast(pa.large_binary())
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
        body = values.buffers()[2] if len(values) else None
        flat = np.concatenate([np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8), np.zeros(8, np.uint8)])
        valid = values.is_valid().to_numpy(zero_copy_only=False)
        return cls(flat, offsets[:-1].copy(), np.where(valid, np.diff(offsets), 0), valid)

    def __len__(self) -> int:
        return len(self.start)

    def part(self, rows: np.ndarray) -> Bytes:
        return Bytes(self.flat, self.start[rows], self.size[rows], self.valid[rows])

    def slices(self, start: np.ndarray, size: np.ndarray, valid: np.ndarray) -> Bytes:
        """Other places of the same buffer."""
        return Bytes(self.flat, np.where(valid, start, 0), np.where(valid, size, 0), valid)

    def number(self, at: np.ndarray | int, width: int, signed: bool = True) -> np.ndarray:
        """The big-endian number at a place of each value; 0 for nulls."""
        place = np.where(self.valid, self.start + at, len(self.flat) - 8)
        out = np.zeros(len(self), np.uint64)
        for k in range(width):
            out = (out << np.uint64(8)) | self.flat[place + k].astype(np.uint64)
        if signed and width < 8:
            out = out.astype(np.int64)
            return out - ((out >> (8 * width - 1)) << (8 * width))
        return out.astype(np.int64)

    def doubles(self, at: np.ndarray | int) -> np.ndarray:
        return self.number(at, 8).view(np.float64)

    def need(self, width: int) -> None:
        if (self.size[self.valid] != width).any():
            raise ValueError(f"a value of {width} bytes has another length")

    def null(self) -> np.ndarray:
        return ~self.valid

    def binary(self, kind: pa.DataType = pa.binary()) -> pa.Array:
        """The values laid end to end."""
        ends = np.cumsum(self.size)
        body = self.flat[np.repeat(self.start - (ends - self.size), self.size) + np.arange(ends[-1] if len(ends) else 0)]
        return _laid(body, self.size, self.valid).cast(kind)


def _laid(body: np.ndarray, size: np.ndarray, valid: np.ndarray, kind: pa.DataType = pa.large_binary()) -> pa.Array:
    mask = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.Array.from_buffers(kind, len(size), [mask, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())])


def _masked(chars: np.ndarray, keep: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Texts from a matrix of characters and which of them stay."""
    keep = keep & valid[:, None]
    return _laid(chars[keep], keep.sum(axis=1), valid, pa.large_string()).cast(pa.string())


def _alike(width: np.ndarray):
    """Rows in runs of at most ROWS, those of like width together."""
    order = np.argsort(width, kind="stable")
    cuts = np.flatnonzero(np.diff(np.frexp(width[order].astype(float) + 1)[1])) + 1
    for run in np.split(order, cuts):
        for a in range(0, len(run), ROWS):
            yield run[a : a + ROWS]


def _scattered(parts: list[tuple[np.ndarray, pa.Array]], kind: pa.DataType) -> pa.Array:
    """Parts of a column put back to their places."""
    if not parts:
        return pa.array([], kind)
    back = np.argsort(np.concatenate([rows for rows, _ in parts]), kind="stable")
    return pa.concat_arrays([p for _, p in parts]).take(pa.array(back))


# ---- numbers


def whole(width: int, kind: pa.DataType, signed: bool = True) -> Decode:
    def decode(b: Bytes) -> pa.Array:
        b.need(width)
        return pa.array(b.number(0, width, signed), pa.int64(), mask=b.null()).cast(kind)

    return decode


def real(width: int) -> Decode:
    def decode(b: Bytes) -> pa.Array:
        b.need(width)
        if width == 8:
            return pa.array(b.doubles(0), pa.float64(), mask=b.null())
        return pa.array(b.number(0, 4, False).astype(np.uint32).view(np.float32), pa.float32(), mask=b.null())

    return decode


_SPECIAL = {0xC000: "NaN", 0xD000: "Infinity", 0xF000: "-Infinity"}


def numeric(b: Bytes) -> pa.Array:
    """Digits in base 10000 with a weight, a sign and a scale, as plain decimal texts; NaN and infinities as such."""
    count, weight, sign, scale = (b.number(2 * k, 2, k == 1) for k in range(4))
    special = b.valid & (sign >= 0xC000)
    left, right = np.where(special, 1, np.maximum(weight + 1, 1)), np.where(special, 0, -(-scale // 4))
    parts = []
    for rows in _alike(left + right):
        own, n, w, at, s = b.part(rows), count[rows], weight[rows], left[rows], scale[rows]
        most, rest = int(at.max(initial=1)), int(right[rows].max(initial=0))
        # groups aligned at the point: column `most` is the first behind it
        groups = np.zeros((len(rows), most + rest), np.int64)
        for k in range(int(np.where(special[rows], 0, n).max(initial=0))):
            column = most - 1 - w + k
            has = (k < n) & ~special[rows] & own.valid & (column >= 0) & (column < most + rest)
            groups[has, column[has]] = own.part(np.flatnonzero(has)).number(8 + 2 * k, 2, False)
        digits = np.stack([groups // d % 10 for d in (1000, 100, 10, 1)], axis=2).reshape(len(rows), -1).astype(np.uint8) + 48
        place = np.arange(4 * most)[None, :]
        seen = np.maximum.accumulate(digits[:, : 4 * most] != 48, axis=1) | (place == 4 * most - 1)
        after = np.arange(4 * rest)[None, :] < s[:, None]
        one = np.ones((len(rows), 1), bool)
        minus, point = one * (sign[rows] == 0x4000)[:, None], one * (s > 0)[:, None]
        chars = np.concatenate([np.full((len(rows), 1), 45, np.uint8), digits[:, : 4 * most], np.full((len(rows), 1), 46, np.uint8), digits[:, 4 * most :]], axis=1)
        parts.append((rows, _masked(chars, np.concatenate([minus, seen, point, after], axis=1), own.valid)))
    texts = _scattered(parts, pa.string())
    for code, name in _SPECIAL.items():
        if (own := special & (sign == code)).any():
            texts = pc.if_else(pa.array(own), name, texts)
    known = ~special | np.isin(sign, list(_SPECIAL))
    return texts if known.all() else pc.if_else(pa.array(known), texts, pa.scalar(None, pa.string()))


def numeric_bytes(values: pa.Array) -> pa.Array:
    """The same the other way, from plain decimal texts (no exponents)."""
    values = values.cast(pa.string())
    special = {pc.equal(values, name).fill_null(False).to_numpy(zero_copy_only=False).tobytes(): code for code, name in _SPECIAL.items()}
    b = Bytes.of(values.cast(pa.binary()))
    code = np.zeros(len(b), np.int64)
    for mask, c in special.items():
        code[np.frombuffer(mask, bool)] = c
    negative = b.valid & (code == 0) & (b.size > 0) & (b.flat[b.start] == 45)
    start, size = b.start + negative, np.where(code == 0, b.size - negative, 0)
    parts = []
    for rows in _alike(size):
        n, width = size[rows], int(size[rows].max(initial=0))
        there = np.arange(width)[None, :] < n[:, None]
        chars = np.where(there, b.flat[np.minimum(start[rows][:, None] + np.arange(width)[None, :], len(b.flat) - 1)], 0)
        dot = np.where((chars == 46).any(axis=1), (chars == 46).argmax(axis=1) if width else 0, n)
        if (there & (chars != 46) & ((chars < 48) | (chars > 57))).any():
            raise ValueError("a numeric's text isn't a plain decimal")
        scale = np.maximum(n - dot - 1, 0)
        most, rest = int((-(-dot // 4)).max(initial=0)), int((-(-scale // 4)).max(initial=0))
        digits = np.zeros((len(rows), 4 * (most + rest)), np.int64)
        r, c = np.nonzero(there & (chars != 46))
        column = np.where(c < dot[r], 4 * most - dot[r] + c, 4 * most + c - dot[r] - 1)
        digits[r, column] = chars[r, c] - 48
        groups = (digits.reshape(len(rows), most + rest, 4) * [1000, 100, 10, 1]).sum(axis=2)
        some = groups != 0
        any_ = some.any(axis=1)
        first = np.where(any_, some.argmax(axis=1) if most + rest else 0, 0)
        last = np.where(any_, most + rest - (some[:, ::-1].argmax(axis=1) if most + rest else 0), 0)
        weight = np.where(any_, most - 1 - first, 0)
        sign = np.where(code[rows] != 0, code[rows], np.where(negative[rows], 0x4000, 0))
        head = np.stack([last - np.where(any_, first, 0), weight, sign, scale], axis=1)
        words = np.concatenate([head, groups], axis=1) & 0xFFFF
        out = np.stack([words >> 8, words & 255], axis=2).reshape(len(rows), -1).astype(np.uint8)
        place = np.arange(most + rest)[None, :]
        keep = np.concatenate([np.ones((len(rows), 4), bool), (place >= first[:, None]) & (place < last[:, None])], axis=1)
        keep = np.repeat(keep, 2, axis=1) & b.valid[rows][:, None]
        parts.append((rows, _laid(out[keep], keep.sum(axis=1), b.valid[rows]).cast(pa.binary())))
    return _scattered(parts, pa.binary())


# ---- texts, times, ids


def text(b: Bytes) -> pa.Array:
    return b.binary().cast(pa.string())


def blob(b: Bytes) -> pa.Array:
    return b.binary()


def jsonb(b: Bytes) -> pa.Array:
    """JSON behind the number of its layout, which is 1; null for others."""
    good = b.valid & (b.size > 0) & (b.flat[b.start] == 1)
    return text(b.slices(b.start + 1, b.size - 1, good))


def boolean(b: Bytes) -> pa.Array:
    b.need(1)
    return pa.array(b.number(0, 1) != 0, mask=b.null())


def date(b: Bytes) -> pa.Array:
    b.need(4)
    return pa.array((b.number(0, 4) + EPOCH_DAYS).astype(np.int32), pa.int32(), mask=b.null()).cast(pa.date32())


def moment(zone: str | None) -> Decode:
    """Times; infinite ones are null."""

    def decode(b: Bytes) -> pa.Array:
        b.need(8)
        micros = b.number(0, 8)
        far = np.abs(micros.astype(float)) > 2.0**62
        return pa.array(np.where(far, 0, micros) + EPOCH_MICROS, pa.int64(), mask=b.null() | far).cast(pa.timestamp("us", tz=zone))

    return decode


_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def uuid(b: Bytes) -> pa.Array:
    b.need(16)
    data = b.flat[np.where(b.valid, b.start, 0)[:, None] + np.arange(16)[None, :]] if len(b) and len(b.flat) >= 16 + 8 else np.zeros((len(b), 16), np.uint8)
    chars = np.stack([_HEX[data >> 4], _HEX[data & 15]], axis=2).reshape(len(b), 32)
    dash = np.full((len(b), 1), 45, np.uint8)
    chars = np.concatenate([chars[:, :8], dash, chars[:, 8:12], dash, chars[:, 12:16], dash, chars[:, 16:20], dash, chars[:, 20:]], axis=1)
    return _masked(chars, np.ones(chars.shape, bool), b.valid)


def bits(b: Bytes) -> pa.Array:
    """A bit string as its digits."""
    count, parts = b.number(0, 4), []
    for rows in _alike(count):
        own, n = b.part(rows), count[rows]
        width = -(-int(n.max(initial=0)) // 8)
        data = own.flat[np.minimum(np.where(own.valid, own.start + 4, 0)[:, None] + np.arange(width)[None, :], len(own.flat) - 1)]
        digits = np.unpackbits(data, axis=1) + 48 if width else np.zeros((len(rows), 0), np.uint8)
        parts.append((rows, _masked(digits, np.arange(8 * width)[None, :] < n[:, None], own.valid)))
    return _scattered(parts, pa.string())


# ---- addresses, geometry, ranges


def inet(b: Bytes) -> pa.Array:
    family, mask = b.number(0, 1, False), b.number(1, 1, False)
    four = pc.binary_join_element_wise(*(pa.array(b.number(4 + k, 1, False)).cast(pa.string()) for k in range(4)), ".")
    six = np.flatnonzero(b.valid & (b.size == 20))
    if len(six):
        long = b.slices(b.start + 4, b.size - 4, b.valid & (b.size == 20)).binary()
        four = pc.if_else(pa.array(b.size == 20), pa.array([None if x is None else str(ipaddress.IPv6Address(x)) for x in long.to_pylist()], pa.string()), four)
    kind = pc.if_else(pa.array(family == 2), "inet4", "inet6")
    return pa.StructArray.from_arrays([four, kind, pa.array(mask.astype(np.int32))], ["address", "type", "netmask"], mask=pa.array(b.null()))


def _lists(counts: np.ndarray, values: pa.Array, valid: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(valid, counts, 0))]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array(~valid)) if len(valid) else pa.ListArray.from_arrays(offsets, values)


def _points(b: Bytes, at: int, counts: np.ndarray) -> pa.Array:
    """So many points of each value from a place on, one after the other."""
    counts = np.where(b.valid, counts, 0)
    row = np.repeat(np.arange(len(b)), counts)
    place = at + 16 * (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts))
    each = b.part(row)
    return pa.StructArray.from_arrays([pa.array(each.doubles(place)), pa.array(each.doubles(place + 8))], ["x", "y"])


def fields(**at: int) -> Decode:
    """A struct of doubles at places."""

    def decode(b: Bytes) -> pa.Array:
        b.need(8 * len(at))
        return pa.StructArray.from_arrays([pa.array(b.doubles(p)) for p in at.values()], list(at), mask=pa.array(b.null()))

    return decode


def corners(b: Bytes) -> pa.Array:
    two = np.full(len(b), 2)
    return _lists(two, _points(b, 0, two), b.valid)


def polygon(b: Bytes) -> pa.Array:
    n = b.number(0, 4)
    return _lists(n, _points(b, 4, n), b.valid)


def path(b: Bytes) -> pa.Array:
    n = b.number(1, 4)
    return pa.StructArray.from_arrays([pa.array(b.number(0, 1) == 0), _lists(n, _points(b, 5, n), np.ones(len(b), bool) & b.valid)], ["open", "points"], mask=pa.array(b.null()))


def range_of(element: Decode) -> Decode:
    def decode(b: Bytes) -> pa.Array:
        flags = b.number(0, 1, False)
        empty, at, bounds = (flags & 1) != 0, np.ones(len(b), np.int64), []
        for bit in (8, 16):
            has = b.valid & ~empty & ((flags & bit) == 0)
            size = np.where(has, b.part(np.arange(len(b))).slices(b.start, b.size, has).number(at, 4), 0)
            bounds.append(element(b.slices(b.start + at + 4, size, has)))
            at = at + np.where(has, 4 + size, 0)
        flag = lambda bit: pa.array((flags & bit) != 0)
        infinite = lambda bit: pa.array(((flags & bit) != 0) & ~empty)
        return pa.StructArray.from_arrays([bounds[0], flag(2), bounds[1], flag(4), infinite(8), infinite(16), pa.array(empty)], ["lower", "lower_inc", "upper", "upper_inc", "lower_inf", "upper_inf", "empty"], mask=pa.array(b.null()))

    return decode


# ---- arrays


def _list_of(kind: pa.DataType, depth: int) -> pa.DataType:
    return pa.list_(_list_of(kind, depth - 1)) if depth else kind


class Arrays:
    """Arrays of any number of dimensions: for each value its lengths and lower bounds, and all elements of all values one after the other."""

    def __init__(self, b: Bytes):
        self.valid, self.dims = b.valid, b.number(0, 4)
        if (self.dims[b.valid] > 6).any() or (self.dims[b.valid] < 0).any():
            raise ValueError("an array has six dimensions at most")
        self.element_oid = np.where(self.dims >= 0, b.number(8, 4, False), 0)
        most = int(self.dims.max(initial=0))
        self.lengths, self.lower = np.ones((len(b), most), np.int64), np.ones((len(b), most), np.int64)
        for d in range(most):
            own = np.flatnonzero(b.valid & (self.dims > d))
            part = b.part(own)
            self.lengths[own, d], self.lower[own, d] = part.number(12 + 8 * d, 4), part.number(16 + 8 * d, 4)
        self.counts = np.where(b.valid & (self.dims > 0), self.lengths.prod(axis=1), 0)
        # each step takes the next element of all values that have one more, so that places follow from the lengths before them
        at, first = b.start + 12 + 8 * self.dims, np.cumsum(self.counts) - self.counts
        start, size = np.zeros(int(self.counts.sum()), np.int64), np.full(int(self.counts.sum()), -1, np.int64)
        live = np.flatnonzero(self.counts > 0)
        for k in range(int(self.counts.max(initial=0))):
            live = live[self.counts[live] > k]
            n = Bytes(b.flat, at[live], np.full(len(live), 4), np.ones(len(live), bool)).number(0, 4)
            start[first[live] + k], size[first[live] + k] = at[live] + 4, n
            at[live] += 4 + np.maximum(n, 0)
        self.elements = b.slices(start, size, size >= 0) if len(start) else Bytes(b.flat, start, np.zeros(0, np.int64), np.zeros(0, bool))

    def nested(self, values: pa.Array, depth: int) -> pa.Array:
        """Lists in lists, `depth` deep, over the elements' values. An empty array is an empty list; an array of other dimensions fails."""
        some = self.valid & (self.dims > 0)
        if (self.dims[some] != depth).any():
            raise ValueError(f"an array hasn't {depth} dimensions")
        out = values
        if self.lengths.shape[1] < depth:  # none has an element
            return pa.array([[] if v else None for v in self.valid], _list_of(values.type, depth))
        for d in range(depth - 1, 0, -1):
            inner = np.repeat(self.lengths[:, d], np.where(some, self.lengths[:, :d].prod(axis=1), 0))
            out = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)), out)
        outer = np.where(some, self.lengths[:, 0], 0) if self.lengths.shape[1] else np.zeros(len(self.valid), np.int64)
        return _lists(outer, out, self.valid)

    def parts(self, values: pa.Array) -> pa.Array:
        """struct<lengths, lower, elements>, which holds arrays of any dimensions in one column."""
        dims = np.where(self.valid, self.dims, 0)
        there = np.arange(self.lengths.shape[1])[None, :] < dims[:, None]
        of = lambda x: _lists(dims, pa.array(x[there].astype(np.int32), pa.int32()), self.valid)
        return pa.StructArray.from_arrays([of(self.lengths), of(self.lower), _lists(self.counts, values, self.valid)], ["lengths", "lower", "elements"], mask=pa.array(~self.valid))


def array_bytes(lists: pa.Array, encode: Callable[[pa.Array], pa.Array], oid: int, depth: int, lower: int = 1) -> pa.Array:
    """Lists in lists, `depth` deep and of equal lengths at each depth, as arrays. An empty list is the array without dimensions."""
    n, valid = len(lists), lists.is_valid().to_numpy(zero_copy_only=False)
    lengths, level = np.zeros((n, depth), np.int64), lists
    owner = np.arange(n)
    for d in range(depth):
        if d and level.null_count:
            raise ValueError("an inner list is null")
        own = pc.list_value_length(level).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        most = np.zeros(n, np.int64)
        np.maximum.at(most, owner, own)
        if (own != most[owner]).any():
            raise ValueError("lists of one depth have different lengths")
        lengths[:, d] = most
        level, owner = level.flatten(), np.repeat(owner, own)
    data = Bytes.of(encode(level))
    counts = np.bincount(owner, minlength=n) if len(owner) else np.zeros(n, np.int64)
    some = valid & (counts > 0)
    nulls = np.zeros(n, bool)
    np.logical_or.at(nulls, owner, ~data.valid)
    head = np.concatenate([_big(x, 4) for x in (np.where(some, depth, 0), nulls.astype(np.int64), np.full(n, oid), *(x for d in range(depth) for x in (lengths[:, d], np.full(n, lower))))], axis=1)
    head_size = np.where(valid, np.where(some, head.shape[1], 12), 0)
    size = np.where(data.valid, data.size, 0)
    total = head_size + np.bincount(owner, weights=4 + size, minlength=n).astype(np.int64) if len(owner) else head_size
    out = np.zeros(int(total.sum()), np.uint8)
    start = np.cumsum(total) - total
    for width in np.unique(head_size).tolist():
        own = np.flatnonzero(head_size == width)
        out[start[own][:, None] + np.arange(width)] = head[own, :width]
    if len(owner):
        ends = np.cumsum(4 + size)
        first = np.searchsorted(owner, np.arange(n))
        at = start[owner] + head_size[owner] + (ends - 4 - size) - np.concatenate([ends - 4 - size, [0]])[first][owner]
        out[at[:, None] + np.arange(4)] = _big(np.where(data.valid, data.size, -1), 4)
        widths = np.unique(size)
        if len(widths) <= 16:
            for width in widths[widths > 0].tolist():
                own = np.flatnonzero(size == width)
                step = np.arange(width)
                out[(at[own] + 4)[:, None] + step] = data.flat[data.start[own][:, None] + step]
        else:
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            out[np.repeat(at + 4, size) + step] = data.flat[np.repeat(data.start, size) + step]
    return _laid(out, total, valid).cast(pa.binary())


# ---- the other way


def _big(numbers: np.ndarray, width: int) -> np.ndarray:
    """Whole numbers as rows of so many bytes, in two's complement."""
    return np.ascontiguousarray(numbers, ">i8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]


def whole_bytes(width: int) -> Callable[[pa.Array], pa.Array]:
    def encode(values: pa.Array) -> pa.Array:
        flat = values.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        data = _big(flat, width)
        valid = values.is_valid().to_numpy(zero_copy_only=False)
        return _laid(data[valid].ravel(), np.where(valid, width, 0), valid).cast(pa.binary())

    return encode


def real_bytes(width: int) -> Callable[[pa.Array], pa.Array]:
    def encode(values: pa.Array) -> pa.Array:
        flat = values.fill_null(0).to_numpy(zero_copy_only=False).astype(f">f{width}")
        valid = values.is_valid().to_numpy(zero_copy_only=False)
        return _laid(flat.view(np.uint8).reshape(-1, width)[valid].ravel(), np.where(valid, width, 0), valid).cast(pa.binary())

    return encode


def text_bytes(values: pa.Array) -> pa.Array:
    return values.cast(pa.string()).cast(pa.binary())


def inet_bytes(values: pa.Array) -> pa.Array:
    """struct<address, type, netmask> as an address; one that isn't of its type fails."""

    def one(v: dict | None) -> bytes | None:
        if v is None:
            return None
        address = ipaddress.ip_address(v["address"]).packed
        return bytes([2 if len(address) == 4 else 3, v["netmask"], 0, len(address)]) + address

    return pa.array([one(v) for v in values.to_pylist()], pa.binary())


def _joined(parts: list[Bytes], valid: np.ndarray) -> pa.Array:
    """The parts of each row one after the other; a null part is nothing."""
    sizes = np.stack([np.where(p.valid, p.size, 0) for p in parts], axis=1) * valid[:, None]
    total = sizes.sum(axis=1)
    begin = (np.cumsum(total) - total)[:, None] + np.cumsum(sizes, axis=1) - sizes
    out = np.zeros(int(total.sum()), np.uint8)
    for k, p in enumerate(parts):
        n = sizes[:, k]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begin[:, k], n) + step] = p.flat[np.repeat(p.start, n) + step]
    return _laid(out, total, valid).cast(pa.binary())


def fields_bytes(*names: str) -> Callable[[pa.Array], pa.Array]:
    """A struct of doubles, one after the other."""

    def encode(values: pa.Array) -> pa.Array:
        valid = values.is_valid().to_numpy(zero_copy_only=False)
        return _joined([Bytes.of(real_bytes(8)(values.field(n))) for n in names], valid)

    return encode


def points_bytes(head: str) -> Callable[[pa.Array], pa.Array]:
    """Lists of points: as they are, or behind their number, or behind whether the path is closed and their number."""

    def encode(values: pa.Array) -> pa.Array:
        lists = values.field("points") if head == "path" else values
        valid = values.is_valid().to_numpy(zero_copy_only=False)
        n = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = fields_bytes("x", "y")(lists.flatten())
        body = Bytes.of(flat)
        whole_ = Bytes(body.flat, np.minimum(16 * (np.cumsum(n) - n), len(body.flat) - 8), 16 * n, valid)
        parts = [whole_]
        if head != "none":
            parts = [Bytes.of(whole_bytes(4)(pa.array(n))), whole_]
        if head == "path":
            parts = [Bytes.of(whole_bytes(1)(pc.if_else(values.field("open").fill_null(False), 0, 1))), *parts]
        return _joined(parts, valid)

    return encode


def range_bytes(element: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
    def encode(values: pa.Array) -> pa.Array:
        valid = values.is_valid().to_numpy(zero_copy_only=False)
        flag = lambda c: values.field(c).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        empty = flag("empty")
        flags = np.where(empty, 1, 2 * flag("lower_inc") + 4 * flag("upper_inc") + 8 * flag("lower_inf") + 16 * flag("upper_inf"))
        parts = [Bytes.of(whole_bytes(1)(pa.array(flags)))]
        for side in ("lower", "upper"):
            own = ~empty & ~flag(f"{side}_inf")
            data = Bytes.of(element(values.field(side)))
            if (own & valid & ~data.valid).any():
                raise ValueError("a range's bound is null but not infinite")
            size = Bytes.of(whole_bytes(4)(pa.array(data.size)))
            parts += [Bytes(x.flat, x.start, x.size, own) for x in (size, data)]
        return _joined(parts, valid)

    return encode
