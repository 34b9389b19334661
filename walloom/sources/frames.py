"""Frames of a captured log: writing messages as binary frames, and reading frames back as typed messages.

frames(slot string, seq long, payload binary): a payload is a message, or a message behind a header of `w`, position, end
position and server clock.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import layouts, wire
from ..operators.transactions import carry_forward

#: The letters of the message kinds.
KINDS = {
    "B": "begin", "C": "commit", "O": "origin", "R": "relation", "Y": "type", "I": "insert", "U": "update", "D": "delete", "T": "truncate",
    "M": "message", "S": "stream_start", "E": "stream_stop", "c": "stream_commit", "A": "stream_abort",
}
LETTER = {name: letter for letter, name in KINDS.items()}
IDENTITY = {"d": "default", "n": "nothing", "f": "full", "i": "index"}
_TUPLE = pa.list_(pa.struct([("kind", pa.string()), ("data", pa.binary())]))
_ATTRIBUTES = pa.list_(pa.struct([("name", pa.string()), ("type_oid", pa.int64()), ("typmod", pa.int32()), ("is_key", pa.bool_())]))
ATTRIBUTES = "array<struct<name:string,type_oid:bigint,typmod:int,is_key:boolean>>"
TUPLE = "array<struct<kind:string,data:binary>>"
_LETTERS = pa.array([chr(k) for k in range(256)], pa.string())


def letter(kind: str) -> Column:
    return F.encode(F.lit(LETTER[kind]), "UTF-8")


# ---- writing


def begin(lsn: Column, micros: Column, xid: Column) -> Column:
    return F.concat(letter("begin"), wire.int_bytes(lsn, 8), wire.int_bytes(micros, 8), wire.int_bytes(xid, 4))


def commit(lsn: Column, end_lsn: Column, micros: Column) -> Column:
    return F.concat(letter("commit"), wire.int_bytes(F.lit(0), 1), wire.int_bytes(lsn, 8), wire.int_bytes(end_lsn, 8), wire.int_bytes(micros, 8))


def origin(lsn: Column, name: Column) -> Column:
    return F.concat(letter("origin"), wire.int_bytes(lsn, 8), wire.cstring(name))


def relation(oid: int, namespace: str, name: str, identity: str, attributes: list[tuple[str, str | int, bool]], xid: Column | None = None) -> Column:
    """attributes: (name, type or its id, key)."""
    parts = [letter("relation"), *([wire.int_bytes(xid, 4)] if xid is not None else []), wire.int_bytes(F.lit(oid), 4), wire.cstring(F.lit(namespace)), wire.cstring(F.lit(name)), F.encode(F.lit(identity), "UTF-8"), wire.int_bytes(F.lit(len(attributes)), 2)]
    for column, kind, key in attributes:
        parts += [wire.int_bytes(F.lit(int(key)), 1), wire.cstring(F.lit(column)), wire.int_bytes(F.lit(kind if isinstance(kind, int) else layouts.oid_of(kind)), 4), wire.int_bytes(F.lit(-1), 4)]
    return F.concat(*parts)


def type_message(oid: Column, namespace: Column, name: Column) -> Column:
    return F.concat(letter("type"), wire.int_bytes(oid, 4), wire.cstring(namespace), wire.cstring(name))


def tuple_bytes(values: list[tuple[Column, Column | None]]) -> Column:
    """A tuple of (bytes of the value or null, flag of an unchanged large value or None)."""
    one = []
    for data, unchanged in values:
        binary = F.concat(F.encode(F.lit("b"), "UTF-8"), wire.int_bytes(F.length(data), 4), data)
        held = F.coalesce(binary, F.encode(F.lit("n"), "UTF-8"))
        one.append(held if unchanged is None else F.when(unchanged, F.encode(F.lit("u"), "UTF-8")).otherwise(held))
    return F.concat(wire.int_bytes(F.lit(len(values)), 2), *one)


def _change(kind: str, oid: Column, *parts: Column, xid: Column | None = None) -> Column:
    return F.concat(letter(kind), *([wire.int_bytes(xid, 4)] if xid is not None else []), wire.int_bytes(oid, 4), *parts)


def insert(oid: Column, new: Column, xid: Column | None = None) -> Column:
    return _change("insert", oid, F.encode(F.lit("N"), "UTF-8"), new, xid=xid)


def update(oid: Column, new: Column, old: Column | None = None, old_kind: str = "K", xid: Column | None = None) -> Column:
    before = [F.encode(F.lit(old_kind), "UTF-8"), old] if old is not None else []
    return _change("update", oid, *before, F.encode(F.lit("N"), "UTF-8"), new, xid=xid)


def delete(oid: Column, old: Column, old_kind: str = "K", xid: Column | None = None) -> Column:
    return _change("delete", oid, F.encode(F.lit(old_kind), "UTF-8"), old, xid=xid)


def truncate(oids: Column, cascade: bool = False, restart: bool = False) -> Column:
    each = F.array_join(F.transform(oids, lambda o: F.hex(wire.int_bytes(o, 4))), "")
    return F.concat(letter("truncate"), wire.int_bytes(F.size(oids), 4), wire.int_bytes(F.lit(int(cascade) + 2 * int(restart)), 1), F.unhex(each))


def message(lsn: Column, prefix: Column, content: Column, transactional: Column, xid: Column | None = None) -> Column:
    head = [letter("message"), *([wire.int_bytes(xid, 4)] if xid is not None else [])]
    return F.concat(*head, wire.int_bytes(transactional.cast("int"), 1), wire.int_bytes(lsn, 8), wire.cstring(prefix), wire.int_bytes(F.length(content), 4), content)


def stream_start(xid: Column, first: Column) -> Column:
    return F.concat(letter("stream_start"), wire.int_bytes(xid, 4), wire.int_bytes(first.cast("int"), 1))


def stream_stop() -> Column:
    return letter("stream_stop")


def stream_commit(xid: Column, lsn: Column, end_lsn: Column, micros: Column) -> Column:
    return F.concat(letter("stream_commit"), wire.int_bytes(xid, 4), wire.int_bytes(F.lit(0), 1), wire.int_bytes(lsn, 8), wire.int_bytes(end_lsn, 8), wire.int_bytes(micros, 8))


def stream_abort(xid: Column, subxid: Column, lsn: Column | None = None, micros: Column | None = None) -> Column:
    more = [wire.int_bytes(lsn, 8), wire.int_bytes(micros, 8)] if lsn is not None and micros is not None else []
    return F.concat(letter("stream_abort"), wire.int_bytes(xid, 4), wire.int_bytes(subxid, 4), *more)


def wal(lsn: Column, end_lsn: Column, micros: Column, body: Column) -> Column:
    return F.concat(F.encode(F.lit("w"), "UTF-8"), wire.int_bytes(lsn, 8), wire.int_bytes(end_lsn, 8), wire.int_bytes(micros, 8), body)


# ---- reading


def split_frames(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(WAL data with lsn, end_lsn, system_clock and body; keep-alives with lsn, system_clock and reply)."""
    tag = F.decode(F.substring("payload", 1, 1), "ISO-8859-1")
    p = F.col("payload")
    data = frames.where(tag == "w").select("slot", "seq", wire.signed(p, 2, 8).alias("wal_lsn"), wire.signed(p, 10, 8).alias("end_lsn"), wire.micros_to_timestamp(wire.signed(p, 18, 8)).alias("system_clock"), F.substring(p, F.lit(26), F.length(p) - 25).alias("payload"))
    alive = frames.where(tag == "k").select("slot", "seq", wire.signed(p, 2, 8).alias("lsn"), wire.micros_to_timestamp(wire.signed(p, 10, 8)).alias("system_clock"), (wire.unsigned(p, 18, 1) == 1).alias("reply_asap"))
    return data, alive


def _split_tuple(flat: np.ndarray, at: np.ndarray, live: np.ndarray):
    """Tuples that begin at places of one byte buffer, column by column: (array of lists, place after each)."""
    n = len(at)
    at = at.copy()
    count = np.zeros(n, np.int64)
    count[live] = flat[at[live]].astype(np.int64) * 256 + flat[at[live] + 1]
    at[live] += 2
    width = int(count.max(initial=0))
    kind = np.zeros((n, width), np.uint8)
    start, size = np.zeros((n, width), np.int64), np.zeros((n, width), np.int64)
    for c in range(width):
        own = np.flatnonzero(count > c)
        kind[own, c] = flat[at[own]]
        at[own] += 1
        data = own[np.isin(kind[own, c], (98, 116))]
        size[data, c] = sum(flat[at[data] + k].astype(np.int64) << (8 * (3 - k)) for k in range(4))
        start[data, c] = at[data] + 4
        at[data] += 4 + size[data, c]
    there = np.arange(width)[None, :] < count[:, None]
    k, s, z = kind[there], start[there], size[there]
    ends = np.cumsum(z)
    body = flat[np.repeat(s - (ends - z), z) + np.arange(ends[-1] if len(ends) else 0)]
    has = np.isin(k, (98, 116))
    mask = np.packbits(has, bitorder="little").tobytes()
    data = pa.Array.from_buffers(pa.large_binary(), len(k), [pa.py_buffer(mask), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64).tobytes()), pa.py_buffer(body.tobytes())]).cast(pa.binary())
    kinds = _LETTERS.take(pa.array(k))
    values = pa.StructArray.from_arrays([kinds, data], ["kind", "data"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), values)
    return lists, at


def _null_lists(lists: pa.Array, live: np.ndarray) -> pa.Array:
    return pa.compute.if_else(pa.array(live), lists, pa.scalar(None, lists.type))


_ROWS = np.frombuffer("".join(LETTER[kind] for kind in ("insert", "update", "delete")).encode(), np.uint8)


def _bodies(payload: pa.Array, body: pa.Array) -> pa.Array:
    """old_kind, old_tuple, new_tuple and attributes of payloads, from the place after the table's id. Only these two columns go to Python, and only what is read comes back."""
    payload, body = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (payload, body))
    payload = payload.cast(pa.large_binary())
    n = len(payload)
    offsets = np.frombuffer(payload.buffers()[1], np.int64)[payload.offset : payload.offset + n + 1]
    flat = np.concatenate([np.frombuffer(payload.buffers()[2] or b"", np.uint8), np.zeros(8, np.uint8)])
    letter = np.where(np.diff(offsets) > 0, flat[offsets[:-1]], 0)
    at = offsets[:-1] + body.fill_null(0).to_numpy(zero_copy_only=False)
    row = np.isin(letter, _ROWS)
    place = np.where(row, at, 0)
    mark = np.where(row, flat[place], 0)
    old = np.isin(mark, (75, 79))
    old_tuple, after = _split_tuple(flat, np.where(old, at + 1, 0), old)
    second = np.where(old, after, at)
    new = np.isin(letter, _ROWS[:2])
    new_tuple, _ = _split_tuple(flat, np.where(new, second + 1, 0), new)
    attributes: list = [None] * n
    for k in np.flatnonzero(letter == ord(LETTER["relation"])):
        attributes[k] = _relation(flat, int(at[k]))
    kinds = _LETTERS.take(pa.array(mark.astype(np.uint8), mask=~old))
    return pa.StructArray.from_arrays([kinds, _null_lists(old_tuple, old), _null_lists(new_tuple, new), pa.array(attributes, _ATTRIBUTES)], ["old_kind", "old_tuple", "new_tuple", "attributes"])


def _relation(flat: np.ndarray, at: int) -> list[dict]:
    """The attribute list of a table description, from the place of its count."""
    out = []
    count, at = int(flat[at]) * 256 + int(flat[at + 1]), at + 2
    for _ in range(count):
        end = at + 1 + int(np.argmin(flat[at + 1 : at + 70000]))
        number = bytes(flat[end + 1 : end + 9])
        out.append({"name": bytes(flat[at + 1 : end]).decode(), "type_oid": int.from_bytes(number[:4], "big"), "typmod": int.from_bytes(number[4:], "big", signed=True), "is_key": bool(flat[at] & 1)})
        at = end + 9
    return out


def tag_of(payload: Column) -> Column:
    """The letter of a message's kind. Letters are ASCII, so that the byte is taken as it is; others are no letter of a kind."""
    return F.substring(payload, 1, 1).cast("string")


def stream_marker(payload: Column) -> Column:
    """What a message says of the block that those behind it stand in: its transaction's id, -1 that there is none, null where it says nothing."""
    tag = tag_of(payload)
    ends = [LETTER[kind] for kind in ("stream_stop", "begin", "commit", "stream_commit", "stream_abort")]
    return F.when(tag == LETTER["stream_start"], wire.unsigned(payload, 2, 4)).when(tag.isin(ends), F.lit(-1).cast("bigint"))


def messages(frames: DataFrame, rows: int = 1_000_000, failfast: bool = True) -> DataFrame:
    """frames(slot, seq, payload without header) -> one typed row a message, in a wide schema.

    Whether a change carries a transaction id depends on whether it stands inside a streamed block, so stream markers are
    carried forward first. Fixed layouts are read by expressions; tuples and attribute lists by one vectorised pass.
    Kinds that aren't known fail, or come out with type null. Frames that have stream_xid already aren't looked at for it; begin_seq is handed on.
    """
    p = F.col("payload")
    tag = tag_of(p)
    names = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    kind = names[tag]
    if failfast:
        kind = F.coalesce(kind, F.raise_error(F.concat(F.lit("unknown message kind "), F.decode(F.substring(p, 1, 1), "ISO-8859-1"))).cast("string"))
    typed = frames.withColumn("type", kind)
    if "stream_xid" not in frames.columns:
        typed = carry_forward(typed, stream_marker(p), "stream_xid", rows=rows)
    streamed = F.coalesce(F.col("stream_xid") >= 0, F.lit(False))
    of = lambda *kinds: F.col("type").isin(*kinds)
    carries = of("relation", "type", "insert", "update", "delete", "truncate", "message") & streamed
    base = F.when(carries, F.lit(6)).otherwise(F.lit(2))
    typed = typed.withColumn("at", base)
    at = F.col("at")
    typed = typed.withColumn("first_end", F.when(of("relation", "type"), wire.cstring_end(p, at + 4)).when(of("message"), wire.cstring_end(p, at + 9)).when(of("origin"), wire.cstring_end(p, F.lit(10))))
    typed = typed.withColumn("second_end", F.when(of("relation", "type"), wire.cstring_end(p, F.col("first_end") + 1)))
    # places are counted from 0 in the helper: of the byte after the table's id, or of a description's attribute count
    body = F.when(of("insert", "update", "delete"), at + 3).when(of("relation"), F.col("second_end") + 1)
    typed = typed.withColumn("body", body.cast("bigint"))
    whole = typed.withColumn("read", F.arrow_udf(_bodies, f"old_kind string, old_tuple {TUPLE}, new_tuple {TUPLE}, attributes {ATTRIBUTES}")("payload", "body"))
    first, second = F.col("first_end"), F.col("second_end")
    size = wire.unsigned(p, first + 1, 4)
    return whole.select(
        "slot", "seq", "type", "stream_xid", *(["begin_seq"] if "begin_seq" in frames.columns else []),
        F.when(of("begin"), wire.unsigned(p, 18, 4)).when(of("stream_start", "stream_commit", "stream_abort"), wire.unsigned(p, 2, 4)).when(carries, wire.unsigned(p, 2, 4)).alias("xid"),
        F.when(of("begin"), wire.signed(p, 2, 8)).when(of("message"), wire.signed(p, at + 1, 8)).alias("lsn"),
        F.when(of("commit"), wire.signed(p, 3, 8)).when(of("stream_commit"), wire.signed(p, 7, 8)).when(of("origin"), wire.signed(p, 2, 8)).alias("commit_lsn"),
        F.when(of("commit"), wire.signed(p, 11, 8)).when(of("stream_commit"), wire.signed(p, 15, 8)).alias("tx_end_lsn"),
        wire.micros_to_timestamp(F.when(of("begin"), wire.signed(p, 10, 8)).when(of("commit"), wire.signed(p, 19, 8)).when(of("stream_commit"), wire.signed(p, 23, 8))).alias("commit_timestamp"),
        F.when(of("stream_abort"), wire.unsigned(p, 6, 4)).alias("subtransaction_xid"),
        F.when(of("stream_abort") & (F.length(p) >= 25), wire.signed(p, 10, 8)).alias("abort_lsn"),
        F.when(of("stream_start"), F.when(wire.unsigned(p, 6, 1) == 1, "first").otherwise("other")).alias("segment"),
        F.when(of("relation", "type", "insert", "update", "delete"), wire.unsigned(p, at, 4)).alias("rel_oid"),
        F.when(of("relation", "type"), wire.text_between(p, at + 4, first)).alias("namespace"),
        F.when(of("relation", "type"), wire.text_between(p, first + 1, second)).when(of("origin"), wire.text_between(p, 10, first)).alias("name"),
        F.when(of("relation"), F.decode(F.substring(p, second + 1, F.lit(1)), "UTF-8")).alias("replica_identity"),
        "read.attributes", "read.old_kind", "read.old_tuple", "read.new_tuple",
        F.when(of("message"), wire.text_between(p, at + 9, first)).alias("prefix"),
        F.when(of("message"), F.substring(p, first + 5, size.cast("int"))).alias("content"),
        F.when(of("message"), wire.unsigned(p, at, 1) == 1).alias("transactional"),
        F.when(of("truncate"), F.transform(F.sequence(F.lit(0), wire.unsigned(p, at, 4) - 1), lambda k: wire.unsigned(p, at + 5 + 4 * k.cast("int"), 4))).alias("oids"),
        F.when(of("truncate"), wire.unsigned(p, at + 4, 1).bitwiseAND(F.lit(1)) == 1).alias("truncate_cascade"),
        F.when(of("truncate"), wire.unsigned(p, at + 4, 1).bitwiseAND(F.lit(2)) == 2).alias("truncate_restart_identity"),
    )
