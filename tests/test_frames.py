"""Golden bytes and round trips of the wire format."""

import datetime
import decimal
import struct

import pytest
from pyspark.sql import functions as F

from walloom import queries
from walloom.functions import layouts, lsn, wire
from walloom.operators import apply, catalog, rows, transactions
from walloom.sources import frames
from walloom.streaming import replica

GOLDEN = {
    "begin": "42000000000242c8e00002d9078ceeb45a000003e0",
    "relation": "52000042237075626c69630074006400020169640000000017ffffffff00730000000019ffffffff",
    "insert": "49000042234e0002620000000400000001620000000161",
    "commit": "4300000000000242c8e0000000000242ce180002d9078ceeb45a",
    "update": "55000042234b00026200000004000000016e4e000262000000040000000775",
    "delete": "44000042234b00026200000004000000076e",
    "truncate": "54000000010200004223",
    "message": "4d0100000000024334786d792d707265666978000000000d48656c6c6f2c20776f726c6421",
    "stream_start": "530000000301",
    "insert_streamed": "4900000004000042234e000262000000040000000974000000017a",
    "stream_stop": "45",
    "stream_commit": "630000000300000000000000000200000000000000120002d9078ceeb45a",
    "stream_abort": "41000000030000000400000000000000150002d9078ceeb45a",
}


@pytest.fixture(scope="module")
def decoded(spark):
    log = [("s", k, bytearray.fromhex(h)) for k, h in enumerate(GOLDEN.values())]
    found = frames.messages(spark.createDataFrame(log, "slot string, seq long, payload binary"), rows=4).collect()
    return {name: r.asDict(True) for name, r in zip(GOLDEN, sorted(found, key=lambda r: r["seq"]), strict=True)}


def test_fixed_layouts(decoded):
    at = datetime.datetime(2025, 5, 26, 12, 6, 45, 873754)
    assert (decoded["begin"]["lsn"], decoded["begin"]["xid"], decoded["begin"]["commit_timestamp"]) == (37931232, 992, at)
    assert (decoded["commit"]["commit_lsn"], decoded["commit"]["tx_end_lsn"]) == (37931232, 37932568)
    assert (decoded["stream_commit"]["xid"], decoded["stream_commit"]["commit_lsn"], decoded["stream_commit"]["tx_end_lsn"]) == (3, 2, 18)
    assert (decoded["stream_abort"]["xid"], decoded["stream_abort"]["subtransaction_xid"], decoded["stream_abort"]["abort_lsn"]) == (3, 4, 21)
    assert decoded["stream_start"]["segment"] == "first"


def test_descriptions_and_tuples(decoded):
    assert [(a["name"], a["type_oid"], a["is_key"]) for a in decoded["relation"]["attributes"]] == [("id", 23, True), ("s", 25, False)]
    assert [v["kind"] for v in decoded["update"]["new_tuple"]] == ["b", "u"]
    assert (decoded["update"]["old_kind"], decoded["delete"]["old_kind"]) == ("K", "K")
    assert decoded["insert_streamed"]["xid"] == 4 and bytes(decoded["insert_streamed"]["new_tuple"][1]["data"]) == b"z"
    assert decoded["insert"]["xid"] is None
    assert (decoded["truncate"]["oids"], decoded["truncate"]["truncate_cascade"], decoded["truncate"]["truncate_restart_identity"]) == ([16931], False, True)
    assert (decoded["message"]["prefix"], bytes(decoded["message"]["content"]), decoded["message"]["transactional"]) == ("my-prefix", b"Hello, world!", True)


def test_encoders_give_golden_bytes(spark):
    lit = F.lit
    micros = lit(801576405873754).cast("bigint")
    built = {
        "begin": frames.begin(lit(37931232), micros, lit(992)),
        "commit": frames.commit(lit(37931232), lit(37932568), micros),
        "relation": frames.relation(16931, "public", "t", "d", [("id", "int4", True), ("s", "text", False)]),
        "insert": frames.insert(lit(16931), frames.tuple_bytes([(wire.encode_value(lit(1), "int4"), None), (wire.encode_value(lit("a"), "text"), None)])),
        "truncate": frames.truncate(F.array(lit(16931)), restart=True),
        "message": frames.message(lit(37958776), lit("my-prefix"), F.encode(lit("Hello, world!"), "UTF-8"), lit(True)),
        "stream_start": frames.stream_start(lit(3), lit(True)),
        "stream_stop": frames.stream_stop(),
        "stream_commit": frames.stream_commit(lit(3), lit(2), lit(18), micros),
        "stream_abort": frames.stream_abort(lit(3), lit(4), lit(21), micros),
    }
    row = spark.range(1).select(*(F.lower(F.hex(c)).alias(n) for n, c in built.items())).first()
    assert {n: row[n] for n in built} == {n: GOLDEN[n] for n in built}


def test_unknown_kind_fails_or_is_null(spark):
    log = spark.createDataFrame([("s", 0, bytearray(b"?x"))], "slot string, seq long, payload binary")
    with pytest.raises(Exception, match="unknown message kind"):
        frames.messages(log).collect()
    assert frames.messages(log, failfast=False).first()["type"] is None


def test_no_frames(spark):
    assert frames.messages(spark.createDataFrame([], "slot string, seq long, payload binary")).count() == 0


@pytest.mark.parametrize("kind,values", [
    ("int8", [0, -1, 2**63 - 1, -(2**63), None]), ("int4", [0, -1, 2**31 - 1, -(2**31), None]), ("int2", [0, -1, 32767, -32768, None]), ("bool", [True, False, None]),
    ("text", ["", "é日本", None]), ("jsonb", ['{"a": 1}', None]), ("uuid", ["00112233-4455-6677-8899-aabbccddeeff", None]), ("pg_lsn", [0, 2**40, None]),
    ("date", [datetime.date(1999, 12, 31), datetime.date(2024, 2, 29), None]), ("bytea", [bytearray(b"\x00\xff"), None]),
])
def test_values_round_trip(spark, kind, values):
    spark_type = {"int8": "bigint", "int4": "int", "int2": "smallint", "bool": "boolean", "date": "date", "bytea": "binary", "pg_lsn": "bigint"}.get(kind, "string")
    df = spark.createDataFrame([(v,) for v in values], f"v {spark_type}")
    assert [r[0] for r in df.select(wire.decode_value(wire.encode_value(F.col("v"), kind), kind)).collect()] == values


@pytest.mark.parametrize("text", ["0", "0.00", "1.23000", "-1234567890.0001", "99999999999999999999999999999999999999999.5", "0.00001", "10000", "NaN", "-Infinity"])
def test_numeric_round_trip(text):
    back = layouts.numeric_text(layouts.numeric_bytes(text))
    assert back == text if text in ("NaN", "-Infinity") else decimal.Decimal(back) == decimal.Decimal(text) and back == text


def test_layouts(spark):
    double = lambda *x: struct.pack(f">{len(x)}d", *x)
    i4 = lambda n: struct.pack(">ii", 4, n)
    cases = {
        "inet": (bytes([2, 24, 0, 4, 192, 168, 0, 1]), {"address": "192.168.0.1", "type": "inet4", "netmask": 24}),
        "point": (double(1, 2), {"x": 1.0, "y": 2.0}),
        "path": (b"\x00" + struct.pack(">i", 1) + double(1, 2), {"open": True, "points": [{"x": 1.0, "y": 2.0}]}),
        "circle": (double(1, 2, 3), {"x": 1.0, "y": 2.0, "r": 3.0}),
        "int4range": (bytes([2]) + i4(1) + i4(5), {"lower": 1, "lower_inc": True, "upper": 5, "upper_inc": False, "lower_inf": False, "upper_inf": False, "empty": False}),
        "tsvector": (struct.pack(">i", 1) + b"cat\x00" + struct.pack(">HH", 1, 0xC003), [{"text": "cat", "entries": [{"position": 3, "weight": "A"}]}]),
        "record": (struct.pack(">i", 2) + struct.pack(">Ii", 23, 4) + b"\x00\x00\x00\x2a" + struct.pack(">Ii", 25, -1), [{"pos": 0, "oid": 23, "value": "0000002a"}, {"pos": 1, "oid": 25, "value": None}]),
    }
    for kind, (data, expected) in cases.items():
        df = spark.createDataFrame([(bytearray(data),), (None,)], "b binary")
        found = [r[0] for r in df.select(layouts.decoder(kind)("b").alias("v")).collect()]
        plain = found[0].asDict(True) if hasattr(found[0], "asDict") else [x.asDict(True) for x in found[0]]
        assert plain == expected, kind
    empty = layouts._range(lambda d: d)(bytes([1]))
    assert empty["empty"] and not empty["lower_inf"]
    assert layouts.array_elements(layouts.array_bytes([b"a", None, b""], 25)) == [b"a", None, b""]
    assert layouts.array_elements(layouts.array_bytes([], 25)) == []
    assert layouts.array_elements(struct.pack(">i", 2) + bytes(24)) is None


def test_special_floats(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-0.0,), (None,)], "v double")
    back = [r[0] for r in df.select(layouts.decoder("float8")(layouts.encoder("float8")("v"))).collect()]
    assert back[1] == float("inf") and back[2] == 0.0 and back[3] is None


def test_text_values(spark):
    df = spark.createDataFrame([("t", "$1,234.50", "12:00:01.5+02", "2024-01-02 03:04:05.678+00", "-$3", "1/A")], "b string, m string, z string, s string, n string, l string")
    row = df.select(wire.decode_text(F.col("b"), "bool"), wire.decode_text(F.col("m"), "money"), wire.decode_text(F.col("z"), "timetz"), wire.decode_text(F.col("s"), "timestamptz"), wire.decode_text(F.col("n"), "money"), wire.decode_text(F.col("l"), "pg_lsn")).first()
    assert row[0] is True and row[1] == 123450 and row[2].asDict() == {"micros": 43201500000, "offset_seconds": 7200}
    assert row[3] == datetime.datetime(2024, 1, 2, 3, 4, 5, 678000) and row[4] == -300 and row[5] == 2**32 + 10


def test_positions(spark):
    assert lsn.lsn_of("1/A") == 2**32 + 10 and lsn.lsn_of(7) == 7
    assert spark.range(1).select(lsn.text_to_lsn(F.lit("x/1"))).first()[0] is None


def test_tags(spark):
    tags = ["INSERT 0 1", "DELETE 2", "UPDATE 3", "MERGE 4", "SELECT 5", "MOVE 6", "FETCH 7", "COPY 8", "CREATE TABLE"]
    df = spark.createDataFrame([(t,) for t in tags], "tag string")
    found = [tuple(r) for r in df.select(catalog.command_of(F.col("tag")), catalog.rows_of(F.col("tag"))).collect()]
    assert found == [(t.split()[0], int(t.split()[-1])) for t in tags[:-1]] + [("CREATE TABLE", None)]


def test_unknown_type(spark):
    pairs = spark.createDataFrame([([("u", 99999)], [("b", bytearray(b"x"))])], "a array<struct<name:string,type_oid:bigint>>, v array<struct<kind:string,data:binary>>")
    with pytest.raises(Exception, match="no decoder"):
        pairs.select(rows.row_map(F.col("a"), F.col("v"))).collect()
    own = {99999: lambda d: F.concat(F.lit("own "), F.decode(d, "UTF-8"))}
    assert pairs.select(rows.row_map(F.col("a"), F.col("v"), own)).first()[0] == {"u": "own x"}
    assert pairs.select(rows.row_map(F.col("a"), F.col("v"), failfast=False)).first()[0] == {}


def test_state_is_carried_over_empty_buckets(spark):
    log = spark.createDataFrame([("s", 0, "a"), ("s", 1, None), ("s", 25, None), ("s", 31, "b"), ("s", 99, None), ("t", 5, None)], "slot string, seq long, m string")
    found = {(r["slot"], r["seq"]): r["v"] for r in transactions.carry_forward(log, F.col("m"), "v", rows=10).collect()}
    assert found == {("s", 0): "a", ("s", 1): "a", ("s", 25): "a", ("s", 31): "b", ("s", 99): "b", ("t", 5): None}


def test_null_that_was_written_wins(spark):
    log = spark.createDataFrame([(1, "insert", "x", 1), (1, "update", None, 2), (2, "insert", "y", 3), (2, "delete", None, 4)], "k int, op string, v string, seq long")
    assert [tuple(r) for r in apply.latest_state(log, ["k"], ["v"], ["seq"]).collect()] == [(1, None)]


def test_replayed_batch_changes_nothing(spark):
    log = spark.createDataFrame([(1, "a", False, "insert", 1, 10), (1, "b", False, "update", 2, 20)], "k int, v string, m boolean, op string, seq long, commit_lsn long")
    table = replica.Replica(replica.folder(spark), ["k"], ["v"], {"v": "m"})
    table(log.where("seq = 1"), 0)
    table(log, 1)
    table(log, 1)
    assert [tuple(r) for r in table.table(spark, 1).collect()] == [(1, "b")] and table.position(spark, 1) == 20
    table(log.where("seq = 1"), 2)
    assert [tuple(r) for r in table.table(spark, 2).collect()] == [(1, "b")] and table.position(spark, 2) == 20


@pytest.mark.parametrize("name", ["row_map", "rename_keys"])
def test_rows_with_names_take_no_python_of_their_own(spark, sf_dir, name):
    """Frames are decoded once for descriptions and rows, and the few descriptions are found without another pass through Python."""
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
