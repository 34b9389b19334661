"""Whole columns of values there and back, the database's own types, and points found by position."""

from __future__ import annotations

import datetime
import json
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from walloom import queries
from walloom.functions import columns, layouts, usertypes, wire
from walloom.jobs import deliver, replicate
from walloom.operators import apply, asof, catalog, changes, progress, rows, transactions, verify
from walloom.sources import frames
from walloom.streaming import replica

POINT = {"x": 1.5, "y": -2.0}
VALUES = {
    "bool": [True, False, None], "int2": [-1, 32767, None], "int4": [-(2**31), 0, None], "int8": [-(2**63), 2**63 - 1, None], "oid": [0, 2**32 - 1, None], "text": ["", "é日本", None], "bytea": [b"", b"\x00\xff", None],
    "jsonb": ['{"a": 1}', None], "uuid": ["00112233-4455-6677-8899-aabbccddeeff", None], "float4": [0.5, -1.0, None], "float8": [1e300, float("inf"), None],
    "date": [datetime.date(1999, 12, 31), datetime.date(2024, 2, 29), None], "timestamp": [datetime.datetime(1999, 12, 31, 23, 59, 59, 999999), None],
    "numeric": ["0", "0.00", "-1234567890.0001", "9" * 60 + ".5", "0.00001", "NaN", "Infinity", "-Infinity", "10000", None],
    "inet": [{"address": "10.0.255.1", "type": "inet4", "netmask": 8}, {"address": "2001:db8::1", "type": "inet6", "netmask": 64}, None],
    "point": [POINT, None], "lseg": [[POINT, {"x": 0.0, "y": 9.0}], None], "polygon": [[POINT] * 3, [POINT], None], "path": [{"open": True, "points": [POINT, POINT]}, {"open": False, "points": [POINT]}, None],
    "line": [{"a": 1.0, "b": 2.0, "c": 3.0}, None], "circle": [{"x": 1.0, "y": 2.0, "r": 3.0}, None],
    "int4range": [{"lower": 1, "lower_inc": True, "upper": 5, "upper_inc": False, "lower_inf": False, "upper_inf": False, "empty": False}, {"lower": None, "lower_inc": False, "upper": None, "upper_inc": False, "lower_inf": False, "upper_inf": False, "empty": True}, None],
    "numrange": [{"lower": None, "lower_inc": False, "upper": "-2.50", "upper_inc": True, "lower_inf": True, "upper_inf": False, "empty": False}, None],
    "tsvector": [[{"text": "cat", "entries": [{"position": 3, "weight": "A"}]}, {"text": "dog", "entries": []}], [], None], "record": [[{"pos": 0, "oid": 23, "value": "0000002a"}, {"pos": 1, "oid": 25, "value": None}], None],
    "varbit": ["", "1", "0000000011", None],
}


@pytest.mark.parametrize("kind", sorted(VALUES))
def test_columns_there_and_back(spark, kind):
    spark_type = layouts.TYPES[kind].spark
    df = spark.createDataFrame([(v,) for v in VALUES[kind]], f"v {spark_type}")
    back = df.select(layouts.decoder(kind)(layouts.encoder(kind)("v")).alias("v")).collect()
    plain = lambda x: x.asDict(True) if hasattr(x, "asDict") else [plain(y) for y in x] if isinstance(x, list) else bytes(x) if isinstance(x, bytearray) else x
    assert [plain(r["v"]) for r in back] == VALUES[kind]


@pytest.mark.parametrize("kind", ["int4", "text", "numeric", "point", "numrange", "float8"])
def test_arrays_of_dimensions(spark, kind):
    a, b = VALUES[kind][0], VALUES[kind][-2]
    element = layouts.TYPES[kind].spark
    plain = lambda x: x.asDict(True) if hasattr(x, "asDict") else [plain(y) for y in x] if isinstance(x, list) else x
    for depth, lists in ((1, [[a, None, b], [], None, [b]]), (2, [[[a, None], [b, a]], [], None, [[b], [a], [None]]]), (3, [[[[a], [b]]], None])):
        df = spark.createDataFrame([(x,) for x in lists], f"v {'array<' * depth + element + '>' * depth}")
        packed = df.select(layouts.encoder(kind + "[]" * depth)("v").alias("b"))
        assert [plain(r["v"]) for r in packed.select(layouts.decoder(kind + "[]" * depth)("b").alias("v")).collect()] == lists
        parts = packed.select(layouts.decoder(kind + "[*]")("b").alias("v")).collect()
        assert [None if r["v"] is None else (len(r["v"]["lengths"]), r["v"]["lower"]) for r in parts] == [None if x is None else (depth * bool(x), [1] * depth * bool(x)) for x in lists]


def test_arrays_with_other_lower_bounds_and_dimensions(spark):
    one = lambda n: struct.pack(">ii", 4, n)
    cube = struct.pack(">iiI", 2, 0, 23) + struct.pack(">iiii", 2, -3, 1, 7) + one(5) + one(6)
    df = spark.createDataFrame([(bytearray(cube),)], "b binary")
    found = df.select(layouts.decoder("int4[*]")("b").alias("v"), layouts.decoder("int4[][]")("b").alias("m")).first()
    assert found["v"].asDict() == {"lengths": [2, 1], "lower": [-3, 7], "elements": [5, 6]} and found["m"] == [[5], [6]]
    with pytest.raises(Exception, match="hasn't 1 dimensions"):
        df.select(layouts.decoder("int4[]")("b")).collect()
    uneven = spark.createDataFrame([([[1], [2, 3]],)], "v array<array<int>>")
    with pytest.raises(Exception, match="different lengths"):
        uneven.select(layouts.encoder("int4[][]")("v")).collect()


def test_numerics_by_columns_equal_one_by_one():
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choice("0001239") for _ in range(n))
    texts = [None, *((rng.choice(["", "-"]) + (digits(rng.randint(1, 30)).lstrip("0") or "0") + rng.choice(["", "." + digits(rng.randint(1, 20))])) for _ in range(2000))]
    data = columns.numeric_bytes(pa.array(texts))
    assert data.to_pylist() == [None if t is None else layouts.numeric_bytes(t) for t in texts]
    assert columns.numeric(columns.Bytes.of(data.slice(7, 900))).to_pylist() == [layouts.numeric_text(d) for d in data.to_pylist()[7:907]]
    with pytest.raises(ValueError, match="plain decimal"):
        columns.numeric_bytes(pa.array(["1e5"]))


def test_types_by_name_and_by_column():
    assert layouts.oid_of("int4[]") == layouts.oid_of("int4[][]") == 1007 and layouts.oid_of("numeric") == 1700 and layouts.oid_of("interval") == 1186
    assert [layouts.kind_of(t) for t in ("int", "array<array<bigint>>", "decimal(10,2)", "timestamp_ntz", layouts.TYPES["point"].spark)] == ["int4", "int8[][]", "numeric", "timestamp", "point"]
    with pytest.raises(ValueError, match="no encoder"):
        layouts.encoder("nothing")


def test_a_type_of_the_users_own_both_ways(spark):
    own = {"celsius": layouts.Type(80001, "double", lambda b: pa.compute.divide(columns.whole(4, pa.int64())(b).cast(pa.float64()), 10.0), lambda v: columns.whole_bytes(4)(pa.compute.multiply(v, 10.0).cast(pa.int64())))}
    df = spark.createDataFrame([(21.5,), (None,)], "v double")
    assert [r[0] for r in df.select(layouts.decoder("celsius", own)(layouts.encoder("celsius", types=own)("v"))).collect()] == [21.5, None]
    nested = df.select(F.array("v", "v").alias("v")).select(layouts.decoder("celsius[]", own)(layouts.encoder("celsius[]", types=own)("v")).alias("v"))
    assert [r["v"] for r in nested.collect()] == [[21.5, 21.5], [None, None]] and layouts.oid_of("celsius", own) == 80001


# ---- the database's own types


def graph():
    v = usertypes.Version
    return usertypes.TypeGraph({
        1: [v(0, "e", "mood")], 2: [v(0, "d", "a", base=3)], 3: [v(0, "d", "b", base=3802)], 4: [v(0, "c", "place", fields=(("n", 20), ("m", 1))), v(50, "c", "place", fields=(("number", 20), ("m", 1)))],
        5: [v(0, "b", "_place", element=4)], 6: [v(0, "c", "trip", fields=(("stops", 5), ("doc", 2), ("tags", 1009)))], 7: [v(10, "d", "late", base=23), v(60, "e", "late")], 8: [v(0, "d", "x", base=9)], 9: [v(0, "d", "y", base=8)],
    })


def record(*fields):
    return struct.pack(">i", len(fields)) + b"".join(struct.pack(">Ii", oid, -1) if d is None else struct.pack(">Ii", oid, len(d)) + d for oid, d in fields)


def test_graph_reads_types_as_they_stood():
    g = graph()
    assert [g.read(o, 55) for o in (1, 2, 4, 5, 20)] == [25, 3802, 2249, 2287, 20]
    assert [g.read(7, s) for s in (5, 10, 59, 60)] == [7, 23, 23, 25] and g.changes(6, 0, 100) == {50} and g.changes(7, 10, 60) == set()
    with pytest.raises(ValueError, match="domain over itself"):
        g.read(8, 1)


def test_records_in_arrays_in_records():
    g = graph()
    place = lambda n: record((20, struct.pack(">q", n)), (1, b"happy" if n else None))
    places = layouts.array_bytes([place(1), None, place(0)], 4)
    trip = record((5, places), (2, b'\x01{"k": 1}'), (1009, layouts.array_bytes([b"x", None], 25)))
    assert g.plain(6, trip, 10) == {"stops": [{"n": 1, "m": "happy"}, None, {"n": 0, "m": None}], "doc": '{"k": 1}', "tags": ["x", None]}
    assert g.plain(6, trip, 50)["stops"][0] == {"number": 1, "m": "happy"}
    assert g.plain(4, record((20, struct.pack(">q", 7))), 1) == {"1": 7}  # other fields than are known
    with pytest.raises(ValueError, match="no decoder for type 99999"):
        g.plain(4, record((99999, b"?"), (1, None)), 1)


def test_descriptions_follow_their_types(spark):
    about = spark.createDataFrame([("s", 20, 7, "t", [("a", 4, -1, True), ("b", 20, -1, False)]), ("s", 80, 7, "t", [("a", 1, -1, True)])], f"slot string, seq long, rel_oid long, name string, attributes {frames.ATTRIBUTES}")
    found = [(r["seq"], [(a["name"], a["type_oid"], a["sent_oid"], a["is_key"]) for a in r["attributes"]]) for r in catalog.resolved(about, graph()).orderBy("seq").collect()]
    assert found == [(s, [("a", 2249, 4, True), ("b", 20, 20, False)]) for s in (20, 50)] + [(80, [("a", 25, 1, True)])]


def test_long_chains_of_domains_and_circles(spark):
    chain = [(k, "d", k + 1) for k in range(1000, 1100)] + [(1100, "d", 23)]
    kinds = "type_oid long, kind string, base_oid long"
    attributes = spark.createDataFrame([("a", 1000), ("b", 25)], "name string, type_oid long")
    got = catalog.base_types(spark.createDataFrame(chain, kinds), attributes).collect()
    assert {r["name"]: r["resolved_oid"] for r in got} == {"a": 23, "b": 25}
    with pytest.raises(ValueError, match="domain over itself"):
        catalog.base_types(spark.createDataFrame([(1, "d", 1)], kinds), attributes)


def test_unknown_types_stop_the_job_and_are_set_aside(spark, sf_dir):
    landed, types = queries.user_type_frames(spark, sf_dir, unknown=True)
    with pytest.raises(Exception, match="no decoder for type 70010 of column nick"):
        deliver.deliver(spark, landed, types=types).collect()
    nick = {70010: lambda d: F.decode(d, "UTF-8")}
    kept, aside = deliver.split(spark, landed, nick, types)
    assert aside.isEmpty() and kept.where("new_row.nick LIKE 'Nick %'").count() > 0


# ---- points by position


@pytest.mark.parametrize("most", [0, 10**6])
def test_latest_points_by_lookup_and_by_shuffle(spark, most):
    rng = random.Random(7)
    log = [(rng.choice(["a", "b", None]), rng.randrange(3), k, f"x{k}") for k in range(400)]
    points = [(rng.choice(["a", "b", None]), rng.randrange(3), k, 1000 + k) for k in sorted(rng.sample(range(400), 60))]
    df, marks = spark.createDataFrame(log, "slot string, rel long, seq long, payload string"), spark.createDataFrame(points, "slot string, rel long, seq long, v long")
    got = {(r["payload"]): r["found"] for r in asof.latest_at(df, marks, ["slot", "rel"], "seq", "v", "found", rows=50, most=most).collect()}
    want = {p: max(((at, v) for s, r, at, v in points if (s, r) == (slot, rel) and at <= seq), default=(None, None))[1] for slot, rel, seq, p in log}
    assert got == want


def test_decoding_shuffles_no_payload(spark, sf_dir):
    for found in (queries.frames_roundtrip_orders(spark, sf_dir), queries.frames_roundtrip_events(spark, sf_dir)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Exchange" in line and "payload" in line]
    plan = frames.messages(queries.order_frames(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_very_many_versions_of_one_table(spark):
    n = 100_000
    versions = spark.range(n).select(F.lit("s").alias("slot"), (F.col("id") * 10).alias("seq"), F.lit(7).cast("bigint").alias("rel_oid"), F.concat(F.lit("v"), F.col("id")).alias("name"))
    log = spark.range(200_000).select(F.lit("s").alias("slot"), (F.col("id") * 5 + 3).alias("seq"), F.lit(7).cast("bigint").alias("rel_oid"))
    got = progress.as_of(log, versions, ["slot", "rel_oid"])
    assert got.where(F.col("name") != F.concat(F.lit("v"), F.floor(F.col("seq") / 10))).isEmpty() and got.count() == 200_000


def test_versions_that_say_nothing_new_are_left_out(spark):
    said = spark.createDataFrame([(1, 1, "a", None), (1, 2, "a", None), (1, 3, None, None), (1, 4, None, None), (2, 5, "a", None), (1, 6, "a", None)], "rel long, seq long, x string, y string")
    assert sorted((r["rel"], r["seq"]) for r in progress.without_repeats(said, ["rel"]).collect()) == [(1, 1), (1, 3), (1, 6), (2, 5)]


# ---- rows that move, replicas that are compared


def test_large_values_follow_chains_of_moves(spark):
    log = [  # (seq, op, key, old key, value, unsent)
        (1, "insert", "a", None, "big", False), (2, "update", "b", "a", None, True), (3, "update", "c", "b", None, True), (4, "insert", "a", None, "other", False), (5, "update", "d", "c", None, True),
        (6, "update", "d", None, None, True), (7, "update", "e", "d", None, True), (8, "update", "x", "never", None, True), (9, "insert", "n", None, None, False), (10, "update", "m", "n", None, True), (11, "update", "y", "a", "new", False), (12, "delete", "y", None, None, False), (13, "update", "q", "e", None, True), (14, "update", "e", "q", None, True),
    ]
    df = spark.createDataFrame(log, "seq long, op string, k string, old_k string, v string, unsent boolean")
    moved = apply.moved_keys(df, "k", "old_k", ["v"])
    for size in (3, 1_000_000):
        found = apply.with_moved_values(moved, ["k"], ["old_k"], ["seq", "part"], {"v": "unsent"}, rows=size)
        assert sorted(tuple(r) for r in apply.latest_state(found, ["k"], ["v"], ["seq", "part"], {"v": "unsent"}).collect()) == [("e", "big"), ("m", None), ("x", None)]
        flags = {r["seq"]: r["unsent"] for r in found.where("part = 1").collect()}
        assert not any(flags[s] for s in (2, 3, 5, 7, 10, 13, 14)) and flags[8] and flags[6]


def test_few_differences_cost_few_leaves(spark):
    n = 60_000
    left = spark.range(n).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 10).alias("v"))
    right = left.withColumn("v", F.when(F.col("id") % 1000 == 1, -1).otherwise(F.col("v")))
    twice = left.union(left.where("id = 7 OR id = 8")).union(left.where("id = 7"))
    depth = verify.depth_of(n)
    near = verify.differing_leaves(verify.leaves(left, depth), verify.leaves(right, depth), depth)
    share = left.withColumn("leaf", verify.leaf_of(left.columns, depth)).join(near, "leaf", "left_semi").count() / n
    assert 0 < share < 0.5
    got = sorted(((r["side"], r["id"]) for r in verify.differences(left, right).collect()))
    assert got == sorted((side, k) for side in ("left", "right") for k in range(1, n, 1000))
    assert sorted((r["side"], r["id"]) for r in verify.differences(twice, left).collect()) == [("left", 7), ("left", 7), ("left", 8)]
    assert verify.differences(left, left).isEmpty()
    trees = [verify.Tree.build(t, replica.folder(spark), depth) for t in (left, right)]
    assert sorted((r["side"], r["id"]) for r in trees[0].differences(trees[1], spark).collect()) == got
    assert trees[0].differences(trees[0], spark).isEmpty()


def test_leaves_grow_with_the_table():
    assert [verify.depth_of(n) for n in (0, 5000, 10**6, 10**12)] == [1, 2, 3, 8]


def test_a_replica_of_its_own_types_in_pieces(spark, sf_dir):
    landed, types = queries.user_type_frames(spark, sf_dir)
    table = replica.FrameReplica(replica.folder(spark), "public.profile", ["user_id"], queries.PROFILE, buckets=4, types=types)
    got = replica.run_to_end(spark, landed, table, "seq", replica.Decoder(replica.folder(spark), table), pieces=2)
    want = replicate.replicate(spark, landed, "public.profile", ["user_id"], queries.PROFILE, types=types)
    plain = lambda df: sorted((json.dumps(r.asDict(), sort_keys=True) for r in df.select(sorted(df.columns)).collect()))
    assert plain(got) == plain(want)


def test_carried_markers_equal_shuffled_ones(spark):
    log = spark.range(500).select(F.lit("s").alias("slot"), F.col("id").alias("seq"))
    mark = F.when(F.col("seq") % 37 == 5, F.floor(F.col("seq") / 74)).cast("bigint")
    one, two = ([tuple(r) for r in transactions.carry_forward(log, mark, "m", rows=40, most=most).orderBy("seq").collect()] for most in (0, 10**6))
    assert one == two and one[4][2] is None and one[42][2] == 0


def test_wire_and_columns_agree(spark):
    df = spark.createDataFrame([(datetime.date(2024, 2, 29), "00112233-4455-6677-8899-aabbccddeeff", -5, True, "é")], "d date, u string, n int, b boolean, t string")
    for c, kind in (("d", "date"), ("u", "uuid"), ("n", "int4"), ("b", "bool"), ("t", "text")):
        row = df.select(wire.encode_value(F.col(c), kind).alias("x"), layouts.encoder(kind)(c).alias("y"), F.col(c)).select("x", "y", layouts.decoder(kind)("x").alias("z"), c).first()
        assert row["x"] == row["y"] and row["z"] == row[c]


def test_known_types_cover_the_registry():
    assert {t.oid for t in layouts.TYPES.values()} <= set(rows.known_oids()) | {wire.OID["xid"]}


@pytest.mark.parametrize("rows_", [20, 10**6])
def test_histories_of_hot_keys(spark, rows_):
    """One key holds most changes; buckets and windows give the same."""
    log = spark.range(300).select(F.col("id").alias("seq"), F.when(F.col("id") % 4 == 0, F.col("id") % 7).otherwise(F.lit(None)).alias("k"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("v"), (F.col("id") % 5 == 1).alias("unsent"))
    order = {r["seq"]: r for r in log.collect()}
    before = {r["seq"]: r["old_v"] for r in changes.previous_versions(log, ["k"], ["v"], "seq", rows=rows_).collect()}
    known = {r["seq"]: r["v"] for r in changes.filled(log, ["k"], {"v": "unsent"}, "seq", rows=rows_).collect()}
    for seq, row in order.items():
        own = [r for s, r in order.items() if s <= seq and r["k"] == row["k"]]
        sent = [r["v"] for r in own if not r["unsent"]]
        assert before[seq] == (own[-2]["v"] if len(own) > 1 else None) and known[seq] == (sent[-1] if sent else None)


def test_conditions_from_the_servers_list(spark, tmp_path):
    path = tmp_path / "codes.txt"
    path.write_text("# codes\nSection: Class 23 - Integrity\n23505    E    ERRCODE_UNIQUE_VIOLATION                  unique_violation\n23506 E ERRCODE_OTHER unique_violation_two\n23505    E    ERRCODE_AGAIN    again\n00000    S    ERRCODE_SUCCESSFUL_COMPLETION\n01008    W    ERRCODE_WARNING    implicit_zero_bit_padding\n")
    assert {tuple(r) for r in catalog.states(spark, str(path)).collect()} == {("23505", "unique-violation"), ("23506", "unique-violation-two"), ("01008", "implicit-zero-bit-padding")}


def test_one_registry_for_both_jobs(spark):
    own = {"celsius": layouts.Type(80001, "double", lambda b: pa.compute.divide(columns.whole(4, pa.int64())(b).cast(pa.float64()), 10.0))}
    lit, t = F.lit, F.lit(0)
    row = frames.tuple_bytes([(wire.encode_value(lit(1), "int4"), None), (wire.int_bytes(lit(215), 4), None)])
    parts = [frames.begin(lit(100), t, lit(1)), frames.relation(7, "public", "t", "d", [("id", "int4", True), ("heat", 80001, False)]), frames.insert(lit(7), row), frames.commit(lit(100), lit(108), t)]
    landed = spark.range(1).select(F.posexplode(F.array(*parts)).alias("seq", "payload")).select(lit("s").alias("slot"), F.col("seq").cast("bigint"), "payload")
    assert [tuple(r) for r in replicate.replicate(spark, landed, "public.t", ["id"], {"id": "int4", "heat": "celsius"}, own).collect()] == [(1, 21.5)]
    assert [r["new_row"] for r in deliver.deliver(spark, landed, own).collect()] == [{"id": "1", "heat": "21.5"}]


def test_delivery_shuffles_tuples_once(spark, sf_dir):
    plan = queries.deliver_frames(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]) == 1 and "rangepartitioning(commit_seq" in plan


def test_user_types_are_read_by_columns(monkeypatch):
    """Whole columns of composites, arrays and domains say what values read one by one say, and aren't read one by one."""
    number = lambda *n: b"".join(x.to_bytes(4, "big", signed=True) for x in n)
    record = lambda *fields: number(len(fields)) + b"".join(number(o) + (number(-1) if d is None else number(len(d)) + d) for o, d in fields)
    listed = lambda oid, *items: number(1, 1, oid, len(items), 1) + b"".join(number(-1) if d is None else number(len(d)) + d for d in items)
    long, text = lambda n: n.to_bytes(8, "big", signed=True), lambda t: t.encode()
    one = lambda n, t: record((20, long(n)), (70001, None if t is None else text(t)))
    graph = usertypes.TypeGraph({
        70001: [usertypes.Version(0, "e", "mood")], 70003: [usertypes.Version(0, "d", "doc", base=3802)], 70009: [usertypes.Version(0, "d", "inner", base=70004)],
        70004: [usertypes.Version(0, "c", "place", fields=(("n", 20), ("kind", 70001))), usertypes.Version(50, "c", "place", fields=(("number \"x\"", 20), ("kind", 70001)))],
        70005: [usertypes.Version(0, "b", "_place", element=70004)],
        70006: [usertypes.Version(0, "c", "big", fields=tuple((f"f{k}", 0) for k in range(9)))],
    })
    double = struct.pack(">d", 0.1)
    big = record((70004, one(-3, "é")), (70005, listed(70004, one(1, "a"), None, one(2, None))), (16, b"\x01"), (1007, listed(23, number(4), None)), (70003, b"\x01{}"), (701, double), (1700, layouts.numeric_bytes("-12.50")), (1082, number(1)), (2249, record((23, number(5)))))
    values = [(70004, one(1, "a"), 1), (70004, one(2, 'q"\n\\'), 60), (70004, None, 3), (70004, record((20, long(7))), 4), (70009, one(9, ""), 51), (70005, number(0, 0, 70004), 5), (70005, listed(70004, one(1, "b"), None), 70), (70006, big, 9), (70006, big, 60), (70004, record(), 7), (70005, number(2, 0, 70004, 1, 1, 2, 1) + 2 * (number(len(one(1, "z"))) + one(1, "z")), 8)]
    wanted = {o: [(None if d is None else layouts.as_json(graph.plain(o, d, at))) for q, d, at in values if q == o] for o in {o for o, _, _ in values}}
    called = []
    plain = usertypes.TypeGraph.plain
    monkeypatch.setattr(usertypes.TypeGraph, "plain", lambda self, *a: called.append(a) or plain(self, *a))
    for o, texts in wanted.items():
        own = [(d, at) for q, d, at in values if q == o]
        assert graph.json(o, columns.Bytes.of(pa.array([d for d, _ in own], pa.binary())), np.array([at for _, at in own])).to_pylist() == texts
    assert len(called) == 6  # the elements of the array of two dimensions and their fields


def test_a_domain_over_itself_fails_by_columns():
    graph = usertypes.TypeGraph({1: [usertypes.Version(0, "d", "a", base=2)], 2: [usertypes.Version(0, "d", "b", base=1)]})
    with pytest.raises(ValueError, match="over itself"):
        graph.json(1, columns.Bytes.of(pa.array([b"x"], pa.binary())), np.array([1]))


def test_texts_and_whole_numbers_are_shown_by_columns(spark):
    """Common values come out of the pass over whole columns as expressions show them; whole numbers of another width are left to expressions."""
    kinds = [("text", "é"), ("varchar", ""), ("jsonb", '{"a": 1}'), ("json", "[]"), ("int8", -(2**63)), ("int4", -7), ("int2", 300), ("name", "n")]
    values = F.array(*(F.struct(F.lit("b").alias("kind"), wire.encode_value(F.lit(v), k).alias("data")) for k, v in kinds), F.struct(F.lit("b").alias("kind"), wire.int_bytes(F.lit(5), 4).alias("data")), F.struct(F.lit("n").alias("kind"), F.lit(None).cast("binary").alias("data")))
    oids = F.array(*(F.lit(wire.OID[k]).cast("bigint") for k, _ in kinds), F.lit(20).cast("bigint"), F.lit(25).cast("bigint"))
    df = spark.range(2).select(values.alias("v"), oids.alias("o"))
    got = df.select(layouts.shown(F.col("v"), F.col("o")).alias("texts"), F.zip_with("v", "o", lambda v, o: rows.shown(v, o)).alias("by_one")).collect()
    for r in got:
        assert r["texts"][:8] == r["by_one"][:8] == [str(v) for _, v in kinds] and r["texts"][8:] == [None, None]


def test_numbers_go_out_without_a_matrix_of_longs():
    """Fixed widths are laid by views of their bytes: the array of one byte a digit of every number that shifts took isn't made."""
    assert columns._big(np.array([1, -2, 2**31 - 1]), 4).tolist() == [[0, 0, 0, 1], [255, 255, 255, 254], [127, 255, 255, 255]]
    lists = pa.array([[1, None], [], None, [-1]], pa.list_(pa.int32()))
    got = columns.array_bytes(lists, layouts.TYPES["int4"].encode, 23, 1).to_pylist()
    assert got == [layouts.array_bytes([(1).to_bytes(4, "big"), None], 23), layouts.array_bytes([], 23), None, layouts.array_bytes([b"\xff" * 4], 23)]
    texts = pa.array([["x" * k, None] for k in range(40)], pa.list_(pa.string()))
    assert columns.array_bytes(texts, layouts.TYPES["text"].encode, 25, 1).to_pylist() == [layouts.array_bytes([b"x" * k, None], 25) for k in range(40)]
