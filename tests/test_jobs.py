"""The three jobs on a small log with every kind of transaction."""

import pytest
from pyspark.sql import functions as F

from walloom.functions import layouts, wire
from walloom.jobs import common, deliver, outbox, replicate
from walloom.operators import asof, transactions
from walloom.sources import frames


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    lit = F.lit
    int4, text = (lambda v: (wire.encode_value(lit(v).cast("int"), "int4"), None)), (lambda v: (wire.encode_value(lit(v), "text"), None))
    row = lambda k, v: frames.tuple_bytes([int4(k), text(v)])
    kept = lambda k: frames.tuple_bytes([int4(k), (lit(None).cast("binary"), lit(True))])
    key = lambda k: frames.tuple_bytes([int4(k), (lit(None).cast("binary"), None)])
    oid, t = lit(7), lit(0)
    about = frames.relation(7, "public", "t", "d", [("id", "int4", True), ("s", "text", False)])
    begin, commit = (lambda n: frames.begin(lit(n), t, lit(n))), (lambda n: frames.commit(lit(n), lit(n + 8), t))
    parts = [
        begin(100), about, frames.insert(oid, row(1, "a")),  # breaks off and comes again
        begin(100), frames.insert(oid, row(1, "a")), frames.insert(oid, row(2, "b")), frames.message(lit(1), lit("p"), F.encode(lit("in"), "UTF-8"), lit(True)), commit(100),
        begin(200), frames.update(oid, kept(5), key(1)), frames.delete(oid, key(2)), commit(200),
        frames.stream_start(lit(9), lit(True)), frames.insert(oid, row(3, "c"), xid=lit(9)), frames.insert(oid, row(4, "d"), xid=lit(10)), frames.stream_stop(),
        frames.stream_abort(lit(9), lit(10)), frames.stream_commit(lit(9), lit(300), lit(308), t),
        frames.stream_start(lit(11), lit(True)), frames.insert(oid, row(6, "e"), xid=lit(11)), frames.stream_stop(), frames.stream_abort(lit(11), lit(11)),
        frames.stream_start(lit(12), lit(True)), frames.insert(oid, row(7, "f"), xid=lit(12)), frames.stream_stop(),  # pending
        frames.message(lit(2), lit("p"), F.encode(lit("at once"), "UTF-8"), lit(False)),
    ]
    all_frames = spark.range(1).select(F.posexplode(F.array(*(frames.wal(lit(k), lit(k + 1), t, p) for k, p in enumerate(parts)))).alias("seq", "payload")).select(lit("s").alias("slot"), F.col("seq").cast("bigint"), "payload")
    path = str(tmp_path_factory.mktemp("log") / "frames")
    all_frames.write.parquet(path)
    return path


def test_replicate(spark, log):
    got = replicate.replicate(spark, log, "public.t", ["id"], {"id": "int4", "s": "text"}).collect()
    assert sorted(tuple(r) for r in got) == [(3, "c"), (5, "a")]  # the moved row keeps the value that was not sent


def test_deliver(spark, log):
    got = [(r["commit_lsn"], r["n"], r["type"], (r["new_row"] or r["old_row"])["id"]) for r in deliver.deliver(spark, log).collect()]
    assert got == [(100, 1, "insert", "1"), (100, 2, "insert", "2"), (200, 1, "update", "5"), (200, 2, "delete", "2"), (300, 1, "insert", "3")]


def test_outbox(spark, log):
    assert sorted(r["value"] for r in outbox.outbox(spark, log, "p").collect()) == ["at once", "in"]


@pytest.fixture(scope="module")
def wide_log(spark, tmp_path_factory):
    """Two tables with a key of two columns and types of all sorts: a truncate of both, a moved row, a text value."""
    lit, t = F.lit, F.lit(0)
    none = (lit(None).cast("binary"), None)
    of = lambda v, kind: (wire.encode_value(lit(v), kind), None)
    coded = lambda v, kind: (layouts.encoder(kind)(lit(v)), None)
    row = lambda a, b, n: frames.tuple_bytes([of(a, "int4"), of(b, "text"), coded(n, "numeric"), coded(2.5, "float8"), of(1000000, "time")])
    key = lambda a, b: frames.tuple_bytes([of(a, "int4"), of(b, "text"), none, none, none])
    as_text = F.concat(lit(bytearray(b"\x00\x05")), *(F.concat(F.encode(lit("t"), "UTF-8"), wire.int_bytes(lit(len(x)), 4), F.encode(lit(x), "UTF-8")) for x in ("4", "z", "7.50", "0.5", "00:00:01")))
    columns = [("a", "int4", True), ("b", "text", True), ("n", "numeric", False), ("f", "float8", False), ("at", "time", False)]
    parts = [
        frames.begin(lit(100), t, lit(1)), frames.relation(7, "public", "t", "d", columns), frames.relation(8, "public", "u", "d", columns),
        frames.insert(lit(7), row(1, "x", "1.10")), frames.insert(lit(8), row(1, "x", "1.10")), frames.commit(lit(100), lit(108), t),
        frames.begin(lit(200), t, lit(2)), frames.truncate(F.array(lit(7), lit(8))), frames.insert(lit(7), row(2, "x", "2.20")), frames.insert(lit(7), row(3, "y", "3.30")), frames.insert(lit(7), as_text), frames.commit(lit(200), lit(208), t),
        frames.begin(lit(300), t, lit(3)), frames.update(lit(7), row(2, "moved", "2.30"), key(2, "x")), frames.commit(lit(300), lit(308), t),
    ]
    path = str(tmp_path_factory.mktemp("wide") / "frames")
    spark.range(1).select(F.posexplode(F.array(*parts)).alias("seq", "payload")).select(lit("s").alias("slot"), F.col("seq").cast("bigint"), "payload").write.parquet(path)
    return path


def test_replicate_truncates_moves_and_types(spark, wide_log):
    kinds = {"a": "int4", "b": "text", "n": "numeric", "f": "float8", "at": "time"}
    got = replicate.replicate(spark, wide_log, "public.t", ["a", "b"], kinds).collect()
    assert sorted(tuple(r) for r in got) == [(2, "moved", "2.30", 2.5, 1000000), (3, "y", "3.30", 2.5, 1000000), (4, "z", "7.50", 0.5, 1000000)]
    assert replicate.replicate(spark, wide_log, "public.u", ["a", "b"], kinds).count() == 0


def test_deliver_truncates_and_types(spark, wide_log):
    got = deliver.deliver(spark, wide_log).where("commit_lsn >= 200").collect()
    assert [(r["commit_lsn"], r["n"], r["type"], r["name"]) for r in got] == [(200, 1, "truncate", "t"), (200, 2, "truncate", "u"), (200, 3, "insert", "t"), (200, 4, "insert", "t"), (200, 5, "insert", "t"), (300, 1, "update", "t")]
    assert got[2]["new_row"] == {"a": "2", "b": "x", "n": "2.20", "f": "2.5", "at": "1000000"} and got[4]["new_row"]["n"] == "7.50"


def test_numbers_of_long_transactions(spark):
    """Transactions that span many steps, one step or a part of one, of two slots, with changes at one place, and one whose early steps hold nothing."""
    rows = [(slot, end, end - back, k) for slot in "ab" for end, backs in ((100, range(1, 98)), (200, (1, 2)), (205, (1, 60, 61, 62))) for back in backs for k in range(1 + (back % 5 == 0))]
    log = spark.createDataFrame(rows, "slot string, commit_seq long, seq long, target int").repartition(5)
    for step in (1, 7, 10, 1000):
        found = transactions.numbered(log, ["slot", "commit_seq"], "commit_seq", "seq", ["target"], step)
        got = {(r["slot"], r["commit_seq"], r["seq"], r["target"]): r["n"] for r in found.collect()}
        expected = {}
        for key in {r[:2] for r in rows}:
            expected |= {r: n for n, r in enumerate(sorted(r for r in rows if r[:2] == key), 1)}
        assert got == expected
        assert found.columns == [*log.columns, "n"]
    parts = transactions.numbered(log.where("slot = 'a'"), ["slot", "commit_seq"], "commit_seq", "seq", ["target"], 7).select("commit_seq", "n").rdd.glom().collect()
    assert [tuple(r) for p in parts for r in p] == sorted(tuple(r) for p in parts for r in p)
    assert transactions.numbered(log.limit(0), ["slot", "commit_seq"], "commit_seq", "seq").count() == 0


def test_outbox_decodes_no_changes(spark, log, monkeypatch):
    """The outbox makes nothing of changes and descriptions, so their tuples aren't decoded; a kind that isn't known still fails."""
    seen = []
    kept = common.stored
    monkeypatch.setattr(common, "stored", lambda df: seen.append(kept(df)) or seen[-1])
    outbox.outbox(spark, log, "tx").collect()
    kinds = {r["type"] for r in seen[0].select("type").distinct().collect()}
    assert kinds and not kinds & {"relation", "insert", "update", "delete", "truncate"}
    odd = spark.range(1).select(F.lit("s").alias("slot"), F.lit(1).cast("bigint").alias("seq"), F.encode(F.lit("?"), "UTF-8").alias("payload"))
    with pytest.raises(Exception, match="unknown message kind"):
        outbox.outbox(spark, odd, "tx")


def test_what_is_set_aside_takes_no_decoding(spark):
    """Values that can't be read come out though the others aren't decoded: here those can't be."""

    def fails(b):
        raise ValueError("decoded")

    lit, t = F.lit, F.lit(0)
    row = frames.tuple_bytes([(wire.encode_value(lit(1), "int4"), None), (wire.int_bytes(lit(215), 4), None), (F.encode(lit("odd"), "UTF-8"), None)])
    parts = [frames.begin(lit(100), t, lit(1)), frames.relation(7, "public", "t", "d", [("id", "int4", True), ("heat", 80001, False), ("nick", 90001, False)]), frames.insert(lit(7), row), frames.commit(lit(100), lit(108), t)]
    landed = spark.range(1).select(F.posexplode(F.array(*parts)).alias("seq", "payload")).select(lit("s").alias("slot"), F.col("seq").cast("bigint"), "payload")
    kept, aside = deliver.split(spark, landed, {"celsius": layouts.Type(80001, "double", fails)})
    assert [tuple(r) for r in aside.collect()] == [("s", 2, 3, "public", "t", "new", "nick", 90001, bytearray(b"odd"))]
    assert kept.collect() == []


def test_a_few_points_are_an_expression(spark):
    """They say what sorted arrays at the workers say, of null keys too, and no row goes to Python for them."""
    log = spark.range(60).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("k"), (F.col("id") % 20).alias("seq"))
    points = spark.createDataFrame([("k1", 5, 50), ("k1", 9, 90), (None, 7, -7), ("k2", 0, 1)], "k string, seq long, v long")
    few = asof.latest_at(log, points, ["k"], "seq", "v", "found")
    assert "Python" not in few._jdf.queryExecution().executedPlan().toString()
    many = asof._looked_up(log, points.withColumnRenamed("v", "__value"), ["k"], "seq", "found")
    rows = lambda df: sorted((str(r["k"]), r["seq"], str(r["found"])) for r in df.collect())
    assert rows(few) == rows(many)
    assert {r["found"] for r in asof.latest_at(log, points.limit(0), ["k"], "seq", "v", "found").collect()} == {None}


def test_many_places_are_found_by_one_shuffle(spark, log, monkeypatch):
    """Blocks and transactions that are too many for a worker to hold: each frame finds its own in buckets of places, whether they begin in its bucket or before, and no lookup through Python is left."""
    landed = spark.read.parquet(log)
    landed = landed.unionByName(landed.withColumn("slot", F.lit("t")).where("seq < 12"))
    own = lambda found: sorted(map(str, common.with_transactions(found).select("slot", "seq", "stream_xid", "begin_seq", "tx").collect()))
    few, called = own(frames.messages(common.bare(landed))), []
    monkeypatch.setattr(asof, "latest_at", lambda *a, **k: called.append(a))
    for rows in (1, 3, 1000):
        assert own(frames.messages(common.placed(common.bare(landed), rows, 0))) == few
    assert not called
    assert "Python" not in common.placed(common.bare(landed), 3, 0)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.undo()
    monkeypatch.setattr(common, "LOOKED_UP", 0)
    assert sorted(tuple(r) for r in replicate.replicate(spark, log, "public.t", ["id"], {"id": "int4", "s": "text"}).collect()) == [(3, "c"), (5, "a")]
    assert sorted(r["value"] for r in outbox.outbox(spark, log, "p").collect()) == ["at once", "in"]


def _updates(spark, *parts):
    """One transaction over a table of a key and a value of a type of its own."""
    lit, t = F.lit, F.lit(0)
    about = frames.relation(7, "public", "t", "f", [("id", "int4", True), ("heat", 80001, False)])
    all_parts = [frames.begin(lit(100), t, lit(1)), about, *parts, frames.commit(lit(100), lit(108), t)]
    return spark.range(1).select(F.posexplode(F.array(*all_parts)).alias("seq", "payload")).select(lit("s").alias("slot"), F.col("seq").cast("bigint"), "payload")


def _pair(k, heat, unsent=None):
    return frames.tuple_bytes([(wire.encode_value(F.lit(k), "int4"), None), (wire.int_bytes(F.lit(heat), 4), F.lit(True) if unsent else None)])


def test_of_an_old_row_only_its_key_is_decoded(spark):
    import pyarrow as pa

    def decode(b):
        values = [None if d is None else int.from_bytes(d, "big") for d in b.binary().to_pylist()]
        if 666 in values:
            raise ValueError("decoded")
        return pa.array(values, pa.int64())

    landed = _updates(spark, frames.insert(F.lit(7), _pair(1, 5)), frames.update(F.lit(7), _pair(2, 6), _pair(1, 666), "O"))
    got = replicate.replicate(spark, landed, "public.t", ["id"], {"id": "int4", "heat": "celsius"}, {"celsius": layouts.Type(80001, "bigint", decode)})
    assert [tuple(r) for r in got.collect()] == [(2, 6)]


def test_rows_that_do_not_move_take_nothing_along(spark, monkeypatch):
    """The changes are stored and looked through for moves only where an update has another old key and leaves a value out."""
    kinds, oid = {"id": "int4", "heat": "int4"}, F.lit(7)
    key = lambda k: frames.tuple_bytes([(wire.encode_value(F.lit(k), "int4"), None), (F.lit(None).cast("binary"), None)])
    outside = frames.tuple_bytes([(F.lit(None).cast("binary"), None), (F.lit(None).cast("binary"), None)])
    called = []
    kept = replicate.apply.with_moved_values
    monkeypatch.setattr(replicate.apply, "with_moved_values", lambda *a: called.append(a) or kept(*a))
    cases = [
        (frames.update(oid, _pair(1, 6), key(2)), False, [(1, 6)]), (frames.update(oid, _pair(1, 6, True), key(1)), False, [(1, 5)]), (frames.update(oid, _pair(1, 6, True)), False, [(1, 5)]),
        (frames.update(oid, _pair(1, 6, True), outside), False, [(1, 5)]), (frames.update(oid, _pair(2, 6, True), key(1)), True, [(2, 5)]), (frames.update(oid, _pair(2, 6, True), _pair(1, 5), "O"), True, [(2, 5)]),
    ]
    for update, moves, wanted in cases:
        called.clear()
        got = replicate.replicate(spark, _updates(spark, frames.insert(oid, _pair(1, 5)), update), "public.t", ["id"], kinds)
        assert bool(called) == moves and [tuple(r) for r in got.collect()] == wanted
