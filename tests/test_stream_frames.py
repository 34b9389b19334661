"""Frames that arrive in batches: state kept between them, failures, redelivery, truncates."""

import pytest
from pyspark.sql import functions as F

from walloom.jobs import common, replicate
from walloom.sources import frames
from walloom.streaming import replica
from test_jobs import log, wide_log  # noqa: F401

KINDS = {"id": "int4", "s": "text"}


def pieces(spark, path, *cuts):
    all_frames = spark.read.parquet(path)
    return [all_frames.where((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in zip((0, *cuts), (*cuts, 1000), strict=True)]


def test_batches_that_end_inside_transactions(spark, log):  # noqa: F811
    table = replica.FrameReplica(replica.folder(spark), "public.t", ["id"], KINDS, buckets=4)
    decoder = replica.Decoder(replica.folder(spark), table)
    for k, piece in enumerate(pieces(spark, log, 5, 13)):
        decoder(piece, k)
    decoder(piece, k)  # a batch that runs again
    assert sorted(tuple(r) for r in table.table(spark).collect()) == [(3, "c"), (5, "a")]
    held = decoder._read(spark, "held", 2).groupBy("type").count().collect()
    assert {r["type"]: r["count"] for r in held} == {"relation": 1, "stream_start": 1, "insert": 1}  # the pending one and the description


def test_the_whole_log_again_changes_nothing(spark, log):  # noqa: F811
    table = replica.FrameReplica(replica.folder(spark), "public.t", ["id"], KINDS, buckets=4)
    decoder = replica.Decoder(replica.folder(spark), table)
    whole = spark.read.parquet(log)
    decoder(whole, 0)
    decoder(whole.withColumn("seq", F.col("seq") + 100), 1)
    assert sorted(tuple(r) for r in table.table(spark).collect()) == [(3, "c"), (5, "a")]


def test_a_truncate_in_a_later_batch(spark, wide_log):  # noqa: F811
    kinds = {"a": "int4", "b": "text", "n": "numeric", "f": "float8", "at": "time"}
    tables = [replica.FrameReplica(replica.folder(spark), f"public.{t}", ["a", "b"], kinds, buckets=4) for t in "tu"]
    decoder = replica.Decoder(replica.folder(spark), lambda changes, k: [t(changes, k) for t in tables])
    for k, piece in enumerate(pieces(spark, wide_log, 6, 8)):
        decoder(piece, k)
    assert sorted(tuple(r)[:3] for r in tables[0].table(spark).collect()) == [(2, "moved", "2.30"), (3, "y", "3.30"), (4, "z", "7.50")]
    assert tables[1].table(spark).count() == 0


def test_a_handler_that_fails_confirms_nothing(spark, log):  # noqa: F811
    home, source = replica.folder(spark), replica.folder(spark)
    table = replica.FrameReplica(replica.folder(spark), "public.t", ["id"], KINDS, buckets=4)
    broken = [True]

    def handler(changes, batch):
        if batch == 1 and broken[0]:
            raise ValueError("the handler failed")
        table(changes, batch)

    decoder = replica.Decoder(replica.folder(spark), handler)
    run = lambda: replica.follow(spark.readStream.schema("slot string, seq long, payload binary").parquet(source), decoder, home).awaitTermination()
    first, second = pieces(spark, log, 8)
    first.write.parquet(source)
    run()
    second.write.mode("append").parquet(source)
    with pytest.raises(Exception, match="the handler failed"):
        run()
    assert sorted(tuple(r) for r in table.table(spark).collect()) == [(1, "a"), (2, "b")]
    broken[0] = False
    run()
    assert sorted(tuple(r) for r in table.table(spark).collect()) == [(3, "c"), (5, "a")]


def test_batches_at_intervals(spark):
    source, seen = replica.folder(spark), []
    spark.range(3).write.parquet(source)
    query = replica.follow(spark.readStream.schema("id long").parquet(source), lambda rows, k: seen.append(rows.count()), replica.folder(spark), every="200 milliseconds")
    query.processAllAvailable()
    spark.range(2).write.mode("append").parquet(source)
    query.processAllAvailable()
    query.stop()
    assert sum(seen) == 5 and len(seen) >= 2


def test_a_streamed_transaction_that_was_sent_again_counts_once(spark):
    lit = F.lit
    from walloom.functions import wire

    row = lambda k: frames.tuple_bytes([(wire.encode_value(lit(k).cast("int"), "int4"), None)])
    block = [frames.stream_start(lit(9), lit(True)), frames.insert(lit(7), row(1), xid=lit(9)), frames.stream_stop()]
    parts = [frames.relation(7, "public", "t", "d", [("id", "int4", True)]), *block, *block, frames.stream_commit(lit(9), lit(300), lit(308), lit(0))]
    landed = spark.range(1).select(F.posexplode(F.array(*parts)).alias("seq", "payload")).select(lit("s").alias("slot"), F.col("seq").cast("bigint"), "payload")
    found = common.messages(spark, landed)
    assert [r["seq"] for r in common.committed(found).collect()] == [5]
    assert replicate.replicate(spark, landed, "public.t", ["id"], {"id": "int4"}).count() == 1


def test_a_stream_without_its_checkpoint_goes_on(spark, log):  # noqa: F811
    """A new process: other objects over the same folders, an empty checkpoint, the whole log landed again."""
    source, kept, states = replica.folder(spark), replica.folder(spark), replica.folder(spark)

    def run():
        table = replica.FrameReplica(kept, "public.t", ["id"], KINDS, buckets=4)
        stream = spark.readStream.schema("slot string, seq long, payload binary").parquet(source)
        replica.follow(stream, replica.Decoder(states, table), replica.folder(spark)).awaitTermination()
        return replica.Replica(kept, ["id"], ["s"])

    first, second = pieces(spark, log, 8)
    first.write.parquet(source)
    assert sorted(tuple(r) for r in run().table(spark).collect()) == [(1, "a"), (2, "b")]
    second.write.mode("append").parquet(source)
    again = run()
    assert sorted(tuple(r) for r in again.table(spark).collect()) == [(3, "c"), (5, "a")] and again.position(spark) == 300
    before = again.state(spark)
    assert run().state(spark)["written"] == before["written"]  # nothing was new
    again.forget(spark)
    assert sorted(tuple(r) for r in again.table(spark).collect()) == [(3, "c"), (5, "a")] and len(replica.versions_at(spark, f"{kept}/state")) == 2


def test_messages_of_an_open_transaction_are_written_once(spark):
    from walloom.functions import wire

    lit = F.lit
    row = lambda k: frames.tuple_bytes([(wire.encode_value(lit(k).cast("int"), "int4"), None)])
    parts = [frames.relation(7, "public", "t", "d", [("id", "int4", True)])]
    for k in range(6):
        parts += [frames.stream_start(lit(9), lit(k == 0)), frames.insert(lit(7), row(k), xid=lit(9)), frames.stream_stop()]
    parts.append(frames.stream_commit(lit(9), lit(300), lit(308), lit(0)))
    landed = spark.range(1).select(F.posexplode(F.array(*parts)).alias("seq", "payload")).select(lit("s").alias("slot"), F.col("seq").cast("bigint"), "payload")
    table = replica.FrameReplica(replica.folder(spark), "public.t", ["id"], {"id": "int4"}, buckets=2)
    decoder = replica.Decoder(replica.folder(spark), table, parts=3)
    for k in range(7):
        decoder(landed.where((F.col("seq") >= 3 * k + (k > 0)) & (F.col("seq") < 3 * k + 4)), k)
    inserts = [decoder._read(spark, "held", k).where("type = 'insert'").count() for k in range(7)]
    assert inserts[:3] == [1, 1, 1] and max(inserts) <= 5 and sum(inserts) < 1 + 2 + 3 + 4 + 5 + 6  # together once there are more than three parts
    assert inserts[-1] == 0 and sorted(r["id"] for r in table.table(spark).collect()) == list(range(6))


@pytest.mark.parametrize("parts", [1, 16])
def test_held_transactions_over_batches(spark, parts):
    """Ids that come again, outcomes and aborts of subtransactions in batches of their own, two slots, a slot without a name, a batch that runs again, rows written together."""
    columns = "slot string, seq long, xid long, subxid long, kind string, value string"
    batches = [
        [("a", 1, 7, 7, "change", "x"), ("a", 2, 7, 8, "change", None), ("b", 1, 7, 7, "change", "other"), (None, 1, 7, None, "change", "no slot"), ("a", 3, 9, 9, "change", "gone")],
        [("a", 4, 7, 8, "abort", None), ("a", 5, 9, 9, "abort", None), ("a", 6, 9, 9, "commit", None), ("b", 2, 7, 6, "change", "more")],
        [("a", 7, 7, None, "commit", None), ("a", 8, 10, 10, "change", "once"), ("a", 9, 10, None, "commit", None)],
        [("a", 10, 7, 7, "change", "again"), ("a", 11, 7, 8, "change", "kept now"), (None, 2, 7, None, "commit", None)],
        [("a", 12, 7, None, "commit", None), ("b", 3, 7, 7, "abort", None), ("c", 1, 1, 1, "change", "open")],
    ]
    held = replica.Held(replica.folder(spark), parts)
    for k, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, columns)
        held(batch, k)
        if k in (2, 4):
            held(batch, k)
    found = held.released(spark, batch.drop("kind").schema).select("slot", "seq", "value").collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted([("a", 1, "x"), (None, 1, "no slot"), ("a", 8, "once"), ("a", 10, "again"), ("a", 11, "kept now")], key=repr)
