"""What the jobs share: the session and the parts from frames to committed changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.usertypes import TypeGraph
from ..operators import asof, catalog, progress, transactions
from ..sources import frames
from ..session import broadcast_if_small, ship, small, stored


def session(name: str) -> SparkSession:
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    return spark


def bare(landed: DataFrame) -> DataFrame:
    """Landed frames (slot, seq, payload) without their headers; keep-alives fall out."""
    tag = F.substring("payload", 1, 1)
    body = F.when(tag == F.lit(bytearray(b"w")), F.substring("payload", F.lit(26), F.length("payload") - 25)).otherwise(F.col("payload"))
    return landed.where(tag != F.lit(bytearray(b"k"))).select("slot", "seq", body.alias("payload"))


#: Ends and beginnings of blocks and transactions up to which they are looked up at the workers, each of which holds them then: 4 MB.
LOOKED_UP = 250_000


def placed(log: DataFrame, rows: int = 100_000, most: int | None = None) -> DataFrame:
    """Frames without headers, where more than `most` of them open or end a block or a transaction, with the block and the transaction that each stands in (stream_xid, begin_seq), found by one
    shuffle of the frames as they came. So no worker holds all such places, and neither is carried along the wider decoded messages. Where they are fewer, the frames as they are."""
    marks = {"stream_xid": frames.stream_marker(F.col("payload")), "begin_seq": F.when(frames.tag_of(F.col("payload")) == frames.LETTER["begin"], F.col("seq"))}
    last = asof.last_marks(log, ["slot"], "seq", marks, rows)
    if (last.agg(F.sum("__count")).first()[0] or 0) <= (LOOKED_UP if most is None else most):
        return log
    return asof.all_filled(log, ["slot"], "seq", marks, last, rows)


def messages(spark: SparkSession, landed: str | DataFrame, unused: tuple[str, ...] = ()) -> DataFrame:
    """Messages of landed frames (slot, seq, payload), a path or a table, with or without a header. They are decoded once and stored: descriptions,
    outcomes and changes are then read from the table. unused: kinds that a job makes nothing of, which aren't decoded; none of those that open or end a block or a transaction."""
    log = bare(spark.read.parquet(landed) if isinstance(landed, str) else landed)
    if unused:
        log = log.where(~frames.tag_of(F.col("payload")).isin([frames.LETTER[kind] for kind in unused]))
    return stored(frames.messages(placed(log)))


def with_transactions(found: DataFrame) -> DataFrame:
    """Messages with `tx`: of a plain transaction the position of its begin, so an attempt that broke off and came again is
    two; of a streamed one its negative id. Messages that have it already stay as they are."""
    if "tx" in found.columns:
        return found
    opened = F.when(F.col("type") == "begin", F.col("seq"))
    log = found if "begin_seq" in found.columns else transactions.carry_forward(found, opened, "begin_seq")
    log = log.withColumn("tx", F.when(F.col("stream_xid") >= 0, -F.col("stream_xid")).otherwise(F.col("begin_seq")))
    return log.withColumn("tx", F.when(F.col("type").isin("stream_start", "stream_commit", "stream_abort"), -F.col("xid")).otherwise(F.col("tx")))


def committed(found: DataFrame) -> DataFrame:
    """Changes of committed transactions, plain and streamed, with (tx, commit_seq, commit_lsn, tx_end_lsn, commit_timestamp).

    Changes of aborted transactions and subtransactions, and of those without an outcome, are left out. Of a streamed
    transaction that was sent again, the copy counts that its first commit ends. Outcomes are stored and measured, and sent to the changes where they are few:
    then changes stay where they lie. Where all of them together are many, what is made of them is measured part by part.
    """
    log = with_transactions(found)
    outcomes = stored(log.where(F.col("type").isin("commit", "stream_commit", "stream_abort") | (F.col("segment") == "first")).select("slot", "seq", "tx", "xid", "type", "subtransaction_xid", "commit_lsn", "tx_end_lsn", "commit_timestamp"))
    ends = outcomes.where(F.col("type").isin("commit", "stream_commit")).select("slot", "tx", F.col("seq").alias("commit_seq"), "commit_lsn", "tx_end_lsn", "commit_timestamp")
    first = ends.groupBy("slot", "commit_lsn").agg(F.min("commit_seq").alias("commit_seq"))
    ends = ends.join(first, ["slot", "commit_lsn", "commit_seq"], "left_semi")
    starts = outcomes.where("type = 'stream_start'").select("slot", "tx", F.col("seq").alias("started"))
    copies = ends.where("tx < 0").select("slot", "tx", "commit_seq").join(starts, ["slot", "tx"]).where("started < commit_seq").groupBy("slot", "tx", "commit_seq").agg(F.max("started").alias("started"))
    few = small(outcomes)  # each part is no larger; it is stored, so that what reads the changes again doesn't make it again
    sent = lambda part: F.broadcast(stored(part)) if few else broadcast_if_small(stored(part))
    ends = sent(ends.join(copies, ["slot", "tx", "commit_seq"], "left"))
    aborts = outcomes.where("type = 'stream_abort'").select("slot", "tx", F.col("xid").alias("top"), F.col("subtransaction_xid").alias("xid"))
    whole, part = (sent(x) for x in (aborts.where("top = xid").select("slot", "tx").distinct(), aborts.where("top <> xid").select("slot", "tx", "xid").distinct()))
    changes = log.where(F.col("type").isin("insert", "update", "delete", "truncate", "message")).select("slot", "seq", "tx", "xid", "type", "rel_oid", "oids", "old_kind", "old_tuple", "new_tuple", "prefix", "content", "transactional")
    changes = changes.join(whole, ["slot", "tx"], "left_anti").join(part, ["slot", "tx", "xid"], "left_anti")
    return changes.join(ends, ["slot", "tx"]).where("seq < commit_seq AND (started IS NULL OR seq > started)").drop("started")


def undecided(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a later batch still needs of the messages so far: (those of transactions without an outcome, with their tx; the descriptions
    of tables that are valid now or at a change that is kept).

    A plain transaction that a later begin of its slot broke off has no outcome to come.
    """
    log = with_transactions(found)
    over = log.where((F.col("type").isin("commit", "stream_commit")) | ((F.col("type") == "stream_abort") & (F.col("xid") == F.col("subtransaction_xid"))))
    last = log.groupBy("slot").agg(F.max("begin_seq").alias("last_begin"))
    kinds = F.col("type").isin("begin", "stream_start", "stream_abort", "insert", "update", "delete", "truncate") | ((F.col("type") == "message") & F.col("transactional"))
    kept = log.where(kinds & F.col("tx").isNotNull()).join(broadcast_if_small(stored(over.select("slot", "tx").distinct())), ["slot", "tx"], "left_anti").join(F.broadcast(last), "slot").where("tx < 0 OR tx = last_begin")  # a row a slot
    own = [c for c in found.columns if c not in ("tx", "begin_seq")]
    kept = stored(kept.select(*own, "tx"))
    oldest = kept.groupBy("slot").agg(F.min("seq").alias("oldest"))
    known = progress.validity(found.where("type = 'relation'"), ["slot", "rel_oid"]).join(F.broadcast(oldest), "slot", "left")
    return kept, known.where("valid_to IS NULL OR valid_to > oldest").select(*own)


def described(found: DataFrame, changes: DataFrame, graph: TypeGraph | None = None) -> DataFrame:
    """Changes with the description of their table at that point; a truncate is a row for each of its tables, in their order.

    graph: of user types, by which attributes name the built-in types as which they are read (see `catalog.resolved`)."""
    plain = F.col("type") != "truncate"
    targets = F.when(plain, F.array("rel_oid")).otherwise(F.col("oids"))
    changes = changes.select(*(c for c in changes.columns if c not in ("rel_oid", "oids")), F.posexplode(targets).alias("target", "rel_oid"))
    known = found.where("type = 'relation'").select("slot", "seq", "rel_oid", "namespace", "name", "attributes")
    if graph is None:
        known = known.withColumn("attributes", F.transform("attributes", lambda a: a.withField("sent_oid", a["type_oid"])))
    else:
        known = catalog.resolved(known, graph)
    return progress.as_of(changes, known, ["slot", "rel_oid"])
