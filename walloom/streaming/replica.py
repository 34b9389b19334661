"""Streams over a change log: frames decoded batch by batch, a replica table kept, and streamed transactions held until their outcome."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..jobs import common, replicate
from ..operators import apply, catalog
from ..session import checkpoint_folder, stored
from ..sources import frames


def folder(spark: SparkSession) -> str:
    """A new folder where the session keeps its checkpoints."""
    return f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"


def versions_at(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written to their end under a folder, in order. Only names are read."""
    jvm = spark.sparkContext._jvm
    home = jvm.org.apache.hadoop.fs.Path(path)
    store = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(home):
        return []
    found = [x.getPath().getName() for x in store.listStatus(home)]
    return sorted(int(n[8:]) for n in found if n.startswith("version=") and store.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


class Replica:
    """A table that a stream keeps, in buckets of its keys: each batch of changes is merged into the buckets that it touches, and only those are
    written anew.

    Each batch writes a new version of the table: the rows of the buckets that it touched, and at the end one row of state with the version that each bucket was last written in, the
    confirmed position of each slot, and the rows' schema. The newest complete state is the table: a
    process with nothing but the path goes on from there, and what a failed batch wrote is never seen. Changes at or before their slot's
    confirmed position are dropped, so a batch that runs again, a transaction that is sent again, or a stream that begins anew without its checkpoint change nothing.
    Batches come in commit order. Choose `buckets` so that one holds some hundred megabytes; it is fixed for the life of the table. `forget` removes what newer versions replaced.
    """

    def __init__(self, path: str, keys: list[str], columns: list[str], marked: dict[str, str] | None = None, order: list[str] | None = None, buckets: int = 64):
        self.path, self.keys, self.columns, self.marked = path, keys, columns, marked or {}
        self.order, self.buckets = order or ["commit_lsn", "seq"], buckets
        self.old_keys: list[str] = []

    def state(self, spark: SparkSession, batch: int | None = None) -> dict:
        """The newest state, or the newest that a batch of this number left: version, batch, schema, written {bucket: version}, confirmed {slot: position}."""
        for version in reversed(versions_at(spark, f"{self.path}/state")):
            found = spark.read.parquet(f"{self.path}/state/version={version}").first().asDict(True)
            if batch is None or found["batch"] == batch:
                return {**found, "version": version}
        return {"version": -1, "batch": -1, "schema": None, "written": {}, "confirmed": {}}

    def position(self, spark: SparkSession, batch: int | None = None) -> int:
        """The least of the slots' confirmed positions, after which a log has to be sent again to lose nothing; -1 before the first."""
        return min(self.state(spark, batch)["confirmed"].values(), default=-1)

    def _rows(self, spark: SparkSession, written: dict[int, int], schema: StructType) -> DataFrame:
        if not written:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*(f"{self.path}/rows/version={v}/bucket={b}" for b, v in sorted(written.items())))

    def apply(self, log: DataFrame, batch: int, emptied: bool = False, confirmed: dict | None = None) -> None:
        """Merge a batch's changes into the table; emptied: it was truncated before them. confirmed: positions of slots, added to those that are known."""
        spark = log.sparkSession
        before = self.state(spark)
        version = before["version"] + 1
        log = stored(log.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")))
        touched = {r["bucket"] for r in log.select("bucket").distinct().collect()}  # at most `buckets` rows
        schema = log.select(*self.keys, *self.columns).schema
        written = {} if emptied else before["written"]
        if touched:
            old = self._rows(spark, {b: v for b, v in written.items() if b in touched}, schema)
            merged = apply.merge(old, log, self.keys, self.columns, self.order, self.marked, self.old_keys)
            merged = merged.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
            home = f"{self.path}/rows/version={version}"
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(home)
            full = set(buckets_at(spark, home))
            written = {**{b: v for b, v in written.items() if b not in touched}, **dict.fromkeys(full, version)}
        row = (batch, schema.json(), written, {**before["confirmed"], **(confirmed or {})})
        spark.createDataFrame([row], "batch long, schema string, written map<int,long>, confirmed map<string,long>").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/version={version}")

    def new(self, changes: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """Changes behind what is confirmed, and the positions that they confirm; a log without slots is one slot."""
        spark = changes.sparkSession
        changes = changes if "slot" in changes.columns else changes.withColumn("slot", F.lit(""))
        known = spark.createDataFrame(list(self.state(spark)["confirmed"].items()), "slot string, done_lsn long")  # a row a slot
        changes = changes.join(F.broadcast(known), "slot", "left").where("done_lsn IS NULL OR commit_lsn > done_lsn").drop("done_lsn")
        ends = changes.groupBy("slot").agg(F.max("commit_lsn").alias("lsn")).collect()
        return changes, {r["slot"]: r["lsn"] for r in ends}

    def __call__(self, changes: DataFrame, batch: int) -> None:
        """Changes with op, the keys, columns and marks, and the order's columns, among them commit_lsn."""
        changes, ends = self.new(changes)
        self.apply(changes.select(*self.keys, *self.columns, *self.marked.values(), "op", *self.order), batch, confirmed=ends)

    def table(self, spark: SparkSession, batch: int | None = None) -> DataFrame:
        """The rows as the newest batch, or one of this number, left them. A table that no batch has written fails."""
        found = self.state(spark, batch)
        if found["schema"] is None:
            raise ValueError(f"nothing was written to {self.path}")
        return self._rows(spark, found["written"], StructType.fromJson(json.loads(found["schema"])))

    def forget(self, spark: SparkSession, keep: int = 2) -> None:
        """Remove states but the last `keep`, and the buckets' files that none of those names."""
        jvm = spark.sparkContext._jvm
        where = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        store = where(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        versions = versions_at(spark, f"{self.path}/state")
        kept = [spark.read.parquet(f"{self.path}/state/version={v}").first()["written"] for v in versions[-keep:]]
        used = {(v, b) for written in kept for b, v in written.items()}
        for v in versions[:-keep]:
            store.delete(where(f"{self.path}/state/version={v}"), True)
        newest = versions[-1] if versions else -1
        for v in (v for v in versions_at(spark, f"{self.path}/rows") if v <= newest):
            for b in buckets_at(spark, f"{self.path}/rows/version={v}"):
                if (v, b) not in used:
                    store.delete(where(f"{self.path}/rows/version={v}/bucket={b}"), True)


def buckets_at(spark: SparkSession, path: str) -> list[int]:
    """Buckets that have files under a folder. Only names are read."""
    home = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [int(n[7:]) for n in (x.getPath().getName() for x in store.listStatus(home)) if n.startswith("bucket=")]


class FrameReplica(Replica):
    """A replica of one table, fed by `Decoder`: typed rows, truncates, rows that move to another key. types: the database's own types, as `catalog.type_graph` takes them."""

    def __init__(self, path: str, table: str, keys: list[str], kinds: dict[str, str], registry: dict | None = None, buckets: int = 64, types: DataFrame | None = None):
        self.graph = catalog.type_graph(types) if types is not None else None
        self.kinds, own = replicate.built_in(kinds, self.graph) if self.graph else (kinds, {})
        self.name, self.registry = table, {**own, **(registry or {})}
        columns = [c for c in kinds if c not in keys]
        super().__init__(path, keys, columns, {c: f"{c}_unchanged" for c in columns}, replicate.ORDER, buckets)
        self.old_keys = [f"old_{k}" for k in keys]

    def __call__(self, changes: DataFrame, batch: int) -> None:
        changes, ends = self.new(changes)
        own = replicate.of_table(changes, self.name)
        log, _ = replicate.keyed(replicate.after_truncates(own).where("type <> 'truncate'"), self.keys, self.kinds, self.registry)
        self.apply(log, batch, emptied=not own.where("type = 'truncate'").isEmpty(), confirmed=ends)


class Decoder:
    """Turns batches of landed frames into committed changes with their tables' descriptions, and hands each batch of them to a handler.

    What a batch needs of those before it is kept in tables of a version each, the last of which is written after the handler has returned: if it fails, the stream fails, and the batch runs again from the same state; a
    stream that begins anew without its checkpoint goes on from it too, since frames at or before a slot's last place are dropped.

    * marker: the last frame of each slot that opens or ends a block, from which the next frames are read on;
    * held: messages of transactions that have no outcome yet, and the table descriptions that they and later changes need. A batch writes only its own messages; `parts` names the batches
      whose messages may still be needed, and `open` the transactions. When parts are many, the messages that are needed are written together. Descriptions are written by each batch;
    * done: for each slot the last place, and the last position that was committed, so that transactions sent again are dropped.
    """

    def __init__(self, path: str, handler: Callable[[DataFrame, int], None], types: DataFrame | None = None, parts: int = 16):
        self.path, self.handler, self.parts = path, handler, parts
        self.graph = catalog.type_graph(types) if types is not None else getattr(handler, "graph", None)

    def _read(self, spark: SparkSession, name: str, version: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{name}/version={version}")

    def _write(self, rows: DataFrame, name: str, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/version={version}")

    def __call__(self, landed: DataFrame, batch: int) -> None:
        spark = landed.sparkSession
        last = max(versions_at(spark, f"{self.path}/done"), default=None)
        version = 0 if last is None else last + 1
        bare = common.bare(landed)
        if last is None:
            log, before = bare, None
        else:
            marker, done = self._read(spark, "marker", last), self._read(spark, "done", last)
            bare = bare.join(F.broadcast(done.select("slot", "last_seq")), "slot", "left").where("last_seq IS NULL OR seq > last_seq").drop("last_seq")  # a row a slot
            log = bare.unionByName(marker)
            parts = [r["part"] for r in self._read(spark, "parts", last).collect()]  # a few numbers
            open_ = self._read(spark, "open", last)
            held = spark.read.parquet(*(f"{self.path}/held/version={v}" for v in parts))  # the last one is among them
            before = held.where("type <> 'relation'").join(open_, ["slot", "tx"], "left_semi").unionByName(held.where((F.col("type") == "relation") & (F.col("part") == last))).drop("tx")
        fresh = frames.messages(log)
        if last is not None:
            fresh = fresh.join(F.broadcast(marker.select("slot", "seq")), ["slot", "seq"], "left_anti")
        fresh = fresh.withColumn("part", F.lit(version).cast("bigint"))
        found = stored(common.with_transactions(fresh if before is None else fresh.unionByName(before)))
        changes = common.committed(found)
        ends = found.groupBy("slot").agg(F.max("seq").alias("last_seq")).join(changes.groupBy("slot").agg(F.max("commit_lsn").alias("commit_lsn")), "slot", "left")
        if last is not None:
            was = done.select("slot", F.col("commit_lsn").alias("done_lsn"))
            changes = changes.join(F.broadcast(was), "slot", "left").where("done_lsn IS NULL OR commit_lsn > done_lsn").drop("done_lsn")
            ends = ends.unionByName(done).groupBy("slot").agg(F.max("last_seq").alias("last_seq"), F.max("commit_lsn").alias("commit_lsn"))
        self.handler(stored(common.described(found, changes, self.graph)), batch)

        tag = F.decode(F.substring("payload", 1, 1), "ISO-8859-1")
        opens = [frames.LETTER[k] for k in ("begin", "commit", "stream_start", "stream_stop", "stream_commit", "stream_abort")]
        self._write(log.where(tag.isin(opens)).groupBy("slot").agg(F.max_by("payload", "seq").alias("payload"), F.max("seq").alias("seq")).select("slot", "seq", "payload"), "marker", version)
        kept, known = common.undecided(found)
        mine = {r["part"] for r in kept.select("part").distinct().collect()}  # a number a batch
        together = len(mine) > self.parts
        kept_now = kept.withColumn("part", F.lit(version).cast("bigint")) if together else kept.where(F.col("part") == version)
        self._write(kept_now.unionByName(known.withColumn("part", F.lit(version).cast("bigint")), allowMissingColumns=True), "held", version)
        self._write(spark.createDataFrame([(v,) for v in sorted({version} if together else mine | {version})], "part long"), "parts", version)
        self._write(kept.select("slot", "tx").distinct(), "open", version)
        self._write(ends, "done", version)


def follow(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run a handler on each batch; the batch is confirmed when it returns. every: seconds between batches, else to the end of
    what is there."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def turns(log: DataFrame, order: str, path: str, count: int) -> Iterator[int]:
    """Write a log in pieces, each a range of positions, and stop after each, so that a stream can be run over what is there."""
    log = stored(log)
    low, high = (x or 0 for x in log.agg(F.min(order), F.max(order)).first())
    step = (high - low) // count + 1
    for k in range(count):
        own = (F.col(order) >= low + k * step) & (F.col(order) < low + (k + 1) * step)
        log.where(own if k < count - 1 else F.col(order) >= low + k * step).write.mode("append").parquet(path)
        yield k


def run_to_end(spark: SparkSession, log: DataFrame, replica: Replica, order: str, handler: Callable[[DataFrame, int], None] | None = None, pieces: int = 3) -> DataFrame:
    """Land a log piece by piece, run a stream over it after each from where it stopped, and return the replica."""
    home = folder(spark)
    for _ in turns(log, order, f"{home}/log", pieces):
        stream = spark.readStream.schema(log.schema).parquet(f"{home}/log")
        follow(stream, handler or replica, f"{home}/checkpoint").awaitTermination()
    return replica.table(spark)


class Held:
    """Changes of streamed transactions, keyed by slot and transaction id, held in tables until each commits; what commits is written to the folder `out`, a part for each batch. Those of aborted
    subtransactions are left out, and a transaction that aborts is forgotten; after either its id may come again.

    Rows come with slot, xid, subxid and kind, and with any other columns. kind: change, commit or abort, of which the last names in subxid what it ends: the transaction where that is xid.
    A batch writes its own undecided rows only, joined as whole tables, so nothing runs once a transaction. `open` names the transactions without an outcome with the batch since which they are
    open, and comes last: a batch that fails runs again from the same state and writes over what it left. When parts are many, the rows that are still needed are written together.
    """

    def __init__(self, path: str, parts: int = 16):
        self.path, self.parts = path, parts

    def _write(self, rows: DataFrame, name: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/version={batch}")

    def __call__(self, arrived: DataFrame, batch: int) -> None:
        spark = arrived.sparkSession
        last = max((v for v in versions_at(spark, f"{self.path}/open") if v < batch), default=None)
        mine = stored(arrived.where(F.col("kind").isin("change", "commit", "abort")).withColumn("__part", F.lit(batch).cast("bigint")))
        whole = (F.col("kind") == "commit") | F.coalesce((F.col("kind") == "abort") & (F.col("subxid") == F.col("xid")), F.lit(False))
        ended = stored(mine.where(whole).groupBy("slot", "xid").agg(F.max(F.col("kind") == "abort").alias("__gone")))
        names, before = mine.columns, None
        if last is not None:
            open_ = spark.read.parquet(f"{self.path}/open/version={last}")
            needed = [r["__in"] for r in spark.read.parquet(f"{self.path}/parts/version={last}").collect()]  # a few numbers
            held = spark.read.schema(mine.schema).parquet(*(f"{self.path}/held/version={v}" for v in needed))
            before = _of(held, open_, "inner").where("__part >= __since").select(*names)
        rows = mine if before is None else mine.unionByName(before)
        done = _of(rows.where("kind <> 'commit'"), ended.where("NOT __gone"), "left_semi")
        aborted = done.where("kind = 'abort'").select("slot", "xid", "subxid").distinct()
        released = _of(done.where("kind = 'change'"), aborted, "left_anti", ("slot", "xid"), ("subxid",))
        self._write(released.drop("kind", "__part"), "out", batch)

        kept = _of(mine, ended, "left_anti")
        together = last is not None and len(needed) >= self.parts
        self._write(_of(rows, ended, "left_anti") if together else kept, "held", batch)
        self._write(spark.createDataFrame([(v,) for v in ([batch] if together or last is None else [*needed, batch])], "__in long"), "parts", batch)
        now = kept.groupBy("slot", "xid").agg(F.min("__part").alias("__since"))
        if last is not None:
            now = now.unionByName(_of(open_, ended, "left_anti")).groupBy("slot", "xid").agg(F.min("__since").alias("__since"))
        self._write(now, "open", batch)

    def released(self, spark: SparkSession, columns: StructType) -> DataFrame:
        """Changes of transactions whose commit has arrived, with all their columns, in no order."""
        found = versions_at(spark, f"{self.path}/out")
        return spark.read.schema(columns).parquet(*(f"{self.path}/out/version={v}" for v in found)) if found else spark.createDataFrame([], columns)


def _of(rows: DataFrame, keyed: DataFrame, how: str, keys: tuple[str, ...] = ("slot", "xid"), equal: tuple[str, ...] = ()) -> DataFrame:
    """Rows joined with a table by keys that may be null, and by others that may not."""
    keyed = keyed.select(*(F.col(k).alias(f"__{k}") for k in (*keys, *equal)), *(c for c in keyed.columns if c not in (*keys, *equal)))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    for k in equal:
        on = on & (F.col(k) == F.col(f"__{k}"))
    return rows.join(keyed, on, how).drop(*(f"__{k}" for k in (*keys, *equal)))


def unique(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """A stream in which rows come more than once, with the first copy of each: a copy is known as one if it comes while event time is within `delay` of the first's, which bounds the
    state. keys: what names a row, such as (slot, commit_lsn, n)."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def unique_to_end(spark: SparkSession, log: DataFrame, keys: list[str], time: str, delay: str, order: str, pieces: int = 3) -> DataFrame:
    """Land a log piece by piece, run `unique` over it, and return what comes out."""
    home = folder(spark)
    for _ in turns(log, order, f"{home}/log", pieces):
        found = unique(spark.readStream.schema(log.schema).parquet(f"{home}/log"), keys, time, delay)
        found.writeStream.format("parquet").option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(log.schema).parquet(f"{home}/out")


def committed_to_end(spark: SparkSession, events: DataFrame, pieces: int = 2) -> DataFrame:
    """Land changes and outcomes piece by piece, run the stream that holds them, and return what it has released."""
    home = folder(spark)
    held = Held(f"{home}/held")
    for _ in turns(events, "seq", f"{home}/log", pieces):
        follow(spark.readStream.schema(events.schema).parquet(f"{home}/log"), held, f"{home}/checkpoint").awaitTermination()
    return held.released(spark, StructType([f for f in events.schema if f.name != "kind"]))
