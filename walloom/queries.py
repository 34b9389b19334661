"""The registered queries of the change-log operators, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .functions import layouts, lsn, usertypes, wire
from .jobs import common, deliver, outbox, replicate
from .operators import apply, catalog, changes, progress, rows, transactions, verify
from .session import stored
from .sources import frames
from .sources.derived import CHANGES, read
from .sources.derived import changes as derived
from .streaming import replica

KEYS, VALUES = ["user_id"], ["event_type", "value", "props"]
LOG = f"WITH log AS ({CHANGES}) "
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_STATE = """SELECT user_id, arg_max_null(event_type, seq) FILTER (op <> 'delete') AS event_type,
 arg_max_null(value, seq) FILTER (op <> 'delete') AS value,
 arg_max_null(props, seq) FILTER (op <> 'delete' AND NOT props_toasted) AS props
 FROM {0} GROUP BY user_id HAVING arg_max(op, seq) <> 'delete'"""


@query(LOG + _STATE.format("log"))
def latest_state(spark, d):
    return apply.latest_state(derived(spark, d), KEYS, VALUES, ["seq"], {"props": "props_toasted"})


@query(LOG + _STATE.format("(SELECT * FROM log WHERE seq > (SELECT MAX(seq) // 5 FROM log)) t"))
def latest_state_truncate(spark, d):
    log = derived(spark, d).withColumn("table", F.lit("user_state"))
    cuts = log.groupBy("table").agg(F.max("seq").alias("last")).select("table", F.explode(F.array(F.floor(F.col("last") / 10), F.floor(F.col("last") / 5))).alias("seq"))
    return apply.latest_state(apply.after_truncate(log, cuts), KEYS, VALUES, ["seq"], {"props": "props_toasted"})


@query(
    LOG
    + """, k AS (SELECT *, (op = 'update' AND seq % 97 = 0) AS moved FROM log),
 p AS (SELECT seq, 0 AS part, 'delete' AS op, user_id, NULL AS event_type, CAST(NULL AS DOUBLE) AS value FROM k WHERE moved
  UNION ALL SELECT seq, 1, CASE WHEN moved THEN 'insert' ELSE op END, CASE WHEN moved THEN user_id + 1000000 ELSE user_id END, event_type, value FROM k)
 SELECT user_id, arg_max_null(event_type, seq * 2 + part) FILTER (op <> 'delete') AS event_type, arg_max_null(value, seq * 2 + part) FILTER (op <> 'delete') AS value
 FROM p GROUP BY user_id HAVING arg_max(op, seq * 2 + part) <> 'delete'"""
)
def key_change_state(spark, d):
    moved = (F.col("op") == "update") & (F.col("seq") % 97 == 0)
    log = derived(spark, d).select("seq", "op", F.when(moved, F.col("user_id")).alias("old_user_id"), F.when(moved, F.col("user_id") + 1000000).otherwise(F.col("user_id")).alias("user_id"), "event_type", "value")
    return apply.latest_state(apply.moved_keys(log, "user_id", "old_user_id", ["event_type", "value"]), KEYS, ["event_type", "value"], ["seq", "part"])


@query("""SELECT l_orderkey, l_linenumber, l_quantity, CAST(unnest(generate_series(1, CAST(n AS BIGINT))) AS INTEGER) AS copy FROM (
 SELECT l_orderkey, l_linenumber, l_quantity, SUM(s) AS n FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, 1 AS s FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, -1 FROM lineitem WHERE l_linenumber = 7 AND l_orderkey % 2 = 0) GROUP BY ALL) WHERE n > 0""")
def net_rows_keyless(spark, d):
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    gone = lines.where("l_linenumber = 7 AND l_orderkey % 2 = 0")
    log = verify.together(lines.withColumn("op", F.lit("insert")), gone.withColumn("op", F.lit("delete")))
    return apply.net_rows(log, lines.columns, F.when(F.col("op") == "insert", 1).otherwise(-1))


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM (
 SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0
 UNION ALL SELECT -o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 = 2)""")
def merged_base(spark, d):
    base = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    kind = F.when(F.col("o_orderkey") % 5 == 0, "delete").when(F.col("o_orderkey") % 5 == 1, "update").when(F.col("o_orderkey") % 5 == 2, "insert")
    log = base.withColumn("op", kind).where("op is not null").withColumn("seq", F.col("o_orderkey"))
    log = log.withColumn("o_orderkey", F.when(F.col("op") == "insert", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))).withColumn("o_orderstatus", F.when(F.col("op") == "update", "X").otherwise(F.col("o_orderstatus")))
    return apply.merge(base, log, ["o_orderkey"], ["o_orderstatus", "o_totalprice"], ["seq"])


# ---- transactions


@query(LOG + "SELECT xid, commit_lsn, COUNT(*) AS n_changes, string_agg(op || ':' || user_id, ',' ORDER BY seq) AS batch FROM log GROUP BY xid, commit_lsn")
def tx_batches(spark, d):
    found = transactions.batches(derived(spark, d), ["xid", "commit_lsn"], "seq", ["op", "user_id"])
    return found.select("xid", "commit_lsn", "n_changes", F.array_join(F.transform("batch", lambda c: F.concat_ws(":", c["op"], c["user_id"])), ",").alias("batch"))


@query(LOG + "SELECT seq, op, user_id, xid, commit_lsn, commit_timestamp FROM log")
def tx_enriched(spark, d):
    log = derived(spark, d)
    tx = log.groupBy("xid").agg(F.max("commit_lsn").alias("commit_lsn"), F.max("commit_timestamp").alias("commit_timestamp"))
    return transactions.enrich(log.select("seq", "op", "user_id", "xid"), tx, ["xid"])


@query(LOG + "SELECT seq, xid, ROW_NUMBER() OVER (PARTITION BY xid ORDER BY seq) AS n FROM log")
def tx_position(spark, d):
    return transactions.positions(derived(spark, d).select("seq", "xid"), ["xid"], "seq")


def _attempts(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """begin and commit records; every fiftieth transaction has a first attempt without a commit, every tenth comes again."""
    tx = log.groupBy("xid", "commit_lsn", "tx_end_lsn").agg(F.min("seq").alias("first"))
    n = F.when(F.col("xid") % 50 == 0, F.array(F.lit(-1), F.lit(0), F.lit(1))).when(F.col("xid") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    each = tx.withColumn("attempt", F.explode(n)).select(F.lit("s").alias("slot"), (F.col("first") * 4 + F.col("attempt") + 1).alias("tx"), "xid", "commit_lsn", "tx_end_lsn", "attempt")
    return each.select("slot", "tx", F.col("commit_lsn").alias("lsn"), "xid"), each.where("attempt >= 0").select("slot", "tx", "commit_lsn", "tx_end_lsn")


_ATTEMPTS = """, tx AS (SELECT xid, commit_lsn, tx_end_lsn, MIN(seq) AS first FROM log GROUP BY ALL), a AS (
 SELECT *, 0 AS attempt FROM tx UNION ALL SELECT *, 1 FROM tx WHERE xid % 10 = 0 UNION ALL SELECT *, -1 FROM tx WHERE xid % 50 = 0) """


@query(LOG + _ATTEMPTS + "SELECT 's' AS slot, first * 4 + attempt + 1 AS tx, commit_lsn AS lsn, xid, commit_lsn, tx_end_lsn FROM a WHERE attempt >= 0")
def begin_commit_pairs(spark, d):
    return transactions.pair_begin_commit(*_attempts(derived(spark, d)))


@query(LOG + "SELECT seq, xid, commit_lsn, op, 0 AS attempt FROM log")
def deduped(spark, d):
    log = derived(spark, d).select("seq", "xid", "commit_lsn", "op")
    again = log.where("xid % 10 = 0").withColumn("attempt", F.lit(1))
    return transactions.deduplicated(log.withColumn("attempt", F.lit(0)).union(again), "commit_lsn", "attempt")


# Every transaction is streamed, every fourth change in a subtransaction. By the id, one transaction in eight aborts, one has its
# subtransaction aborted, one is still open, and the rest commit.
_STREAMED = ", s AS (SELECT seq, xid, op, user_id, CASE WHEN seq % 4 = 1 THEN -1 - xid ELSE xid END AS subxid FROM log) "
_KEPT = "NOT (xid % 8 = 5 AND subxid < 0)"


def _streamed(spark, d):
    log = derived(spark, d).select("seq", "xid", "op", "user_id", F.when(F.col("seq") % 4 == 1, -1 - F.col("xid")).otherwise(F.col("xid")).alias("subxid"))
    ids = log.select("xid").distinct()
    commits = ids.where("xid % 8 NOT IN (3, 7)")
    aborts = ids.where("xid % 8 = 3").select("xid", F.col("xid").alias("subxid")).union(ids.where("xid % 8 = 5").select("xid", -1 - F.col("xid")))
    return log, commits, aborts


@query(LOG + _STREAMED + "SELECT seq, xid, op, user_id, subxid FROM s WHERE xid % 8 <> 3 AND " + _KEPT)
def aborted_removed(spark, d):
    log, _, aborts = _streamed(spark, d)
    return transactions.without_aborted(log, aborts).select("seq", "xid", "op", "user_id", "subxid")


@query(LOG + _STREAMED + "SELECT seq, xid, op, user_id, subxid FROM s WHERE xid % 8 NOT IN (3, 7) AND " + _KEPT)
def committed_streamed(spark, d):
    log, commits, aborts = _streamed(spark, d)
    return transactions.committed_streamed(transactions.without_aborted(log, aborts), commits, ["xid"]).select("seq", "xid", "op", "user_id", "subxid")


@query(LOG + _STREAMED + "SELECT seq, xid, op, user_id, subxid FROM s WHERE xid % 8 = 7")
def pending_streams(spark, d):
    log, commits, aborts = _streamed(spark, d)
    outcomes = commits.union(aborts.where("xid = subxid").select("xid"))
    return transactions.pending_streamed(log, outcomes, ["xid"]).select("seq", "xid", "op", "user_id", "subxid")


@query("SELECT event_id AS seq, last_value(CASE WHEN event_type = 'signup' THEN user_id END IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM events")
def stream_state(spark, d):
    log = read(spark, d, "events").select(F.lit("s").alias("slot"), F.col("event_id").alias("seq"), "event_type", "user_id")
    return transactions.carry_forward(log, F.when(F.col("event_type") == "signup", F.col("user_id")), "state", rows=512).select("seq", "state")


@query(LOG + "SELECT seq, xid, op, TRUE AS in_order FROM log")
def commit_order(spark, d):
    """in_order: whether a row stands behind all rows of the partitions before its own and behind the row before it. Rows are stored with their places: planned twice, the order would be dealt
    to other partitions each time, as large as the columns that are read."""
    ordered = transactions.in_commit_order(derived(spark, d).select("seq", "xid", "op"), "xid", "seq")
    placed = stored(ordered.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))
    at = F.struct("xid", "seq")
    ends = placed.groupBy("part").agg(F.max(at).alias("last"))
    before = ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("before"))  # a row a partition
    own = F.lag(at).over(Window.partitionBy("part").orderBy("place"))
    return placed.withColumn("own", own).join(F.broadcast(before), "part").select("seq", "xid", "op", (F.coalesce(at > F.col("own"), F.lit(True)) & F.coalesce(at > F.col("before"), F.lit(True))).alias("in_order"))


# ---- relations


@query(LOG + "SELECT seq, op, CASE WHEN seq >= 5000 THEN 2 ELSE 1 END AS version, CASE WHEN seq >= 5000 THEN 'user_id,event_type,value,props' ELSE 'user_id,event_type,value' END AS columns FROM log")
def relation_asof(spark, d):
    versions = spark.createDataFrame([(16931, -1, 1, "user_id,event_type,value"), (16931, 5000, 2, "user_id,event_type,value,props")], "rel_oid long, seq long, version int, columns string")
    log = derived(spark, d).select("seq", "op", F.lit(16931).cast("bigint").alias("rel_oid"))
    return progress.as_of(log, versions, ["rel_oid"]).select("seq", "op", "version", "columns")


@query(LOG + ", t AS (SELECT seq FROM log WHERE seq % 2500 = 0) SELECT seq, position, namespace, name FROM t, (VALUES (0, 'public', 'user_state'), (1, 'audit', 'log')) v(position, namespace, name)")
def truncate_targets(spark, d):
    cuts = derived(spark, d).where("seq % 2500 = 0").select(F.lit("s").alias("slot"), "seq", F.lit(False).alias("truncate_cascade"), F.lit(True).alias("truncate_restart_identity"), F.array(F.lit(16931), F.lit(16940)).cast("array<bigint>").alias("oids"))
    known = spark.createDataFrame([("s", -2, 16931, "public", "user_state"), ("s", -1, 16940, "audit", "log")], "slot string, seq long, rel_oid long, namespace string, name string")
    return rows.truncate_targets(cuts, known, progress.as_of).select("seq", "position", "namespace", "name")


_KNOWN = [(16931, "user_id", 20, True), (16931, "event_type", 70001, False), (16931, "value", 701, False), (16931, "props", 70003, False), (16931, "place", 70004, False)]


@query(LOG + "SELECT seq, name, CAST(oid AS BIGINT) AS resolved_oid FROM log, (VALUES ('user_id', 20), ('event_type', 25), ('value', 701), ('props', 3802), ('place', 2249)) v(name, oid)")
def user_types(spark, d):
    types = spark.createDataFrame([(70001, "e", None), (70002, "d", 3802), (70003, "d", 70002), (70004, "c", None), (20, "b", None), (701, "b", None), (3802, "b", None)], "type_oid long, kind string, base_oid long")
    attributes = catalog.base_types(types, spark.createDataFrame(_KNOWN, "rel_oid long, name string, type_oid long, is_key boolean"))
    log = derived(spark, d).select("seq", F.lit(16931).cast("bigint").alias("rel_oid"))
    return log.join(F.broadcast(attributes), "rel_oid").select("seq", "name", F.col("resolved_oid").cast("bigint"))


# ---- versions of rows


@query(LOG + "SELECT seq, user_id, op, CASE WHEN props_toasted THEN arg_max_null(props, seq) FILTER (NOT props_toasted) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE props END AS props FROM log")
def toast_filled(spark, d):
    return changes.filled(derived(spark, d), KEYS, {"props": "props_toasted"}, "seq").select("seq", "user_id", "op", "props")


@query(LOG + "SELECT seq, user_id FROM log WHERE props_toasted")
def toast_rows(spark, d):
    return changes.toasted(derived(spark, d), ["props_toasted"]).select("seq", "user_id")


_PREVIOUS = "SELECT seq, user_id, op, event_type, {0}, LAG(event_type) OVER w AS old_event_type, LAG({1}) OVER w AS old_value FROM log WINDOW w AS (PARTITION BY user_id ORDER BY seq)"


@query(LOG + _PREVIOUS.format("value", "value"))
def previous_version(spark, d):
    return changes.previous_versions(derived(spark, d).select("seq", "user_id", "op", "event_type", "value"), KEYS, ["event_type", "value"], "seq")


@query(LOG + ", v AS (" + _PREVIOUS.format("value", "value") + ") SELECT seq, user_id, concat_ws(',', CASE WHEN event_type IS DISTINCT FROM old_event_type THEN 'event_type' END, CASE WHEN value IS DISTINCT FROM old_value THEN 'value' END) AS changed FROM v WHERE op = 'update'")
def changed_columns(spark, d):
    both = previous_version(spark, d).where("op = 'update'")
    return both.select("seq", "user_id", F.array_join(changes.changed_columns(["event_type", "value"]), ",").alias("changed"))


@query(LOG + ", r AS (SELECT seq, user_id, op, event_type, FLOOR(value / 100) AS value FROM log), v AS (" + _PREVIOUS.format("value", "value").replace("FROM log", "FROM r") + ") SELECT seq, user_id, op FROM v WHERE NOT (op = 'update' AND event_type IS NOT DISTINCT FROM old_event_type AND value IS NOT DISTINCT FROM old_value)")
def redundant_removed(spark, d):
    log = derived(spark, d).select("seq", "user_id", "op", "event_type", F.floor(F.col("value") / 100).alias("value"))
    return changes.without_redundant(changes.previous_versions(log, KEYS, ["event_type", "value"], "seq"), ["event_type", "value"]).select("seq", "user_id", "op")


# ---- filters


@query(LOG + "SELECT seq, op AS type FROM log")
def data_changes(spark, d):
    log = derived(spark, d).select("seq", F.col("op").alias("type"))
    markers = log.select("seq", F.explode(F.array(F.lit("begin"), F.lit("relation"), F.lit("commit"))).alias("type"))
    return changes.data_changes(log.union(markers))


@query(LOG + "SELECT seq, op, user_id FROM log WHERE op IN ('insert', 'delete')")
def publication_filter(spark, d):
    tables = spark.createDataFrame([("public", "user_state")], "schema string, table string")
    log = derived(spark, d).select("seq", "op", "user_id", F.lit("public").alias("schema"), F.lit("user_state").alias("table"))
    other = log.withColumn("table", F.lit("other"))
    return changes.published(log.union(other), ["insert", "delete"], tables).select("seq", "op", "user_id")


@query("SELECT event_id AS seq, props AS text FROM events WHERE event_type = 'purchase' AND event_id % 7 <> 0")
def messages_by_prefix(spark, d):
    log = read(spark, d, "events").select(F.col("event_id").alias("seq"), F.lit("message").alias("type"), F.col("event_type").alias("prefix"), (F.col("event_id") % 7 != 0).alias("transactional"), F.encode("props", "UTF-8").alias("content"))
    return rows.message_text(changes.logical_messages(log, "purchase", True)).select("seq", "text")


@query(LOG + "SELECT DISTINCT xid, 'commit' AS type, CAST(NULL AS BIGINT) AS abort_lsn FROM log WHERE xid % 8 <> 3 UNION ALL SELECT DISTINCT xid, 'stream_abort', commit_lsn FROM log WHERE xid % 16 = 3")
def ackable(spark, d):
    tx = derived(spark, d).select("xid", "commit_lsn").distinct()
    kind = F.when(F.col("xid") % 16 == 3, "stream_abort").when(F.col("xid") % 8 == 3, "stream_start").otherwise("commit")
    return changes.acknowledgeable(tx.select("xid", kind.alias("type"), F.when(F.col("xid") % 16 == 3, F.col("commit_lsn")).alias("abort_lsn")))


@query(LOG + "SELECT seq, commit_lsn FROM log WHERE commit_lsn >= 1638400")
def start_from_lsn(spark, d):
    return changes.from_position(derived(spark, d).select("seq", "commit_lsn"), lsn.lsn_of("0/190000"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (1, 2, 3)")
def any_array(spark, d):
    kept = changes.any_of(read(spark, d, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"])
    return changes.none_of(kept, "c_nationkey", [1, 2, 3]).select("c_custkey", "c_mktsegment")


# ---- progress


def _commits(spark, d):
    tx = derived(spark, d).select("xid", "tx_end_lsn", "commit_timestamp").distinct()
    return tx.select(F.concat(F.lit("s"), F.col("xid") % 3).alias("slot"), "tx_end_lsn", "commit_timestamp", (F.col("xid") % 5 != 4).alias("acknowledged"))


_COMMITS = ", t AS (SELECT DISTINCT 's' || (xid % 3) AS slot, tx_end_lsn, commit_timestamp, xid % 5 <> 4 AS acknowledged FROM log) "


@query(LOG + _COMMITS + "SELECT slot, MAX(tx_end_lsn) AS confirmed_lsn FROM t WHERE acknowledged GROUP BY slot")
def confirmed_lsn(spark, d):
    return progress.confirmed(_commits(spark, d))


@query(LOG + _COMMITS + "SELECT t.slot, MAX(tx_end_lsn) AS confirmed_lsn FROM t JOIN (SELECT slot, MIN(tx_end_lsn) AS gap FROM t WHERE NOT acknowledged GROUP BY slot) g ON t.slot = g.slot WHERE tx_end_lsn < gap GROUP BY t.slot")
def confirmed_safe_lsn(spark, d):
    return progress.confirmed_safe(_commits(spark, d))


@query(LOG + _COMMITS + "SELECT slot, MAX(tx_end_lsn) - MAX(tx_end_lsn) FILTER (acknowledged) AS lag_bytes, epoch_us(MAX(commit_timestamp)) - epoch_us(MAX(commit_timestamp) FILTER (acknowledged)) AS lag_micros FROM t GROUP BY slot")
def slot_lag(spark, d):
    return progress.lag(_commits(spark, d))


@query(LOG + "SELECT MAX(tx_end_lsn) >= 40960 AS caught_up FROM log")
def caught_up(spark, d):
    return progress.caught_up(derived(spark, d), 40960)


@query(LOG + ", l AS (SELECT seq, commit_lsn * 1048576 + seq AS lsn FROM log) SELECT seq, format('{:X}/{:X}', lsn >> 32, lsn & 4294967295) AS text, lsn AS back, lsn >> 32 AS segment, lsn & 4294967295 AS byte_offset FROM l")
def lsn_text(spark, d):
    log = derived(spark, d).select("seq", (F.col("commit_lsn") * 1048576 + F.col("seq")).alias("lsn"))
    text = lsn.lsn_to_text(F.col("lsn"))
    return log.select("seq", text.alias("text"), lsn.text_to_lsn(text).alias("back"), lsn.lsn_segment(F.col("lsn")).alias("segment"), lsn.lsn_offset(F.col("lsn")).alias("byte_offset"))


# ---- binary round trips

ORDERS = {"o_orderkey": "int8", "o_custkey": "int8", "o_orderstatus": "text", "o_orderdate": "timestamp", "o_comment": "text"}


def _order_columns(spark, d):
    orders = read(spark, d, "orders")
    known = {"o_orderkey": F.col("o_orderkey"), "o_custkey": F.col("o_custkey"), "o_orderstatus": F.col("o_orderstatus"), "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"), "o_comment": F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("é "), F.col("o_orderstatus")))}
    return orders.select(*(c.alias(n) for n, c in known.items()))


def order_frames(spark, d) -> DataFrame:
    """The orders table as a log: its description, then an insert for each row."""
    values = [(wire.encode_value(F.col(n), k), None) for n, k in ORDERS.items()]
    inserts = _order_columns(spark, d).select(F.lit("s").alias("slot"), (F.col("o_orderkey") + 1).alias("seq"), frames.insert(F.lit(16931), frames.tuple_bytes(values)).alias("payload"))
    about = frames.relation(16931, "public", "orders", "d", [(n, k, n == "o_orderkey") for n, k in ORDERS.items()])
    return stored(inserts.union(spark.range(1).select(F.lit("s"), F.lit(-1).cast("bigint"), about)))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'é ' || o_orderstatus END AS o_comment FROM orders")
def frames_roundtrip_orders(spark, d):
    found = frames.messages(order_frames(spark, d)).where("type = 'insert'")
    return found.select(*rows.typed(F.col("new_tuple"), ORDERS))


@query("SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS custkey, o_orderstatus AS status, CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE 5 END AS n_values, 'o_orderkey' AS keys FROM orders")
def row_map(spark, d):
    read_back = stored(frames.messages(order_frames(spark, d)))
    known = read_back.where("type = 'relation'").select("slot", "seq", "rel_oid", "attributes")
    found = progress.as_of(read_back.where("type = 'insert'").select("slot", "seq", "rel_oid", "new_tuple"), known, ["slot", "rel_oid"])
    row = rows.row_map(F.col("attributes"), F.col("new_tuple"))
    return found.select((F.col("seq") - 1).alias("seq"), row.alias("row"), rows.key_names(F.col("attributes")).alias("names")).select("seq", F.col("row")["o_custkey"].alias("custkey"), F.col("row")["o_orderstatus"].alias("status"), F.size("row").alias("n_values"), F.array_join("names", ",").alias("keys"))


@query("SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'orders.o_comment,' END || 'orders.o_custkey,orders.o_orderdate,orders.o_orderkey,orders.o_orderstatus' AS names FROM orders")
def rename_keys(spark, d):
    read_back = stored(frames.messages(order_frames(spark, d)))
    known = read_back.where("type = 'relation'").select("slot", "seq", "rel_oid", "attributes", "name")
    found = progress.as_of(read_back.where("type = 'insert'").select("slot", "seq", "rel_oid", "new_tuple"), known, ["slot", "rel_oid"])
    named = rows.renamed(rows.row_map(F.col("attributes"), F.col("new_tuple")), lambda k: F.concat_ws(".", F.col("name"), k))
    return found.select((F.col("seq") - 1).alias("seq"), F.array_join(F.array_sort(F.map_keys(named)), ",").alias("names"))


EVENTS = {"user_id": "int8", "event_type": "text", "props": "jsonb", "ts": "timestamp"}


@query(LOG + "SELECT seq, op AS type, user_id, event_type, props, CASE WHEN props_toasted THEN 'props' ELSE '' END AS unchanged, CASE WHEN op = 'insert' THEN NULL ELSE user_id END AS old_user_id FROM log")
def frames_roundtrip_events(spark, d):
    kinds = {k: v for k, v in EVENTS.items() if k != "ts"}
    log = derived(spark, d)
    new = frames.tuple_bytes([(wire.encode_value(F.col("user_id"), "int8"), None), (wire.encode_value(F.col("event_type"), "text"), None), (wire.encode_value(F.col("props"), "jsonb"), F.col("props_toasted"))])
    old = frames.tuple_bytes([(wire.encode_value(F.col("user_id"), "int8"), None), (F.lit(None).cast("binary"), None), (F.lit(None).cast("binary"), None)])
    oid = F.lit(16931)
    body = F.when(F.col("op") == "insert", frames.insert(oid, new)).when(F.col("op") == "update", frames.update(oid, new, old)).otherwise(frames.delete(oid, old))
    found = frames.messages(log.select(F.lit("s").alias("slot"), "seq", body.alias("payload")))
    names = F.array(*(F.struct(F.lit(n).alias("name")) for n in kinds))
    values = rows.typed(F.coalesce("new_tuple", "old_tuple"), kinds)
    before = rows.typed(F.col("old_tuple"), {"old_user_id": "int8"})
    return found.select("seq", "type", *values, F.coalesce(F.array_join(rows.unchanged(F.col("new_tuple"), names), ","), F.lit("")).alias("unchanged"), *before)


@query("SELECT event_id, epoch_us(ts) AS micros, user_id, CAST(event_id % 30000 AS SMALLINT) AS small, event_type, event_id % 2 = 0 AS flag, CAST(ts AS DATE) AS day, CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS props FROM events")
def values_roundtrip_builtin(spark, d):
    e = read(spark, d, "events").select("event_id", "ts", "user_id", "event_type", F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"))
    back = lambda c, k: wire.decode_value(wire.encode_value(c, k), k)
    return e.select(
        back(F.col("event_id"), "int8").alias("event_id"), F.unix_micros(back(F.col("ts"), "timestamptz")).alias("micros"), back(F.col("user_id"), "int8").alias("user_id"), back(F.col("event_id") % 30000, "int2").alias("small"),
        back(F.col("event_type"), "text").alias("event_type"), back(F.col("event_id") % 2 == 0, "bool").alias("flag"), back(F.col("ts").cast("date"), "date").alias("day"), back(F.col("props"), "jsonb").alias("props"),
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS price, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text, l_returnflag || ',' || l_linestatus AS elements FROM lineitem")
def values_roundtrip_layouts(spark, d):
    lines = read(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    parts = F.array(F.encode("l_returnflag", "UTF-8"), F.lit(None).cast("binary"), F.encode("l_linestatus", "UTF-8"))
    packed = lines.select("l_orderkey", "l_linenumber", layouts.encoder("float8")(F.col("l_quantity").cast("double")).alias("q"), layouts.encoder("float8")(F.col("l_extendedprice").cast("double")).alias("p"), layouts.encoder("numeric")(price).alias("t"), layouts.encoder("[]", 25)(parts).alias("e"))
    read_back = packed.select("l_orderkey", "l_linenumber", layouts.decoder("float8")("q").alias("quantity"), layouts.decoder("float8")("p").alias("price"), layouts.decoder("numeric")("t").alias("price_text"), layouts.decoder("[]")("e").alias("e"))
    return read_back.select("l_orderkey", "l_linenumber", "quantity", "price", "price_text", F.array_join(F.transform("e", lambda x: F.decode(x, "UTF-8")), ",").alias("elements"))


@query("""SELECT l_orderkey, l_linenumber, l_linenumber || ',-;' || (l_orderkey % 100) || ',' || l_linenumber AS matrix, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ',-' AS prices,
 CASE WHEN l_orderkey % 3 = 0 THEN '2x2' ELSE '1' END AS lengths, CASE WHEN l_orderkey % 3 = 0 THEN 4 ELSE 1 END AS n_elements FROM lineitem""")
def values_arrays(spark, d):
    """Arrays with nulls in one and two dimensions there and back, and a column of arrays of different dimensions."""
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    n, none = F.col("l_linenumber").cast("int"), F.lit(None)
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.array(F.array(n, none.cast("int")), F.array((F.col("l_orderkey") % 100).cast("int"), n)).alias("m"), F.array(price, none.cast("string")).alias("p"), F.array(n).alias("a"))
    packed = lines.select("l_orderkey", "l_linenumber", layouts.encoder("int4[][]")("m").alias("m"), layouts.encoder("numeric[]")("p").alias("p"), layouts.encoder("int4[]")("a").alias("a"))
    mixed = packed.withColumn("a", F.when(F.col("l_orderkey") % 3 == 0, F.col("m")).otherwise(F.col("a")))
    back = mixed.select("l_orderkey", "l_linenumber", layouts.decoder("int4[][]")("m").alias("m"), layouts.decoder("numeric[]")("p").alias("p"), layouts.decoder("int4[*]")("a").alias("a"))
    return back.select("l_orderkey", "l_linenumber", F.array_join(F.transform("m", lambda r: F.array_join(r, ",", "-")), ";").alias("matrix"), F.array_join("p", ",", "-").alias("prices"), F.array_join("a.lengths", "x").alias("lengths"), F.size("a.elements").alias("n_elements"))


@query("""SELECT event_id, '10.' || (user_id % 256) || '.0.' || (event_id % 256) AS address, 24 AS netmask, CAST(user_id AS DOUBLE) AS x, value AS y, user_id AS lower, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id + event_id END AS upper, event_id % 5 = 0 AS unbounded,
 event_type AS word, 3 AS place, 20 AS field_oid, lpad(lower(format('{:X}', user_id)), 16, '0') AS field, event_id % 2 = 0 AS flag, CASE WHEN event_id % 2 = 0 THEN '101' ELSE '0000000011' END AS bits FROM events""")
def values_layouts(spark, d):
    """Addresses, points, ranges, search vectors, records and bit strings there and back."""
    e = read(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    one, byte = F.col("event_id"), lambda c: (F.col(c) % 256).cast("string")
    open_, upper = one % 5 == 0, F.when(one % 5 != 0, F.col("user_id") + one)
    built = {
        "inet": F.struct(F.concat(F.lit("10."), byte("user_id"), F.lit(".0."), byte("event_id")).alias("address"), F.lit("inet4").alias("type"), F.lit(24).alias("netmask")),
        "point": F.struct(F.col("user_id").cast("double").alias("x"), F.col("value").alias("y")),
        "int8range": F.struct(F.col("user_id").alias("lower"), F.lit(True).alias("lower_inc"), upper.alias("upper"), F.lit(False).alias("upper_inc"), F.lit(False).alias("lower_inf"), open_.alias("upper_inf"), F.lit(False).alias("empty")),
        "tsvector": F.array(F.struct(F.col("event_type").alias("text"), F.array(F.struct(F.lit(3).alias("position"), F.lit("A").alias("weight"))).alias("entries"))),
        "record": F.array(F.struct(F.lit(0).alias("pos"), F.lit(20).cast("bigint").alias("oid"), F.lower(F.lpad(F.hex("user_id"), 16, "0")).alias("value"))),
        "bool": one % 2 == 0, "varbit": F.when(one % 2 == 0, "101").otherwise("0000000011"),
    }
    packed = e.select("event_id", *(layouts.encoder(kind)(value).alias(kind) for kind, value in built.items()))
    b = packed.select("event_id", *(layouts.decoder(kind)(kind).alias(kind) for kind in built))
    word, field = F.get("tsvector", F.lit(0)), F.get("record", F.lit(0))
    return b.select("event_id", "inet.address", "inet.netmask", "point.x", "point.y", "int8range.lower", "int8range.upper", F.col("int8range.upper_inf").alias("unbounded"), word["text"].alias("word"), F.get(word["entries"], F.lit(0))["position"].alias("place"), field["oid"].alias("field_oid"), field["value"].alias("field"), F.col("bool").alias("flag"), F.col("varbit").alias("bits"))


@query("SELECT event_id, event_id % 2 = 0 AS flag, user_id AS number, ts AS at FROM events")
def values_text(spark, d):
    e = read(spark, d, "events")
    text = e.select("event_id", F.when(F.col("event_id") % 2 == 0, "t").otherwise("f").alias("b"), F.col("user_id").cast("string").alias("n"), F.col("ts").cast("string").alias("t"))
    return text.select("event_id", wire.decode_text(F.col("b"), "bool").alias("flag"), wire.decode_text(F.col("n"), "int8").alias("number"), wire.decode_text(F.col("t"), "timestamp").alias("at"))


@query("SELECT event_id AS seq, event_type AS prefix, props AS text, event_id % 7 <> 0 AS transactional FROM events")
def emitted_messages(spark, d):
    e = read(spark, d, "events")
    log = e.select(F.lit("s").alias("slot"), F.col("event_id").alias("seq"), frames.message(F.col("event_id") * 16, F.col("event_type"), F.encode("props", "UTF-8"), F.col("event_id") % 7 != 0).alias("payload"))
    return rows.message_text(frames.messages(log)).select("seq", "prefix", "text", "transactional")


@query("SELECT event_id AS seq, event_id * 16 AS wal_lsn, event_id * 16 + 8 AS end_lsn, ts AS system_clock FROM events WHERE event_id % 10 <> 0")
def split_frames(spark, d):
    e = read(spark, d, "events")
    micros = wire.timestamp_to_micros(F.col("ts"))
    data = frames.wal(F.col("event_id") * 16, F.col("event_id") * 16 + 8, micros, frames.message(F.col("event_id"), F.col("event_type"), F.encode("props", "UTF-8"), F.lit(True)))
    alive = F.concat(F.encode(F.lit("k"), "UTF-8"), wire.int_bytes(F.col("event_id"), 8), wire.int_bytes(micros, 8), wire.int_bytes(F.lit(1), 1))
    found, _ = frames.split_frames(e.select(F.lit("s").alias("slot"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 10 == 0, alive).otherwise(data).alias("payload")))
    return found.select("seq", "wal_lsn", "end_lsn", F.col("system_clock").cast("timestamp_ntz").alias("system_clock"))


# ---- jobs over a log of frames

#: The log of frames that carries the changes of CHANGES. A transaction has 128 positions from xid * 128. By the id, one in eight is streamed and commits after the
#: one behind it, one is streamed and aborts, one is streamed and its subtransaction (every fourth change) aborts; the rest are plain. Behind a tenth of the log the table is truncated.
_FRAMES = LOG + """, c AS (SELECT *, CASE xid % 8 WHEN 3 THEN 'streamed' WHEN 7 THEN 'aborted' WHEN 5 THEN 'partly' ELSE 'plain' END AS kind FROM log),
 k AS (SELECT *, xid * 128 + (seq % 8) * 8 + 4 AS pos, CASE kind WHEN 'plain' THEN xid * 128 + 65 ELSE xid * 128 + 198 END AS commit_seq FROM c WHERE NOT (kind = 'aborted' OR (kind = 'partly' AND seq % 4 = 1))),
 cut AS (SELECT (MAX(xid) // 10) * 128 AS pos FROM log) """
TABLE = {"user_id": "int8", "event_type": "text", "value": "float8", "props": "jsonb"}


def state_frames(spark, d) -> DataFrame:
    """The change log as the frames that a server would send, commit positions rising: see _FRAMES. Every transaction carries a message, and after each comes one at once, with a header, and a keep-alive."""
    log = stored(derived(spark, d)).withColumn("kind", F.when(F.col("xid") % 8 == 3, "streamed").when(F.col("xid") % 8 == 7, "aborted").when(F.col("xid") % 8 == 5, "partly").otherwise("plain"))
    plain, none, oid = F.col("kind") == "plain", (F.lit(None).cast("binary"), None), F.lit(16931)
    user = (wire.encode_value(F.col("user_id"), "int8"), None)
    log = log.withColumn("value_bytes", layouts.encoder("float8")("value"))
    new = frames.tuple_bytes([user, (wire.encode_value(F.col("event_type"), "text"), None), (F.col("value_bytes"), None), (wire.encode_value(F.col("props"), "jsonb"), F.col("props_toasted"))])
    old = frames.tuple_bytes([user, none, none, none])
    log = log.withColumns({"new": new, "old": old})
    new, old = F.col("new"), F.col("old")
    sub = F.when((F.col("kind") == "partly") & (F.col("seq") % 4 == 1), F.col("xid") + 2**31).otherwise(F.col("xid"))
    body = lambda xid: F.when(F.col("op") == "insert", frames.insert(oid, new, xid)).when(F.col("op") == "update", frames.update(oid, new, old, xid=xid)).otherwise(frames.delete(oid, old, xid=xid))
    changed = log.select((F.col("xid") * 128 + F.col("seq") % 8 * 8 + 4).alias("seq"), F.when(plain, body(None)).otherwise(body(sub)).alias("payload"))

    tx = log.groupBy("xid", "kind", "commit_lsn", "tx_end_lsn").agg(wire.timestamp_to_micros(F.max("commit_timestamp")).alias("micros"))
    x, lsn_at, end, micros = (F.col(c) for c in ("xid", "commit_lsn", "tx_end_lsn", "micros"))
    said = F.encode(F.concat(F.lit("tx "), x), "UTF-8")
    cut = (x == F.floor(F.lit(log.agg(F.max("xid")).first()[0]) / 10)) if not tx.isEmpty() else F.lit(False)
    at = lambda place, payload, only: F.when(only, F.struct((x * 128 + place).alias("seq"), payload.alias("payload")))
    parts = [
        at(0, F.when(plain, frames.begin(lsn_at, micros, x)).otherwise(frames.stream_start(x, F.lit(True))), F.lit(True)),
        at(2, F.when(plain, frames.message(lsn_at, F.lit("tx"), said, F.lit(True))).otherwise(frames.message(lsn_at, F.lit("tx"), said, F.lit(True), x)), F.lit(True)),
        at(65, F.when(plain, frames.commit(lsn_at, end, micros)).otherwise(frames.stream_stop()), F.lit(True)),
        at(66, frames.stream_abort(x, x + 2**31), F.col("kind") == "partly"),
        at(67, frames.stream_abort(x, x, lsn_at, micros), F.col("kind") == "aborted"),
        at(198, frames.stream_commit(x, lsn_at + 4097, end + 4097, micros), F.col("kind").isin("streamed", "partly")),
        at(80, frames.begin(lsn_at + 2, micros, x + 2**30), cut), at(81, frames.truncate(F.array(oid)), cut), at(82, frames.commit(lsn_at + 2, end + 2, micros), cut),
        at(90, frames.wal(lsn_at, end, micros, frames.message(lsn_at, F.lit("now"), said, F.lit(False))), F.lit(True)),
        at(95, F.concat(F.encode(F.lit("k"), "UTF-8"), wire.int_bytes(end, 8), wire.int_bytes(micros, 8), wire.int_bytes(F.lit(1), 1)), F.lit(True)),
    ]
    markers = tx.select(F.explode(F.array_compact(F.array(*parts))).alias("f")).select("f.*")
    about = spark.range(1).select(F.lit(-1).cast("bigint").alias("seq"), frames.relation(16931, "public", "user_state", "d", [(n, k, n == "user_id") for n, k in TABLE.items()]).alias("payload"))
    return stored(changed.union(markers).union(about).select(F.lit("s").alias("slot"), "seq", "payload"))


@query(_FRAMES + ", s AS (SELECT k.* EXCLUDE (seq), commit_seq * 256 + (seq % 8) AS seq FROM k, cut WHERE commit_seq > cut.pos + 82) " + _STATE.format("s"))
def replicate_frames(spark, d):
    """The job `replicate` from frames to a table: plain, streamed, aborted and partly aborted transactions, and a truncate."""
    return replicate.replicate(spark, state_frames(spark, d), "public.user_state", KEYS, TABLE)


@query(_FRAMES + """, a AS (SELECT commit_seq, pos, op AS type, user_id, event_type, value FROM k UNION ALL SELECT pos + 82, pos + 81, 'truncate', NULL, NULL, NULL FROM cut)
 SELECT commit_seq, ROW_NUMBER() OVER (PARTITION BY commit_seq ORDER BY pos) AS n, type, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN type <> 'delete' THEN event_type END AS event_type, value FROM a""")
def deliver_frames(spark, d):
    """The job `deliver` from frames to rows for a consumer."""
    found = deliver.deliver(spark, state_frames(spark, d))
    row = lambda c: F.coalesce(F.col("new_row")[c], F.col("old_row")[c])
    return found.select("commit_seq", F.col("n").cast("bigint").alias("n"), "type", row("user_id").alias("user_id"), F.col("new_row")["event_type"].alias("event_type"), F.col("new_row")["value"].cast("double").alias("value"))


@query(_FRAMES + "SELECT 's/' || (xid * 128 + 2) AS key, 'tx ' || xid AS value FROM c WHERE kind <> 'aborted' GROUP BY xid")
def outbox_frames(spark, d):
    """The job `outbox`: messages of transactions that committed."""
    return outbox.outbox(spark, state_frames(spark, d), "tx")


@query(_FRAMES + "SELECT 's/' || (xid * 128 + 90) AS key, 'tx ' || xid AS value FROM c GROUP BY xid")
def outbox_at_once(spark, d):
    """The same job: messages outside transactions, which come behind a header."""
    return outbox.outbox(spark, state_frames(spark, d), "now")


@query(_FRAMES + """, t AS (SELECT DISTINCT xid, kind, commit_lsn, tx_end_lsn FROM c), m AS (SELECT MAX(xid) // 10 AS x FROM log)
 SELECT type, COUNT(*) AS n, SUM(seq) AS seqs, SUM(xid) AS xids, SUM(lsn) AS lsns FROM (
 SELECT 'relation' AS type, -1 AS seq, NULL AS xid, NULL AS lsn UNION ALL SELECT 'begin', xid * 128, xid, commit_lsn FROM t WHERE kind = 'plain' UNION ALL SELECT 'commit', xid * 128 + 65, NULL, commit_lsn FROM t WHERE kind = 'plain'
 UNION ALL SELECT 'stream_start', xid * 128, xid, NULL FROM t WHERE kind <> 'plain' UNION ALL SELECT 'stream_stop', xid * 128 + 65, NULL, NULL FROM t WHERE kind <> 'plain'
 UNION ALL SELECT 'stream_abort', xid * 128 + 66, xid, NULL FROM t WHERE kind = 'partly' UNION ALL SELECT 'stream_abort', xid * 128 + 67, xid, commit_lsn FROM t WHERE kind = 'aborted'
 UNION ALL SELECT 'stream_commit', xid * 128 + 198, xid, commit_lsn + 4097 FROM t WHERE kind IN ('streamed', 'partly')
 UNION ALL SELECT 'begin', xid * 128 + 80, xid + 1073741824, commit_lsn + 2 FROM t JOIN m ON xid = x UNION ALL SELECT 'truncate', xid * 128 + 81, NULL, NULL FROM t JOIN m ON xid = x UNION ALL SELECT 'commit', xid * 128 + 82, NULL, commit_lsn + 2 FROM t JOIN m ON xid = x
 UNION ALL SELECT 'message', xid * 128 + 2, CASE WHEN kind <> 'plain' THEN xid END, commit_lsn FROM t UNION ALL SELECT 'message', xid * 128 + 90, NULL, commit_lsn FROM t
 UNION ALL SELECT op, xid * 128 + (seq % 8) * 8 + 4, CASE WHEN kind = 'plain' THEN NULL WHEN kind = 'partly' AND seq % 4 = 1 THEN xid + 2147483648 ELSE xid END, NULL FROM c) GROUP BY type""")
def decoded_kinds(spark, d):
    """Messages of every kind that the log holds, decoded: how many there are, and sums of their positions, transaction ids and log positions."""
    found = common.messages(spark, state_frames(spark, d))
    total = lambda c: F.sum(c).cast("decimal(38,0)")
    at = F.coalesce("lsn", "commit_lsn", "abort_lsn")
    return found.groupBy("type").agg(F.count("*").alias("n"), total("seq").alias("seqs"), total("xid").alias("xids"), total(at).alias("lsns"))


@query(_FRAMES + "SELECT 's' AS slot, MAX(tx_end_lsn) AS server_lsn, MAX(commit_timestamp) AS server_clock, MAX(tx_end_lsn) - MAX(tx_end_lsn) FILTER (xid % 5 <> 4) AS lag_bytes FROM log")
def keepalive_lag(spark, d):
    """How far what is confirmed is behind the position that keep-alives tell."""
    _, alive = frames.split_frames(state_frames(spark, d))
    done = _commits(spark, d).withColumn("slot", F.lit("s"))
    return progress.behind(alive, done).withColumn("server_clock", F.col("server_clock").cast("timestamp_ntz"))


# ---- the database's own types

#: The log as a table whose columns are of an enum, a domain over a domain over jsonb, a composite with the enum in it, and an array of the enum. A transaction has 16 positions from
#: xid * 16. From the middle of the log on the composite's first field has another name, though the table isn't described again.
_USER = LOG + ", m AS (SELECT MAX(xid) // 2 AS x FROM log) "
_PLACE = """CASE WHEN xid < x THEN '{"n": ' ELSE '{"number": ' END || user_id || ', "kind": "' || event_type || '"}'"""
PROFILE = {"user_id": "int8", "mood": "mood", "doc": "doc", "place": "place", "tags": "_mood"}


def user_type_frames(spark, d, unknown: bool = False) -> tuple[DataFrame, DataFrame]:
    """(frames, catalog). unknown: the table has a column of a type that nobody knows, set in every seventh change."""
    log = stored(derived(spark, d))
    middle = (log.agg(F.max("xid")).first()[0] or 0) // 2 * 16
    x, oid, none = F.col("xid"), F.lit(16931), (F.lit(None).cast("binary"), None)
    user, mood = wire.encode_value(F.col("user_id"), "int8"), wire.encode_value(F.col("event_type"), "text")
    number = lambda n: wire.int_bytes(F.lit(n), 4)
    tags = F.concat(*(number(n) for n in (1, 1, 70001, 2, 1)), wire.int_bytes(F.length(mood), 4), mood, number(-1))
    values = [user, mood, wire.encode_value(F.col("props"), "jsonb"), usertypes.record_bytes([(20, user), (70001, mood)]), tags]
    values += [F.when(F.col("seq") % 7 == 0, F.encode(F.concat(F.lit("Nick "), F.col("user_id")), "UTF-8"))] if unknown else []
    log = log.withColumns({"new": frames.tuple_bytes([(v, None) for v in values]), "old": frames.tuple_bytes([(user, None), *[none] * (len(values) - 1)])})
    new, old = F.col("new"), F.col("old")
    body = F.when(F.col("op") == "insert", frames.insert(oid, new)).when(F.col("op") == "update", frames.update(oid, new)).otherwise(frames.delete(oid, old))
    changed = log.select((x * 16 + F.col("seq") % 8 + 1).alias("seq"), body.alias("payload"))
    tx = log.groupBy("xid", "commit_lsn", "tx_end_lsn").agg(wire.timestamp_to_micros(F.max("commit_timestamp")).alias("micros"))
    ends = F.array(F.struct((x * 16).alias("seq"), frames.begin(F.col("commit_lsn"), F.col("micros"), x).alias("payload")), F.struct((x * 16 + 10).alias("seq"), frames.commit(F.col("commit_lsn"), F.col("tx_end_lsn"), F.col("micros")).alias("payload")))
    oids = {"user_id": 20, "mood": 70001, "doc": 70003, "place": 70004, "tags": 70005} | ({"nick": 70010} if unknown else {})
    said = [frames.type_message(F.lit(o), F.lit("public"), F.lit(n)) for n, o in (("mood", 70001), ("doc", 70003), ("place", 70004))]
    about = [*said, frames.relation(16931, "public", "profile", "d", [(n, o, n == "user_id") for n, o in oids.items()])]
    first = spark.range(1).select(F.posexplode(F.array(*about)).alias("k", "payload")).select((F.col("k") - 9).cast("bigint").alias("seq"), "payload")
    fields = [("kind", 70001)]
    types = [(-10, 70001, "e", 0, 0, "mood", None), (-10, 70002, "d", 3802, 0, "raw", None), (-10, 70003, "d", 70002, 0, "doc", None), (-10, 70004, "c", 0, 0, "place", [("n", 20), *fields]), (middle, 70004, "c", 0, 0, "place", [("number", 20), *fields]), (-10, 70005, "b", 0, 70001, "_mood", None)]
    catalog_ = spark.createDataFrame([(*t[:5], "public", *t[5:]) for t in types], "seq long, type_oid long, kind string, base_oid long, element_oid long, namespace string, name string, fields array<struct<name:string,type_oid:bigint>>")
    whole = changed.union(tx.select(F.explode(ends).alias("f")).select("f.*")).union(first)
    return stored(whole.select(F.lit("s").alias("slot"), "seq", "payload")), catalog_


@query(_USER + f"""SELECT user_id, arg_max_null(event_type, seq) FILTER (op <> 'delete') AS mood, arg_max_null(props, seq) FILTER (op <> 'delete') AS doc, arg_max({_PLACE}, seq) FILTER (op <> 'delete') AS place,
 arg_max(event_type || ',-', seq) FILTER (op <> 'delete') AS tags FROM log, m GROUP BY user_id HAVING arg_max(op, seq) <> 'delete'""")
def replicate_user_types(spark, d):
    landed, types = user_type_frames(spark, d)
    found = replicate.replicate(spark, landed, "public.profile", KEYS, PROFILE, types=types)
    return found.withColumn("tags", F.array_join("tags", ",", "-"))


_DELIVERED = f"""SELECT xid * 16 + 10 AS commit_seq, ROW_NUMBER() OVER (PARTITION BY xid ORDER BY seq) AS n, op AS type, user_id, CASE WHEN op <> 'delete' THEN event_type END AS mood, props AS doc,
 CASE WHEN op <> 'delete' THEN {_PLACE} END AS place, CASE WHEN op <> 'delete' THEN '["' || event_type || '", null]' END AS tags, seq FROM log, m"""


def _profile(found: DataFrame) -> DataFrame:
    row = F.coalesce("new_row", "old_row")
    return found.select("commit_seq", F.col("n").cast("bigint").alias("n"), "type", row["user_id"].cast("bigint").alias("user_id"), *(row[c].alias(c) for c in ("mood", "doc", "place", "tags")))


@query(_USER + "SELECT * EXCLUDE (seq) FROM (" + _DELIVERED + ")")
def deliver_user_types(spark, d):
    landed, types = user_type_frames(spark, d)
    return _profile(deliver.deliver(spark, landed, types=types))


@query(_USER + "SELECT * EXCLUDE (seq) FROM (" + _DELIVERED + ") WHERE type = 'delete' OR seq % 7 <> 0")
def deliver_known(spark, d):
    """Changes whose every value can be read, with their numbers among all changes of their transaction."""
    landed, types = user_type_frames(spark, d, unknown=True)
    return _profile(deliver.split(spark, landed, types=types)[0])


@query(_USER + """SELECT 's' AS slot, xid * 16 + seq % 8 + 1 AS seq, xid * 16 + 10 AS commit_seq, 'profile' AS name, 'new' AS row, 'nick' AS "column", 70010 AS oid, 'Nick ' || user_id AS data FROM log WHERE op <> 'delete' AND seq % 7 = 0""")
def deliver_set_aside(spark, d):
    """The values that can't be read, with the ids of their types and their bytes."""
    landed, types = user_type_frames(spark, d, unknown=True)
    aside = deliver.split(spark, landed, types=types)[1]
    return aside.select("slot", "seq", "commit_seq", "name", "row", "column", "oid", F.decode("data", "UTF-8").alias("data"))


_MOVES = ", k AS (SELECT *, COUNT(*) FILTER (op = 'update' AND seq % 5 = 0) OVER (PARTITION BY user_id ORDER BY seq) AS moves FROM log) "


@query(LOG + _MOVES + _STATE.format("k").replace("SELECT user_id,", "SELECT user_id + 1000000 * MAX(moves) AS user_id,"))
def moved_large_values(spark, d):
    """Every fifth update moves its row to a new key, so that rows move again and again, and large values aren't sent along: they follow their rows."""
    before = Window.partitionBy("user_id").orderBy("seq")
    moved = (F.col("op") == "update") & (F.col("seq") % 5 == 0)
    log = derived(spark, d).withColumn("moves", F.count(F.when(moved, 1)).over(before))
    at = lambda n: F.col("user_id") + 1000000 * n
    log = log.select("seq", "op", F.when(moved, at(F.col("moves") - 1)).alias("old_user_id"), at(F.col("moves")).alias("user_id"), *VALUES, "props_toasted")
    order, marked = ["seq", "part"], {"props": "props_toasted"}
    parts = apply.moved_keys(log, "user_id", "old_user_id", VALUES)
    return apply.latest_state(apply.with_moved_values(parts, KEYS, ["old_user_id"], order, marked, rows=512), KEYS, VALUES, order, marked)


@query("SELECT event_id AS seq, event_type AS origin, event_id * 16 AS lsn FROM events")
def decoded_origins(spark, d):
    """Messages that name where a transaction comes from."""
    log = read(spark, d, "events").select(F.lit("s").alias("slot"), F.col("event_id").alias("seq"), frames.origin(F.col("event_id") * 16, F.col("event_type")).alias("payload"))
    return frames.messages(log).where("type = 'origin'").select("seq", F.col("name").alias("origin"), F.col("commit_lsn").alias("lsn"))


@query("SELECT event_id AS seq, 100000 + user_id AS oid, 'public' AS namespace, event_type AS name FROM events")
def decoded_types(spark, d):
    """Messages that name a user's type."""
    log = read(spark, d, "events").select(F.lit("s").alias("slot"), F.col("event_id").alias("seq"), frames.type_message(100000 + F.col("user_id"), F.lit("public"), F.col("event_type")).alias("payload"))
    return frames.messages(log).where("type = 'type'").select("seq", F.col("rel_oid").alias("oid"), "namespace", "name")


@query("SELECT event_id AS seq, 'v' || (event_id // 3) AS columns FROM events")
def relation_many_versions(spark, d):
    """A table that is described anew before every third change, and again in between with nothing new: each change has its own version."""
    e = read(spark, d, "events").select(F.col("event_id").alias("seq"), F.lit(16931).cast("bigint").alias("rel_oid"), F.concat(F.lit("v"), F.floor(F.col("event_id") / 3)).alias("columns"))
    return progress.as_of(e.select("seq", "rel_oid"), e.where("seq % 3 <> 2").select("rel_oid", "seq", "columns"), ["rel_oid"]).select("seq", "columns")


# ---- consumers


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def message_json(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query(LOG + """SELECT seq, CASE op WHEN 'insert' THEN 'INSERT INTO public.user_state (user_id, event_type) VALUES (' || user_id || ', ' || COALESCE('''' || replace(event_type, '''', '''''') || '''', 'NULL') || ')'
 WHEN 'update' THEN 'UPDATE public.user_state SET event_type = ' || COALESCE('''' || replace(event_type, '''', '''''') || '''', 'NULL') || ' WHERE user_id = ' || user_id
 ELSE 'DELETE FROM public.user_state WHERE user_id = ' || user_id END AS statement FROM log""")
def sql_statements(spark, d):
    literal = {"user_id": F.col("user_id").cast("string"), "event_type": apply.quoted(F.col("event_type"))}
    return derived(spark, d).select("seq", apply.statements(derived(spark, d), "public.user_state", KEYS, ["event_type"], literal).alias("statement"))


@query(LOG + """, s AS (SELECT xid, seq, ROW_NUMBER() OVER (PARTITION BY xid ORDER BY seq) AS n, CASE WHEN seq % 50 = 0 THEN 'TRUNCATE TABLE public.user_state, audit.log RESTART IDENTITY' WHEN op = 'insert' THEN 'INSERT INTO public.user_state (user_id) VALUES (' || user_id || ')'
 WHEN op = 'update' THEN 'UPDATE public.user_state SET user_id = ' || user_id || ' WHERE user_id = ' || user_id ELSE 'DELETE FROM public.user_state WHERE user_id = ' || user_id END AS t FROM log)
 SELECT xid, CAST((n - 1) // 3 AS BIGINT) AS part, COUNT(*) AS n_statements, string_agg(t || ';', chr(10) ORDER BY n) AS batch FROM s GROUP BY xid, (n - 1) // 3""")
def statement_batches(spark, d):
    """Statements of each transaction, truncates among them, in batches of three at most."""
    log = transactions.positions(derived(spark, d).select("xid", "seq", "op", "user_id"), ["xid"], "seq")
    user = F.col("user_id").cast("string")
    plain = apply.statements(log, "public.user_state", KEYS, [], {"user_id": user})
    update = F.concat(F.lit("UPDATE public.user_state SET user_id = "), user, F.lit(" WHERE user_id = "), user)
    cut = apply.truncate_statement(F.array(F.lit("public.user_state"), F.lit("audit.log")), F.lit(False), F.lit(True))
    said = F.when(F.col("seq") % 50 == 0, cut).when(F.col("op") == "update", update).otherwise(plain)
    return apply.statement_batches(log.withColumn("statement", said), ["xid"], most=3)


@query(LOG + "SELECT DISTINCT user_id FROM log")
def changed_keys(spark, d):
    return changes.changed_keys(derived(spark, d), KEYS)


@query(LOG + """SELECT '{"user_id":' || user_id || '}' AS key, '{"seq":' || seq || ',"op":"' || op || '"}' AS value FROM log""")
def outbox_json(spark, d):
    return changes.as_json(derived(spark, d), ["user_id"], ["seq", "op"])


@query("SELECT o_orderkey, o_orderstatus, 'left' AS side FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT o_orderkey, 'Z', 'right' FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT o_orderkey, o_orderstatus, 'left' FROM orders WHERE o_orderkey % 77 = 1 AND o_orderkey % 50 <> 0")
def replica_diff(spark, d):
    source = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    replica_rows = source.where("NOT (o_orderkey % 77 = 1 AND o_orderkey % 50 <> 0)").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 50 == 0, "Z").otherwise(F.col("o_orderstatus")))
    return verify.differences(source, replica_rows)


@query("SELECT o_orderkey, o_orderstatus, 'left' AS side FROM orders WHERE o_orderkey % 1000 = 1 UNION ALL SELECT o_orderkey, 'Z', 'right' FROM orders WHERE o_orderkey % 1000 = 1")
def replica_tree_diff(spark, d):
    """A table and its replica, each kept with its tree of digests: the comparison reads the digests and the rows of leaves that differ."""
    source = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    copy = source.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 1000 == 1, "Z").otherwise(F.col("o_orderstatus")))
    one = verify.Tree.build(source, replica.folder(spark))
    return one.differences(verify.Tree.build(copy, replica.folder(spark), one.depth), spark)


@query("SELECT 'orders' AS side, NOT EXISTS (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer) AS subset UNION ALL SELECT 'customer', NOT EXISTS (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)")
def subset_check(spark, d):
    """Whether each side's customers are among the other's: customers without orders make the second one false."""
    ordered, known = read(spark, d, "orders").select(F.col("o_custkey").alias("key")), read(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    one, other = verify.is_subset(ordered, known), verify.is_subset(known, ordered)
    return one.select(F.lit("orders").alias("side"), "subset").union(other.select(F.lit("customer"), "subset"))


@query("SELECT 'orders' AS source, o_orderkey AS id, o_orderstatus AS status, CAST(NULL AS BIGINT) AS nation FROM orders UNION ALL SELECT 'customer', c_custkey, NULL, c_nationkey FROM customer")
def union_sources(spark, d):
    a = read(spark, d, "orders").select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    b = read(spark, d, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("nation"))
    return verify.together(a, b)


@query("SELECT c_custkey, unnest(generate_series(1, 3)) AS n FROM customer")
def series(spark, d):
    return read(spark, d, "customer").select("c_custkey", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(3).cast("bigint"))).alias("n"))


@query(LOG + "SELECT upper(op) AS command, CAST(COUNT(*) AS BIGINT) AS n_rows FROM log GROUP BY op")
def command_tags(spark, d):
    tag = F.when(F.col("op") == "insert", "INSERT 0 1").otherwise(F.concat(F.upper("op"), F.lit(" 1")))
    return catalog.rows_by_command(derived(spark, d).select(tag.alias("tag")))


_STATES = [("23505", "unique-violation"), ("40001", "serialization-failure"), ("57014", "query-canceled")]


@query("SELECT event_id, error_code, COALESCE(condition, 'unknown') AS condition FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '23505' WHEN 1 THEN '40001' WHEN 2 THEN '57014' ELSE 'ZZZZZ' END AS error_code FROM events WHERE event_type = 'error') LEFT JOIN (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _STATES) + ") s(error_code, condition) USING (error_code)")
def sqlstate_names(spark, d):
    code = F.element_at(F.array(*(F.lit(c) for c in ("23505", "40001", "57014", "ZZZZZ"))), (F.col("event_id") % 4 + 1).cast("int"))
    errors = read(spark, d, "events").where("event_type = 'error'").select("event_id", code.alias("error_code"))
    return catalog.named_states(errors, spark.createDataFrame(_STATES, "error_code string, condition string")).select("event_id", "error_code", "condition")


@query("SELECT event_id, 'ERROR' AS severity, '23505' AS error_code, event_type AS message, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 100 AS INTEGER) END AS position, CAST(user_id % 1000 AS INTEGER) AS line FROM events WHERE event_type = 'error'")
def error_fields(spark, d):
    """The fields of errors by name; places and lines are numbers."""
    e = read(spark, d, "events").where("event_type = 'error'")
    pair = lambda code, value: F.struct(F.lit(code).alias("code"), value.cast("string").alias("value"))
    parts = [pair("V", F.lit("ERROR")), pair("C", F.lit("23505")), pair("M", F.col("event_type")), F.when(F.col("event_id") % 3 != 0, pair("P", F.col("event_id") % 100)), pair("L", F.col("user_id") % 1000)]
    sent = F.map_from_entries(F.array_compact(F.array(*parts)))
    return e.select("event_id", *catalog.error_fields(sent)).select("event_id", "severity", "error_code", "message", "position", "line")


# ---- queries that users send through the client


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def lookup_join(spark, d):
    return read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("SELECT o_orderkey, l_linenumber, c_name FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_quantity > 45")
def three_way_join(spark, d):
    lines = read(spark, d, "lineitem").where("l_quantity > 45")
    return read(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "l_linenumber", "c_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT (o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40))")
def in_subquery_delete(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    gone = orders.join(read(spark, d, "customer").where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").join(read(spark, d, "lineitem").where("l_quantity > 40"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return orders.join(gone.select("o_orderkey"), "o_orderkey", "left_anti")


@query("SELECT p_partkey, p_name AS name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_name ASC, p_partkey LIMIT 10")
def top_k(spark, d):
    return read(spark, d, "part").orderBy(F.desc("p_retailprice"), F.asc("p_name"), "p_partkey").limit(10).select("p_partkey", F.trim("p_name").alias("name"), "p_retailprice")


@query("SELECT p_partkey, upper(left(p_name, 1)) || lower(substr(p_name, 2)) AS title FROM (SELECT p_partkey, regexp_replace(trim(p_name), ' ', '-', 'g') AS p_name FROM part)")
def titles(spark, d):
    """A text function of reports: words with a capital letter, here of names whose words are joined to one."""
    return read(spark, d, "part").select("p_partkey", F.initcap(F.regexp_replace(F.trim("p_name"), " ", "-")).alias("title"))


@query("""SELECT event_id || ',' || CASE WHEN event_id % 7 = 0 THEN '' ELSE user_id::VARCHAR END || ',' || event_type || ',' || CASE WHEN contains(props, '"') OR contains(props, ',') THEN '"' || replace(props, '"', '""') || '"' WHEN props = '' THEN '""' ELSE COALESCE(props, '') END AS value FROM events""")
def csv_lines(spark, d):
    e = read(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"), "event_type", "props")
    return e.select(rows.delimited(["event_id", "user_id", "event_type", "props"]).alias("value"))


@query("SELECT s_suppkey, r_name AS namespace, n_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')")
def catalog_lookup(spark, d):
    named = read(spark, d, "nation").join(F.broadcast(read(spark, d, "region").where(F.col("r_name").isin("ASIA", "EUROPE"))), F.col("n_regionkey") == F.col("r_regionkey"))  # a catalog of fixed size
    return read(spark, d, "supplier").join(F.broadcast(named), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("r_name").alias("namespace"), F.col("n_name").alias("name"))


@query("SELECT COUNT(1) AS n FROM orders WHERE o_orderstatus = 'F'")
def count_where(spark, d):
    return read(spark, d, "orders").where("o_orderstatus = 'F'").agg(F.count("*").alias("n"))


# ---- streams


@query(LOG + _STATE.format("log"))
def stream_replica(spark, d):
    """The same table as latest_state, kept by a stream over the log in several batches."""
    table = replica.Replica(replica.folder(spark), KEYS, VALUES, {"props": "props_toasted"}, buckets=8)
    return replica.run_to_end(spark, derived(spark, d), table, "commit_lsn")


@query(_FRAMES + ", s AS (SELECT k.* EXCLUDE (seq), commit_seq * 256 + (seq % 8) AS seq FROM k, cut WHERE commit_seq > cut.pos + 82) " + _STATE.format("s"))
def stream_frames(spark, d):
    """The same table as replicate_frames, from frames that arrive in pieces: a piece ends inside transactions, and the tables' description comes in the first only."""
    table = replica.FrameReplica(replica.folder(spark), "public.user_state", KEYS, TABLE, buckets=8)
    return replica.run_to_end(spark, state_frames(spark, d), table, "seq", replica.Decoder(replica.folder(spark), table))


@query(LOG + _STREAMED + "SELECT slot, seq, xid, op, user_id, subxid FROM s, (VALUES ('a', 3), ('b', 5)) v(slot, gone) WHERE xid % 8 NOT IN (gone, 7) AND (slot = 'b' OR " + _KEPT + ")")
def stream_committed(spark, d):
    """Streamed changes held in state until each transaction's outcome arrives, of two slots with the same transaction ids: in the second other transactions abort, and no subtransactions."""
    log, _, aborts = _streamed(spark, d)
    last = F.lit(1 << 50).cast("bigint")
    ids = log.select("xid").distinct()
    slots = []
    for slot, gone in (("a", 3), ("b", 5)):
        ended = aborts if slot == "a" else ids.where("xid % 8 = 5").select("xid", F.col("xid").alias("subxid"))
        slots += [
            log.withColumn("kind", F.lit("change")).withColumn("slot", F.lit(slot)),
            ids.where(f"xid % 8 NOT IN ({gone}, 7)").select(last.alias("seq"), "xid", F.lit("commit").alias("kind"), F.lit(slot).alias("slot")),
            ended.select((last - 1).alias("seq"), "xid", "subxid", F.lit("abort").alias("kind"), F.lit(slot).alias("slot")),
        ]
    return replica.committed_to_end(spark, verify.together(*slots))


@query(LOG + "SELECT seq, op, user_id, ROW_NUMBER() OVER (PARTITION BY seq // 5000 ORDER BY seq) AS n FROM log")
def numbered_long(spark, d):
    """The number of each change in transactions of 5000 places, which are cut into steps of 64, so that no task numbers a whole one."""
    log = derived(spark, d).select("seq", "op", "user_id", (F.floor(F.col("seq") / 5000) * 5000 + 5000).alias("end"))
    return transactions.numbered(log, ["end"], "end", "seq", rows=64).select("seq", "op", "user_id", "n")


@query(LOG + "SELECT xid, commit_lsn, op, user_id, CAST(ROW_NUMBER() OVER (PARTITION BY xid ORDER BY seq) AS INTEGER) AS n FROM log")
def stream_unique(spark, d):
    """A stream in which every tenth transaction comes twice, each change once."""
    log = transactions.positions(derived(spark, d).select("xid", "commit_lsn", "commit_timestamp", "seq", "op", "user_id"), ["xid"], "seq")
    log = log.withColumn("commit_timestamp", F.col("commit_timestamp").cast("timestamp"))
    again = log.where("xid % 10 = 0").withColumn("seq", F.col("seq") + 20)
    return replica.unique_to_end(spark, log.union(again), ["commit_lsn", "n"], "commit_timestamp", "3650 days", "seq").select("xid", "commit_lsn", "op", "user_id", "n")
