"""A change log derived from the events table, by SQL that reads the same in Spark and elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Each user is a row of a table user_state; an event inserts, updates or deletes it. Eight events make a transaction.
CHANGES = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(FLOOR(event_id / 8.0) AS BIGINT) AS xid,
         LAG(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_type
  FROM events
), c AS (
  SELECT *, CASE
      WHEN prev_type IS NULL OR prev_type = 'error'
        THEN CASE WHEN event_type = 'error' THEN NULL ELSE 'insert' END
      WHEN event_type = 'error' THEN 'delete'
      ELSE 'update' END AS op
  FROM e
)
SELECT event_id AS seq, xid,
       (xid + 1) * 4096 AS commit_lsn,
       (xid + 1) * 4096 + 48 AS tx_end_lsn,
       MAX(ts) OVER (PARTITION BY xid) AS commit_timestamp,
       op, user_id,
       CASE WHEN op = 'delete' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN op = 'delete' OR event_id % 10 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN op = 'delete' OR (op = 'update' AND event_type = 'view') THEN NULL ELSE props END AS props,
       (op = 'update' AND event_type = 'view') AS props_toasted
FROM c WHERE op IS NOT NULL
"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CHANGES.replace("FROM events", "FROM {events}"), events=read(spark, sf_dir, "events"))
