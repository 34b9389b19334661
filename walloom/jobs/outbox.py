"""spark-submit outbox.py FRAMES PREFIX OUT: logical messages of committed transactions as key and value for a broker."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walloom.jobs import common
from walloom.operators import changes


def outbox(spark, path: str | DataFrame, prefix: str) -> DataFrame:
    """Transactional messages count when their transaction has committed; others at once."""
    found = common.messages(spark, path, unused=("relation", "type", "origin", "insert", "update", "delete", "truncate"))
    wanted = changes.logical_messages(found, prefix)
    at_once = wanted.where("NOT transactional").select("slot", "seq", "content")
    held = common.committed(found).where((F.col("type") == "message") & (F.col("prefix") == prefix) & F.col("transactional")).select("slot", "seq", "content")
    both = at_once.union(held)
    return both.select(F.concat_ws("/", "slot", "seq").alias("key"), F.decode("content", "UTF-8").alias("value"))


def main(frames: str, prefix: str, out: str) -> None:
    outbox(common.session("outbox"), frames, prefix).write.mode("overwrite").parquet(out)


if __name__ == "__main__":
    main(*sys.argv[1:])
