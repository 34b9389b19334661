"""Session helpers."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "walloom.zip")
    Path(path).write_bytes(held.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Where that is unset, a temporary one of a session that is one process, as in tests; on a cluster,
    whose machines don't share such folders, that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the checkpoint folder, so that they are made once and later reads take only the columns they use."""
    path = f"{checkpoint_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 32 << 20) -> bool:
    """Whether a stored table's rows are measured to take at most so many bytes as JSON."""
    size = df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()[0] if df.columns else 0
    return (size or 0) <= most


def broadcast_if_small(df: DataFrame, most: int = 32 << 20) -> DataFrame:
    """A stored table, broadcast where it is small; else Spark shuffles both sides of the join."""
    return F.broadcast(df) if small(df, most) else df
