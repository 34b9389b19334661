"""Whether two tables hold the same rows, by a tree of digests."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stored

#: Binary digits of a row's hash by which a branch parts into the next level's, and rows of a leaf, about.
FAN, LEAF = 4, 256


def leaf_of(columns: list[str], depth: int) -> Column:
    """The leaf of a row: the first digits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - FAN * depth)


def depth_of(rows: int, leaf: int = LEAF) -> int:
    """Levels such that a leaf holds about `leaf` rows, however many rows there are; 15 at most, which is more leaves than there will be rows."""
    depth = 1
    while depth < 15 and leaf << (FAN * depth) < rows:
        depth += 1
    return depth


def leaves(rows: DataFrame, depth: int) -> DataFrame:
    """(leaf, n, h): the number of rows of each leaf and two sums over hashes of different seeds. One aggregate with map-side combine."""
    h = [F.xxhash64(*rows.columns), F.xxhash64(F.lit(1), *rows.columns)]
    each = rows.select(leaf_of(rows.columns, depth).alias("leaf"), h[0].alias("a"), h[1].alias("b"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    return each.groupBy("leaf").agg(F.count("*").alias("n"), total("a"), total("b"))


def differing_leaves(a: DataFrame, b: DataFrame, depth: int) -> DataFrame:
    """Leaves whose digests differ, found from the root down: at each level only branches under those that differed above are summed and compared."""
    parents = None
    for level in range(1, depth + 1):
        up = lambda t, level=level: t.withColumn("branch", F.shiftrightunsigned("leaf", FAN * (depth - level)))
        sides = [up(t) for t in (a, b)]
        if parents is not None:
            above = parents.withColumnRenamed("branch", "above")
            sides = [t.join(broadcast_if_small(above), F.shiftrightunsigned("branch", FAN) == F.col("above"), "left_semi") for t in sides]
        sums = [t.groupBy("branch").agg(*(F.sum(c).alias(c) for c in ("n", "a", "b"))) for t in sides]
        both = sums[0].alias("x").join(sums[1].alias("y"), "branch", "full")
        same = reduce(lambda p, q: p & q, (F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("n", "a", "b")))
        parents = stored(both.where(~same).select("branch"))
        if parents.isEmpty():
            break
    return parents.withColumnRenamed("branch", "leaf")


def _signed(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one side only, as bags: one sum of signs over both."""
    both = left.select(*columns, F.lit(1).alias("__sign")).union(right.select(*columns, F.lit(-1)))
    net = both.groupBy(*columns).agg(F.sum("__sign").alias("__n")).where("__n <> 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("__n")))
    return net.select(*columns, F.when(F.col("__n") > 0, "left").otherwise("right").alias("side"), copies.alias("__copy")).drop("__copy")


def differences(left: DataFrame, right: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Rows of one side only, as bags, with `side`. Nulls are equal to each other.

    Each side is digested in one pass to leaves of about `leaf` rows; only rows of leaves that differ are compared with each other, so that
    a few differences cost a few leaves, whatever the tables' size. A replica that is checked again and again is better kept as a `Tree`.
    """
    columns = left.columns
    right = right.select(*columns)
    depth = depth_of(max(left.count(), right.count()), leaf)
    differing = differing_leaves(stored(leaves(left, depth)), stored(leaves(right, depth)), depth)
    near = broadcast_if_small(differing)
    x, y = (t.withColumn("leaf", leaf_of(columns, depth)).join(near, "leaf", "left_semi") for t in (left, right))
    return _signed(x, y, columns)


@dataclass(frozen=True)
class Tree:
    """A table kept in the order of its rows' hashes, with its digests: what a comparison reads of it are the digests and the row groups of leaves that differ."""

    path: str
    columns: tuple[str, ...]
    depth: int

    @classmethod
    def build(cls, rows: DataFrame, path: str, depth: int | None = None, leaf: int = LEAF) -> Tree:
        depth = depth or depth_of(rows.count(), leaf)
        placed = rows.withColumn("leaf", leaf_of(rows.columns, depth))
        placed.repartitionByRange("leaf").sortWithinPartitions("leaf").write.option("parquet.block.size", 1 << 20).parquet(f"{path}/rows")
        leaves(rows, depth).write.parquet(f"{path}/leaves")
        return cls(path, tuple(rows.columns), depth)

    def of(self, spark: SparkSession, near: list[tuple[int, int]]) -> DataFrame:
        """Rows whose leaf is in one of some ranges, which are pushed to the scan."""
        rows = spark.read.parquet(f"{self.path}/rows")
        return rows.where(reduce(lambda p, q: p | q, (F.col("leaf").between(a, b) for a, b in near), F.lit(False)))

    def differences(self, other: Tree, spark: SparkSession, ranges: int = 256) -> DataFrame:
        """Rows of one side only. Both trees have the same columns and depth. For the scan, leaves that differ are put into about
        `ranges` ranges, one for each equal share of all leaves; the rows found are then held against the leaves themselves."""
        if (self.columns, self.depth) != (other.columns, other.depth):
            raise ValueError("trees of different columns or depths")
        a, b = (spark.read.parquet(f"{t.path}/leaves") for t in (self, other))
        differing = differing_leaves(a, b, self.depth)
        parts = differing.select("leaf", F.floor(F.col("leaf") / max(1, (1 << (FAN * self.depth)) // ranges)).alias("part"))
        near = [(r["a"], r["b"]) for r in parts.groupBy("part").agg(F.min("leaf").alias("a"), F.max("leaf").alias("b")).collect()]  # at most `ranges`, rounded up
        x, y = (t.of(spark, near).join(broadcast_if_small(differing), "leaf", "left_semi") for t in (self, other))
        return _signed(x, y, list(self.columns))


def is_subset(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select(*right.columns).subtract(right).agg((F.count("*") == 0).alias("subset"))


def together(*sources: DataFrame) -> DataFrame:
    """Several logs as one; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
