"""Exact top-k search over whole-number vectors, pruned by segment statistics at several resolutions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, stored

SAFE = float(1 << 52)
NONE = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max
BATCH = 1 << 16
#: Vectors, those of the least hash, that give each query its first floor; the first of them, one for CELL_ROWS vectors, are the cells' centres.
SAMPLE, CELL_ROWS = 2048, 4096
#: Bytes of one side of a task's work.
TILE = 32 << 20
#: A level that dismisses a smaller share of the pairs of a block is left out in the blocks after it.
WORTH = 0.02


def levels_of(width: int) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 4, 16 and so on, and last segments of two components each."""
    coarse = [4**k for k in range(20) if 4**k * 2 < width]
    return [*coarse, max(1, width // 2)]


def _whole(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    v = F.col("v")
    fit = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(fit_of(fit))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v array<double>): floor(scale * x) of every component; vectors that are null or empty or hold null or
    non-finite components are left out, and of rows that repeat an id the least vector stays."""
    return _whole(vectors, id_col, vector_col, scale).where("vec_id is not null").groupBy("vec_id").agg(F.min("v").alias("v"))


def whole_rows(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(row, vec_id, v): the same of every row, also of those that repeat an id or have none, under numbers in the order of their ids (nulls last, then by vector)."""
    ordered = _whole(vectors, id_col, vector_col, scale).orderBy(F.col("vec_id").asc_nulls_last(), "v")
    return stored(ordered.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"))


def fit_of(column):
    return F.coalesce(column, F.lit(False))


def _statistics(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row and segment: mean times the root of the segment's width, and the norm of the deviations."""
    edges = np.linspace(0, x.shape[1], parts + 1).astype(int)
    mean = np.empty((len(x), parts))
    dev = np.empty((len(x), parts))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = x[:, a:b]
        m = part.mean(axis=1)
        mean[:, k] = m * np.sqrt(b - a)
        dev[:, k] = np.sqrt(np.maximum(((part - m[:, None]) ** 2).sum(axis=1), 0))
    return mean, dev


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row-wise inner products; Python's whole numbers where doubles can't hold them."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if bound < SAFE:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for r, s in zip(q, x, strict=True)]
    return np.array(np.clip(np.array(whole, dtype=object), -(2**63), 2**63 - 1), dtype=np.int64)


def _best(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray | None = None, block: int = 2048):
    """The k best of x for each query, coarse to fine, and the pairs that were left after each level (the first number is that of all pairs).

    With segment means mu and deviations d, |q - x|^2 >= sum w (mu_q - mu_x)^2 + (|d_q| - |d_x|)^2; in terms of the
    inner product, which is what is ranked, <q, x> <= sum w mu_q mu_x + |d_q| |d_x|. The floor of a query is its k-th
    best exact score so far, or what it brings along; candidates whose bound is under the floor at a coarse level never reach a finer one.
    """
    levels = levels_of(q.shape[1])
    of_q = [_statistics(q, p) for p in levels]
    n = len(q)
    best_s, best_i = np.full((n, k), NONE), np.full((n, k), LAST)
    size = np.sqrt((q**2).sum(axis=1))
    left, use = np.zeros(len(levels) + 1, np.int64), [True] * len(levels)
    order = np.argsort(-(x**2).sum(axis=1), kind="stable")
    whole = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < SAFE
    first = min(len(x), 16 * k)
    for at, end in [(0, first), *((a, a + block) for a in range(first, len(x), block))]:
        rows = order[at:end]
        part, ids = x[rows], x_ids[rows]
        slack = 1e-9 * (1 + size[:, None] * np.sqrt((part**2).sum(axis=1))[None, :])
        least = np.where(best_s[:, -1] == NONE, -np.inf, best_s[:, -1])
        least = least if floor is None else np.maximum(least, floor)
        left[0] += n * len(part)
        qi = xi = None
        for level, parts in enumerate(levels):
            if use[level]:
                (qm, qd), (xm, xd) = of_q[level], _statistics(part, parts)
                had = n * len(part) if qi is None else len(qi)
                if had * 4 > n * len(part):
                    live = ~(qm @ xm.T + qd @ xd.T + slack < least[:, None])  # what overflows is kept
                    keep = live if qi is None else live[qi, xi]
                else:
                    keep = ~((qm[qi] * xm[xi]).sum(axis=1) + (qd[qi] * xd[xi]).sum(axis=1) + slack[qi, xi] < least[qi])
                qi, xi = np.nonzero(keep) if qi is None else (qi[keep], xi[keep])
                use[level] = had == 0 or level == len(levels) - 1 or len(qi) <= (1 - WORTH) * had
            left[level + 1] += n * len(part) if qi is None else len(qi)
        keep = q_ids[qi] != ids[xi]
        qi, xi = qi[keep], xi[keep]
        if len(qi) * 8 > n * len(part) and whole:
            score = (q @ part.T)[qi, xi].astype(np.int64)
        else:
            score = np.concatenate([np.zeros(0, np.int64), *(_exact(q[qi[a : a + BATCH]], part[xi[a : a + BATCH]]) for a in range(0, len(qi), BATCH))])
        good = score >= best_s[qi, -1]
        qi, xi, score = qi[good], xi[good], score[good]
        if not len(qi):
            continue
        who = np.unique(qi)
        every_q = np.concatenate([qi, np.repeat(who, k)])
        every_s, every_i = np.concatenate([score, best_s[who].ravel()]), np.concatenate([ids[xi], best_i[who].ravel()])
        by = np.lexsort((every_i, ~every_s, every_q))
        every_q = every_q[by]
        top = by[np.arange(len(by)) - np.searchsorted(every_q, every_q, side="left") < k]
        best_s[who], best_i[who] = every_s[top].reshape(-1, k), every_i[top].reshape(-1, k)
    return best_s, best_i, left


def _by_width(ids: pa.Array, lists: pa.Array):
    """Rows of a batch with vectors of one length: (places, ids, vectors)."""
    width = np.diff(lists.offsets.to_numpy())
    flat, all_ids = lists.flatten().to_numpy(), ids.to_numpy()
    begin = np.cumsum(width) - width
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        yield own, all_ids[own], flat[begin[own][:, None] + np.arange(w)]


@dataclass(frozen=True)
class Cells:
    """For each length of vectors a sample (ids, vectors), of which the first `count` are centres; after `bounded`, boxes of the cells' statistics too."""

    sample: dict[int, tuple[np.ndarray, np.ndarray]]
    count: int
    boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    def cell(self, x: np.ndarray) -> np.ndarray:
        """The nearest centre; 0 where there is none."""
        _, centres = self.sample.get(x.shape[1], (None, np.zeros((1, x.shape[1]))))
        centres = centres[: self.count]
        return (x @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1).astype(np.int32)

    def floors(self, ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """The k-th best score of each query in the sample."""
        own, x = self.sample.get(q.shape[1], (np.zeros(0, np.int64), np.zeros((0, q.shape[1]))))
        score = np.where(ids[:, None] == own[None, :], -np.inf, q @ x.T)
        if score.shape[1] < k:
            return np.full(len(q), -np.inf)
        best = np.partition(score, -k, axis=1)[:, -k]
        return best - 1e-9 * (1 + np.abs(best))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The most that a query's score can be in each cell, by the boxes of the finest level's means and deviations."""
        low, high, dev = self.boxes[q.shape[1]]
        mean, own = _statistics(q, levels_of(q.shape[1])[-1])
        up, down = np.maximum(mean, 0), np.minimum(mean, 0)
        most = up @ high.T + down @ low.T + own @ dev.T
        return most + 1e-9 * (1 + np.abs(most))


def cells_of(vectors: DataFrame) -> Cells:
    """A sample of at most SAMPLE vectors, and the boxes of the cells around its first ones; a cell is a vector's nearest centre."""
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    sample = {}
    for batch in drawn.combine_chunks().to_batches() if drawn.num_rows else ():
        sample = {x.shape[1]: (ids, x) for _, ids, x in _by_width(batch.column(0), batch.column(1))}
    count = max(1, min(SAMPLE // 2, vectors.count() // CELL_ROWS))
    cells = Cells(sample, count, {})
    boxes: dict = {}
    for width, cell, low, high, dev in vectors.mapInArrow(_boxed(cells), "width int, cell int, low array<double>, high array<double>, dev array<double>").groupBy("width", "cell").applyInArrow(_united, "width int, cell int, low array<double>, high array<double>, dev array<double>").collect():  # a row a cell
        own = boxes.setdefault(width, tuple(np.zeros((len(sample[width][0][:count]), len(low))) for _ in range(3)))
        for box, side in zip(own, (low, high, dev), strict=True):
            box[cell] = side
    return Cells(sample, count, boxes)


def _boxed(cells: Cells):
    """A task's vectors -> the boxes of their cells, for the lengths that the sample has."""

    def run(batches):
        found: dict = {}
        for batch in batches:
            for _, _, x in _by_width(batch.column(0), batch.column(1)) if batch.num_rows else ():
                if x.shape[1] in cells.sample:
                    mean, dev = _statistics(x, levels_of(x.shape[1])[-1])
                    of = cells.cell(x)
                    for c in np.unique(of):
                        own = of == c
                        low, high, most = found.get((x.shape[1], c), (np.inf, -np.inf, 0.0))
                        found[x.shape[1], c] = np.minimum(low, mean[own].min(axis=0)), np.maximum(high, mean[own].max(axis=0)), np.maximum(most, dev[own].max(axis=0))
        if found:
            keys, sides = zip(*found.items(), strict=True)
            columns = [pa.array([s[k].tolist() for s in sides], pa.list_(pa.float64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in keys], pa.int32()), pa.array([int(c) for _, c in keys], pa.int32()), *columns], ["width", "cell", "low", "high", "dev"])

    return run


def _united(table: pa.Table) -> pa.Table:
    rows = lambda c: np.array(table[c].to_pylist())  # noqa: E731  a row a task
    sides = [rows("low").min(axis=0), rows("high").max(axis=0), rows("dev").max(axis=0)]
    return pa.table([table["width"][:1], table["cell"][:1], *(pa.array([s.tolist()], pa.list_(pa.float64())) for s in sides)], names=table.column_names)


def _celled(cells: Cells):
    def run(batches):
        for batch in batches:
            for own, _, x in _by_width(batch.column(0), batch.column(1)) if batch.num_rows else ():
                rows = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(own), x.shape[1]), pa.int32()), pa.array(cells.cell(x))], ["vec_id", "v", "width", "cell"])

    return run


def _routed(cells: Cells, k: int):
    """Queries -> a row for each cell that can hold one of their k best, with the floor; a length that the sample lacks has one cell."""

    def run(batches):
        for batch in batches:
            for own, ids, q in _by_width(batch.column(0), batch.column(1)) if batch.num_rows else ():
                for a in range(0, len(own), BATCH // 8):
                    part = q[a : a + BATCH // 8]
                    floor = cells.floors(ids[a : a + BATCH // 8], part, k)
                    which, cell = np.nonzero(~(cells.bounds(part) < floor[:, None])) if part.shape[1] in cells.boxes else (np.arange(len(part)), np.zeros(len(part), int))
                    rows = batch.take(pa.array(own[a + which]))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(which), part.shape[1]), pa.int32()), pa.array(cell.astype(np.int32)), pa.array(floor[which])], ["vec_id", "v", "width", "cell", "floor"])

    return run


def _searched(k: int, report: bool):
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return empty
        unpack = lambda t: (t["vec_id"].to_numpy(), t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1))
        (x_ids, xs), (y_ids, ys) = unpack(x), unpack(y)
        score, ids, left = _best(y_ids, ys, x_ids, xs, k, y["floor"].to_numpy())
        if report:
            return pa.table({"query_id": np.arange(len(left)), "vec_id": np.zeros(len(left), np.int64), "score": left})
        there = ids.ravel() != LAST
        return pa.table({"query_id": np.repeat(y_ids, k)[there], "vec_id": ids.ravel()[there], "score": score.ravel()[there]})

    return run


def _found(vectors: DataFrame, queries: DataFrame, k: int, tile: int, report: bool = False) -> DataFrame:
    cells = cells_of(vectors)  # SAMPLE vectors, and three rows for each centre
    vector = f"vec_id long, v {vectors.schema['v'].dataType.simpleString()}, width int, cell int"
    celled, routed = vectors.mapInArrow(_celled(cells), vector), queries.mapInArrow(_routed(cells, k), f"{vector}, floor double")
    most = F.greatest(F.lit(1), F.lit(tile) / (8 * F.greatest(F.col("width"), F.lit(1))))
    sizes = celled.groupBy("width", "cell").agg(F.ceil(F.count("*") / most).cast("int").alias("cs"))
    sizes = sizes.join(routed.groupBy("width", "cell").agg(F.ceil(F.count("*") / most).cast("int").alias("qs")), ["width", "cell"])
    sizes = checkpointed(sizes)
    sizes = broadcast_if_small(sizes, sizes.count())
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pick = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    left = celled.join(sizes, ["width", "cell"]).select("vec_id", "v", "width", "cell", pick("cs").alias("c"), each("qs").alias("q"))
    right = routed.join(sizes, ["width", "cell"]).select("vec_id", "v", "floor", "width", "cell", pick("qs").alias("q"), each("cs").alias("c"))
    keys = ["width", "cell", "c", "q"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_searched(k, report), "query_id long, vec_id long, score long")


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, tile: int = TILE) -> DataFrame:
    """vectors, queries (vec_id long, v array<double> of whole numbers) -> (query_id, rank, vec_id, score).

    For each query its k highest inner products among the vectors of its own length but itself, ties to the smaller id.
    Vectors are dealt into cells by their nearest centre. A query gets a first floor from a sample, and goes only to cells whose box of segment
    statistics can reach that floor. A cell and its queries are cut by hash into tiles of a bounded number of bytes; each pair of tiles is
    one task's work and gives k rows a query, which a window then merges. So the shuffle is the queries times the cells that they can't
    dismiss, and a copy of a cell for each tile of its queries. Fewer than
    k other vectors: all of them. No vectors or no queries: no rows. Scores are exact (whole numbers outside the doubles'
    exact range are summed as Python's), held to the range of a long.
    """
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return _found(vectors, queries, k, tile).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def survivors(vectors: DataFrame, queries: DataFrame, k: int = 5, tile: int = TILE) -> DataFrame:
    """-> (level, pairs): pairs of a query and a vector of the cells it goes to (level 0), and those left after each level; the last are compared exactly."""
    return _found(vectors, queries, k, tile, report=True).groupBy(F.col("query_id").alias("level")).agg(F.sum("score").alias("pairs"))


def topk_query(embeddings: DataFrame) -> DataFrame:
    """-> (query_id, rank, vec_id, score) of every row whose id is divisible by 50 against every other row. Rows that repeat an id are queries and candidates each;
    rows without one are candidates, behind all others where scores tie."""
    rows = whole_rows(embeddings, "vec_id", "embedding", 256)
    vectors = rows.select(F.col("row").alias("vec_id"), "v")
    asked = rows.where(F.pmod("vec_id", F.lit(50)) == 0)
    found = exact_topk(vectors, asked.select(F.col("row").alias("vec_id"), "v"))
    who = lambda r, name: rows.select(F.col("row").alias(r), F.col("vec_id").alias(name))
    named = found.select(F.col("query_id").alias("__query"), "rank", F.col("vec_id").alias("__found"), "score").join(who("__query", "query_id"), "__query").join(who("__found", "vec_id"), "__found")
    return named.select("query_id", "rank", "vec_id", "score")
