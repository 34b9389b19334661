"""Vectors as short codes: product codebooks learned by Lloyd rounds over whole numbers, with Elkan's bounds kept from round to round.

Each row keeps, for each part, an upper bound of its distance to its entry and a lower bound of that to every entry. When entries move, upper
bounds grow by their entry's movement and lower ones shrink by each entry's; the triangle inequality then dismisses, strictly, entries that can't be as
near, and only the others are compared, in whole numbers, so that ties go to the lower index and the result is that of comparing everything.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_small, frugal, stored

#: Sums leave a task in digits of so many bits, so that Spark adds them up in longs whatever their size.
BITS = 30
#: Bounds are held apart by this share, which is far more than rounding adds to them.
SLACK = 1e-9
ROWS = 4096
MOST = 2**63 - 1


@dataclass(frozen=True)
class Books:
    """entries: for each part a whole-number array (entry, place); moved: how far each entry moved in the last round, or None at first."""

    entries: list[np.ndarray]
    moved: list[np.ndarray] | None = None

    @property
    def count(self) -> int:
        return len(self.entries[0])

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for part in self.entries for entry in part for x in entry).encode()).hexdigest()

    def halves(self, part: int) -> np.ndarray:
        """Half the distance of each two entries of a part."""
        own = self.entries[part]
        return np.sqrt(_squares(own[:, None, :], own[None, :, :]).astype(np.float64)) / 2


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(axis=-1)


def _safe(width: int, *arrays: np.ndarray) -> bool:
    """Whether squared distances fit whole numbers of 64 bits."""
    most = max([0, *(int(np.abs(a).max()) for a in arrays if a.size)])
    return width * (2 * most) ** 2 < 2**62


def assign_part(x: np.ndarray, books: Books, part: int, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """One part's new entries, bounds, and the number of distances that were compared. x: whole numbers that are safe to square."""
    entries, half = books.entries[part], books.halves(part)
    if books.moved is not None:
        upper = upper + books.moved[part][own]
        lower = np.maximum(lower - books.moved[part][None, :], 0)
    apart = half + np.where(np.eye(len(half), dtype=bool), np.inf, 0)
    nearest = apart.min(axis=1)
    up = upper * (1 + SLACK)
    rows = np.flatnonzero(~(up < nearest[own] * (1 - SLACK)))
    best = _squares(x[rows], entries[own[rows]])
    own, upper, lower, compared = own.copy(), upper.copy(), lower.copy(), len(rows)
    upper[rows] = np.sqrt(best.astype(np.float64))
    lower[rows, own[rows]] = upper[rows]
    for j in range(len(entries)):
        up = upper[rows] * (1 + SLACK)
        left = np.flatnonzero((own[rows] != j) & ~(up < lower[rows, j] * (1 - SLACK)) & ~(up < apart[own[rows], j] * (1 - SLACK)))
        if not len(left):
            continue
        at = rows[left]
        square = _squares(x[at], entries[j])
        compared += len(at)
        lower[at, j] = np.sqrt(square.astype(np.float64))
        nearer = (square < best[left]) | ((square == best[left]) & (j < own[at]))
        own[at[nearer]] = j
        upper[at[nearer]] = lower[at[nearer], j]
        best[left[nearer]] = square[nearer]
    return own, upper, lower, compared


def _whole(x: np.ndarray, books: Books) -> np.ndarray:
    """The same numbers as Python's, where their squares don't fit 64 bits."""
    if _safe(x.shape[-1], x, *books.entries):
        return x.astype(np.int64)
    return np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape)


def _nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """By comparing everything, in numbers of any size."""
    best = own = None
    for j, entry in enumerate(entries):
        square = _squares(x, entry.astype(object))
        nearer = np.zeros(len(x), bool) if best is None else (square < best).astype(bool)
        best, own = (square, np.zeros(len(x), np.int64)) if best is None else (np.where(nearer, square, best), np.where(nearer, j, own))
    return own


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, max(1, x.shape[1]), dtype=np.int32)[: len(x) + 1]), pa.array(x.ravel()))


def _assigned(books: Books):
    """Rows (vec_id, label, v, own, upper, lower) -> the same with new entries and bounds. At first own, upper and lower are null."""

    def run(batches):
        parts, k = len(books.entries), books.count
        part = books.entries[0].shape[1]
        for batch in batches:
            for rows in (batch.slice(a, ROWS) for a in range(0, batch.num_rows, ROWS)):
                n = rows.num_rows
                x = _whole(_vectors(rows.column(2), parts * part).reshape(n, parts, part), books)
                if books.moved is None:
                    own, upper, lower = np.zeros((n, parts), np.int64), np.full((n, parts), np.inf), np.zeros((n, parts, k))
                else:
                    own, upper = _vectors(rows.column(3), parts).astype(np.int64), _vectors(rows.column(4), parts).copy()
                    lower = _vectors(rows.column(5), parts * k).reshape(n, parts, k).astype(np.float64)
                for m in range(parts):
                    if x.dtype == object:  # bounds can't hold such numbers: no bound is given
                        own[:, m], upper[:, m], lower[:, m] = _nearest(x[:, m], books.entries[m]), np.inf, 0
                    else:
                        own[:, m], upper[:, m], lower[:, m], _ = assign_part(x[:, m], books, m, own[:, m], upper[:, m], lower[:, m])
                down = lower.reshape(n, parts * k).astype(np.float32)
                down = np.maximum(np.nextafter(down, np.float32(-np.inf)), np.float32(0))
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], _lists(own.astype(np.int32)), _lists(upper), _lists(down)], ["vec_id", "label", "v", "own", "upper", "lower"])

    return run


def _sums(books: Books):
    """A task's rows -> (part, entry, place, digit, total): sums of the parts of each entry by place, in digits of BITS bits; their number at place -1."""

    def run(batches):
        parts, k, part = len(books.entries), books.count, books.entries[0].shape[1]
        total, count = np.zeros((parts, k, part), object), np.zeros((parts, k), np.int64)
        for batch in batches:
            for rows in (batch.slice(a, ROWS) for a in range(0, batch.num_rows, ROWS)):
                x, own = _whole(_vectors(rows.column(0), parts * part).reshape(-1, parts, part), books), _vectors(rows.column(1), parts)
                for m in range(parts):
                    for j in np.unique(own[:, m]):
                        at = own[:, m] == j
                        count[m, j] += int(at.sum())
                        total[m, j] += x[at, m].sum(axis=0).astype(object)
        out = []
        for m, j in zip(*np.nonzero(count), strict=True):
            out.append((m, j, -1, 0, int(count[m, j])))
            for place, s in enumerate(total[m, j]):
                rest, digit = abs(int(s)), 0
                while rest:
                    out.append((m, j, place, digit, (rest & ((1 << BITS) - 1)) * (1 if s > 0 else -1)))
                    rest, digit = rest >> BITS, digit + 1
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(np.array(c, np.int32)) for c in columns[:4]), pa.array(np.array(columns[4], np.int64))], ["part", "entry", "place", "digit", "total"])

    return run


def _moved(books: Books, state: DataFrame) -> Books:
    """The next codebooks: each entry the rounded-down mean of its parts; one that has none stays. The driver gets a number for each place of each entry."""
    rows = state.select("v", "own").mapInArrow(frugal(_sums(books), "vector_codes"), "part int, entry int, place int, digit int, total long")
    found = rows.groupBy("part", "entry", "place", "digit").agg(F.sum("total").alias("total")).collect()
    sums, counts = [e.astype(object) * 0 for e in books.entries], {}
    for r in found:
        if r["place"] < 0:
            counts[r["part"], r["entry"]] = r["total"]
        else:
            sums[r["part"]][r["entry"], r["place"]] += r["total"] << (BITS * r["digit"])
    new = [e.astype(object).copy() for e in books.entries]
    for (m, j), n in counts.items():
        new[m][j] = sums[m][j] // n
    part = new[0].shape[1]
    if _safe(part, *new):
        new = [e.astype(np.int64) for e in new]
    if not all(e.dtype == np.int64 for e in (*new, *books.entries)):
        return Books(new, [np.full(len(e), np.inf) for e in new])  # no bound survives
    return Books(new, [np.sqrt(_squares(a, b).astype(np.float64)) * (1 + SLACK) for a, b in zip(new, books.entries, strict=True)])


def _coded(books: Books):
    def run(batches):
        parts, part = len(books.entries), books.entries[0].shape[1]
        for batch in batches:
            for rows in (batch.slice(a, ROWS) for a in range(0, batch.num_rows, ROWS)):
                own = _vectors(rows.column(3), parts)
                x = _whole(_vectors(rows.column(2), parts * part).reshape(-1, parts, part), books)
                error = sum(_squares(x[:, m], books.entries[m][own[:, m]]).astype(object) for m in range(parts))
                code = ["".join(f"{j:02x}" for j in row) for row in own.tolist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(code), pa.array([min(int(e), MOST) for e in error], pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def fit_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None, scale: int, parts: int) -> DataFrame:
    """(vec_id, label, v array<double>): floor(scale * x) of each component, exact whole numbers. Vectors that are null, or that hold null or non-finite
    components or such that `scale` makes non-finite, go, and so do those that can't be cut into `parts` equal parts, the empty one too."""
    v, high = F.col("v"), F.lit(float("inf"))
    fit = v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < high))
    whole = lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)  # noqa: E731  larger doubles are whole
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.coalesce(fit, F.lit(False))).select("vec_id", "label", F.transform("v", lambda x: whole(x * scale)).alias("v"))


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, Books | None]:
    """-> rows (vec_id, label, code, error), and the codebooks; each part's start as that part of the vectors with the least ids (nulls last, ties by vector).

    With fewer vectors than `entries` there are so many entries. Vectors of another length than the first one's go. Rows that repeat an id or have none
    each count and each get a row. Without any vector there are no rows and no codebooks. Errors beyond 64 bits come out as the largest number.
    Rows with their bounds are written once a round, and the next round reads them; nothing is shuffled but the sums of each task.
    """
    spark = vectors.sparkSession
    rows = fit_vectors(vectors, id_col, vector_col, label_col, scale, parts)
    kind = rows.schema["label"].dataType
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    if not first:
        return spark.createDataFrame([], T.StructType().add("vec_id", "long").add("label", kind).add("code", "string").add("error", "long")), None
    width = len(first[0]["v"])
    rows = rows.where(F.size("v") == width)
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    x = np.array([[int(c) for c in r["v"]] for r in start], dtype=object).reshape(len(start), parts, width // parts)
    x = x.astype(np.int64) if _safe(width // parts, x) else x
    books = Books([x[:, m] for m in range(parts)])
    held = T.StructType().add("vec_id", "long").add("label", kind).add("v", T.ArrayType(T.DoubleType())).add("own", T.ArrayType(T.IntegerType())).add("upper", T.ArrayType(T.DoubleType())).add("lower", T.ArrayType(T.FloatType()))
    none = [F.lit(None).cast(f"array<{t}>").alias(c) for c, t in (("own", "int"), ("upper", "double"), ("lower", "float"))]
    state = rows.select("vec_id", "label", "v", *none)
    for _ in range(rounds):
        state = stored(state.mapInArrow(frugal(_assigned(books), "vector_codes"), held))
        books = _moved(books, state)
    state = state.mapInArrow(frugal(_assigned(books), "vector_codes"), held)
    return state.mapInArrow(frugal(_coded(books), "vector_codes"), T.StructType().add("vec_id", "long").add("label", kind).add("code", "string").add("error", "long")), books


def decoded(code: np.ndarray, books: Books, scale: int = 4096) -> np.ndarray:
    """Rows of entry numbers -> the vectors that they stand for."""
    return np.concatenate([books.entries[m][code[:, m]].astype(np.float64) / scale for m in range(len(books.entries))], axis=1)


def code_query(vectors: DataFrame) -> DataFrame:
    """-> (vec_id, code, error, label_error, codebooks_sha256). The errors of a label are summed with map-side combine, so that one that most rows have costs a row a task."""
    found, books = codes(vectors)
    found = stored(found)
    total = stored(found.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error")))
    total = total.withColumnRenamed("label", "of")
    joined = found.join(broadcast_if_small(total, total.count()), F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"))
