"""Document quality by co-training: one classifier sees the text, the other the metadata, and each teaches the other."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, frugal, slices, stored, string_bytes

#: Bound of the labelled documents that are learned from, those of the least hash. Unlabelled ones have none.
LABELLED_ROWS = 6000
ROUNDS, SURE = 4, 0.95
#: Most weight of a row that a view labelled, and of all of them as a share of the labelled rows' weight.
TAUGHT_WEIGHT = 0.5
#: Bytes of text that a task takes at once.
SLICE = 2 << 20
#: Sums of tasks are added up in so many groups of tasks, and these once more.
BRANCHES = 256
PAIR_BINS, SOURCE_BINS, LANG_BINS, SIZE_BINS = 256, 32, 16, 12


def text_features(texts: pa.Array) -> np.ndarray:
    """Per text: shares of 128 byte classes and of hashed byte pairs, shape of words and repetition, all of the whole text."""
    flat, offsets = string_bytes(texts)
    out = np.zeros((len(texts), 128 + PAIR_BINS + 6), np.float32)
    words = [t.as_py().split() if t.is_valid else [] for t in texts]
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        own = flat[a:b]
        if not len(own):
            continue
        out[k, :128] = np.sqrt(np.bincount(np.minimum(own, 127), minlength=128) / len(own))
        if len(own) > 1:
            pair = (own[:-1].astype(np.uint32) * 263 + own[1:] * np.uint32(7919)) % PAIR_BINS
            out[k, 128 : 128 + PAIR_BINS] = np.sqrt(np.bincount(pair, minlength=PAIR_BINS) / len(pair))
        w = words[k]
        if w:
            distinct = len(set(w))
            out[k, -6:] = (distinct / len(w), np.log1p(len(w)) / 10, len(own) / len(w) / 20, sum(x == y for x, y in zip(w, w[1:], strict=False)) / len(w), np.log1p(distinct) / 10, 1 - distinct / len(w) if len(w) > 50 else 0)
    return out


def _bin(values: list, bins: int) -> np.ndarray:
    import zlib

    return np.array([zlib.crc32(v.encode()) % (bins - 1) + 1 if v is not None else 0 for v in values], int)


def meta_features(source: list, lang: list, n_chars: np.ndarray) -> np.ndarray:
    """Per row: hashed source and language, and the size on a logarithmic scale in bins; missing values have bins of their own."""
    n = len(source)
    out = np.zeros((n, SOURCE_BINS + LANG_BINS + SIZE_BINS), np.float32)
    rows = np.arange(n)
    out[rows, _bin(source, SOURCE_BINS)] = 1
    out[rows, SOURCE_BINS + _bin(lang, LANG_BINS)] = 1
    size = np.nan_to_num(np.asarray(n_chars, float), nan=-1)
    out[rows, SOURCE_BINS + LANG_BINS + np.where(size < 0, 0, np.minimum(np.log2(np.maximum(size, 0) + 1) / 2 + 1, SIZE_BINS - 1).astype(int))] = 1
    return out


def sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the logistic loss over rows; the last place is the intercept's."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    p = sigmoid(x @ w)
    curve = (weight * np.maximum(p * (1 - p), 1e-6)).astype(x.dtype)
    return x.T @ (weight * (p - y)), ((x * curve[:, None]).T @ x).astype(float)


def code_of(meta: np.ndarray) -> np.ndarray:
    """The three bins of metadata features as one number."""
    bins = np.split(meta, [SOURCE_BINS, SOURCE_BINS + LANG_BINS], axis=1)
    source, lang, size = (b.argmax(axis=1) for b in bins)
    return ((source * LANG_BINS + lang) * SIZE_BINS + size).astype(np.int32)


def code_features(codes: np.ndarray) -> np.ndarray:
    """The metadata features of such numbers."""
    out = np.zeros((len(codes), SOURCE_BINS + LANG_BINS + SIZE_BINS), np.float32)
    rows = np.arange(len(codes))
    out[rows, codes // (LANG_BINS * SIZE_BINS)] = 1
    out[rows, SOURCE_BINS + codes // SIZE_BINS % LANG_BINS] = 1
    out[rows, SOURCE_BINS + LANG_BINS + codes % SIZE_BINS] = 1
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 25, lesson: Lesson | SparkLesson | None = None, start: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the intercept of a penalised logistic regression, by Newton's steps. lesson: further rows, of
    which only the sums are needed; then start is where the steps begin."""
    x = x.astype(float)
    share = TAUGHT_WEIGHT * min(1.0, weight.sum() / lesson.n) if lesson else 0.0
    w = np.zeros(x.shape[1] + 1) if start is None or not lesson else start.copy()
    ridge = np.full(len(w), penalty * max(1.0, weight.sum() + (share * lesson.n if lesson else 0)))
    ridge[-1] = 1e-6
    for _ in range(steps):
        g, h = sums(x, y, weight, w)
        if lesson:
            more_g, more_h = lesson.sums(w)
            g, h = g + share * more_g, h + share * more_h
        step = np.linalg.solve(h + np.diag(ridge), g + ridge * w)
        w = w - step
        if np.abs(step).max() < (1e-3 if lesson else 1e-6):
            break
    return w


def margin(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class View:
    """A classifier of one view and its calibration: a slope (never negative) and an intercept on its margins."""

    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * margin(self.weights, x) + self.shift


@dataclass
class Model:
    text: View
    meta: View
    prior: float
    taught: tuple[int, int]

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of each view, and of both: their evidence over the prior's, added."""
        t, m = self.text.logit(text), self.meta.logit(meta)
        return sigmoid(t), sigmoid(m), sigmoid(t + m - self.prior)


@dataclass
class Lesson:
    """Rows that one view labelled for the other, each standing for `count` rows."""

    x: np.ndarray
    y: np.ndarray
    count: np.ndarray

    @property
    def n(self) -> float:
        return float(self.count.sum())

    def sums(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return sums(self.x.astype(float), self.y, self.count, w)


class Rows:
    """A pool in memory. teach: most rows of a class that a view labels, the surest; None for all."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, teach: int | None = None):
        self.views, self.teach = (text, meta), teach

    def lesson(self, k: int, teacher: View, sure: float) -> Lesson | None:
        p = sigmoid(teacher.logit(self.views[1 - k])) if len(self.views[0]) else np.zeros(0)
        own, labels = [], []
        for label, confidence in ((1, p), (0, 1 - p)):
            order = np.argsort(-confidence, kind="stable")
            free = order[confidence[order] >= sure][: self.teach]
            own.append(free)
            labels.append(np.full(len(free), float(label)))
        rows = np.concatenate(own).astype(int)
        return Lesson(self.views[k][rows], np.concatenate(labels), np.ones(len(rows))) if len(rows) else None


class SparkPool:
    """A pool of any size: a table (code int, text binary) of features. The metadata has few values (a code is the three bins),
    so its side is a table of counts by code; the text side's sums are added up by Spark."""

    def __init__(self, table: DataFrame):
        self.table = table
        found = table.groupBy("code").count().toArrow()  # at most one row for each three bins
        self.codes, self.counts = found["code"].to_numpy(), found["count"].to_numpy().astype(float)

    def lesson(self, k: int, teacher: View, sure: float) -> Lesson | SparkLesson | None:
        if not len(self.codes):
            return None
        if k == 0:
            p = sigmoid(teacher.logit(code_features(self.codes)))
            some = (p >= sure) | (1 - p >= sure)
            labels = dict(zip(self.codes[some].tolist(), (p[some] >= 0.5).astype(float).tolist(), strict=True))
            return SparkLesson(self.table, labels, float(self.counts[some].sum())) if labels else None
        found = self.table.mapInArrow(frugal(_told(teacher, sure), "quality"), "code int, y double, n double").groupBy("code", "y").agg(F.sum("n").alias("n")).toArrow()
        return Lesson(code_features(found["code"].to_numpy()), found["y"].to_numpy(), found["n"].to_numpy()) if len(found) else None


@dataclass
class SparkLesson:
    """The pool's rows of which the metadata view is sure, for the text view."""

    table: DataFrame
    labels: dict[int, float]
    n: float

    def sums(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self.table.where(F.col("code").isin(list(self.labels)))
        parts = rows.mapInArrow(frugal(_part_sums(self.labels, w), "quality"), "place int, line binary")
        branched = parts.withColumn("branch", F.pmod(F.spark_partition_id(), F.lit(BRANCHES)))
        added = branched.groupBy("place", "branch").applyInArrow(_added, "place int, line binary")
        found = added.groupBy("place").applyInArrow(_added, "place int, line binary").toArrow()  # a line a weight
        upper, g = np.zeros((len(w), len(w))), np.zeros(len(w))
        for place, line in zip(found["place"].to_pylist(), found["line"].to_pylist(), strict=True):
            line = np.frombuffer(line)
            upper[place, place:], g[place] = line[:-1], line[-1]
        return g, upper + np.triu(upper, 1).T


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(rows, -1)


def _told(teacher: View, sure: float):
    """Rows of which the text view is sure, counted by code and label."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                p = sigmoid(teacher.logit(_matrix(batch.column(1), batch.num_rows)))
                some = (p >= sure) | (1 - p >= sure)
                both, n = np.unique(batch.column(0).to_numpy()[some].astype(np.int64) * 2 + (p[some] >= 0.5), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((both >> 1).astype(np.int32)), pa.array((both & 1).astype(float)), pa.array(n.astype(float))], ["code", "y", "n"])

    return run


def _part_sums(labels: dict[int, float], w: np.ndarray):
    """A task's Hessian, which is symmetric, from the diagonal on, one row a line, with the gradient as the last column."""

    def run(batches):
        label = np.zeros(SOURCE_BINS * LANG_BINS * SIZE_BINS)
        label[list(labels)] = list(labels.values())
        whole = np.zeros((len(w), len(w) + 1))
        for batch in batches:
            if batch.num_rows:
                g, h = sums(_matrix(batch.column(1), batch.num_rows), label[batch.column(0).to_numpy()], np.ones(batch.num_rows), w)
                whole[:, -1] += g
                whole[:, :-1] += h
        if whole.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(w), dtype=np.int32)), pa.array([line[k:].tobytes() for k, line in enumerate(whole)], pa.binary())], ["place", "line"])

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(line) for line in table["line"].to_pylist())
    return pa.table({"place": table["place"][:1], "line": pa.array([total.tobytes()], pa.binary())})


def _calibrated(x: np.ndarray, y: np.ndarray, of: np.ndarray, own_y: np.ndarray, lesson: Lesson | SparkLesson | None, start: np.ndarray | None) -> View:
    """Fit on x, y and the lesson; calibrate on held-out rows."""
    view = View(fit_logistic(x, y, np.ones(len(y)), lesson=lesson, start=start))
    slope, shift = fit_logistic(margin(view.weights, of)[:, None], own_y, np.ones(len(own_y)), 1e-4)
    if slope <= 0:
        rate = np.clip(own_y.mean(), 1e-3, 1 - 1e-3)
        return View(view.weights, 0.0, float(np.log(rate / (1 - rate))))
    return View(view.weights, float(slope), float(shift))


def exchange(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: Rows | SparkPool, rounds: int = ROUNDS, sure: float = SURE) -> Model:
    """Two views of labelled rows, which teach each other over a pool. A fifth of the labelled rows of each class only calibrates.

    Each round both views are fitted and calibrated; each labels, for the other, every row of the pool of which it is sure. What it taught
    in the round before is forgotten. A labelled row weighs 1; the taught ones weigh alike, TAUGHT_WEIGHT at most, and together no more than that share
    of the labelled ones. Calibration keeps a view that knows little from being sure.
    """
    hold = np.concatenate([np.flatnonzero(y == c)[::5] for c in (0, 1)])
    own = np.setdiff1d(np.arange(len(y)), hold)
    lessons: list = [None, None]
    starts: list = [None, None]

    def fitted(k: int) -> View:
        view = _calibrated(views[k][own], y[own].astype(float), views[k][hold], y[hold].astype(float), lessons[k], starts[k])
        starts[k] = view.weights
        return view

    text = fitted(0)
    for _ in range(rounds):
        lessons[1] = pool.lesson(1, text, sure)
        meta = fitted(1)
        had, lessons[0] = lessons[0], pool.lesson(0, meta, sure)
        if had is None and lessons[0] is None:
            break  # the text view has learned nothing new, so further rounds would be the same
        text = fitted(0)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    return Model(text, meta, float(np.log(rate / (1 - rate))), tuple(int(x.n) if x else 0 for x in lessons))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, teach: int | None = None, sure: float = SURE) -> Model:
    """The exchange over rows in memory. y: 1 and 0, or -1 for rows without a label."""
    known, pool = y >= 0, y < 0
    return exchange((text[known], meta[known]), y[known], Rows(text[pool], meta[pool], teach), rounds, sure)


_COLUMNS = ("doc_id", "text", "source", "lang", "n_chars")


def _views(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = lambda c: rows.column(rows.schema.get_field_index(c))
    n_chars = column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False)
    return text_features(column("text")), meta_features(column("source").to_pylist(), column("lang").to_pylist(), n_chars)


def _featured(batches):
    for rows in slices(batches, SLICE):
        text, meta = _views(rows)
        as_list = lambda x: pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index("y")), as_list(text), as_list(meta)], ["y", "text", "meta"])


def _pooled(batches):
    for rows in slices(batches, SLICE):
        text, meta = _views(rows)
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(code_of(meta)), pa.array([x.tobytes() for x in text], pa.binary())], ["doc_id", "code", "text"])


def _scored(model: Model):
    def run(batches):
        for rows in slices(batches, SLICE):
            text, meta, both = model.scores(*_views(rows))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(text), pa.array(meta), pa.array(both)], ["doc_id", "text_score", "meta_score", "quality_score"])

    return run


def _rows(documents: DataFrame) -> DataFrame:
    kinds = {"doc_id": None, "text": "string", "source": "string", "lang": "string", "n_chars": "double"}
    return documents.select(*(F.col(c).cast(k).alias(c) if k else F.col(c) for c, k in kinds.items()))


def train(documents: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> Model | None:
    """Learn from labels(doc_id, quality) and all documents without; None unless both classes are there.

    The labelled sample is bounded, taken by hash, and its features (not texts) come to the driver. The features of every unlabelled
    document are stored once; Spark labels and sums them each round. Labels that repeat a document count as their mean, over 0.5 as good.
    """
    rows = _rows(documents)
    given = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    ids = rows.select("doc_id").where("doc_id is not null")
    known = ids.join(given, "doc_id").select("doc_id", "y").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    sample = rows.join(broadcast_if_small(known, labelled_rows), "doc_id").select("text", "source", "lang", "n_chars", "y")
    table = sample.mapInArrow(frugal(_featured, "quality"), "y int, text array<float>, meta array<float>").toArrow()
    y = table["y"].to_numpy()
    if len({*y.tolist()}) < 2 or len(y) < 10:
        return None
    unpack = lambda c: table[c].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    text, meta = unpack("text"), unpack("meta")
    order = np.lexsort((*text.T, *meta.T, y))  # the same rows in the same order, however Spark dealt them
    order = order[np.random.default_rng(7).permutation(len(order))]
    featured = rows.where("doc_id is not null").mapInArrow(frugal(_pooled, "quality"), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, code int, text binary")
    pool = featured.join(broadcast_if_small(given.select("doc_id"), given.count()), "doc_id", "left_anti").select("code", "text")
    return exchange((text[order], meta[order]), y[order], SparkPool(stored(pool)))


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """-> (doc_id, text_score, meta_score, quality_score, kept) for every row.

    kept: quality_score >= 0.5. Without a model every score is 0.5 and all are kept. Null or empty texts have the features
    of an empty text; missing metadata has bins of its own. Repeated rows each give a row.
    """
    rows = _rows(documents)
    if model is None:
        half = F.lit(0.5)
        return rows.select("doc_id", half.alias("text_score"), half.alias("meta_score"), half.alias("quality_score"), F.lit(True).alias("kept"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_score double, meta_score double, quality_score double"
    return rows.mapInArrow(frugal(_scored(model), "quality"), schema).withColumn("kept", F.col("quality_score") >= 0.5)


def _kept(model: Model):
    def run(batches):
        for rows in slices(batches, SLICE):
            yield rows.filter(pa.array(model.scores(*_views(rows))[2] >= 0.5))

    return run


def keep_good(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows, with all their columns, of quality_score >= 0.5; all of them without a model."""
    return documents if model is None else documents.mapInArrow(frugal(_kept(model), "quality"), documents.schema)


def quality_of(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, train(documents, labels))
