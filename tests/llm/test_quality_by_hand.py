"""Co-training held against a plain version of its own: features by counting, regressions to full convergence, the exchange row by row."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from walloom.llm import quality
from walloom.llm.common import table

SF = "/root/testdata/sf0.01"


def _text(text):
    data, out = (text or "").encode(), [0.0] * 390
    for b, n in Counter(min(b, 127) for b in data).items():
        out[b] = math.sqrt(n / len(data))
    pairs = Counter((a * 263 + b * 7919) % 256 for a, b in zip(data, data[1:], strict=False))
    for p, n in pairs.items():
        out[128 + p] = math.sqrt(n / (len(data) - 1))
    words = (text or "").split()
    if words:
        kinds, n = len(set(words)), len(words)
        out[384:] = [kinds / n, math.log1p(n) / 10, len(data) / n / 20, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, math.log1p(kinds) / 10, 1 - kinds / n if n > 50 else 0.0]
    return [float(np.float32(v)) for v in out]


def _meta(source, lang, n_chars):
    out = [0.0] * 60
    out[0 if source is None else zlib.crc32(source.encode()) % 31 + 1] = 1.0
    out[32 + (0 if lang is None else zlib.crc32(lang.encode()) % 15 + 1)] = 1.0
    out[48 + (0 if n_chars is None or n_chars < 0 else min(int(math.log2(n_chars + 1) / 2 + 1), 11))] = 1.0
    return out


def _p(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(x, y, weight, penalty):
    """The least of the penalised loss; the intercept, last, is hardly penalised."""
    x, w = np.c_[np.array(x), np.ones(len(x))], np.zeros(len(x[0]) + 1)
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    for _ in range(60):
        p = _p(x @ w)
        slope = x.T @ (weight * (p - y)) + ridge * w
        curve = x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]) + np.diag(ridge)
        w = w - np.linalg.solve(curve, slope)
    return w


def _view(x, y, held_x, held_y, taught):
    """A fitted and calibrated view -> its log odds. taught: (features, label) of rows that the other view named."""
    share = 0.5 * min(1.0, len(y) / len(taught)) if taught else 0.0
    every = [*x, *(f for f, _ in taught)]
    labels, weight = np.array([*y, *(label for _, label in taught)], float), np.array([1.0] * len(y) + [share] * len(taught))
    w = _fit(every, labels, weight, 1e-3 * max(1.0, weight.sum()))
    margins = np.array(held_x) @ w[:-1] + w[-1]
    slope, shift = _fit(margins[:, None], np.array(held_y, float), np.ones(len(held_y)), 1e-4 * max(1, len(held_y)))
    if slope <= 0:
        rate = min(max(np.mean(held_y), 1e-3), 1 - 1e-3)
        slope, shift = 0.0, math.log(rate / (1 - rate))
    return lambda f: slope * (np.array(f) @ w[:-1] + w[-1]) + shift


def _by_hand(docs, labels):
    """{doc_id: score} and how many rows were taught to the text and the metadata view."""
    marks = {}
    for doc_id, good in labels:
        marks.setdefault(doc_id, []).append(good)
    known = {d: int(np.mean(v) >= 0.5) for d, v in marks.items()}
    text, meta = {d["doc_id"]: _text(d["text"]) for d in docs}, {d["doc_id"]: _meta(d["source"], d["lang"], d["n_chars"]) for d in docs}
    ids = sorted((d for d in text if d in known), key=lambda d: (known[d], meta[d][::-1], text[d][::-1]))
    ids = [ids[k] for k in np.random.default_rng(7).permutation(len(ids))]
    held = [d for c in (0, 1) for d in [d for d in ids if known[d] == c][::5]]
    own = [d for d in ids if d not in set(held)]
    pool = [d for d in text if d not in known]
    view = lambda f, taught: _view([f[d] for d in own], [known[d] for d in own], [f[d] for d in held], [known[d] for d in held], taught)

    def lesson(of, teacher, seen):
        odds = _p(teacher([seen[d] for d in pool]))
        return [(of[d], int(p >= 0.5)) for d, p in zip(pool, odds, strict=True) if p >= 0.95 or 1 - p >= 0.95]

    by_text, for_text = view(text, []), []
    for _ in range(4):
        for_meta = lesson(meta, by_text, text)
        by_meta = view(meta, for_meta)
        had, for_text = for_text, lesson(text, by_meta, meta)
        if not had and not for_text:
            break
        by_text = view(text, for_text)
    rate = np.mean([known[d] for d in ids])
    both = {d: float(_p(by_text([text[d]]) + by_meta([meta[d]]) - math.log(rate / (1 - rate)))[0]) for d in text}
    return both, (len(for_text), len(for_meta))


def test_quality_equals_plain_exchange(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), table(spark, SF, "labels", "doc_id", "quality")
    expected, taught = _by_hand(docs.select("doc_id", "text", "source", "lang", "n_chars").collect(), [tuple(r) for r in labels.where("quality is not null").collect()])
    model = quality.train(docs, labels)
    assert min(taught) > 0 and all(abs(a - b) <= 2 for a, b in zip(model.taught, taught, strict=True))
    got = {r["doc_id"]: r["quality_score"] for r in quality.score(docs, model).collect()}
    assert got.keys() == expected.keys()
    assert max(abs(got[d] - expected[d]) for d in got) < 5e-3


def test_quality_is_learned_alike_however_rows_are_dealt(spark):
    """The labelled rows that calibrate are found by what they hold, so splits of the input don't matter."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), table(spark, SF, "labels", "doc_id", "quality")
    first, second = quality.train(docs, labels), quality.train(docs.repartition(7, F.xxhash64("text")), labels)
    assert np.allclose(first.text.weights, second.text.weights, atol=1e-4) and np.allclose(first.meta.weights, second.meta.weights, atol=1e-4)
    assert first.taught == second.taught and abs(first.text.shift - second.text.shift) < 1e-3
