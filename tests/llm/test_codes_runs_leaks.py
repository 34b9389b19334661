"""Vector codes, periodic runs and benchmark decontamination against brute force, and on odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from walloom.llm import decontamination, periodic_runs, queries, vector_codes

DOCS = "doc_id long, text string, spans string, row string, item_id string"
ITEMS = "item_id long, text string, doc_id string"
TWELVE = "one two three four five six seven eight nine ten eleven twelve"
ODD = [
    (1, None, "x", "y", "z"), (2, "", "x", "y", "z"), (3, " \n\t!? ", "x", "y", "z"), (4, f"so {TWELVE.upper()} and so on " * 3, "x", None, None), (5, "123 456 !!", "x", "y", "z"),
    (6, "naïve ÑAME 日本語 \U0001f600", "x", "y", "z"), (6, "naïve ÑAME 日本語 \U0001f600", "x", "y", "z"), (7, "alpha beta " * 3000 + TWELVE, None, None, None),
    (None, f"no id: {TWELVE}", "x", "y", "z"), (None, f"no id: {TWELVE}", "x", "y", "z"), (8, "one-two,three.four five\nsix  seven eight nine", "x", "y", "z"), (9, "x" * 5000, "x", "y", "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---- 13


def words(text):
    lower = (text or "").translate({k: k + 32 for k in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def leaks(docs, items):
    grams = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            grams.setdefault(tuple(w[k : k + 10]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found |= {i for i in grams[tuple(w[k : k + n])] if i is not None}
        listed = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


BENCHMARKS = {
    "none": [],
    "no words": [(1, None, "x"), (2, "?!", "x")],
    "long": [(1, f"{TWELVE} thirteen", "x"), (10, f"zero {TWELVE}", "x"), (2, TWELVE, "x"), (2, "other words of an item with a repeated id are here as well too", "x"), (None, "alpha beta " * 6, "x")],
    "short": [(1, "alpha", "x"), (2, "eleven twelve", "x"), (3, "ñame", "x"), (4, "Ñame", "x"), (5, "three four", "x"), (6, "alpha beta " * 5 + TWELVE, "x"), (7, "456", "x"), (8, TWELVE, "x")],
}


@pytest.mark.parametrize("name", sorted(BENCHMARKS))
@pytest.mark.parametrize("chunk, broadcast", [(7, 64 << 20), (2048, 0)])
def test_leaks_equal_brute_force(spark, odd, monkeypatch, name, chunk, broadcast):
    monkeypatch.setattr(decontamination, "CHUNK", chunk)
    monkeypatch.setattr(decontamination, "BROADCAST", broadcast)
    items = spark.createDataFrame(BENCHMARKS[name], ITEMS)
    got = decontamination.contamination(odd, items).collect()
    assert sorted((tuple(r) for r in got), key=str) == leaks([(r[0], r[1]) for r in ODD], [(i, t) for i, t, _ in BENCHMARKS[name]])


def test_leaks_of_no_documents(spark, empty):
    items = spark.createDataFrame(BENCHMARKS["short"], ITEMS)
    assert decontamination.contamination(empty, items).collect() == [] and decontamination.decontaminate(empty, items).collect() == []


def test_leaks_need_no_python(spark, sf_dir):
    plan = queries.op13_decontamination(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_decontaminate_cuts_spans_and_drops_documents(spark, odd):
    items = spark.createDataFrame(BENCHMARKS["long"][:3], ITEMS)
    got = decontamination.decontaminate(odd, items)
    assert got.columns == odd.columns
    rows = got.collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == [1, 2, 3, 5, 6, 6, 7, 8, 9]  # over half of the words of 4 and of the two without an id are hit
    by = {r["doc_id"]: r for r in rows}
    assert by[7]["text"] == ("alpha beta " * 3000).rstrip() and by[1]["text"] is None and by[3]["text"] == ODD[2][1] and by[6]["text"] == ODD[5][1]
    cut = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(odd, items, most_share=1).collect()}
    assert cut[4] == ("so and so on " * 3) and cut[None] == "no id"


# ---- 12


def runs(w):
    n, found = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            if i - s + p >= max(6, 4 * p) and i > s:
                found.setdefault((s, i - s + p), p)
            i += i == s
    return sorted(((s, k, p) for (s, k), p in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        n, k = rng.randint(0, 90), rng.choice([1, 2, 3, 5])
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5 and n > 10:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert [tuple(r) for r in periodic_runs.runs_of(np.array(w, np.int32)).tolist()] == runs(w)


def test_many_queries_are_answered_in_parts(monkeypatch):
    monkeypatch.setattr(periodic_runs, "QUERIES", 7)
    w = [0] * 40 + [1, 2] * 20 + [0, 1, 2] * 9 + [5]
    assert [tuple(r) for r in periodic_runs.runs_of(np.array(w, np.int32)).tolist()] == runs(w)


def test_least_values_of_ranges():
    rng = np.random.default_rng(2)
    for n in (1, 31, 32, 33, 1000):
        values = rng.integers(0, 99, n)
        a, b = np.sort(rng.integers(0, n, (2, 400)), axis=0)
        assert (periodic_runs.Minima(values)(a, b) == [values[x : y + 1].min() for x, y in zip(a, b, strict=True)]).all()


def digest(doc_id, text, planted=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs(w)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, k, p in found for i in range(s + p, s + k)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    collapsed = sha(" ".join(x for i, x in enumerate(w) if i not in gone))
    return (doc_id, len(found), *(top or (None, None, None)), top and 1000 * top[1] // top[2], sha("".join(f"{s},{k},{p}\n" for s, k, p in found)), collapsed)


REPEATS = [*ODD, *((k, "a b c d " * 8 + " x  y " * 7 + "z " * 9 + "q", "x", "y", "z") for k in range(20, 60)), (60, "w " * 300, "x", "y", "z"), (61, "a b a b a b a b a b a b\v\f", "x", "y", "z")]


def test_run_digests_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", 50)
    short = [r for r in REPEATS if r[0] != 7]
    docs = spark.createDataFrame(short, DOCS)
    got = periodic_runs.run_digests(docs.withColumn("text", periodic_runs.repeated(F.col("text"), F.col("doc_id")))).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((digest(r[0], r[1]) for r in short), key=str)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in short)
    plain = periodic_runs.run_digests(docs).collect()
    assert sorted((tuple(r) for r in plain), key=str) == sorted((digest(r[0], r[1], False) for r in short), key=str)


def test_long_text_of_one_word_and_no_documents(spark, empty):
    docs = spark.createDataFrame([(1, "w " * 30_000, None, None, None), (2, "alpha beta " * 20_000, None, None, None)], DOCS)
    got = {r["doc_id"]: r["runs"] for r in periodic_runs.find_runs(docs).collect()}
    assert [tuple(r) for r in got[1]] == [(0, 30_000, 1)] and [tuple(r) for r in got[2]] == [(0, 40_000, 2)]
    assert periodic_runs.run_digests(empty).collect() == [] and periodic_runs.collapse(empty).collect() == []


def test_collapse_keeps_columns_and_texts_without_runs(spark, odd):
    got = periodic_runs.collapse(odd)
    assert got.columns == odd.columns
    by = {r["doc_id"]: r["text"] for r in got.collect()}
    assert by[7] == "alpha beta " + TWELVE and by[1] is None and by[8] == ODD[10][1] and by[2] == ""


# ---- 11


def lloyd(rows, parts=8, entries=16, rounds=6):
    """Every distance of every round, in Python's numbers."""
    kept = [(i, label, [int(x * 4096 // 1) for x in v]) for i, label, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = [[v[m * width : (m + 1) * width] for m in range(parts)] for _, _, v in kept]
    books = [[c[m] for c in cut[:entries]] for m in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda c: [min(range(len(books[m])), key=lambda j: (far(c[m], books[m][j]), j)) for m in range(parts)]
    for _ in range(rounds):
        own = [nearest(c) for c in cut]
        for m in range(parts):
            for j in range(len(books[m])):
                of = [c[m] for c, o in zip(cut, own, strict=True) if o[m] == j]
                if of:
                    books[m][j] = [sum(x) // len(of) for x in zip(*of, strict=True)]
    own = [nearest(c) for c in cut]
    error = [sum(far(c[m], books[m][o[m]]) for m in range(parts)) for c, o in zip(cut, own, strict=True)]
    total = {}
    for (_, label, _), e in zip(kept, error, strict=True):
        total[label] = total.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = 2**63 - 1
    return sorted(((i, "".join(f"{j:02x}" for j in o), min(e, most), min(total[label], most), sha) for (i, label, _), o, e in zip(kept, own, error, strict=True)), key=str)


VECTORS = "vec_id long, embedding array<double>, label int, v string, code string, own string"


def coded(spark, rows):
    return sorted((tuple(r) for r in vector_codes.code_query(spark.createDataFrame([(*r, "x", None, "y") for r in rows], VECTORS)).collect()), key=str)


def cases():
    rng = np.random.default_rng(3)
    grid = [(int(i), [float(x) for x in rng.integers(-2, 3, 16) / 4096], None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(300)]
    yield "ties", grid
    yield "repeated rows and ids, no ids", [*grid[:60], *grid[:60], *((None, v, 1) for _, v, _ in grid[:20]), *((7, v, 2) for _, v, _ in grid[20:40])]
    yield "fewer than entries", grid[:5]
    yield "all equal", [(i, [0.25] * 8, 1) for i in range(40)]
    odd = [(1000, None, 1), (1001, [0.1] * 15 + [None], 1), (1002, [float("nan")] * 16, 1), (1003, [float("inf")] * 16, None)]
    yield "left out", [*grid[:50], *odd]
    yield "large", [(i, [float(x) for x in rng.normal(0, 1e9, 16)], i % 2) for i in range(60)]
    yield "huge and small", [*((i, [float(x) for x in rng.normal(0, 1, 16)], 0) for i in range(40)), *((100 + i, [float(x) for x in rng.normal(0, 1e30, 16)], 1) for i in range(10))]


@pytest.mark.parametrize("name, rows", list(cases()), ids=lambda x: x if isinstance(x, str) else "")
def test_codes_equal_every_distance(spark, name, rows):
    assert coded(spark, rows) == lloyd([(i, label, v) for i, v, label in rows])


def test_codes_of_nothing_and_of_other_lengths(spark):
    assert coded(spark, [(1, None, 1), (2, [], 1), (3, [1.0] * 7, 1)]) == []
    assert [r[0] for r in coded(spark, [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1), (3, [2.0] * 8, None), (4, [1.0] * 9, 1)])] == [1, 3]


def test_codes_without_labels(spark):
    rows, books = vector_codes.codes(spark.createDataFrame([(i, [float(i % 3)] * 8) for i in range(20)], "vec_id long, embedding array<double>"), label_col=None, entries=3)
    got = rows.collect()
    assert len(got) == 20 and books.count == 3 and all(r["error"] == 0 for r in got)
    x = vector_codes.decoded(np.array([[int(r["code"][2 * m : 2 * m + 2], 16) for m in range(8)] for r in got]), books)
    assert (x == np.array([[i % 3] * 8 for i in sorted(r["vec_id"] for r in got)])).all() or {tuple(v) for v in x} == {(0.0,) * 8, (1.0,) * 8, (2.0,) * 8}


def test_bounds_dismiss_most_distances():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 4000, (16, 8))
    x = (centres[rng.integers(0, 16, 4000)] + rng.normal(0, 300, (4000, 8))).astype(np.int64)
    books = vector_codes.Books([x[:16].copy()])
    own, upper, lower = np.zeros(4000, np.int64), np.full(4000, np.inf), np.zeros((4000, 16))
    compared = []
    for _ in range(7):
        own, upper, lower, n = vector_codes.assign_part(x, books, 0, own, upper, lower)
        compared.append(n)
        every = ((x[:, None, :] - books.entries[0][None]) ** 2).sum(axis=2)
        assert (own == every.argmin(axis=1)).all()
        assert (upper * (1 + 1e-9) >= np.sqrt(every[np.arange(4000), own])).all() and (lower * (1 - 1e-9) <= np.sqrt(every)).all()
        new = np.array([x[own == j].sum(axis=0) // (own == j).sum() if (own == j).any() else books.entries[0][j] for j in range(16)])
        books = vector_codes.Books([new], [np.sqrt(((new - books.entries[0]) ** 2).sum(axis=1).astype(float))])
    assert compared[-1] < 0.2 * 4000 * 16
