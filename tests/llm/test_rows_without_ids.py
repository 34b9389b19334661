"""Rows without an id, and rows that repeat one, count like any other."""

from __future__ import annotations

import pytest

from walloom.llm import ngram_join, vector_dedup, vector_topk

WORDS = [f"w{k}" for k in range(60)]


def chain():
    """Three texts of which the first and the last are linked only by way of the one between them."""
    texts = [" ".join(WORDS), " ".join([*WORDS[:-3], "x1", "x2", "x3"]), " ".join(["y1", "y2", "y3", *WORDS[3:-3], "x1", "x2", "x3"])]
    sets = [{tuple(t.split()[k : k + 4]) for k in range(57)} for t in texts]
    jaccard = lambda a, b: len(a & b) / len(a | b)
    assert jaccard(sets[0], sets[1]) >= 0.85 and jaccard(sets[1], sets[2]) >= 0.85 > jaccard(sets[0], sets[2])
    return texts


@pytest.mark.parametrize("ids", [(1, 2, 3), (1, None, 3), (None, 2, 3), (None, 2, None), (None, None, None), (None, None, 3)])
@pytest.mark.parametrize("copies", [1, 3])
def test_rows_without_ids_link(spark, ids, copies):
    rows = [(i, t) for i, t in zip(ids, chain(), strict=True) for _ in range(copies)] + [(None, "something else " * 9), (9, None), (None, None)]
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), words=4, percent=85).collect()
    least = min((i for i in ids if i is not None), default=None)
    linked = sorted((str(r["doc_id"]), r["component_id"]) for r in got if r["n_shingles"] == 57)
    assert linked == sorted((str(i), least) for i in ids for _ in range(copies))
    assert sorted(((r["n_shingles"], r["component_id"]) for r in got if r["n_shingles"] < 57), key=str) == [(0, 9), (0, None), (2, None)]


def test_vectors_without_ids_and_with_repeated_ones(spark):
    rows = [(None, [1.0, 0.0]), (5, [1.0, 0.01]), (5, [0.0, 1.0]), (7, [0.0, 1.0]), (None, [0.5, -0.5]), (None, [0.5, -0.5]), (None, None), (9, None), (9, [1.0, 0.02])]
    got = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([
        (None, 2, 5, False), (5, 2, 5, True), (9, 2, 5, False), (5, 1, 5, True), (7, 1, 5, False), (None, 1, None, True), (None, 1, None, True), (None, 0, None, True), (9, 0, 9, True),
    ], key=str)


def test_search_among_rows_without_ids_and_with_repeated_ones(spark):
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.5]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [2.0, 0.0]), (2, None)]
    got = vector_topk.topk_query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    one = 256 * 256
    assert sorted(by[50], key=str) == sorted([(1, None, 2 * one), (2, 1, one), (3, 50, one), (4, None, one), (1, None, 2 * one), (2, 1, one), (3, 50, one), (4, None, one)], key=str) and set(by) == {50}
