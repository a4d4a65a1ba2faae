"""Exact top-k where queries and vectors are dealt to many meetings."""

import numpy as np
import pytest

from sheafline.llm import topk

SCHEMA = "vec_id long, vector array<long>"


def best_by_script(rows, queries, k):
    found = set()
    for key, query in queries:
        scores = [(-sum(a * b for a, b in zip(query, v, strict=True)), i) for i, v in rows if i != key and len(v) == len(query)]
        found |= {(key, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return found


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    # small components, so that scores tie; every tenth vector is shorter, every seventh is far larger
    return [
        (i, (rng.integers(-3, 4, 3 if i % 10 == 0 else 6) * (10**8 if i % 7 == 0 else 1)).tolist()) for i in range(300)
    ]


def test_copies_of_queries_do_not_pass_through_the_driver(spark, rows):
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = topk.exact_top_k(vectors, vectors.filter("vec_id % 5 = 0"), k=3, pack=4, query_pack=4)
    queries = [r for r in rows if r[0] % 5 == 0]
    assert {tuple(r) for r in found.collect()} == best_by_script(rows, queries, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan or "Final Plan" in plan
    assert "Broadcast" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("tasks", [10_000, 3])
def test_meetings_find_the_best_of_all_vectors(spark, rows, tasks, monkeypatch):
    monkeypatch.setattr(topk, "TASKS", tasks)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    queries = [r for r in rows if r[0] % 2 == 0]
    found = topk.exact_top_k(vectors, vectors.filter("vec_id % 2 = 0"), k=4, pack=8, query_pack=2).collect()
    assert {tuple(r) for r in found} == best_by_script(rows, queries, 4) and len(found) == 4 * len(queries)


def test_a_meeting_gives_the_best_of_its_packs_once(spark, rows):
    """However many packs pass by: rows to rank do not grow with them."""
    vectors = spark.createDataFrame([r for r in rows if r[0] % 10], SCHEMA).coalesce(1)
    packed = topk.packs(topk._usable(vectors, "vec_id", "vector").selectExpr("0 AS part", "*"), 16).collect()
    assert [len(r["ids"]) // 8 for r in packed] == [16] * 16 + [14]
    best = topk.Best(np.array([1, 2]), np.array(dict(rows)[1] + dict(rows)[2], np.int64).reshape(2, 6), 5)
    for r in packed:
        ids, low, step = (np.frombuffer(r[c], np.int64) for c in ("ids", "lows", "steps"))
        cell = np.frombuffer(r["cells"], np.uint8).reshape(-1, 6)
        best.scan(ids, topk._wide(r["vectors"], len(ids), 6), cell, low, step)
    found = best.found().to_pylist()
    expected = best_by_script([r for r in rows if r[0] % 10], [(i, dict(rows)[i]) for i in (1, 2)], 5)
    assert {(r["query_id"], r["vec_id"], r["score"]) for r in found} == {(q, i, s) for q, _, i, s in expected}
    assert len(found) == 10
