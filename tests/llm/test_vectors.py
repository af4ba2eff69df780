"""Pivot index and threshold search against brute force, with the cases that must not break them."""

import numpy as np
import pytest

from candlewick.llm import pivot_dedup, threshold_topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, component_id string"


def vectors(n=260, d=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d))
    rows = []
    for i in range(n):
        v = base[i % 60] + (0.05 if i % 3 else 0.25) * rng.normal(size=d)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2, "clash", "clash"))
    rows += [(1000 + i, rows[7][1], 1, "x", "y") for i in range(5)]  # exact copies
    rows += [(2000, None, 1, "", ""), (2001, [0.0] * d, 1, "", ""), (2002, [float("nan")] * d, 1, "", ""), (2003, [None] * d, 1, "", "")]
    rows += [(2004, [1.0] * d, None, "", ""), (None, [1.0] * d, 1, "", ""), (2005, [float("inf")] + [0.0] * (d - 1), 0, "", ""), (2006, [], 0, "", "")]
    rows += [(2007, [1e30] * d, 0, "", ""), (2008, [2e30] * d, 0, "", ""), (2009, [1.0, 2.0], 0, "", ""), (2010, [2.0, 4.0], 0, "", "")]
    return rows


def plain_links(rows, threshold):
    good = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float64) / np.max(np.abs(v))
        good[i] = (label, x / np.sqrt((x * x).sum()))
    root, n = {i: i for i, *_ in rows if i is not None}, {i: 0 for i, *_ in rows if i is not None}

    def top(x):
        return x if root[x] == x else top(root[x])

    ids = sorted(good)
    for a in ids:
        for b in ids:
            if a < b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= threshold:
                n[a] += 1
                n[b] += 1
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (n[i], top(i)) for i in n}


@pytest.mark.parametrize("block", [2048, 16])
def test_pivot_index_finds_all_groups(spark, block):
    rows = vectors()
    got = pivot_dedup.pivot_dedup(spark.createDataFrame(rows, SCHEMA), threshold=0.98, pivots=32, prefix=8, block=block).collect()
    want = plain_links(rows, 0.98)
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    alone = next(r for r in got if r.vec_id is None)
    assert (alone.n_links, alone.component_id, alone.kept) == (0, None, True)


@pytest.mark.parametrize("d", [16, 128])
def test_a_third_of_all_vectors_in_one_group(spark, d):
    rng = np.random.default_rng(7)
    base, n = rng.normal(size=d), 1500
    rows = [(i, [float(x) for x in (base + 0.14 * rng.normal(size=d) if i % 3 == 0 else rng.normal(size=d))], 1, "", "") for i in range(n)]
    got = {r.vec_id: r.n_links for r in pivot_dedup.pivot_dedup(spark.createDataFrame(rows, SCHEMA), pivots=512).collect()}
    x = np.array([np.float32(r[1]) for r in rows], np.float64)
    x /= np.sqrt((x * x).sum(1))[:, None]
    want = (x @ x.T >= 0.98).sum(1) - 1
    have = np.array([got[i] for i in range(n)])
    assert want.sum() > 5_000 and (have <= want).all() and have.sum() >= 0.9 * want.sum()


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pivot_dedup.pivot_dedup(empty).collect() == []
    assert threshold_topk.top_k(empty).collect() == []


@pytest.mark.parametrize(("block", "scale"), [(2048, 1024.0), (32, 1024.0), (64, 1.0)])
def test_threshold_search_is_exact(spark, block, scale):
    rows = [(i * 10 if i is not None else None, *r) for i, *r in vectors(200)] + [(50, [0.5] * 16, 0, "", ""), (50, [0.5] * 16, 0, "", "")]
    got = threshold_topk.top_k(spark.createDataFrame(rows, SCHEMA), k=10, every=100, scale=scale, block=block, queries=8).collect()
    good = [(i, np.floor(np.array(v, np.float64) * scale)) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) and abs(x) < 1e20 for x in v)]
    want = set()
    for q, x in {i: x for i, x in good if i % 100 == 0}.items():
        scored = sorted((-int(x @ y), i) for i, y in good if i != q and len(y) == len(x))[:10]
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == want


def test_stops_before_the_end():
    rng = np.random.default_rng(1)
    values = rng.integers(-5, 5, (4000, 3)).astype(np.int64)
    values[17] = 500
    lists = threshold_topk.SortedLists(np.arange(4000), values)
    met = []
    scores = lists.scores
    lists.scores = lambda at, q: met.append(len(at)) or scores(at, q)
    ids, best = lists.top(-1, np.array([3, 2, 1]), 1)
    assert ids.tolist() == [17] and best.tolist() == [3000] and sum(met) < 400
