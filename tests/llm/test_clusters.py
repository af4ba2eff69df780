"""Bisector tournament and cover-tree codes against plain loops in whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from candlewick.llm import bisector, cover_tree

SCHEMA = "vec_id long, embedding array<float>, label string, vec string, cluster string, size string, _k string"
ODD = [None, [float("nan")] * 4, [None] * 4, [float("inf"), 0.0, 0.0, 0.0], []]


def rows_of(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dims))
    made = [(int(i), [float(np.float32(x)) for x in spread * (base[i % 12] + 0.3 * rng.normal(size=dims))], None if i % 5 == 0 else f"l{i % 3}", *"abcd") for i in rng.permutation(n)]
    made += [(5000 + i, made[i % 3][1], "l1", *"abcd") for i in range(9)]  # copies, ties
    made += [(6000, made[0][1], None, *"abcd"), (6000, made[1][1], "", *"abcd"), (None, made[2][1], "l2", *"abcd")]
    made += [(7000 + i, None if v is None else v * (dims // 4) if v else v, "l1", *"abcd") for i, v in enumerate(ODD)]
    return made


def good(rows, scale, fits):
    out = []
    for i, v, label, *_ in rows:
        if v is not None and fits(len(v)) and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [math.floor(scale * x) for x in v], label))
    return out


def nearest(x, books):
    d = [sum((a - b) ** 2 for a, b in zip(x, m)) for m in books]
    return d.index(min(d)), min(d)


def lloyd(points, books, rounds):
    for _ in range(rounds):
        own = [nearest(p, books)[0] for p in points]
        for c in set(own):
            mine = [p for p, o in zip(points, own) if o == c]
            books[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return [nearest(p, books) for p in points], books


def plain_clusters(rows, k, rounds, dims, scale=1024):
    kept = good(rows, scale, lambda n: n == dims)
    digest = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"3:{i}".encode()).hexdigest())
    seeds = [v for _, v, _ in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    told, books = lloyd([v for _, v, _ in kept], seeds, rounds)
    inertia = {c: sum(d for o, d in told if o == c) for c in range(k)}
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), tuple(books[c])) for (i, _, _), (c, d) in zip(kept, told)), key=str)


@pytest.mark.parametrize("spread, k", [(1.0, 8), (2e4, 5)])
def test_clusters_equal_plain_lloyd(spark, spread, k):
    rows = rows_of(150, 8, 5, spread)
    told, centroids = bisector.bisector_clusters(spark.createDataFrame(rows, SCHEMA).repartition(3), k=k, rounds=4, dims=8)
    got = [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in told.join(centroids, "cluster").collect()]
    assert sorted(got, key=str) == plain_clusters(rows, k, 4, 8)


def test_planes_keep_the_smaller_number_on_ties():
    planes = bisector.Planes(np.array([[0, 0], [4, 0], [0, 4], [4, 0]], dtype=object))
    champion, square = planes.assign(np.array([[2, 2], [4, 1], [2, 0], [0, 3]]))
    assert champion.tolist() == [0, 1, 0, 2] and square.tolist() == [8, 1, 4, 1]


def test_numbers_beyond_64_bits_stay_exact():
    rng = np.random.default_rng(4)
    far = 2**40 + rng.integers(-1000, 1000, (60, 3))
    books = far[:5].astype(object)
    want = [nearest([int(x) for x in p], books.tolist()) for p in far]
    champion, square = bisector.Planes(books).assign(far)
    assert list(zip(champion.tolist(), square.tolist())) == want
    tree, order = cover_tree.build(far, np.ones(60, np.int64), leaf=2)
    assert cover_tree.assign(tree, books)[0].tolist() == [want[i][0] for i in order]
    with pytest.raises(OverflowError):
        bisector.Planes(np.array([[0] * 3], dtype=object)).assign(far)


def test_clusters_of_few_and_no_vectors(spark):
    few = [(2, [1.0, 2.0], "x", *"abcd"), (1, [1.0, 2.0], "x", *"abcd"), (3, [9.0, 9.0], "x", *"abcd")]
    told, centroids = bisector.bisector_clusters(spark.createDataFrame(few, SCHEMA), k=8, rounds=3, dims=2)
    assert centroids.count() == 3 and {(r.vec_id, r.distance) for r in told.collect()} == {(1, 0), (2, 0), (3, 0)}
    told, centroids = bisector.bisector_clusters(spark.createDataFrame([], SCHEMA))
    assert told.collect() == [] and centroids.collect() == []
    with pytest.raises(Exception, match="2\\^62"):
        bisector.bisector_clusters(spark.createDataFrame([(1, [3e30, 0.0], "", *"abcd")], SCHEMA), dims=2)
    with pytest.raises(ValueError):
        bisector.bisector_clusters(spark.createDataFrame([], SCHEMA), k=100_000)


def test_tree_covers_its_points_and_spares_comparisons():
    rng = np.random.default_rng(2)
    centers = rng.integers(-9000, 9000, (16, 8))
    points = np.unique(centers[rng.integers(0, 16, 3000)] + rng.integers(-60, 61, (3000, 8)), axis=0)
    counts = rng.integers(1, 5, len(points))
    tree, order = cover_tree.build(points, counts)
    assert sorted(order.tolist()) == list(range(len(points))) and (tree.points == points[order]).all()
    for lo, hi, center, radius, first, last in zip(tree.start, tree.end, tree.center, tree.radius, tree.first, tree.last):
        assert lo <= center < hi
        away = np.sqrt(((tree.points[lo:hi] - tree.points[center]) ** 2).sum(axis=1))
        assert away.max() <= radius * (1 + 1e-12)
        if first >= 0:
            assert tree.start[first] == lo and tree.end[last - 1] == hi and (tree.end[first : last - 1] == tree.start[first + 1 : last]).all()
            heads = tree.points[tree.center[first:last]]
            gaps = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(axis=2)) + np.eye(len(heads)) * 1e9
            assert gaps.min() > radius / 2 and tree.radius[first:last].max() <= radius / 2
    code, compared = cover_tree.assign(tree, centers)
    plain = ((tree.points[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (code == plain).all() and compared < len(points) / 4
    n, total = cover_tree.sums(tree, code, 16)
    for c in range(16):
        assert n[c] == tree.counts[plain == c].sum() and (total[c] == (tree.points * tree.counts[:, None])[plain == c].sum(axis=0)).all()


def plain_codes(rows, parts, entries, rounds, dims, scale=4096):
    kept = good(rows, scale, lambda n: n == dims)
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    width = dims // parts
    codes, errors, flat = [""] * len(kept), [0] * len(kept), []
    for p in range(parts):
        cut = lambda v: v[p * width : (p + 1) * width]  # noqa: B023, E731
        told, books = lloyd([cut(v) for _, v, _ in kept], [cut(v) for _, v, _ in first], rounds)
        flat += [x for m in books for x in m]
        for i, (c, d) in enumerate(told):
            codes[i] += f"{c:02x}"
            errors[i] += d
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(((i, c, e, by_label[label]) for (i, _, label), c, e in zip(kept, codes, errors)), key=str), flat


@pytest.mark.parametrize("spread", [1.0, 2e4])
def test_codes_equal_plain_lloyd(spark, spread, monkeypatch):
    monkeypatch.setattr(cover_tree, "LEAF", 2)
    rows = rows_of(180, 16, 9, spread)
    told, books = cover_tree.cover_tree_codes(spark.createDataFrame(rows, SCHEMA).repartition(3), rounds=4)
    want, flat = plain_codes(rows, 8, 16, 4, 16)
    got = [(r.vec_id, "".join(f"{c:02x}" for c in r.codes), r.error, r.label_error) for r in told.collect()]
    assert sorted(got, key=str) == want
    assert [(r["size"], list(r.codebooks)) for r in books.collect()] == [(16, flat)]


def test_codes_of_mixed_lengths_and_no_vectors(spark):
    rows = [(i, [float(i % 4)] * 8, "x", *"abcd") for i in range(20)] + [(i, [float(i)] * 16, "x", *"abcd") for i in range(20, 23)] + [(99, [1.0] * 7, "x", *"abcd")]
    told, books = cover_tree.cover_tree_codes(spark.createDataFrame(rows, SCHEMA))
    assert {r.vec_id for r in told.collect()} == set(range(23)) and sorted((r["size"], len(r.codebooks)) for r in books.collect()) == [(8, 128), (16, 48)]
    assert all(r.error == 0 and r.label_error == 0 for r in told.collect())
    told, books = cover_tree.cover_tree_codes(spark.createDataFrame([], SCHEMA))
    assert told.collect() == [] and books.collect() == []
