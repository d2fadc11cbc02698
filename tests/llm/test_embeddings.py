import math
import random

import numpy as np
import pytest

from clearledger.llm import embeddings
from clearledger.llm.embeddings import near_duplicates, plan, sketch_plan


def usable(v):
    return bool(v) and None not in v and all(math.isfinite(x) for x in v) and any(v)


def expected(rows):
    parent = {r[0]: r[0] for r in rows}
    links = dict.fromkeys(parent, 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = [r for r in rows if r[0] is not None and r[2] is not None and usable(r[1])]
    for i, (a, u, x, *_) in enumerate(good):
        for b, v, y, *_ in good[:i]:
            if x == y and len(u) == len(v):
                u_, v_ = np.array(u, dtype=float), np.array(v, dtype=float)
                if u_ @ v_ / math.sqrt(u_ @ u_) / math.sqrt(v_ @ v_) >= 0.93:
                    links[a] += 1
                    links[b] += 1
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (links[i], root(i)) for i in parent}


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, kept string")
    got = near_duplicates(spark, df).collect()
    assert len(got) == len(rows)
    want = expected([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows])
    for r in got:
        assert (r.n_links, r.component_id) == want[r.vec_id], r
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)


@pytest.mark.parametrize("block", [8, 512])
def test_clusters_of_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "BUCKET", 16)
    rng, rows = np.random.default_rng(11), []
    for label in range(3):
        centres = rng.standard_normal((6, 32))
        for k in range(120):
            v = centres[k % 6] * (1 if k % 5 else 3) + rng.standard_normal(32) * (0.3 if k % 3 else 0.0)
            rows.append((len(rows), v.tolist(), label))
    rows += [(1000 + i, rows[0][1], 0) for i in range(40)]
    check(spark, rows)


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 0), (2, one, 0), (3, [2.0, 4.0, 6.0], 0), (4, one, 1), (5, one, None), (6, None, 0), (7, [], 0),
        (8, [0.0] * 3, 0), (9, [1.0, None, 3.0], 0), (10, [float("nan"), 1.0, 1.0], 0), (11, [float("inf"), 1.0, 1.0], 0),
        (12, [1.0, 2.0], 0), (13, [1e-30, 2e-30, 3e-30], 0), (14, [-1.0, -2.0, -3.0], 0), (15, [1.0, 2.0, -0.0], 0), (16, [1.0, 2.0, 0.0], 0),
    ]
    check(spark, rows)
    df = spark.createDataFrame([(None, one, 0), (1, one, 0), (1, one, 0)], "vec_id long, embedding array<float>, label int")
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in near_duplicates(spark, df).collect()) == [
        ("1", 1, "1", True), ("1", 1, "1", True), ("None", 0, "None", True),
    ]
    assert near_duplicates(spark, df.limit(0)).count() == 0


def test_plan_keeps_the_chance_to_miss():
    same = 1 - math.acos(0.93) / math.pi
    for n in (1, 500, 10**4, 10**6, 10**9):
        bits, tables = plan(n)
        assert n / 2**bits <= embeddings.BUCKET or n < embeddings.BUCKET
        assert (1 - same**bits) ** tables <= embeddings.MISS


def test_random_pairs_at_the_threshold_are_found(spark):
    rng, rows = random.Random(12), []
    for i in range(300):
        u = np.array([rng.gauss(0, 1) for _ in range(16)])
        w = np.array([rng.gauss(0, 1) for _ in range(16)])
        u /= np.linalg.norm(u)
        w -= (w @ u) * u
        v = 0.931 * u + math.sqrt(1 - 0.931**2) * w / np.linalg.norm(w)
        rows += [(2 * i, u.tolist(), 0), (2 * i + 1, v.tolist(), 0)]
    check(spark, rows)


def test_sketch_keeps_the_chance_to_miss():
    differs = math.acos(0.93) / math.pi
    for bits in (1, 3, 4, 7, 21, 40):
        per, most = sketch_plan(bits, 0.93, 5e-7)
        n = 2 * per * bits
        assert per * bits <= 64 and n >= 64
        chance = lambda m: sum(math.comb(n, k) * differs**k * (1 - differs) ** (n - k) for k in range(m + 1, n + 1))
        assert chance(most) <= 5e-7 < chance(most - 1)


def test_doubles_are_compared_as_doubles(spark):
    u = [1.0, 0.0, 0.0]
    off = lambda c: [c, math.sqrt(1 - c * c), 0.0]
    rows = [(1, u, 0), (2, off(0.93 + 1e-12), 0), (3, [0.0, 0.0, 1.0], 0), (4, [off(0.93 - 1e-12)[0], 0.0, off(0.93 - 1e-12)[1]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(spark, df).collect()} == {
        1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4),
    }


def test_one_bucket_in_many_blocks(spark, monkeypatch):
    """A hot bucket: near copies of one vector, blocks of a few rows, some of them empty."""
    monkeypatch.setattr(embeddings, "BLOCK", 3)
    monkeypatch.setattr(embeddings, "CHUNK", 2)
    rng = np.random.default_rng(13)
    centre = rng.standard_normal(24)
    check(spark, [(i, (centre + 0.02 * rng.standard_normal(24)).tolist(), 0) for i in range(60)])
