import random
import re
import zlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from clearledger.llm import queries, sharding
from clearledger.llm.sharding import shard


def check(rows, texts):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    )
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert sorted(slots) == list(range(len(slots)))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_shards_have_near_equal_bytes_despite_a_hot_value(spark):
    rows = [(i, "x" * (i * 37 % 400) if i % 3 else "the same text", "en" if i % 2 else "de", "hot" if i % 3 else f"s{i % 9}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, shard string")
    sizes = check(shard(spark, df, n_shards=8).collect(), [(i, t) for i, t, *_ in rows])
    assert len(sizes) == 8
    assert max(sizes.values()) - min(sizes.values()) <= 3 * 401


@pytest.mark.parametrize("target", [500, 5000, 10**9])
def test_leaves_reach_the_target(spark, docs, target):
    texts = [(i, "y" * (i % 50)) for i in range(800)]
    sizes = check(shard(spark, docs(texts), target_bytes=target).collect(), texts)
    total = sum(sizes.values())
    assert all(v < 1.5 * target for v in sizes.values())
    assert len(sizes) == 1 or min(sizes.values()) > 0.7 * target - 51 or total < target


def test_widest_dimension_is_split_first(spark, docs):
    texts = [(i, "z") for i in range(64)]
    placed = shard(spark, docs(texts), n_shards=2, dimensions={"flat": F.lit(5), "wide": F.col("doc_id") * 1000}).collect()
    assert {r.shard for r in placed if r.doc_id < 32} == {0}
    assert {r.shard for r in placed if r.doc_id >= 32} == {1}


def test_odd_rows(spark, odd, nothing):
    check(shard(spark, odd, n_shards=4).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert shard(spark, nothing, n_shards=8).count() == 0


@pytest.mark.parametrize("i", [7, None])
def test_equal_rows_are_split(spark, docs, i):
    texts = [(i, "the same row")] * 64 + [(k, "z" * k) for k in range(20)]
    sizes = check(shard(spark, docs(texts), n_shards=8).collect(), texts)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 3 * 20


def test_a_last_row_with_most_bytes_is_split_off(spark, docs):
    texts = [(1, "a"), (2, "b" * 5000)]
    sizes = check(shard(spark, docs(texts), target_bytes=1000).collect(), texts)
    assert sorted(sizes.values()) == [2, 5001]


def brute(rows, k):
    """Shards (as lists of ids) of the tree over rows (id, text, lang, source) with distinct ids."""
    crc = lambda t: zlib.crc32(t.encode())
    nodes = [{"id": i, "size": len(t.encode()) + 1, "crc": crc(t), "tie": xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) >> 24, "dims": (len(t), crc(lang), crc(src))} for i, t, lang, src in rows]
    whole = [max(1, max(r["dims"][d] for r in nodes) - min(r["dims"][d] for r in nodes)) for d in range(3)]

    def split(node, k):
        if k == 1 or len(node) == 1:
            return [sorted(r["id"] for r in node)]
        reach = [(max(r["dims"][d] for r in node) - min(r["dims"][d] for r in node)) / whole[d] for d in range(3)]
        d = reach.index(max(reach))
        node = sorted(node, key=lambda r: (r["dims"][d], r["crc"], r["tie"]))
        total, upto, at = sum(r["size"] for r in node), 0, 0
        while upto * k < total * (k // 2):
            upto += node[at]["size"]
            at += 1
        left, right = node[: min(at, len(node) - 1)], node[min(at, len(node) - 1) :]
        own = round(k * sum(r["size"] for r in left) / total)
        own = max(1, k - len(right), min(own, k - 1, len(left)))
        return split(left, own) + split(right, max(1, k - own))

    return split(nodes, k)


@pytest.mark.parametrize("seed, n, k, tail", [(1, 20, 8, 1.1), (2, 20, 8, 0.6), (3, 60, 8, 0.8), (4, 200, 5, 1.5), (5, 6, 8, 1.0), (6, 500, 16, 0.7)])
def test_tree_equals_brute_force_and_never_has_more_shards(spark, seed, n, k, tail):
    """Sizes with heavy tails, down to one row with most of the bytes."""
    pick = random.Random(seed)
    rows = [(i, f"{i}" + "x" * min(20_000, int(20 * pick.paretovariate(tail))), pick.choice(["en", "de", "fr"]), pick.choice(["hot", "hot", "s1", "s2"])) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    placed = shard(spark, df, n_shards=k).collect()
    check(placed, [(i, t) for i, t, *_ in rows])
    found = defaultdict(list)
    for r in placed:
        found[r.shard].append(r.doc_id)
    assert [sorted(found[j]) for j in range(len(found))] == brute(rows, k)
    assert max(found) < k and len(found) == min(k, n)


def test_too_many_leaves_are_refused(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "MAX_LEAVES", 4)
    with pytest.raises(ValueError, match="raise target_bytes"):
        shard(spark, docs([(i, "abc") for i in range(100)]), target_bytes=8)


def test_plan_has_no_python(spark, sf_dir):
    plan = queries.op9_kd_tree_shards(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop|ExistingRDD", plan)
